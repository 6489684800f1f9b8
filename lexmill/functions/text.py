"""Small scalar functions over text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.normalize import normalize

# Marker of a leading blank, how it and its mis-decoded forms are shown, escapes.
SPACE_MARKER = "▁"
VISIBLE_MARKER = "[ws]"
MARKER_FORMS = ("▁", "â–\u0081", "â–")
NAMED_ESCAPES = (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))

# Source kinds.
PARQUET_CORPUS = "parquet_corpus_text"
SUPPLEMENTAL_CORPUS = "supplemental_corpus_text"
BASE_TRAINING = "base_training"
CONTEXTUALIZATION = "contextualization"
CUSTOM_VERBALIZATION = "custom_verbalization"
SMALL_SUPERVISED = "small_supervised"
HELD_OUT = "held_out_sample"
CORPUS_INVENTORY = "corpus_inventory"
SUPPLEMENTAL_PREFIX = "supplemental-"


def byte_length(text: Column) -> Column:
    """UTF-8 length; every "character count" of the reports is this."""
    return F.octet_length(text).cast("long")


def encode_hex(text: Column) -> Column:
    return F.lower(F.hex(F.encode(text, "UTF-8")))


def decode_hex(digits: Column) -> Column:
    """Inverse of :func:`encode_hex`; an odd length or a bad digit is an error."""
    valid = digits.rlike(r"^(?:[0-9a-fA-F]{2})*\z")
    problem = F.raise_error(F.concat(F.lit("malformed hex payload: "), digits)).cast("string")
    return F.when(digits.isNull(), None).when(valid, F.decode(F.unhex(digits), "UTF-8")).otherwise(problem)


def visible(text: Column) -> Column:
    """Show the blank marker as ``[ws]`` and escape control bytes."""
    for form in MARKER_FORMS:
        text = F.replace(text, F.lit(form), F.lit(VISIBLE_MARKER))
    named = dict(NAMED_ESCAPES)
    for code in [*range(0x20), 0x7F]:
        text = F.replace(text, F.lit(chr(code)), F.lit(named.get(chr(code), f"\\x{code:02x}")))
    return text


def text_lines(text: Column) -> Column:
    """All lines of a text, split on LF only, each without one trailing CR; no line after a final LF."""
    body = F.regexp_replace(text, r"\n\z", "")
    lines = F.transform(F.split(body, "\n"), lambda line: F.regexp_replace(line, r"\r\z", ""))
    return F.when(F.octet_length(text) > 0, lines).otherwise(F.array().cast("array<string>"))


def normalized_lines(text: Column) -> Column:
    """The non-empty lines of a text, each normalised on its own."""
    return F.filter(F.transform(text_lines(text), normalize), lambda line: line != "")


def shard_name(shard: Column) -> Column:
    return F.format_string("shard-%06d.txt", shard)


def sampling_key(path: Column, line_no: Column, text: Column) -> Column:
    return F.concat_ws(":", path, line_no.cast("string"), text)


def example_label(example_id: Column, side: Column) -> Column:
    """``<id>.input`` or ``<id>.output``."""
    return F.concat_ws(".", F.coalesce(example_id, F.lit("")), side)


def is_supplemental(path: Column) -> Column:
    """True when the file name, at any depth, starts with the supplemental prefix."""
    return F.element_at(F.split(path, "/"), -1).startswith(SUPPLEMENTAL_PREFIX)


def corpus_kind(path: Column) -> Column:
    return F.when(is_supplemental(path), F.lit(SUPPLEMENTAL_CORPUS)).otherwise(F.lit(PARQUET_CORPUS))


def parse_corpus_kind(label: Column) -> Column:
    """Only the two corpus kinds are valid in an index; anything else becomes null."""
    return F.when(label.isin(PARQUET_CORPUS, SUPPLEMENTAL_CORPUS), label)


def ratio(numerator: Column, denominator: Column) -> Column:
    """0.0 when the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double")).otherwise(F.lit(0.0))


def utc_text(moment: Column | None = None) -> Column:
    moment = F.current_timestamp() if moment is None else moment
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``; listing columns hold full URIs, the root may lack its scheme."""
    tail = root.rstrip("/").split("://", 1)[-1].split(":", 1)[-1]
    tail = "/" + tail.lstrip("/")
    plain = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    return F.substr(plain, F.instr(plain, F.lit(tail + "/")) + F.lit(len(tail) + 1))


def scanned_path(root: str) -> Column:
    """Path below ``root`` of the file a row was read from. File metadata is percent-encoded, listings are not."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return relative_path(F.url_decode(encoded), root)
