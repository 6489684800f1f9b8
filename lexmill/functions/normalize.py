"""The text normaliser, as one built-in Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The project normaliser's literal replacements, in order of application.
NORMALIZER_NAME = "english_project_v1"
LITERAL_REPLACEMENTS = (
    ("\r\n", "\n"),
    ("\r", "\n"),
    ("\t", " "),
    ("‘", "'"),
    ("’", "'"),
    ("“", '"'),
    ("”", '"'),
    ("–", "-"),
    ("—", " - "),
    ("…", "..."),
)
# Whitespace is the C locale's: blank, LF, VT and FF (TAB and CR are gone by then). NBSP and
# other Unicode blanks are text. ``\s`` and ``$`` are avoided on purpose: they mean other things.
# The patterns match only runs that change, so clean text is scanned but never rebuilt.
NEWLINE_RUN = r"[ \x0B\f]+\n[ \x0B\f\n]*|\n[ \x0B\f\n]+"
BLANK_RUN = r"[ \x0B\f]{2,}|[\x0B\f]"
# Texts without any of these have nothing to replace or collapse. Curly quotes, dashes and the
# ellipsis share their first two UTF-8 bytes, E2 80.
UNCLEAN = ("\ufeff", "\r", "\t", "\v", "\f", "  ", " \n", "\n ", "\n\n")
PUNCTUATION_BYTES = b"\xe2\x80"


def strip_bom(text: Column) -> Column:
    """Drop one leading byte order mark."""
    return F.regexp_replace(text, "^\ufeff", "")


def unify_characters(text: Column) -> Column:
    """Map line ends, tabs, curly quotes, dashes and the ellipsis to ASCII."""
    for needle, replacement in LITERAL_REPLACEMENTS:
        text = F.replace(text, F.lit(needle), F.lit(replacement))
    return text


def collapse_space(text: Column) -> Column:
    """One newline for a whitespace run that holds one, else one blank."""
    return F.regexp_replace(F.regexp_replace(text, NEWLINE_RUN, "\n"), BLANK_RUN, " ")


def trim_space(text: Column) -> Column:
    """Drop blanks and newlines at both ends."""
    return F.trim(text, F.lit(" \n"))


def null_to_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def needs_cleaning(text: Column) -> Column:
    """Plain byte searches, so that clean text never meets a regular expression."""
    unclean = F.contains(text.cast("binary"), F.lit(PUNCTUATION_BYTES))
    for part in UNCLEAN:
        unclean = unclean | F.contains(text, F.lit(part))
    return unclean


def normalize(text: Column) -> Column:
    """The whole normaliser; a null text gives the empty string."""
    cleaned = F.when(needs_cleaning(text), collapse_space(unify_characters(strip_bom(text))))
    return trim_space(F.coalesce(cleaned, text, F.lit("")))
