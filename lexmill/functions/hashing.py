"""Checksums and hash-to-unit-interval: built-in expressions, and one Arrow function for the byte-wise checksum."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Basis and prime of the 64-bit checksum, and its text prefix. The basis is not
# the standard FNV one. The prime is 2**40 + FNV_PRIME_LOW.
FNV_BASIS = 1469598103934665603
FNV_PRIME_LOW = 435
FNV_PREFIX = "fnv1a64:"

_FNV_PRIME = (1 << 40) + FNV_PRIME_LOW
#: Bytes that are folded at once; the arrays made of them take some fifty times as much.
_FOLDED_BYTES = 1 << 18
_LIMB = 0xFFFFFFFF
_UNIT_BITS = 52
CHECKSUM_MODULUS = 1 << 60


def _fold_fnv(states: np.ndarray, octets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Fold the bytes of strings that lie one after the other, none of them empty, each into its state.

    A step xors a byte into the lowest eight bits and multiplies by the prime. The lowest eight bits depend on nothing above them, and as the
    prime is odd, each of their bits is a running xor once those below it are known: eight scans over all bytes. With them known, the xor is
    an addition, so the checksum is a polynomial in the prime.
    """
    starts = np.cumsum(lengths) - lengths
    basis = np.repeat(states.astype(np.uint8), lengths)
    mixed = np.zeros_like(octets)  # the lowest eight bits after the xor
    for bit in range(8):
        flips = (octets ^ (mixed * np.uint8(_FNV_PRIME & 0xFF))) & np.uint8(1 << bit)
        earlier = np.bitwise_xor.accumulate(flips) ^ flips
        earlier ^= np.repeat(earlier[starts], lengths)
        mixed |= (earlier ^ basis ^ octets) & np.uint8(1 << bit)
    added = (mixed.astype(np.int64) - (mixed ^ octets)).view(np.uint64)
    powers = np.cumprod(np.full(lengths.max(), _FNV_PRIME, np.uint64))
    added *= powers[np.repeat(starts + lengths - 1, lengths) - np.arange(len(octets))]
    return states * powers[lengths - 1] + np.add.reduceat(added, starts)


def _fnv_of(octets: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksums of strings by their ends in ``octets``, a bounded number of bytes at a time, whatever the length of a string."""
    starts = np.concatenate([[0], ends[:-1]])
    states = np.full(len(ends), FNV_BASIS, np.uint64)
    first = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _FOLDED_BYTES, "right")))
        for at in range(int(starts[first]), int(ends[last - 1]), _FOLDED_BYTES):  # more than once only for one long string
            stop = min(at + _FOLDED_BYTES, int(ends[last - 1]))
            lengths = np.minimum(ends[first:last], stop) - np.maximum(starts[first:last], at)
            some = first + np.flatnonzero(lengths)
            states[some] = _fold_fnv(states[some], octets[at:stop], lengths[lengths > 0])
        first = last
    return states


def _fnv_bits(text: Column) -> Column:
    """The 64-bit checksum of the UTF-8 bytes as a long with the same bits; a null text counts as empty."""

    @F.arrow_udf("bigint")
    def fold(texts: pa.Array) -> pa.Array:
        if len(texts) == 0:
            return pa.array([], pa.int64())
        raw = texts.fill_null("").cast(pa.large_binary())
        _, offsets, data = raw.buffers()
        bounds = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
        octets = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
        return pa.array(_fnv_of(octets, bounds[1:] - bounds[0]).view(np.int64))

    return fold(text.cast("string"))


def fnv_checksum(text: Column) -> Column:
    """``fnv1a64:<hex>`` of a string. Set checksums of bulk data use :func:`row_hash`."""
    return F.concat(F.lit(FNV_PREFIX), F.lower(F.hex(_fnv_bits(text))))


def fnv_unit_interval(text: Column) -> Column:
    """The 64-bit checksum divided by its largest value."""
    bits = _fnv_bits(text)
    high, low = F.shiftrightunsigned(bits, 32), bits.bitwiseAND(F.lit(_LIMB))
    value = high.cast("double") * F.lit(float(1 << 32)) + low.cast("double")
    return value / F.lit(float((1 << 64) - 1))


def unit_bits(key: Column) -> Column:
    """The first 52 bits of the key's MD5 as a long: exact in a double, equal in every engine."""
    return F.conv(F.substring(F.md5(F.encode(key, "UTF-8")), 1, _UNIT_BITS // 4), 16, 10).cast("long")


def unit_interval(key: Column) -> Column:
    """Hash to [0, 1)."""
    return unit_bits(key) / F.lit(float(1 << _UNIT_BITS))


def row_hash(*parts: Column) -> Column:
    """A 60-bit row hash for mergeable set checksums: ``bit_xor`` of it does not depend on partitioning."""
    joined = F.concat_ws(":", *[part.cast("string") for part in parts])
    return F.conv(F.substring(F.md5(F.encode(joined, "UTF-8")), 1, 15), 16, 10).cast("long")


#: Rolling checksums are polynomials in this base over two prime fields below 2**31, so that products fit a long.
ROLLING_BASE, ROLLING_MODULI = 1_000_003, (2_147_483_647, 2_147_483_629)
ROLLING_PREFIX = "rolling62:"


def rolling_unit(hash60: Column) -> Column:
    """The rolling checksum of a sequence of one element.

    Rolling checksums are a monoid: a pair (weight, value) for each field, where the weight is the base to the power of the length. They join
    in order and in any grouping, so parts of a sequence are folded where they are and nothing is numbered.
    """
    fields = []
    for place, modulus in enumerate(ROLLING_MODULI):
        fields += [F.lit(ROLLING_BASE).cast("long").alias(f"weight{place}"), (hash60 % F.lit(modulus)).alias(f"value{place}")]
    return F.struct(*fields)


def rolling_join(left: Column, right: Column) -> Column:
    """The rolling checksum of two sequences one after the other."""
    fields = []
    for place, modulus in enumerate(ROLLING_MODULI):
        weight, value = f"weight{place}", f"value{place}"
        fields.append((left[weight] * right[weight] % F.lit(modulus)).alias(weight))
        fields.append(((left[value] * right[weight] + right[value]) % F.lit(modulus)).alias(value))
    return F.struct(*fields)


def rolling_fold(parts: Column) -> Column:
    """The rolling checksum of an array of rolling checksums, in its order."""
    nothing = [F.lit(int(name == "weight")).cast("long").alias(f"{name}{place}") for place in (0, 1) for name in ("weight", "value")]
    return F.aggregate(parts, F.struct(*nothing), rolling_join)


def rolling_checksum(rolled: Column) -> Column:
    """Both values as one hexadecimal number."""
    return F.concat(F.lit(ROLLING_PREFIX), F.lower(F.hex(F.shiftleft(rolled["value0"], 31).bitwiseOR(rolled["value1"]))))


def hex_checksum(value: Column) -> Column:
    return F.concat(F.lit("md5x60:"), F.lower(F.hex(F.coalesce(value, F.lit(0)))))


def bag_checksum(row_hashes: Column) -> Column:
    """Aggregate: a checksum of a bag of rows, the same for any order and partitioning."""
    total = F.sum(row_hashes.cast("decimal(20,0)"))
    return hex_checksum((total % F.lit(CHECKSUM_MODULUS).cast("decimal(20,0)")).cast("long"))
