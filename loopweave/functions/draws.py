"""Reproducible random draws: a hash of the seed and the row's key, never ``rand()``.

A lost task that runs again draws the same values, and any SQL engine with md5 can check them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(seed, parts) -> Column:
    return F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])


def hash_text(seed, *parts: Column) -> Column:
    """Hex md5 of ``seed|part|part...``, used as a random sort key."""
    return F.md5(_text(seed, parts))


def hash_int(seed, *parts: Column) -> Column:
    """Uniform integer in 0..2^32-1."""
    return F.conv(F.substring(hash_text(seed, *parts), 1, 8), 16, 10).cast("bigint")


def uniform_int(low: Column, high: Column, seed, *parts: Column) -> Column:
    """Uniform integer in low..high, both ends included."""
    return low + F.pmod(hash_int(seed, *parts), high - low + 1)


def uniform_float(low: Column, high: Column, seed, *parts: Column) -> Column:
    return low + (high - low) * hash_int(seed, *parts) / F.lit(float(2**32))


def draw_without_replacement(slots: int, k: int, seed, *parts: Column) -> Column:
    """Array of ``k`` different slot numbers out of 0..slots-1 (Floyd's sampling).

    Each step adds a draw from 0..j, or j itself when that number is taken; k hashes are
    enough for a uniform subset, so no slot table has to be built, ranked or joined.
    """
    if not 0 < k <= slots:
        raise ValueError(f"cannot draw {k} of {slots} slots")
    chosen = F.array().cast("array<bigint>")
    for j in range(slots - k, slots):
        t = F.pmod(hash_int(seed, *parts, F.lit(j)), F.lit(j + 1))
        chosen = F.array_append(chosen, F.when(F.array_contains(chosen, t), F.lit(j).cast("bigint")).otherwise(t))
    return chosen
