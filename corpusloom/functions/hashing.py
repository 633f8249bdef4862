"""Repeatable choice: an order and uniform numbers from a seed and a stable key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded(seed: str, *keys: Column) -> Column:
    """md5 of the seed and the keys: sorts rows into a repeatable random order."""
    return F.md5(F.concat_ws(":", F.lit(seed), *(k.cast("string") for k in keys)).cast("binary"))


def number(digest: Column) -> Column:
    """60 bits of a hex digest as a BIGINT."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def uniform(digest: Column) -> Column:
    """A number in [0, 1) from a hex digest."""
    return number(digest) / F.lit(float(1 << 60))


def short_sha(text: Column, chars: int) -> Column:
    return F.substring(F.sha2(text, 256), 1, chars)
