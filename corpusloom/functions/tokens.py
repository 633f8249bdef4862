"""Word tokens and repetition measures over token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def unique_ratio(ids: Column) -> Column:
    return F.size(F.array_distinct(ids)) / F.greatest(F.lit(1), F.size(ids))


def repeat_ratio(ids: Column) -> Column:
    """Share of neighbours that are equal; 0 for fewer than two tokens."""
    n = F.size(ids)
    pairs = F.zip_with(F.slice(ids, 2, F.greatest(n - 1, F.lit(0))), F.slice(ids, 1, F.greatest(n - 1, F.lit(0))), lambda a, b: a == b)
    return F.when(n > 1, F.size(F.filter(pairs, lambda x: x)) / (n - 1)).otherwise(F.lit(0.0))


def ngram_repeat_ratio(ids: Column, width: int = 4) -> Column:
    """1 - distinct / all n-grams; 0 for fewer tokens than the width.

    N-grams count by 64-bit hashes: distinct arrays of arrays would compare all pairs.
    """
    n = F.size(ids)
    starts = F.sequence(F.lit(1), F.greatest(n - (width - 1), F.lit(1)))
    grams = F.transform(starts, lambda i: F.xxhash64(F.slice(ids, i, width)))
    return F.when(n >= width, 1 - F.size(F.array_distinct(grams)) / F.size(grams)).otherwise(F.lit(0.0))


def suspicious(loss: Column, unique: Column, repeat: Column, ngram: Column) -> Column:
    """Rows that look degenerate or whose loss is no finite number."""
    return (
        (repeat > 0.2) | (ngram > 0.5) | (unique < 0.05)
        | loss.isNull() | F.isnan(loss) | (F.abs(loss) == F.lit(float("inf")))
    )
