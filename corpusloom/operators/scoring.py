"""Losses of texts under n-gram models, the scorer that needs no network."""

from __future__ import annotations

from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import written
from .token_tables import BUCKET, COMMON_PAIRS, MEASURES, PART, UNIT, bucket_losses, bucketed_pairs, first_counts, head_rows, listed_counts, token_rows, word_counts


class Scorer(Protocol):
    """Anything that turns (key, ids) into (key, loss); the scorers below take texts for ``ids`` as well and split them in their tasks."""

    def score(self, rows: DataFrame, key: str, ids: str) -> DataFrame: ...


def token_counts(rows: DataFrame, key: str, ids: str) -> DataFrame:
    """(key, tok, k): how often a row has a token."""
    return rows.select(key, F.explode(ids).alias("tok")).groupBy(key, "tok").agg(F.count("*").alias("k"))


def adapted_counts(base: DataFrame, adapter: DataFrame, scale: float) -> DataFrame:
    """(tok, c): a model's counts with those of an adapter, weighted by ``scale``; the base stays as it is."""
    more = adapter.select("tok", (F.col("c") * scale).alias("_more"))
    return base.join(more, "tok", "full").select("tok", (F.coalesce("c", F.lit(0)) + F.coalesce("_more", F.lit(0.0))).alias("c"))


#: The most frequent tokens of a fitted text, at most so many, are looked up in the tasks; the others meet their counts in buckets.
FREQUENT = 200_000
#: Different words, and words, of a fitted text in one bucket, about.
BUCKET_TYPES, BUCKET_WORDS = 1 << 16, 1 << 19


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest count, in steps of a sixteenth of its power of two, that at most ``most`` rows of (c) reach."""
    power = F.floor(F.log2(F.col("c").cast("double"))).cast("int")
    step = F.floor(F.when(power > 4, F.col("c") / F.pow(F.lit(2.0), power - 4)).otherwise(F.col("c"))).cast("long")
    least, rows = 1, 0
    kinds = counts.where("c > 0").groupBy(power.alias("power"), step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).collect()  # at most 16 for each power of two
    for kind in sorted(kinds, key=lambda k: -k["low"]):
        rows += kind["n"]
        if rows > most:
            return kind["high"] + 1
    return least


class UnigramScorer:
    """Add-one smoothed unigram model of the given rows.

    Counts are written once.  Sums of logarithms are whole numbers, so a loss does
    not depend on the order of its parts, and equal texts have equal losses.
    """

    def __init__(self, fitted_on: DataFrame, ids: str):
        self._set(written(word_counts(fitted_on, ids)))
        words = self.counts.where(F.col("tok").isNotNull())
        least = least_count(words, FREQUENT)
        self.frequent = words.where(F.col("c") >= least).toArrow()  # at most FREQUENT
        types, n = words.where(F.col("c") < least).agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
        self.buckets = max(-(-types // BUCKET_TYPES), -(-n // BUCKET_WORDS))

    @classmethod
    def of_counts(cls, counts: DataFrame) -> UnigramScorer:
        """A model of (tok, c)."""
        new = cls.__new__(cls)
        new._set(counts)
        return new

    def _set(self, counts: DataFrame) -> None:
        self.counts, self.frequent = counts, None
        self.totals = counts.agg(F.sum("c").alias("total"), F.count("*").alias("types"))

    def _joined(self, rows: DataFrame, key: str, ids: str, measured: bool) -> DataFrame:
        """(key, head, high, low): parts of the sums of k log(c + 1), in the heads or beside them; tokens that the model has not seen add 0."""
        if self.frequent is not None:
            return head_rows(rows, self.counts, key, ids, self.frequent, measured, self.buckets).select(key, "head", F.lit(None).cast("long").alias("high"), F.lit(None).cast("long").alias("low"))
        whole = F.rint(F.log(F.col("c").cast("double") + 1) * UNIT).cast("long")
        parts = self.counts.select("tok", F.shiftright(whole, PART.bit_length() - 1).alias("_h"), whole.bitwiseAND(F.lit(PART - 1)).alias("_l"))
        per = token_rows(rows, key, ids, measured).join(parts, "tok", "left")
        return per.select(key, "head", (F.col("k") * F.col("_h")).alias("high"), (F.col("k") * F.col("_l")).alias("low"))

    def _losses(self, per: DataFrame, key: str, *heads: Column) -> DataFrame:
        def add(part: str) -> Column:
            return F.coalesce(F.sum(F.coalesce(f"head.{part}", part)), F.lit(0))

        sums = per.groupBy(key).agg(F.sum("head.n").alias("n_pos"), add("high").alias("_high"), add("low").alias("_low"), *heads).where("n_pos > 0")
        logs = F.col("_high") / (UNIT // PART) + F.col("_low") / UNIT
        loss = F.log(F.col("total") + F.col("types")) - logs / F.col("n_pos")
        return sums.crossJoin(F.broadcast(self.totals)).withColumn("loss", loss)  # one row

    def score(self, rows: DataFrame, key: str, ids: str) -> DataFrame:
        """(key, loss, n_pos): mean negative log likelihood, in nats, of rows with tokens."""
        return self._losses(self._joined(rows, key, ids, False), key).select(key, "loss", "n_pos")

    def score_measured(self, rows: DataFrame, key: str, ids: str) -> DataFrame:
        """``rows`` that have tokens, without these, with loss, unique_r, rep_r and rep_ng4: all from one reading of the rows."""
        out = self._losses(self._joined(rows, key, ids, True), key, F.collect_list("head").alias("_heads"))
        return out.select("loss", F.explode("_heads").alias("h")).where("h.n > 0").select("h.row.*", "loss", *(f"h.{m}" for m in MEASURES))


class BigramScorer:
    """Add-one smoothed bigram model of the given rows; a row of n tokens has n - 1 positions.

    Pairs are shuffled once, packed by stretches of texts, to buckets by their first word,
    and by both words where the first is common; a bucket counts its pairs and first
    words and gives each document its part of the loss.  The commonest pairs are looked
    up in the tasks instead.  Sums of logarithms are whole numbers, as in the unigram
    model.  A pair with a null token counts as unseen.
    """

    def __init__(self, fitted_on: DataFrame, ids: str):
        self.rows, self.ids = fitted_on, ids
        counts = written(first_counts(fitted_on, ids))
        words = counts.where("not pair and a is not null")
        self.total = total = counts.where("not pair").agg(F.sum("c").alias("total")).first()["total"] or 0
        self.types = words.count()
        self.firsts = words.where(F.col("c") * FREQUENT >= F.greatest(F.lit(total), F.lit(1))).select("a", "c").toArrow()  # at most FREQUENT
        common = counts.where("pair and a is not null and b is not null").where(F.col("c") * COMMON_PAIRS >= total)
        self.listed = common.select("a", "b").toArrow()  # at most COMMON_PAIRS
        seen = listed_counts(fitted_on, ids, self.listed)
        place = pc.index_in(self.listed.column("a"), value_set=self.firsts.column("a").combine_chunks())
        first = self.firsts.column("c").to_numpy()[place.to_numpy()] if len(seen) else seen
        self.logs = np.log(first + float(self.types)) - np.log(seen + 1.0)

    def _pairs(self, rows: DataFrame, key: str, ids: str, fit: bool, scored: bool) -> DataFrame:
        pairs = bucketed_pairs(rows, key, ids, self.firsts, self.listed, self.logs, max(1, -(-self.total // BUCKET)))
        return pairs.withColumns({"fit": F.lit(fit), "scored": F.lit(scored)})

    def score(self, rows: DataFrame, key: str, ids: str) -> DataFrame:
        """(key, loss, n_pos): mean negative log likelihood, in nats, of rows with two tokens or more."""
        own = rows is self.rows and ids == self.ids  # read once
        pairs = self._pairs(rows, key, ids, own, True)
        if not own:
            kind = dict(rows.dtypes)[key]
            model = self.rows.select(F.lit(None).cast(kind).alias(key), F.col(self.ids).alias("_model"))
            pairs = pairs.unionByName(self._pairs(model, key, "_model", True, False))
        firsts, types = self.firsts, self.types

        def count(t: pa.Table) -> pa.Table:
            return bucket_losses(t, firsts, types)

        parts = pairs.groupBy("bucket").applyInArrow(count, f"key {dict(rows.dtypes)[key]}, n long, high long, low long")
        sums = parts.groupBy(F.col("key").alias(key)).agg(F.sum("n").alias("n_pos"), F.sum("high").alias("high"), F.sum("low").alias("low")).where("n_pos > 0")
        return sums.select(key, ((F.col("high") / (UNIT // PART) + F.col("low") / UNIT) / F.col("n_pos")).alias("loss"), "n_pos")
