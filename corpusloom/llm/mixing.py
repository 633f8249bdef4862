"""Mixing sources to target weights by iterative proportional fitting (raking).

Tokens are counted by (source, language, topic) cell; the cells' weights are
scaled to the target share of each source, then language, then topic, until all
three marginals hold.  Raking runs under the bound that no token can be drawn
more than once, so the margins hold in the sample itself.  A document is sampled
with its cell's probability, by a hash of its id, so the draw repeats and does
not depend on partitions or on which executor ran it.

Everything is DataFrame work; raking runs over cells, whose number is that of
combinations, not of documents, and only sums come to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable, table

MARGINS = ("source", "lang", "topic")
NONE = "(none)"
FRACTION, SEED, ROUNDS, TOLERANCE = 0.5, 17, 40, 1e-6
#: Sources are tempered: a source with n tokens aims at a share in proportion to n ** this.
SOURCE_POWER = 0.5
#: Topics likewise.
TOPIC_POWER = 0.8
LANG_SHARES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}


def token_count() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic() -> Column:
    """The kind of text, from its form: empty, brief, marked (symbols), listed (many lines) or prose."""
    text = F.coalesce("text", F.lit(""))
    marks = F.length(text) - F.length(F.translate(text, "#$%&*|", ""))
    lines = F.length(text) - F.length(F.translate(text, "\n", ""))
    n = F.col("n_tokens")
    return (
        F.when(n == 0, "empty").when(marks > n, "marked").when(n < 100, "brief").when(lines * 20 > n, "listed").otherwise("prose")
    )


def described(docs: DataFrame, topic_of: Column | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens) of every row; null categories become ``(none)``."""
    base = docs.select("doc_id", "text", "source", "lang").withColumn("n_tokens", token_count())
    return base.select(
        "doc_id",
        *(F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")),
        (topic() if topic_of is None else F.coalesce(topic_of.cast("string"), F.lit(NONE))).alias("topic"),
        "n_tokens",
    )


def target_shares(cells: DataFrame) -> dict[str, DataFrame]:
    """The query's targets as (value, share): tempered sources and topics, fixed languages."""
    lang = F.lit(0.0)
    for name, share in LANG_SHARES.items():
        lang = F.when(F.col("value") == name, share).otherwise(lang)
    sums = {m: cells.groupBy(F.col(m).alias("value")).agg(F.sum("tokens").alias("tokens")).where("tokens > 0") for m in MARGINS}
    return {
        "source": sums["source"].select("value", F.pow("tokens", F.lit(SOURCE_POWER)).alias("share")),
        "lang": sums["lang"].select("value", lang.alias("share")).where("share > 0"),
        "topic": sums["topic"].select("value", F.pow("tokens", F.lit(TOPIC_POWER)).alias("share")),
    }


def aims(cells: DataFrame, targets: dict[str, DataFrame], fraction: float) -> DataFrame | None:
    """``cells`` with ``asked_<margin>`` and ``aim_<margin>``, shares of the sample for the cell's value; None without tokens.

    ``targets`` has (value, share >= 0) for each margin; shares are normalised
    over the values that occur.  A value without a target is asked for the share
    it has in the corpus.  A value that has too few tokens for its share aims at
    all it has, and the others at what is left, in proportion.
    """
    now = cells
    for m, shares in targets.items():
        shares = shares.groupBy("value").agg(F.sum("share").alias("share"))
        sums = cells.groupBy(F.col(m).alias("value")).agg(F.sum("tokens").cast("double").alias("had"))
        both = sums.join(shares, "value", "left")
        given, missing, all_tokens = both.where("had > 0").agg(
            F.sum("share"), F.sum(F.when(F.col("share").isNull(), F.col("had"))), F.sum("had")
        ).first()
        if not all_tokens:
            return None
        rest = (missing or 0.0) / all_tokens
        aim = F.when(F.col("share").isNull(), F.col("had") / all_tokens).otherwise(
            F.col("share") * F.lit((1 - rest) / given if given else 0.0)
        )
        wanted = durable(both.where("had > 0").select("value", aim.alias("asked"), (F.col("had") / (fraction * all_tokens)).alias("most")))
        scale = 1.0
        for _ in range(100):  # each pass finds a value that is short, or ends
            full = F.col("asked") * scale >= F.col("most")
            fixed, free = wanted.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("asked")))).first()
            better = (1.0 - (fixed or 0.0)) / free if free else scale
            if better <= scale * (1 + 1e-12):
                break
            scale = better
        wanted = wanted.select(F.col("value").alias(m), F.col("asked").alias(f"asked_{m}"), F.least(F.col("asked") * scale, F.col("most")).alias(f"aim_{m}"))
        now = now.join(wanted, m, "left").fillna(0.0, [f"asked_{m}", f"aim_{m}"])
    return now


def rake(cells: DataFrame, targets: dict[str, DataFrame], fraction: float = 1.0, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` with ``weight`` and ``probability``: the sampling probability of the cell's tokens.

    Iterative proportional fitting under a bound: each step scales the cells of a
    value so that what is expected of it in the sample, ``tokens * min(1, weight /
    tokens)`` summed over its cells, is its share of ``fraction`` of all tokens.
    Cells that reach their bound stay there and the others make up for it, so the
    margins hold in the sample and not only before the bound.  ``missed_<margin>``
    is the share of the sample that the value has beyond what was asked for: 0
    within ``tolerance`` unless the margins cannot all be met in ``rounds``
    rounds, for instance with too few tokens of a value.
    """
    now = aims(cells, targets, fraction)
    if now is None:
        none = F.lit(0.0)
        return cells.withColumns({"weight": none, "probability": none, **{f"missed_{m}": none for m in targets}})
    n = F.col("tokens").cast("double")
    everything = cells.agg(F.sum("tokens").cast("double")).first()[0]
    budget = fraction * everything
    now = durable(now.withColumn("weight", n * fraction))
    expected = F.least(F.col("weight"), n)
    for done in range(1, rounds + 1):
        for m in targets:
            each = Window.partitionBy(m)
            aim = F.col(f"aim_{m}") * budget
            full = F.col("weight") >= n
            # The cells below their bound have to bring what the full ones leave; where these bring too much, all come down.
            fixed = F.sum(F.when(full, n).otherwise(0.0)).over(each)
            free = F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).over(each)
            scale = F.when((fixed < aim) & (free > 0), (aim - fixed) / free).otherwise(aim / F.nullif(F.sum(expected).over(each), F.lit(0.0)))
            now = now.withColumn("weight", F.coalesce(F.col("weight") * scale, F.lit(0.0)))
        if done % 5 == 0 or done == rounds:
            now = durable(now)
            gaps = [now.groupBy(m).agg(F.abs(F.sum(expected) / budget - F.max(f"aim_{m}")).alias("e")).agg(F.max("e").alias("e")) for m in targets]
            if max(g.first()[0] for g in gaps) < tolerance:
                break
    for m in targets:
        missed = F.sum(expected).over(Window.partitionBy(m)) / budget - F.col(f"asked_{m}")
        now = now.withColumn(f"missed_{m}", F.when(F.abs(missed) < tolerance, 0.0).otherwise(missed))
    return now.withColumn("probability", F.when(n > 0, F.least(F.lit(1.0), F.col("weight") / n)).otherwise(0.0)).drop(*(f"{k}_{m}" for m in targets for k in ("aim", "asked")))


def sampled(docs: DataFrame, fraction: float = FRACTION, seed: int = SEED, topic_of: Column | None = None, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, probability, missed_<margin>, kept) of every row.

    Texts without tokens belong to no cell that weighs anything: probability 0,
    not kept.  Rows of the same doc_id share their draw; a null doc_id draws like
    any other.  ``missed_<margin>`` says by how much of the sample the document's
    value falls short of or exceeds its target.  Whole texts of any length count;
    an empty table gives an empty result; columns other than doc_id, text, source
    and lang are ignored.
    """
    base = durable(described(docs, topic_of))
    cells = durable(base.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")))
    raked = rake(cells, targets or target_shares(cells), fraction)
    missed = [f"missed_{m}" for m in MARGINS if f"missed_{m}" in raked.columns]
    cell = raked.select(*MARGINS, "probability", *missed)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    out = base.join(cell, list(MARGINS))
    return out.select("doc_id", *MARGINS, "n_tokens", "probability", *missed, (draw < F.col("probability")).alias("kept"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled documents.

    Texts without tokens are not drawn; rows of one doc_id share their draw, and
    stay together when one of them is kept.  An empty table stays empty.
    """
    keep = sampled(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["kept_id"]), "left_semi")
