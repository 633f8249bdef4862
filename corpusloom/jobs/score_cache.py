"""A cache of scored rows that is kept up to date shard by shard.

Scores lie under the version of model and rules that made them, so a change of
either starts an empty cache beside the old one.  Below it they are partitioned by
a hash of the shard's key and the digest of its content; an update writes the
partitions of missing shards only, over what an update that broke off has left, and
then notes the shards in a ledger.  A shard counts once the ledger has it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import exists, written

LEDGER = "shard_hash string, shard_key string, digest string, n_rows long, fields string"


def version_of(*parts: object) -> str:
    """A short name for whatever the scores rest on: model, rules, window length."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]


class ScoreCache:
    """Scored rows of shards under ``path``, for one version of model and rules.

    ``score`` turns rows with shard_key into rows with shard_key and scores; it must
    score a row alike whatever other rows come with it.
    """

    def __init__(self, spark: SparkSession, path: str, version: str, score: Callable[[DataFrame], DataFrame]):
        self.spark, self.at, self.score = spark, f"{path.rstrip('/')}/version={version}", score

    def _hashed(self, shards: DataFrame) -> DataFrame:
        """(shard_key, digest, shard_hash) of the shards asked for; a null digest is one of its own."""
        digest = F.coalesce("digest", F.lit("")) if "digest" in shards.columns else F.lit("")
        named = shards.where("shard_key is not null").select("shard_key", digest.alias("digest")).distinct()
        return named.withColumn("shard_hash", F.substring(F.sha2(F.concat_ws("|", "digest", "shard_key"), 256), 1, 16))

    def ledger(self) -> DataFrame:
        if not exists(self.spark, f"{self.at}/ledger/_SUCCESS"):
            return self.spark.range(0).select(*(F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in LEDGER.split(", "))))  # empty, without Python tasks
        return self.spark.read.schema(LEDGER).parquet(f"{self.at}/ledger").dropDuplicates(["shard_hash"])

    def missing(self, shards: DataFrame) -> DataFrame:
        """(shard_key, digest, shard_hash) of the shards that are not scored yet, under this version and content."""
        return self._hashed(shards).join(self.ledger().select("shard_hash"), "shard_hash", "left_anti")

    def update(self, shards: DataFrame, rows: DataFrame) -> DataFrame:
        """Scores what is missing and returns it: (shard_key, digest, shard_hash).

        ``rows`` has shard_key and what ``score`` needs.  A second update of the
        same shards reads the ledger only.  A shard without rows is noted as well.
        """
        todo = written(self.missing(shards))
        if todo.isEmpty():
            return todo
        scored = self.score(rows.join(todo.select("shard_key"), "shard_key", "left_semi"))
        kept = scored.join(todo.select("shard_key", "shard_hash"), "shard_key")
        writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard_hash")
        writer.parquet(f"{self.at}/scores")
        # Counted from what was written: the ledger never says more than the files hold.
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scored.schema)
        there = self._scores(fields)
        counts = todo.select("shard_hash").limit(0).withColumn("n_rows", F.lit(0).cast("long")) if there is None else (
            there.join(todo.select("shard_hash"), "shard_hash", "left_semi").groupBy("shard_hash").agg(F.count("*").alias("n_rows"))
        )
        noted = todo.join(counts, "shard_hash", "left").select(
            "shard_hash", "shard_key", "digest", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), F.lit(fields).alias("fields")
        )
        noted.write.mode("append").parquet(f"{self.at}/ledger")
        return todo

    def _scores(self, fields: str) -> DataFrame | None:
        """All scored rows; None before any was written."""
        if not exists(self.spark, f"{self.at}/scores"):
            return None
        return self.spark.read.schema(f"{fields}, shard_hash string").parquet(f"{self.at}/scores")

    def read(self, shards: DataFrame) -> DataFrame | None:
        """Scored rows of all the shards, or None if any is missing or none is asked for."""
        asked = self._hashed(shards)
        noted = asked.join(self.ledger().select("shard_hash", "fields"), "shard_hash", "left")
        n, known, fields = noted.agg(F.count("*"), F.count("fields"), F.max("fields")).first()
        if n == 0 or known < n:
            return None
        scores = self._scores(fields)
        if scores is None:
            return self.spark.createDataFrame([], fields)
        return scores.join(asked.select("shard_hash"), "shard_hash", "left_semi").drop("shard_hash")

    def scored(self, shards: DataFrame, rows: DataFrame) -> DataFrame:
        """Scored rows of the shards, after scoring what is missing."""
        self.update(shards, rows)
        out = self.read(shards)
        if out is None:
            raise ValueError("no shard has been scored")
        return out

