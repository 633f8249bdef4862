"""Loading of the Parquet tables, and tables written on the way."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; columns and filters are pruned into the scan by the optimizer."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores where its files make no more splits than there are cores.

    A small table in few row groups would otherwise keep one core busy with all
    its texts.  A large one has many more splits and is left as it is read, and so
    is one of many files that fill a split for each core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df if splits > cores or splits == cores and len(df.inputFiles()) >= 2 * cores else df.repartition(cores)


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which the whole cluster shares.

    A folder of this machine is taken only where none is set and the master is
    this machine, as in tests; elsewhere a missing setting is an error.
    """
    context = spark.sparkContext
    given = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if given is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="corpusloom-"))
    return given or context.getCheckpointDir()


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder, in folders ``by``, and read again: computed once, and safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    reader = df.sparkSession.read.schema(df.schema) if by else df.sparkSession.read  # folders alone tell no schema where there is no row
    return reader.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def listing_digest(spark: SparkSession, path: str) -> str:
    """Changes with the names, sizes or times of the files at or below a path; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    each = files.select(F.sha2(F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_millis("modificationTime").cast("string")), 256).alias("h"))
    listed = each.agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list("h"))), 256)).first()  # one hash for each file
    return listed[0]


def kept(spark: SparkSession, name: str, source: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from the files of ``source``, made once for their present state and found again later.

    It lies in the shared folder under a name that follows from ``name`` and the
    listing of the files; one whose writing broke off is made anew.
    """
    key = hashlib.sha256(f"{name}|{source}|{listing_digest(spark, source)}".encode()).hexdigest()[:24]
    path = f"{shared_folder(spark)}/kept-{name}-{key}"
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
