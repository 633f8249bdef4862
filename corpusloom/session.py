"""Session settings for local runs; on a cluster the given session is used as it is."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, memory: str = "8g") -> SparkSession:
    n = cpus or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, where it is not installed on them."""
    here = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom")
    archive = shutil.make_archive(base, "zip", root_dir=os.path.dirname(here), base_dir=os.path.basename(here))
    spark.sparkContext.addPyFile(archive)


#: Applications that have the package.
_SHIPPED: set[str] = set()


def ship_once(spark: SparkSession) -> None:
    """As ``ship``, once for each application."""
    name = spark.sparkContext.applicationId
    if name not in _SHIPPED:
        ship(spark)
        _SHIPPED.add(name)
