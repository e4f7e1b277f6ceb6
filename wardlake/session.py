"""A Spark session with the settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# With it, the shuffle files of a query go when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str | None = None, shuffle_partitions: int | None = None, **conf: str
) -> SparkSession:
    """Adaptive execution splits skewed join partitions and coalesces small ones.

    On a cluster leave ``master`` and ``shuffle_partitions`` to spark-submit.
    """
    builder = (
        SparkSession.builder.appName("wardlake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Recording the Python call site of every expression makes plans slow to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, every query that ends takes its shuffle files with it.

    Otherwise they stay until the driver happens to collect garbage, and those of all layers pile up.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
