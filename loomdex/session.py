"""Session helpers: shared work folder, checkpoints, size-checked broadcast, scan spreading."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only while it stays under both limits. A row costs about a hundred bytes in
# memory, and query text turns into some terms per dozen bytes, so either limit means about 100 MB.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 8 * 1024 * 1024

_local_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir. Unset, a single-process session gets a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="loomdex-")
    return _local_dirs[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows outlive the executors that computed them."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark))
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession):
    """Shuffle files of a job in here go when it ends; else they stay until the driver happens to collect its garbage.

    For jobs that write tables: rows that are needed again would be shuffled anew.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of jobs in here hold so many rows at most: for rows with long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    return _setting(spark, name, str(min(now, rows) if now > 0 else rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows written as a table in the work folder and read again: `cut_lineage` for rows that hold texts, or are many."""
    path = fresh_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, *text_columns: str) -> bool:
    """Whether rows and text bytes of a table stay below the limits; both are summed by task first."""
    total = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text_columns), F.lit(0))
    rows, volume = df.agg(F.count("*"), F.sum(total.cast("bigint"))).first()
    return rows <= BROADCAST_ROWS and (volume or 0) <= BROADCAST_BYTES


# A table read in fewer splits than this is at most a gigabyte at Spark's default split size.
FEW_SPLITS = 8


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use every core on small inputs stored in a few splits; anything larger is returned unshuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= min(cores, FEW_SPLITS):
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)
