"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.session import cut_lineage, fresh_dir

HELD_OUT_FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Rows written once to the shared folder: later reads neither recompute them nor need the executors that made them."""
    return cut_lineage(df)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 0; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_FOLDS == 0, F.lit(False))


def partitions_for(spark: SparkSession, rows: int, per_partition: int) -> int:
    """Enough partitions that each holds about per_partition rows, never fewer than the session asks for."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, -(-rows // per_partition))



def store(df: DataFrame, name: str) -> DataFrame:
    """Rows written as a table in the shared folder and read again: `keep` for rows that hold texts, as it compresses them."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
