"""Continuous ingest and crawl progress with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomdex.functions import vocab
from loomdex.functions.urls import host
from loomdex.operators.ingest import documents_of
from loomdex.sources.readers import PAGE_SCHEMA
from loomdex.sources.store import append_segment


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_ingest(pages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append every micro-batch as a segment named by its batch number.

    A replayed batch rewrites the same segment, so failures never duplicate documents.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append_segment(documents_of(batch).withColumn("seq", F.lit(batch_id).cast("bigint")), target, batch_id)

    return (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def progress_counts(pages: DataFrame) -> DataFrame:
    """Running page count per crawled host."""
    return pages.groupBy(host(F.col("url")).alias("host")).agg(F.count("*").alias("pages_found"))


def start_progress(pages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the counts that changed in each micro-batch; the newest batch per host is current."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        progress_counts(pages).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_progress(spark: SparkSession, target: str) -> DataFrame:
    rows = spark.read.option("basePath", target).parquet(f"{target}/batch=*")
    return rows.groupBy("host").agg(F.max_by("pages_found", "batch").alias("pages_found"))


EVENT_SCHEMA = "host string, crawl bigint, kind string"


def crawl_states(events: DataFrame) -> DataFrame:
    """(host, crawl, pages_found, running): kept per crawl, so events may come late or in any order.

    `events(host, crawl, kind)` names a start, a kept page or the finish of a crawl; a host's crawls have growing
    numbers. Pages are pre-aggregated before the shuffle, so a host with a third of all events is no hot key.
    A null host is a host of its own; events without a crawl number belong to no crawl and are left out.
    """
    kind = F.col("kind")
    return events.filter("crawl is not null").groupBy("host", "crawl").agg(
        F.count_if(kind == "page").alias("pages_found"),
        F.coalesce(~F.bool_or(kind == "finish"), F.lit(True)).alias("running"),
    )


def newest_crawls(states: DataFrame) -> DataFrame:
    """(host, crawl, running, pages_found, message) of each host's newest crawl: its start puts the count back to zero."""
    newest = states.groupBy("host").agg(F.max(F.struct("crawl", "pages_found", "running")).alias("s")).select("host", "s.*")
    done = F.format_string(vocab.CRAWL_FINISHED, "pages_found")
    message = F.when(F.col("running"), vocab.CRAWL_STARTED).otherwise(done)
    return newest.select("host", "crawl", "running", "pages_found", message.alias("message"))


def event_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def start_crawl_status(events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the crawls that changed in each micro-batch; a replayed batch rewrites its own rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        crawl_states(events).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_crawl_status(spark: SparkSession, target: str) -> DataFrame:
    """Status of each host's newest crawl; of a crawl written by several batches the newest one counts."""
    rows = spark.read.option("basePath", target).parquet(f"{target}/batch=*")
    states = rows.groupBy("host", "crawl").agg(F.max_by(F.struct("pages_found", "running"), "batch").alias("s"))
    return newest_crawls(states.select("host", "crawl", "s.*"))
