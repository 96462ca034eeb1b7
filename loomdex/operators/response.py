"""Search responses: one row, or one JSON text, per query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.operators import search
from loomdex.operators.suggest import suggest
from loomdex.session import cut_lineage, stored
from loomdex.sources.store import Index


def _blank_to_null(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def respond(index: Index, queries: DataFrame, stop: list[str] | None = None) -> DataFrame:
    """(query_id, results, total, page, pageSize, totalPages, suggestion, indexedPages).

    Suggestions are computed only for queries whose page is empty.
    """
    # Pages, totals and the unanswered queries all read the scores: computed once, then kept as a table. Scores of a
    # document lie together there, so its key takes little disk.
    scored = stored(search.scores(index, queries, stop), "scores")
    rows = search.results(index, queries, scored, stop)
    hit = F.struct(
        "rank", F.lit(0).alias("id"), _blank_to_null("url").alias("url"), "title",
        _blank_to_null("file_path").alias("filePath"), _blank_to_null("file_type").alias("fileType"),
        F.round("score", 6).alias("score"), _blank_to_null("snippet").alias("snippet"), "relevance",
    )
    # A page holds at most 50 hits, so the list per query is small.
    listed = rows.groupBy("query_id").agg(F.array_sort(F.collect_list(hit)).alias("hits"))
    listed = listed.withColumn("results", F.transform("hits", lambda h: h.dropFields("rank")))
    listed = cut_lineage(listed.drop("hits"))
    answered = queries.join(listed, "query_id", "left").join(
        search.totals(scored).select("query_id", "total"), "query_id", "left"
    )
    unanswered = queries.join(listed.select("query_id"), "query_id", "left_anti")
    unanswered = unanswered.filter("q <> ''")
    if unanswered.isEmpty():
        hints = unanswered.select("query_id", F.lit("").alias("suggestion"))
    else:
        hints = suggest(index, unanswered, stop)
    total = F.coalesce("total", F.lit(0).cast("bigint"))
    none = F.slice("results", 1, 0)
    return answered.join(hints, "query_id", "left").select(
        "query_id",
        F.coalesce("results", none, F.from_json(F.lit("[]"), listed.schema["results"].dataType)).alias("results"),
        total.alias("total"),
        "page",
        F.col("size").alias("pageSize"),
        search.total_pages(total, F.col("size")).alias("totalPages"),
        _blank_to_null("suggestion").alias("suggestion"),
        index.n_docs.alias("indexedPages"),
    )


def to_json(responses: DataFrame) -> DataFrame:
    fields = [c for c in responses.columns if c != "query_id"]
    return responses.select("query_id", F.to_json(F.struct(*fields)).alias("response"))
