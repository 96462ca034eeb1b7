"""Index tables: current documents, postings, document frequencies, field lengths."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdex.functions.analysis import index_tokens, located_terms
from loomdex.functions.arrays import let
from loomdex.operators.vectors import posting_rows, term_vectors
from loomdex.session import cut_lineage, fits_broadcast

FIELDS = ("title", "content")
# Title and content as one field; its postings are the sums of theirs.
ALL = "all"
HOT_SPLITS = 16


def latest(documents: DataFrame, key: str = "doc_key", order: str = "seq") -> DataFrame:
    """Last write per key.

    The rank filter also runs before the shuffle, so a key written very often sends one row per
    input task.
    """
    newest_first = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (
        documents.withColumn("_n", F.row_number().over(newest_first)).filter("_n = 1").drop("_n")
    )


def newest(documents: DataFrame, key: str = "doc_key", order: str = "seq") -> DataFrame:
    """`latest` for rows with texts: only keys written more than once are shuffled with their texts, once these are known.

    Where they are too many to be broadcast, all rows go through `latest`.
    """
    repeated = cut_lineage(documents.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_key"))
    if not fits_broadcast(repeated, "_key"):
        return latest(documents, key, order)
    again = F.broadcast(repeated)
    same = documents[key].eqNullSafe(again["_key"])
    once = documents.join(again, same, "left_anti")
    return once if repeated.isEmpty() else once.unionByName(latest(documents.join(again, same, "left_semi"), key, order))


def document_count(documents: DataFrame) -> DataFrame:
    """Number of documents after upserts: distinct keys, counted without moving any text."""
    return documents.agg(F.count_distinct("doc_key").alias("n_docs"))


def field_columns(fields=FIELDS) -> dict[str, Column]:
    return {f: F.col(f) for f in fields}


def everything() -> dict[str, Column]:
    """Title and content as one field."""
    return {ALL: F.concat_ws("\n", F.col("title"), F.col("content"))}


def field_tokens(docs: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """(doc_key, field, tokens): one row per document and field, no shuffle."""
    parts = [
        F.struct(F.lit(name).alias("field"), index_tokens(text).alias("tokens"))
        for name, text in fields.items()
    ]
    return docs.select("doc_key", F.explode(F.array(*parts)).alias("f")).select("doc_key", "f.*")


def field_lengths(docs: DataFrame, fields: Mapping[str, Column] | None = None) -> DataFrame:
    per_field = field_tokens(docs, fields or field_columns())
    return per_field.select("doc_key", "field", F.size("tokens").cast("bigint").alias("n_tokens"))


def runs(items: Column, key: Callable[[Column], Column], build: Callable[..., Column]) -> Column:
    """build(sorted items, first index, length) for every run of equal keys in a sorted, non-empty array.

    Counting inside the row needs no shuffle, which grouping by document and term would.
    """

    def of_sorted(sorted_items: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(sorted_items) - 1),
            lambda i: (i == 0) | (key(F.get(sorted_items, i)) != key(F.get(sorted_items, i - 1))),
        )
        found = let(starts, lambda at: F.transform(at, lambda first, j: build(
            sorted_items, first, F.coalesce(F.get(at, j + 1), F.size(sorted_items)) - first
        )))
        return F.when(F.size(sorted_items) > 0, found)

    return let(F.sort_array(items), of_sorted)


def term_vector(text: Column) -> Column:
    """array<struct<term,tf,locs>> of one text, sorted by term: what a search and its snippets need of the text."""
    return runs(located_terms(text), lambda s: s["term"], lambda items, first, n: F.struct(
        F.get(items, first)["term"].alias("term"), n.cast("bigint").alias("tf"),
        F.transform(F.slice(items, first + 1, n), lambda s: s.dropFields("term")).alias("locs"),
    ))


def vector_postings(docs: DataFrame, *kept: str) -> DataFrame:
    """Postings of title, content and both as one field from stored term vectors: no text is read, nothing is shuffled."""
    return posting_rows(docs, ["doc_key", *kept], list(FIELDS), ALL)


def postings(
    docs: DataFrame,
    fields: Mapping[str, Column] | None = None,
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """(doc_key, field, term, tf, n_tokens), without a shuffle. With `vocabulary(term)` only those terms are kept."""
    named = dict(fields or field_columns())
    rows = posting_rows(term_vectors(docs, named).select("doc_key", *(f"{f}_terms" for f in named)), ["doc_key"], list(named))
    return rows if vocabulary is None else rows.join(vocabulary, "term", "left_semi")


def located_postings(docs: DataFrame, fields: Mapping[str, Column] | None = None) -> DataFrame:
    """(doc_key, field, term, tf, locs): postings with position and byte offsets, without a shuffle."""
    named = dict(fields or field_columns())
    found = term_vectors(docs, named)
    parts = [F.struct(F.lit(name).alias("field"), F.col(f"{name}_terms").alias("terms")) for name in named]
    # The arrays become columns of their own before they are exploded: a struct around them would be
    # copied into every exploded row.
    per_field = found.select("doc_key", F.explode(F.array(*parts)).alias("f")).select("doc_key", "f.*")
    return per_field.select("doc_key", "field", F.explode("terms").alias("p")).select(
        "doc_key", "field", "p.term", "p.tf",
        F.transform("p.locs", lambda s: F.struct(s["pos"].alias("pos"), s["start"].alias("start"), s["end"].alias("end"))).alias("locs"),
    )


def document_frequencies(posting_rows: DataFrame) -> DataFrame:
    """(field, term, df); counts are combined before the shuffle, so frequent terms stay small.

    Reading `tf` and `n_tokens` keeps the input plan equal to the one that is scored, so that Spark
    computes the shuffled postings once for both.
    """
    present = F.when((F.col("tf") > 0) & (F.col("n_tokens") > 0), 1).otherwise(0)
    return posting_rows.groupBy("field", "term").agg(F.sum(present).alias("df"))


def known_urls(urls: DataFrame, index_docs: DataFrame) -> DataFrame:
    return urls.join(index_docs.select(F.col("doc_key").alias("url")), "url", "left_semi")


def unknown_urls(urls: DataFrame, index_docs: DataFrame) -> DataFrame:
    return urls.join(index_docs.select(F.col("doc_key").alias("url")), "url", "left_anti")


def salt(column: str = "doc_key", splits: int = HOT_SPLITS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(splits)).cast("int")
