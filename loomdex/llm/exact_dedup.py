"""Exact duplicates: documents grouped by a 128-bit content hash, texts compared byte by byte inside groups.

Only short rows (hash, length, id) are grouped. The texts themselves move only where a hash occurs twice:
they are grouped by hash *and* bytes, which Spark combines in the reading tasks first, so a group of any
number of copies leaves each task as one row. A hash that turns out to stand for different texts is
split by the texts; all other hashes are groups as they are.

Groups holding more than a thousandth of all rows (at most a thousand of them) are broadcast to their
rows, the others are joined by hash, so no task gathers a hot group.

Defined cases: a null text counts as empty, and all empty texts are one group; of equal texts the one with
the most code points before normalisation stays, then the smallest doc_id (null last), then any single
one of rows that agree in both; repeated rows are copies of each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.llm import bloom
from loomdex.llm.common import keep, store

#: Characters that texts may differ in and still be equal.
IGNORED = (" ", "\t", "\n", "\v", "\f", "\r")
#: A group is hot when it holds more than one row in this many.
HOT_SHARE = 1000

Hash = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    """The text without ignored characters; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in IGNORED:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def _hashed(docs: DataFrame, hashed: Hash) -> DataFrame:
    return docs.select("doc_id", "text", normalised(F.col("text")).alias("norm")).withColumn("hash", hashed(F.col("norm")))


def _marked(rows: DataFrame, *extra: str) -> DataFrame:
    """Short rows, each with a number of its own."""
    chars = F.char_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return rows.select(
        "doc_id", "hash", *extra, chars.alias("chars"), F.sha2("norm", 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row"),
    )


def _choose(rows: DataFrame, total: int, *keys: str) -> DataFrame:
    """Every row with the one of its group that stays and the size of the group."""
    order = F.struct(-F.col("chars"), F.col("doc_id").isNull(), "doc_id", "row")
    groups = rows.groupBy(*keys).agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    groups = keep(groups.select(*keys, "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")))
    is_hot = F.col("group_size") * HOT_SHARE > total
    hot = groups.filter(is_hot)  # fewer than HOT_SHARE rows, as they hold more than total / HOT_SHARE each
    found = rows.join(F.broadcast(hot), list(keys))
    others = rows.join(F.broadcast(hot.select(*keys)), list(keys), "left_anti").join(groups.filter(~is_hot), list(keys))
    return found.unionByName(others).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )


def colliding_hashes(docs: DataFrame, marked: DataFrame, hashed: Hash = content_hash) -> DataFrame:
    """(hash): those that more than one normalised text has."""
    repeated = keep(marked.groupBy("hash").count().filter("count > 1").select(F.xxhash64("hash").alias("key")))
    blocks = bloom.blocks_for(repeated.count())
    rows = _hashed(docs, hashed).withColumn("key", F.xxhash64("hash"))
    likely = bloom.test(rows, bloom.build(repeated, "key", blocks), "likely", "key", blocks).filter("likely")
    texts = likely.groupBy("hash", "norm").agg(F.count("*").alias("copies"))
    return texts.groupBy("hash").count().filter("count > 1").select("hash")


def duplicates(docs: DataFrame, hashed: Hash = content_hash) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for every row of `docs`."""
    marked = store(_marked(_hashed(docs, hashed)), "hashed")
    total = marked.count()
    colliding = keep(colliding_hashes(docs, marked, hashed))
    if colliding.isEmpty():
        return _choose(marked, total, "hash")
    plain = _choose(marked.join(colliding, "hash", "left_anti"), total, "hash")
    odd = store(_marked(_hashed(docs, hashed).join(colliding, "hash", "left_semi"), "norm"), "colliding")
    return plain.unionByName(_choose(odd, total, "hash", "norm"))


def unique_documents(docs: DataFrame, hashed: Hash = content_hash) -> DataFrame:
    """(doc_id): the documents that stay."""
    return duplicates(docs, hashed).filter("kept").select("doc_id")
