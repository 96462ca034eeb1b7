"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors. Every vector is represented by its `posted` nearest pivots in
order of nearness, found once, and posted in the lists of these only, with the place the pivot has in that
order. A query reads the lists of its own `read` nearest pivots and adds up how far its places are from the
posted ones (Spearman's footrule; a pivot that a vector does not name counts as the place after its last).
Vectors are ranked by that sum, those found in none of these lists last, and the best share of them is
compared exactly.

Equal vectors are one entry of the index; it names the smallest ids that share it, as many as an answer
can hold. Lists are built block by block in tasks; blocks of queries meet blocks of the index, and each
such pair hands on its nearest only. `share` of a block is reranked, at least `least_reranked` entries.

Defined cases: vectors that are null, empty, all zero, of another length than the commonest, or that hold
null or non-finite components take no part, nor do rows with a null id; rows with the query's own id are
not its neighbours; equal distances go to the smaller id; a lone vector has no neighbours and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ShortType, StructField, StructType

from loomdex.llm.common import keep

PIVOTS = 512
#: Pivots that a vector is posted under, and lists that a query reads.
POSTED = 192
READ = 48
SHARE = 0.2
LEAST_RERANKED = 400
#: Different vectors in a block of the index, and queries in a block of queries.
INDEX_BLOCK = 8192
QUERY_BLOCK = 8192
#: Vectors whose distances to all pivots are held at once.
ROWS_AT_ONCE = 2048


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): rows with an id and a finite vector other than zero, as 64-bit numbers."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    ).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # no negative zeros
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    return rows.join(F.broadcast(sizes.select("n")), F.size("v") == F.col("n"), "left_semi")  # one row


def entries(rows: DataFrame, ids: int) -> DataFrame:
    """One row per different vector with the `ids` smallest ids that share it."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("nth", nth).filter(F.col("nth") <= ids)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def pivot_orders(vectors: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """[vector, place]: the nearest pivots of every vector, nearest first; ties by pivot number."""
    distances = (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    return np.argsort(distances, axis=1, kind="stable")[:, :posted].astype(np.int16)


class Lists:
    """The pivots' inverted files over a block of pivot orders."""

    def __init__(self, orders: np.ndarray, pivots: int):
        self.vectors, self.posted = orders.shape
        by_pivot = np.argsort(orders.ravel(), kind="stable")
        self.starts = np.searchsorted(orders.ravel()[by_pivot], np.arange(pivots + 1))
        self.vector = (by_pivot // self.posted).astype(np.int32)
        self.place = (by_pivot % self.posted).astype(np.int32)

    def footrule(self, own: np.ndarray) -> np.ndarray:
        """Of every vector, over the pivots of a query; the greatest number for vectors in none of their lists."""
        sums = np.full(self.vectors, sum(self.posted - place for place in range(len(own))), np.int64)
        found = np.zeros(self.vectors, bool)
        for place, pivot in enumerate(own):
            entries = slice(self.starts[pivot], self.starts[pivot + 1])
            vector = self.vector[entries]  # each at most once
            sums[vector] += np.abs(self.place[entries] - place) - (self.posted - place)
            found[vector] = True
        sums[~found] = np.iinfo(np.int64).max
        return sums


def with_pivots(rows: DataFrame, centres: np.ndarray, posted: int) -> DataFrame:
    """`rows` (v, ...) with `pivots`, the nearest ones in order."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                orders = pivot_orders(matrix(batch["v"]), centres, posted)
                ends = pa.array(np.arange(len(orders) + 1) * orders.shape[1], pa.int32())
                yield batch.append_column("pivots", pa.ListArray.from_arrays(ends, pa.array(orders.ravel())))

    return rows.mapInArrow(add, StructType([*rows.schema.fields, StructField("pivots", ArrayType(ShortType()))]))


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows."""
    whole = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", embedding: str = "embedding",
    pivots: int = PIVOTS, posted: int = POSTED, read: int = READ, share: float = SHARE, least_reranked: int = LEAST_RERANKED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row of `queries`, by Euclidean distance."""
    index = keep(entries(usable(vectors, vec_id, embedding), k + 1))
    total = index.count()
    asked = keep(usable(queries, vec_id, embedding))
    if not total:
        return asked.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    sample = index.orderBy(F.xxhash64("v"), "v").limit(pivots).select("v").collect()  # `pivots` rows
    centres = np.array([r.v for r in sample])

    # Vectors asked about by several ids are searched once.
    wanted = entries(asked, 1).select("v", F.col("ids")[0].alias("query_key"))
    index_blocks, query_blocks = -(-total // INDEX_BLOCK), -(-wanted.count() // QUERY_BLOCK)
    entered = with_pivots(index, centres, posted).withColumn("i", F.pmod(F.xxhash64("v"), F.lit(index_blocks))).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(max(1, query_blocks) - 1)))
    ).select("i", "q", "v", "pivots", "ids", F.lit(None).cast("bigint").alias("query_key"))
    probes = with_pivots(wanted, centres, posted).withColumn("q", F.pmod(F.xxhash64("v", F.lit(1)), F.lit(max(1, query_blocks)))).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.lit(index_blocks - 1)))
    ).select("i", "q", "v", "pivots", F.array().cast("array<bigint>").alias("ids"), "query_key")

    def search(block: pa.Table) -> pa.Table:
        asks = np.asarray(block["query_key"].is_valid())
        everything, orders = matrix(block["v"]), matrix(block["pivots"])
        keys = block["query_key"].filter(pa.array(asks)).to_numpy()
        held, ids = everything[~asks], block["ids"].filter(pa.array(~asks)).to_pylist()
        out: tuple[list, list, list] = ([], [], [])
        if len(held):
            lists = Lists(orders[~asks], len(centres))
            reranked = min(len(held), max(least_reranked, int(np.ceil(share * len(held)))))
            for key, query, own in zip(keys, everything[asks], orders[asks]):
                best = np.argpartition(lists.footrule(own[:read]), reranked - 1)[:reranked]
                distance = np.sqrt(((held[best] - query) ** 2).sum(axis=1))
                # k + 1 entries: one of them may be the query itself. Ties at the edge stay in.
                edge = np.partition(distance, min(k, reranked - 1))[min(k, reranked - 1)]
                near = [(d, i) for b, d in zip(best[distance <= edge], distance[distance <= edge]) for i in ids[b]]
                for d, i in sorted(near)[:k + 1]:
                    out[0].append(key)
                    out[1].append(i)
                    out[2].append(d)
        return pa.table({"query_key": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    found = entered.unionByName(probes).groupBy("i", "q").applyInArrow(search, "query_key bigint, vec_id bigint, score double")
    top = Window.partitionBy("query_key").orderBy("score", "vec_id")
    best = found.withColumn("nth", F.row_number().over(top)).filter(F.col("nth") <= k + 1).drop("nth")
    # Back to every id that asks for the vector, without itself.
    same = asked.select(F.col("vec_id").alias("query_id"), "v").distinct().join(wanted, "v").select("query_id", "query_key")
    answers = same.join(best, "query_key").filter("vec_id <> query_id")
    mine = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
