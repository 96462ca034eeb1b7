"""SimHash near-duplicates, linked by the generalised pigeonhole principle.

The 64 bits are grouped into partitions, correlated bits together. Two fingerprints within distance D
have, for any thresholds t_i that sum to D - m + 1 over the m partitions (-1: skip), some partition i in
which they differ in at most t_i bits. Each fingerprint gets its own thresholds: dynamic programming takes
those with the fewest probes and candidates, estimated from counts of partition values, so a fingerprint
with a crowded value skips that partition. It is posted under its own values and probes all values within
its thresholds; whoever meets in a bucket is compared in full.

Only different fingerprints are compared: copies and other equal fingerprints are grouped before. A
bucket too full for a task is cut into blocks, and pairs of blocks are compared in tasks of their own. A
bucket gives a spanning forest of the links found in it, never all its pairs; components are the same.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked like any
other; repeated rows are rows of one group; a null doc_id is never a component's id, unless the
component has no other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import keep, partitions_for
from loomdex.llm.components import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
MAX_DISTANCE = 3
PARTITIONS = 4
#: A probe costs a shuffled row, a candidate one comparison of two words.
PROBE_COST = 64
#: Leading bits of a partition whose values are counted: the histograms stay below 2^16 counts each.
COUNTED_BITS = 16
#: Fingerprints of a bucket that one task compares.
BLOCK = 8192
#: Shingles hashed at a time.
STRETCH = 1 << 16


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text; words are split at ASCII white space, A-Z in lower case."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    ends = starts + sizes
    reach = min(shingle, len(words)) - 1
    total = len(words) - reach
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, STRETCH):
        upto = min(total, at + STRETCH)
        bounds = zip(starts[at:upto].tolist(), ends[at + reach:upto + reach].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in bounds], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found)], ["doc_id", "text_hash", "fp"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _fp_column(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def _project(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for place, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


def correlated_partitions(distinct: DataFrame, partitions: int) -> list[list[int]]:
    """Bits in equal groups; each group grows by the bit most correlated with it."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            fps = _fp_column(batch)
            bits = ((fps[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
            total += bits.T @ bits
        cells = [pa.array(x.reshape(-1)) for x in (*np.indices((BITS, BITS)), total.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(cells, ["i", "j", "n"])

    both = np.zeros((BITS, BITS))
    sums = distinct.select("fp").mapInArrow(products, "i bigint, j bigint, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n"))
    for i, j, n in sums.collect():  # 64 x 64 sums
        both[i, j] = n
    rows, ones = max(1, distinct.count()), np.diag(both)
    spread = np.sqrt(np.maximum(1e-9, ones * (rows - ones)))
    strength = np.abs(rows * both - np.outer(ones, ones)) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    free, groups = set(range(BITS)), []
    for part in range(partitions):
        size = (BITS - sum(map(len, groups))) // (partitions - part)
        group = [max(sorted(free), key=lambda b: strength[b, sorted(free)].sum())]
        free.discard(group[0])
        while len(group) < size:
            group.append(max(sorted(free), key=lambda b: strength[b, group].sum()))
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


class Allocator:
    """Estimated candidates of every partition value within every threshold, and the best thresholds for a fingerprint."""

    def __init__(self, groups: list[list[int]], counts: list[np.ndarray], distance: int) -> None:
        self.groups, self.distance, self.counts = groups, distance, counts
        self.costs = [self._costs(len(g), c) for g, c in zip(groups, counts)]

    def _costs(self, width: int, counts: np.ndarray) -> np.ndarray:
        """[threshold + 1, counted value]: probes and candidates."""
        counted = min(width, COUNTED_BITS)
        exact, values = [], np.arange(1 << counted)
        for d in range(self.distance + 1):
            flips = [sum(1 << b for b in c) for c in combinations(range(counted), d)]
            exact.append(sum((counts[values ^ f] for f in flips), np.zeros(len(values))))
        rest, costs = width - counted, [np.zeros(len(values))]
        for t in range(self.distance + 1):
            candidates = sum(
                exact[d] * sum(comb(rest, e) for e in range(t - d + 1)) for d in range(t + 1)
            ) / (1 << rest)
            costs.append(candidates + PROBE_COST * sum(comb(width, d) for d in range(t + 1)))
        return np.array(costs)

    def thresholds(self, values: list[np.ndarray]) -> np.ndarray:
        """[partition, fingerprint]: thresholds from -1 on that sum to distance - partitions + 1, least total cost."""
        budget = self.distance + 1  # in steps above -1
        rows = len(values[0])
        best = np.full((budget + 1, rows), np.inf)
        best[0] = 0
        taken = []
        for costs, value in zip(self.costs, values):
            mine = costs[:, value & (costs.shape[1] - 1)]
            options = np.full((budget + 1, budget + 1, rows), np.inf)  # [steps so far, steps here]
            for total in range(budget + 1):
                for here in range(total + 1):
                    options[total, here] = best[total - here] + mine[here]
            taken.append(options.argmin(axis=1))
            best = options.min(axis=1)
        out, left = np.zeros((len(values), rows), np.int64), np.full(rows, budget)
        for part in range(len(values) - 1, -1, -1):
            here = taken[part][left, np.arange(rows)]
            out[part], left = here - 1, left - here
        return out

    def postings(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(partition, values, fingerprints): where each fingerprint is posted or probes."""
        values = [_project(fps, g) for g in self.groups]
        thresholds = self.thresholds(values)
        for part, (group, value) in enumerate(zip(self.groups, values)):
            yield part, value, fps
            for d in range(1, self.distance + 1):
                probing = thresholds[part] >= d
                if probing.any():
                    for c in combinations(range(len(group)), d):
                        yield part, value[probing] ^ sum(1 << b for b in c), fps[probing]


def value_counts(distinct: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """How many fingerprints have each value of (the counted bits of) each partition."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _fp_column(batch)
            for part, group in enumerate(groups):
                value = _project(fps, group) & ((1 << COUNTED_BITS) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), part)), pa.array(value)], ["part", "value"])

    counts = [np.zeros(1 << min(len(g), COUNTED_BITS)) for g in groups]
    found = distinct.select("fp").mapInArrow(project, "part bigint, value bigint").groupBy("part", "value").count()
    for part, rows in found.toPandas().groupby("part"):  # at most 2^16 counts a partition
        counts[part][rows["value"].to_numpy()] = rows["count"].to_numpy()
    return counts


def bucket_forest(runs: np.ndarray, fps: np.ndarray, distance: int) -> np.ndarray:
    """For rows sorted by run: each row's root in a spanning forest of the links inside its run."""
    root = np.arange(len(fps))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    active, step = np.arange(len(fps)), 1
    while len(active):
        active = active[active + step < len(fps)]
        active = active[runs[active + step] == runs[active]]
        near = active[np.bitwise_count(fps[active] ^ fps[active + step]) <= distance]
        near = near[root[near] != root[near + step]]
        if len(near):
            for i in near.tolist():
                a, b = find(i), find(i + step)
                root[max(a, b)] = min(a, b)
            while (root[root] != root).any():
                root = root[root]
        step += 1
    return root


def links(distinct: DataFrame, distance: int = MAX_DISTANCE, partitions: int = PARTITIONS, block: int = BLOCK) -> DataFrame:
    """Pairs (u, v) of fingerprints that chains of links within a bucket connect; together they connect all that is connected."""
    groups = correlated_partitions(distinct, partitions)
    allocator = Allocator(groups, value_counts(distinct, groups), distance)
    width = max(map(len, groups))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                for part, value, fps in allocator.postings(_fp_column(batch.slice(at, 4096))):
                    counts = allocator.counts[part]
                    blocks = np.maximum(1, -(-counts[value & (len(counts) - 1)].astype(np.int64) // block))
                    copies = np.repeat(np.arange(len(value)), blocks)
                    other = np.arange(len(copies)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    own = ((fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)[copies] % blocks[copies]
                    pair = np.minimum(own, other) * blocks[copies] + np.maximum(own, other)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in ((np.int64(part) << width) + value[copies], pair, fps.view(np.int64)[copies])],
                        ["bucket", "pair", "fp"],
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in range(3)]

        def forest(rows: list[np.ndarray]) -> pa.RecordBatch:
            bucket, pair, fp = rows
            new = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])])
            root = bucket_forest(np.cumsum(new), fp.view(np.uint64), distance)
            child = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], ["u", "v"])

        for batch in batches:
            rows = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) if len(rows[0]) else np.zeros(0, bool)
            held = [r[same] for r in rows]  # the last run may go on
            if (~same).any():
                yield forest([r[~same] for r in rows])
        if len(held[0]):
            yield forest(held)

    tasks = partitions_for(distinct.sparkSession, distinct.count() * partitions, 400_000)
    posted = distinct.select("fp").mapInArrow(post, "bucket bigint, pair bigint, fp bigint")
    buckets = posted.repartition(tasks, "bucket", "pair").sortWithinPartitions("bucket", "pair", "fp")
    return buckets.mapInArrow(compare, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE, partitions: int = PARTITIONS) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root): every row's fingerprint and the smallest doc_id that its chain of links reaches."""
    rows = keep(fingerprints(docs, shingle))
    distinct = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(links(distinct, distance, partitions))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(grouped.select("fp", "root").join(ids, "root"), "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def unique_documents(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near-duplicates, with all columns: the one of the smallest doc_id (null if there is no other)."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("kept")
    kept = near_duplicates(docs, **options).groupBy("root").agg(least).select("kept.*")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    # Rows that agree in doc_id and text are one document.
    return docs.join(kept, same).dropDuplicates(["_id", "_hash"]).select(docs.columns)
