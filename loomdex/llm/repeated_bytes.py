"""Bytes covered by long strings that occur more than once, by a distributed sparse suffix array.

A string of `length` bytes is removed wherever it also starts anywhere else. Not every suffix has to be
sorted: of the grams (`gram` bytes) that start in a window of `length` bytes, the one with the least hash is
the window's anchor, and equal windows have their anchors at the same place. Only suffixes at anchors
are made, about one in 170 bytes, and only where the anchor's gram occurs twice at all.

Suffixes are range-partitioned by their leading bytes between sampled splitters. A bucket sorts them by
multikey quicksort on eight-byte symbols, once to the right of the anchor and once, reversed, to its left,
with the longest common prefixes of neighbours. A window that reaches o bytes to the left is repeated if
and only if its anchor shares an interval of prefixes of length - o bytes in one order and one of o
bytes in the other with another anchor; the intervals are read off both arrays for every o.

A gram too common for one bucket is compared across buckets instead, by counting 128-bit digests: its
windows are taken in runs of neighbouring reaches; a run whose common part occurs once is done, one whose
joint extent occurs twice is repeated as a whole, and only of the others single windows are counted.

Equal texts are handled once: their bytes are all repeated if there are `length` of them.

Defined cases: null and empty texts have no bytes and lose none; a null doc_id is carried; repeated rows
are documents of their own, so they remove each other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import keep, partitions_for, store

LENGTH = 400
GRAM = 64
#: Suffixes sorted together; a gram with more is compared by digests.
BLOCK = 20_000
#: Runs of reaches that the windows of a common gram are taken in.
RUNS = 8
#: Bytes of a text hashed at a time.
STRETCH = 1 << 20
_PLACE_BITS = 21
_BASE = 0x9E3779B97F4A7C15

_KEY = ["k1", "k2"]


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def anchors(body: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows of a text, and the hashes of their grams."""
    places, hashes = [], []
    starts = length - gram + 1  # gram starts in a window
    for at in range(0, max(0, len(body) - length + 1), STRETCH):
        part = np.frombuffer(body, np.uint8, min(STRETCH + length - 1, len(body) - at), at)
        size = STRETCH + length if len(part) > 1 << 16 else 1 << 17
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_byte_values()[part] * _powers(_BASE, size)[: len(part)], out=sums[1:])
            grams = (sums[gram:] - sums[:-gram]) * _powers(_inverse(_BASE), size)[: len(part) - gram + 1]
            grams ^= grams >> np.uint64(29)
            grams *= np.uint64(0xBF58476D1CE4E5B9)
            grams ^= grams >> np.uint64(32)
        order = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
        # Least value of every window, from running minima of blocks as long as a window.
        blocks = np.full(-(-len(order) // starts) * starts, np.iinfo(np.uint64).max)
        blocks[: len(order)] = order
        blocks = blocks.reshape(-1, starts)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        windows = len(order) - starts + 1
        least = np.minimum(behind[:windows], ahead[starts - 1:starts - 1 + windows])
        marked = np.zeros(len(order), bool)
        marked[(least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)] = True
        found = np.flatnonzero(marked)
        places.append(found + at)
        hashes.append(grams[found])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[first].view(np.int64)


def padded(strings: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings as rows of bytes filled up with zeros, and their lengths."""
    strings = strings.cast(pa.large_binary())
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    sizes = np.diff(bounds)
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    rows = np.zeros((len(strings), width), np.uint8)
    rows[np.arange(width) < sizes[:, None]] = data
    return rows, sizes


def multikey_sort(rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings, shorter before longer if equal, and the common prefix of each with the one before it.

    Multikey quicksort on symbols of eight bytes: strings that are equal so far form a group; each step
    sorts the members of groups of two or more by their next symbol and splits the groups.
    """
    total, width = rows.shape
    symbols = rows.reshape(total, width // 8, 8).view(">u8")[:, :, 0]
    order, common = np.arange(total), np.zeros(total, np.int64)
    group = np.zeros(total, np.int64)  # by place in the order
    open_ = np.arange(total)
    for depth in range(width // 8 + 1):
        if len(open_) < 2:
            break
        members = order[open_]
        symbol = symbols[members, depth].astype(np.uint64) if depth < width // 8 else sizes[members].astype(np.uint64)
        inner = np.lexsort((symbol, group[open_]))
        order[open_], symbol, grouped = members[inner], symbol[inner], group[open_][inner]
        same_group = grouped[1:] == grouped[:-1]
        split = same_group & (symbol[1:] != symbol[:-1])
        if depth < width // 8:
            differ = symbol[1:][split] ^ symbol[:-1][split]
            lead = np.zeros(len(differ), np.int64)
            for byte in range(1, 8):  # whole leading bytes in common
                lead += differ < np.uint64(1 << (8 * (8 - byte)))
            common[open_[1:][split]] = 8 * depth + lead
        else:
            common[open_[1:][split]] = width
        new_group = np.concatenate([[True], ~same_group | split])
        group[open_] = open_[np.maximum.accumulate(np.where(new_group, np.arange(len(open_)), 0))]
        if depth == width // 8:
            common[open_[1:][~new_group[1:]]] = width
            break
        alone = new_group & np.concatenate([new_group[1:], [True]])
        open_ = open_[~alone]
    ordered = sizes[order]
    common[1:] = np.minimum(common[1:], np.minimum(ordered[1:], ordered[:-1]))
    return order, common


def repeated_reaches(left: pa.Array, right: pa.Array, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor the least and greatest reach to the left of a repeated window (greatest -1: none).

    `left` holds the bytes before the anchors, reversed.
    """
    total, most = len(left), length - gram
    sides = [(*padded(right, -(-length // 8) * 8),), (*padded(left, -(-most // 8) * 8),)]
    arrays = [multikey_sort(*side) for side in sides]
    nearest = []
    for order, common in arrays:
        best = np.zeros(total, np.int64)
        best[order] = np.maximum(common, np.append(common[1:], 0))
        nearest.append(best)
    low, high = np.maximum(0, length - nearest[0]), np.minimum(most, nearest[1])
    least, greatest = np.full(total, most + 1), np.full(total, -1)
    interval = [np.empty(total, np.int64), np.empty(total, np.int64)]
    for reach in range(most + 1):
        some = np.flatnonzero((low <= reach) & (reach <= high))
        if len(some) < 2:
            continue
        for (order, common), out, enough in zip(arrays, interval, (length - reach, reach)):
            out[order] = np.cumsum(common < enough)
        both = interval[0][some] * (total + 1) + interval[1][some]
        rank = np.argsort(both, kind="stable")
        equal = both[rank][1:] == both[rank][:-1]
        twice = np.zeros(len(some), bool)
        twice[rank[1:][equal]] = twice[rank[:-1][equal]] = True
        hit = some[twice]
        least[hit] = np.minimum(least[hit], reach)
        greatest[hit] = reach
    return least, greatest


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, d (never null), the 128-bit key of the text, and the text as bytes."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit((1 << 63) - 1)).alias("d"), F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(1), text).alias("k2"), text.cast("binary").alias("body"),
    )


def candidate_texts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, body, anchors): different texts that share a gram with themselves or another, with the shared anchors."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(body.as_py(), length, gram) for body in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([p for p, _ in found], pa.list_(pa.int64())), pa.array([h for _, h in found], pa.list_(pa.int64()))],
                ["k1", "k2", "d", "place", "gram"],
            )

    long = _keyed(docs).filter(F.octet_length("body") >= length)
    found = long.select("k1", "k2", "d", "body").mapInArrow(find, "k1 bigint, k2 bigint, d bigint, place array<bigint>, gram array<bigint>")
    texts = keep(found.groupBy(*_KEY).agg(F.min("d").alias("d"), F.any_value("place").alias("place"), F.any_value("gram").alias("gram")))
    suffixes = texts.select(*_KEY, "d", F.inline(F.arrays_zip("place", "gram")))
    shared = keep(suffixes.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"))  # so that the join can split a common gram
    where = suffixes.join(shared, "gram").groupBy(*_KEY, "d").agg(F.collect_list(F.struct("place", "n")).alias("anchors"))
    return store(long.select(*_KEY, "d", "body").join(where, [*_KEY, "d"]).select(*_KEY, "body", "anchors"), "candidate-texts")


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """(k1, k2, first, end): stretches of repeated bytes; those of one text may overlap. `texts`: see candidate_texts."""
    texts = texts.withColumns({
        "few": F.filter("anchors", lambda a: a["n"] <= block)["place"], "many": F.filter("anchors", lambda a: a["n"] > block)["place"]
    })
    return sorted_spans(texts, length, gram, block).unionByName(counted_spans(texts.filter(F.size("many") > 0), length, gram))


def sorted_spans(texts: DataFrame, length: int, gram: int, block: int) -> DataFrame:
    """Spans at the anchors in `few`, by sorted buckets of suffixes."""
    most = length - gram

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, body, places in zip(*(batch.column(i) for i in range(4))):
                body, places = body.as_py(), places.as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k1.as_py()] * len(places), pa.int64()), pa.array([k2.as_py()] * len(places), pa.int64()),
                        pa.array(places, pa.int64()), pa.array([body[max(0, p - most):p][::-1] for p in places], pa.binary()),
                        pa.array([body[p:p + length] for p in places], pa.binary()),
                    ],
                    ["k1", "k2", "place", "left", "right"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bucket(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            k1, k2, place = (rows.column(i).to_numpy() for i in range(3))
            least, greatest = repeated_reaches(*(rows.column(i).combine_chunks() for i in (3, 4)), length, gram)
            hit = np.flatnonzero(greatest >= 0)
            spans = (k1[hit], k2[hit], place[hit] - greatest[hit], place[hit] - least[hit] + length)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in spans], ["k1", "k2", "first", "end"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= block:
                rows = pa.Table.from_batches(held).combine_chunks()
                lead = pa.compute.binary_slice(rows.column(4), 0, gram).combine_chunks()
                done = int(np.argmax(np.asarray(pa.compute.equal(lead, lead[-1]))))  # the last gram may go on
                if done:
                    yield bucket(rows.slice(0, done))
                    held = rows.slice(done).to_batches()
        if held and sum(b.num_rows for b in held):
            yield bucket(pa.Table.from_batches(held))

    total = texts.agg(F.sum(F.size("few"))).first()[0] or 0
    lead = F.substring("right", 1, gram)
    suffixes = texts.select(*_KEY, "body", "few").mapInArrow(cut, "k1 bigint, k2 bigint, place bigint, left binary, right binary")
    buckets = suffixes.repartitionByRange(partitions_for(texts.sparkSession, total, block), lead).sortWithinPartitions(lead)
    return buckets.mapInArrow(compare, "k1 bigint, k2 bigint, first bigint, end bigint")


def counted_spans(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans at the anchors in `many`, by counts of digests.

    Every window of a run of reaches holds the run's core, so a core that occurs once rules the run out. If
    the hull, all windows of the run together, occurs twice, all of them do. Of each group of equal hulls
    one goes on beside those without an equal, to be compared window by window.
    """
    import xxhash

    digest = xxhash.xxh3_128_digest
    bounds = np.linspace(0, length - gram + 1, RUNS + 1).astype(int).tolist()
    runs = [(a, b - 1) for a, b in zip(bounds, bounds[1:]) if b > a]
    place = "k1 bigint, k2 bigint, place bigint, run int"

    def batch_of(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def post_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, body, places in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                for p in places:
                    for run, (near, far) in enumerate(runs):
                        if max(near, p + length - len(body)) <= min(far, p):  # some window of the run lies in the text
                            whole = p >= far and p + length - near <= len(body)
                            hull = digest(body[p - far:p + length - near]) if whole else None
                            rows.append((k1, k2, p, run, digest(body[p - near:p + length - far]), hull))
                yield batch_of(rows, ["k1", "k2", "place", "run", "core", "hull"], [*[pa.int64()] * 3, pa.int32(), pa.binary(), pa.binary()])

    def post_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, body, asked in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                for p, run in ((a["place"], a["run"]) for a in asked):
                    near, far = runs[run]
                    for reach in range(max(near, p + length - len(body)), min(far, p) + 1):
                        rows.append((k1, k2, p - reach, digest(body[p - reach:p - reach + length])))
                yield batch_of(rows, ["k1", "k2", "first", "window"], [*[pa.int64()] * 3, pa.binary()])

    posted = keep(texts.select(*_KEY, "body", "many").mapInArrow(post_runs, f"{place}, core binary, hull binary"))
    cores = keep(posted.groupBy("core").agg(F.count("*").alias("cores")).filter("cores > 1"))
    # By run: the same place of a text can be the hull of two anchors' different runs, which is no repetition.
    hulls = posted.filter("hull is not null").groupBy("run", "hull").agg(
        F.count("*").alias("hulls"), F.min(F.struct(*_KEY, "place")).alias("one")
    )
    hulls = keep(hulls.filter("hulls > 1"))
    open_ = keep(posted.join(cores, "core").select(*_KEY, "place", "run", "hull"))
    equal = open_.filter("hull is not null").join(hulls, ["run", "hull"], "left")
    whole = equal.filter("hulls > 1")
    near = F.get(F.array(*(F.lit(a) for a, _ in runs)), F.col("run"))
    far = F.get(F.array(*(F.lit(b) for _, b in runs)), F.col("run"))
    spans = whole.select(*_KEY, (F.col("place") - far).alias("first"), (F.col("place") - near + length).alias("end"))

    single = equal.filter(F.col("hulls").isNull() | (F.struct(*_KEY, "place") == F.col("one")))
    asked = single.select(*_KEY, "place", "run").unionByName(open_.filter("hull is null").select(*_KEY, "place", "run"))
    asked = asked.groupBy(*_KEY).agg(F.collect_list(F.struct("place", "run")).alias("asked"))
    windows = texts.select(*_KEY, "body").join(asked, _KEY).mapInArrow(post_windows, "k1 bigint, k2 bigint, first bigint, window binary")
    windows = keep(windows.distinct())  # a window of two anchors' runs is one window
    twice = keep(windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window"))
    single_spans = windows.join(twice, "window").select(*_KEY, "first", (F.col("first") + length).alias("end"))
    return spans.unionByName(single_spans)


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted((s["first"], s["end"]) for s in spans):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((first, end))
    return out


def remove_repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of `docs`."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body, spans in zip(batch.column(2), batch.column(3)):
                body, cuts, at, kept = memoryview(body.as_py()), _merged(spans.as_py()), 0, hashlib.sha256()
                for first, end in cuts:
                    kept.update(body[at:first])
                    at = end
                kept.update(body[at:])
                rows.append((sum(e - f for f, e in cuts), len(cuts), kept.hexdigest()))
            removed, runs, sha = list(zip(*rows)) or ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())],
                ["k1", "k2", "cut", "runs", "sha"],
            )

    texts = candidate_texts(docs, length, gram)
    spans = repeated_spans(texts, length, gram).groupBy(*_KEY).agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    cut = texts.select(*_KEY, "body").join(spans, _KEY).mapInArrow(digest, "k1 bigint, k2 bigint, cut bigint, runs bigint, sha string")
    rows = _keyed(docs).select("doc_id", *_KEY, F.octet_length("body").cast("bigint").alias("n_bytes"), F.sha2("body", 256).alias("whole"))
    by_text = rows.groupBy(*_KEY).agg(F.count("*").alias("copies")).join(cut, _KEY, "left")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return rows.join(by_text, _KEY).select(
        "doc_id", "n_bytes", F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("runs", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copied, hashlib.sha256().hexdigest()).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
    )
