"""Repeated runs of lines: a suffix array over line-ID sequences, by distributed prefix doubling.

Every document is a sequence of lines. Lines that occur once in the corpus end any repeated run, so only
repeated lines get into the array. Round 0 ranks suffixes by their first line, round k by their first 2^k
lines: the pair (rank here, rank 2^(k-1) lines further on) is counted, pairs that occur once are final and
drop out, the rest are sorted by range partitioning and numbered in that order. Suffixes with the same
rank have at least 2^k lines in common: they are an interval of the array whose longest common prefix is
that long. Any length m in between is the pair of the ranks of its first and its last 2^k lines.

A repeated run counts from `min_words` words on. Every line of such a run lies in a shortest run of that
many words that starts or ends in it, so it is enough to look up these shortest runs: the union of those
that are repeated is the union of all maximal repeated runs. In each interval the first occurrence by
(doc_id, line) stays and every later one is deleted, overlapping ones of one document included.

All of it is column expressions. Hot lines and hot runs are counted and minimised with partial aggregates;
the only rows that meet by rank are joins, whose hot keys Spark splits.

Defined cases: a null text stays null and has no lines; an empty text is one empty line, which never
counts alone, as a line without words counts as one word; rows that agree in doc_id and text are one
document here and keep or lose the same lines; null doc_ids come last in the corpus order; a document may
end up empty; other columns are kept by `remove_repeated_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdex.llm.common import keep

MIN_WORDS = 10

_KEY = ["d", "h"]


def _d(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit((1 << 63) - 1))


def _trimmed(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\f\v", "    "))


def lines_of(docs: DataFrame) -> DataFrame:
    """(d, h, pos, a, b, words): document key, place of the line, 128-bit id of the trimmed line, its words (at least one)."""
    rows = docs.filter("text is not null").select(
        _d(F.col("doc_id")).alias("d"), F.xxhash64("text").alias("h"), F.posexplode(F.split("text", "\n")).alias("pos", "line")
    ).select(*_KEY, "pos", _trimmed(F.col("line")).alias("line"))
    words = F.greatest(F.lit(1), F.size(F.filter(F.split("line", " "), lambda w: w != "")))
    return rows.select(
        *_KEY, "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"),
        F.least(F.lit(1 << 20), words).cast("int").alias("words"),
    )


def ranked(pairs: DataFrame) -> DataFrame:
    """(a, b, rank) for pairs that occur more than once; ranks follow the order of the pairs.

    After range partitioning and sorting, the running row number of a partition and the partition's own
    number above it make an increasing id, so no task needs to see all pairs.
    """
    repeated = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b")
    return keep(repeated.repartitionByRange("a", "b").sortWithinPartitions("a", "b").withColumn("rank", F.monotonically_increasing_id()))


def suffix_ranks(lines: DataFrame, rounds: int) -> list[DataFrame]:
    """Per round k: (d, h, pos, rank) of the suffixes whose first 2^k lines are repeated; words too in round 0."""
    distinct = lines.distinct()  # equal rows are one document
    at = keep(distinct.join(ranked(distinct.select("a", "b")), ["a", "b"]).select(*_KEY, "pos", "words", "rank"))
    out = [at]
    order = Window.partitionBy(*_KEY).orderBy("pos")
    for k in range(rounds):
        step = 1 << k
        ahead = at.select(
            *_KEY, "pos", F.col("rank").alias("a"), F.lead("rank", step).over(order).alias("b"), F.lead("pos", step).over(order).alias("next")
        )
        # A run of 2^(k+1) repeated lines has all its suffixes in this round, so they are neighbours here.
        pairs = ahead.filter(F.col("next") == F.col("pos") + step).select(*_KEY, "pos", "a", "b")
        at = keep(pairs.join(ranked(pairs.select("a", "b")), ["a", "b"]).select(*_KEY, "pos", "rank"))
        out.append(at)
    return out


def _shortest(rows: Column, i: Column, backward: bool, min_words: int) -> Column:
    """(first index, lines) of the shortest run of `min_words` words that starts (or ends) at index i; 0 lines if none."""
    if backward:
        near = F.reverse(F.slice(rows, F.greatest(F.lit(1), i + 2 - min_words), F.least(i + 1, F.lit(min_words))))
    else:
        near = F.slice(rows, i + 1, min_words)
    here = F.get(rows, i)["pos"]
    zero = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"))
    went = F.aggregate(
        near, zero,
        lambda s, x: F.when(
            (s["w"] < min_words) & (F.abs(x["pos"] - here) == s["n"]), F.struct((s["w"] + x["words"]).alias("w"), (s["n"] + 1).alias("n"))
        ).otherwise(s),
    )
    lines = F.when(went["w"] >= min_words, went["n"]).otherwise(0)
    return F.struct((i - F.when(F.lit(backward), lines - 1).otherwise(0)).alias("i"), lines.alias("m"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, h, first, end): maximal stretches of lines to delete in each document; `end` is exclusive."""
    rounds = max(0, min_words.bit_length() - 1)  # a shortest run has at most min_words lines
    ranks = suffix_ranks(lines_of(docs), rounds)
    rows = [
        r.select(*_KEY, "pos", (F.col("words") if k == 0 else F.lit(None).cast("int")).alias("words"),
                 *((F.col("rank") if j == k else F.lit(None).cast("bigint")).alias(f"r{j}") for j in range(rounds + 1)))
        for k, r in enumerate(ranks)
    ]
    table = rows[0]
    for r in rows[1:]:
        table = table.unionByName(r)
    columns = ["words", *(f"r{j}" for j in range(rounds + 1))]
    wide = table.groupBy(*_KEY, "pos").agg(*(F.max(c).alias(c) for c in columns))
    sequences = wide.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("pos", *columns))).alias("rows"))

    indexes = F.sequence(F.lit(0), F.size("rows") - 1)
    runs = F.concat(*(F.transform(indexes, lambda i: _shortest(F.col("rows"), i, backward, min_words)) for backward in (False, True)))
    found = sequences.select(*_KEY, "rows", F.explode(F.array_distinct(runs)).alias("run")).filter("run.m > 0")

    def rank_at(level: int, index: Column) -> Column:
        return F.get(F.col("rows"), index)[f"r{level}"]

    first = last = F.lit(None).cast("bigint")
    for k in range(rounds + 1):
        fits = (F.col("run.m") >= 1 << k) & (F.col("run.m") < 2 << k)
        first = F.when(fits, rank_at(k, F.col("run.i"))).otherwise(first)
        last = F.when(fits, rank_at(k, F.col("run.i") + F.col("run.m") - (1 << k))).otherwise(last)
    named = keep(
        found.select(*_KEY, F.get("rows", F.col("run.i"))["pos"].alias("pos"), F.col("run.m").alias("m"), first.alias("first"), last.alias("last"))
        .filter("first is not null and last is not null")
    )
    start = F.struct(*_KEY, "pos")
    intervals = keep(named.groupBy("m", "first", "last").agg(F.min(start).alias("original"), F.count("*").alias("n")).filter("n > 1"))
    later = named.join(intervals, ["m", "first", "last"]).filter(start != F.col("original"))

    # Overlapping and adjoining runs become one stretch.
    order = Window.partitionBy(*_KEY).orderBy("pos", "end")
    spans = later.select(*_KEY, "pos", (F.col("pos") + F.col("m")).alias("end")).distinct()
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.col("pos") <= reach, 0).otherwise(1))
    spans = spans.withColumn("stretch", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy(*_KEY, "stretch").agg(F.min("pos").alias("first"), F.max("end").alias("end")).drop("stretch")


def remove_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of `docs`, their text without the later copies, plus n_lines and n_removed."""
    cuts = repeated_runs(docs, min_words).groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("_cuts"))
    cuts = cuts.select(F.col("d").alias("_d"), F.col("h").alias("_h"), "_cuts")
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.select(own).join(cuts, (_d(F.col("doc_id")) == F.col("_d")) & (F.xxhash64("text") == F.col("_h")), "left")
    no_cuts = F.array().cast("array<struct<first:int,end:int>>")
    joined = joined.withColumn("_cuts", F.coalesce("_cuts", no_cuts)).withColumn("_lines", F.split("text", "\n"))
    starts = F.concat(F.array(F.lit(0)), F.col("_cuts.end"))
    ends = F.concat(F.col("_cuts.first"), F.array(F.size("_lines")))
    kept = F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(F.col("_lines"), s + 1, e - s)))
    removed = F.aggregate("_cuts", F.lit(0), lambda n, c: n + c["end"] - c["first"])
    text = F.when(F.size("_cuts") == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in own),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("bigint").alias("n_lines"), removed.cast("bigint").alias("n_removed"),
    )
