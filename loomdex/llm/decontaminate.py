"""Benchmark decontamination by spaced seeds.

A window of `SPAN` tokens is hashed under each mask, which ignores some places, so two windows that differ
only there share a seed. Every pair of places is ignored by one of the masks at least, so no window within
two substitutions is missed; more than two (`max_substitutions`) need masks of their own. Seeds of the benchmark's windows are looked up among all windows of all
documents, first in a Bloom filter of bounded size, then by an exact join; each hit is verified over the
whole window around it, which may differ in at most `max_substitutions` tokens. Items shorter than a
window are matched as a whole without substitutions; those below `least_tokens`, which clean texts may hold by
chance, match documents that consist of them alone. Letters of scripts without spaces are tokens one by one.

All of it is column expressions: the tokens of a window, as 64-bit hashes, are columns of a row, and no
text is shuffled.

Windows of the benchmark are grouped first, so repeated items and shared passages cost one window. Which items
hold a window is a table of its own, joined to the verified windows only, so every item is named.

Defined cases: null or empty texts and items have no tokens and match nothing; a null item_id is carried as null; rows that agree in doc_id and text are one document here and
share its verdict; a null doc_id is kept as such; an empty benchmark matches nothing; other columns are
ignored by `overlaps` and kept by `remove`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.llm import bloom
from loomdex.llm.common import keep

SPAN = 13
#: 1: the token counts, 0: it is ignored. Mask m ignores the places that are m, m + 1 or m + 3 modulo 7, the lines
#: of the Fano plane, so that any two places are ignored together by some mask.
MASKS = (
    "0010111001011",
    "1001011100101",
    "1100101110010",
    "1110010111001",
    "0111001011100",
    "1011100101110",
    "0101110010111",
)
MAX_SUBSTITUTIONS = 2
LEAST_TOKENS = 8


#: First and last letters of the blocks of scripts written without spaces: Thai and Lao, Myanmar, Khmer, kana, Han.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF),
)
_UNSPACED = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in UNSPACED) + "]"
#: One range to look for first: no text without such a letter holds any of the others.
_FAR = rf"[^\x00-\x{{{UNSPACED[0][0] - 1:X}}}]"


def tokens_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; letters of scripts without spaces one by one."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    apart = F.when(lower.rlike(_FAR), F.regexp_replace(lower, f"({_UNSPACED})", " $1 ")).otherwise(lower)
    return F.array_remove(F.split(apart, r"[^\p{L}\p{N}]+"), "")


def _t(i: int) -> Column:
    return F.col(f"t{i}")


def windows(df: DataFrame, text: str, span: int = SPAN) -> DataFrame:
    """A row per token: its place and the `span` tokens from it on (null past the end)."""
    rows = df.withColumn("_tokens", F.transform(tokens_of(F.col(text)), lambda t: F.xxhash64(t))).drop(text)
    size = F.size("_tokens")
    shifted = [F.slice("_tokens", i + 1, size).alias(f"t{i}") for i in range(span)]
    zipped = F.arrays_zip(F.slice(F.sequence(F.lit(1), size + 1), F.lit(1), size).alias("place"), *shifted)
    return rows.select(*[c for c in rows.columns if c != "_tokens"], F.inline(zipped).alias("place", *(f"t{i}" for i in range(span))))


def seeds(lengths: list[int], masks: tuple[str, ...] = MASKS, least_tokens: int = LEAST_TOKENS) -> list[Column]:
    """One hash per mask, null where the window is cut short, and one per length of the shorter items.

    Below `least_tokens` it is null but for a text of just that many tokens.
    """
    span = len(masks[0])
    spaced = [
        F.when(_t(span - 1).isNotNull(), F.xxhash64(F.lit(m), *(_t(i) for i in range(span) if mask[i] == "1")))
        for m, mask in enumerate(masks)
    ]
    whole = []
    for n in lengths:
        there = _t(n - 1).isNotNull()
        alone = there if n >= least_tokens else there & (F.col("place") == 1) & _t(n).isNull()
        whole.append(F.when(alone, F.xxhash64(F.lit(-n), *(_t(i) for i in range(n)))))
    return spaced + whole


def overlaps(
    docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS,
    max_substitutions: int = MAX_SUBSTITUTIONS, least_tokens: int = LEAST_TOKENS,
) -> DataFrame:
    """(doc_id, text_hash, n_windows, item_ids): documents that share a window with the benchmark, and with which items."""
    span = len(masks[0])
    cells = [f"t{i}" for i in range(span)]
    items = windows(
        benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text", F.size(tokens_of(F.col("text"))).alias("n")), "text", span
    )
    # Whole windows, and the first window of an item too short for one; n: tokens that must be there.
    own = items.filter((F.col("n") >= span) & _t(span - 1).isNotNull() | F.col("n").between(1, span - 1) & (F.col("place") == 1))
    own = keep(own.withColumn("n", F.least("n", F.lit(span))).withColumns(
        {"window": F.xxhash64(*cells), "window_too": F.xxhash64(F.lit(1), *cells)}
    ))
    members = own.select("window", "window_too", "item_id").distinct()
    held = keep(own.groupBy(*cells, "window", "window_too").agg(F.min("n").alias("n"), F.min("place").alias("place")))
    lengths = sorted(r.n for r in held.filter(F.col("n") < span).select("n").distinct().collect())  # fewer than span
    hashes = seeds(lengths, masks, least_tokens)
    fits = [F.col("n") == span] * len(masks) + [F.col("n") == n for n in lengths]
    keyed = held.withColumn("seed", F.explode(F.array_compact(F.array(*(F.when(f, h) for f, h in zip(fits, hashes))))))
    keyed = keyed.select("seed", "window", "window_too", "n", *(F.col(c).alias(f"b{i}") for i, c in enumerate(cells)))
    size = bloom.blocks_for(keyed.count())
    filter_ = bloom.build(keyed, "seed", size)

    rows = windows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"), "text", span)
    rows = rows.select("doc_id", "text_hash", "place", *cells, F.explode(F.array(*hashes)).alias("seed"))
    hits = bloom.test(rows, filter_, "maybe", "seed", size).filter("maybe").join(keyed, "seed")

    differ = reduce(
        lambda a, b: a + b,
        [F.when((F.col("n") > i) & ~_t(i).eqNullSafe(F.col(f"b{i}")), 1).otherwise(0) for i in range(span)],
    )
    verified = hits.filter(differ <= F.when(F.col("n") == span, max_substitutions).otherwise(0))
    # A document may meet a window at many places: counted once for each place, named once.
    by_window = verified.groupBy("doc_id", "text_hash", "window", "window_too").agg(F.collect_set("place").alias("places"))
    named = by_window.join(members, ["window", "window_too"])
    return named.groupBy("doc_id", "text_hash").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("bigint").alias("n_windows"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that share nothing with the benchmark, with all their columns."""
    found = overlaps(docs, benchmark, **options).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(found, same, "left_anti")
