"""Array helpers that keep whole-document work inside one row (no shuffle, no Python)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "\u0001"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def any_of(conditions) -> Column:
    conditions = list(conditions)
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


# Items of a block of prefix sums; only block totals go through the doubling passes.
SUM_BLOCK = 16


def _doubling_sum(values: Column) -> Column:
    """Inclusive prefix sums in log2(n) doubling passes."""

    def scan(a: Column) -> Column:
        passes = F.ceil(F.log2(F.size(a).cast("double"))).cast("int")
        return F.when(F.size(a) < 2, a).otherwise(
            F.aggregate(
                F.sequence(F.lit(0), F.greatest(passes - 1, F.lit(0))),
                a,
                lambda acc, step: let(
                    F.pow(F.lit(2.0), step).cast("int"),
                    lambda shift: F.transform(
                        acc, lambda x, i: x + F.coalesce(F.get(acc, i - shift), F.lit(0))
                    ),
                ),
            )
        )

    return let(values, scan)


def running_sum(values: Column) -> Column:
    """Inclusive prefix sums of an integer array: within blocks, then plus the sums of the blocks before."""

    def within(block: Column) -> Column:
        # A short block is summed by appending to its own array.
        first = F.slice(block, 1, 1)
        return F.aggregate(
            F.slice(block, F.lit(2), F.lit(SUM_BLOCK)), first,
            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
        )

    def blocked(a: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(a), F.lit(SUM_BLOCK))
        sums = F.transform(starts, lambda at: within(F.slice(a, at, F.lit(SUM_BLOCK))))
        return let(sums, lambda blocks: let(
            _doubling_sum(F.transform(blocks, lambda b: F.element_at(b, -1))),
            lambda totals: F.flatten(F.transform(blocks, lambda b, j: F.when(j == 0, b).otherwise(
                let(F.get(totals, j - 1), lambda t: F.transform(b, lambda x: x + t))
            ))),
        ))

    return let(values, lambda a: F.when(F.size(a) <= SUM_BLOCK, _doubling_sum(a)).otherwise(blocked(a)))


def marked(text: Column, pattern: str) -> Column:
    """Text with a mark before and behind every match."""
    return F.regexp_replace(F.translate(text, MARK, " "), pattern, f"{MARK}$0{MARK}")


def pieces(text: Column, pattern: str) -> Column:
    """Split text into gap, match, gap, match, ..., gap (odd length, nothing lost)."""
    return F.split(marked(text, pattern), MARK)


def spans(text: Column, pattern: str, measure: Callable[[Column], Column], unit: str = "int") -> Column:
    """array<struct<pos,start,end,token>> of all matches; offsets in the unit of `measure`, as numbers of type `unit`."""
    parts_and_ends = let(
        pieces(text, pattern),
        lambda parts: F.struct(
            parts.alias("parts"),
            running_sum(F.transform(parts, lambda p: measure(p).cast(unit))).alias("ends"),
        ),
    )

    def build(pe: Column) -> Column:
        parts, ends = pe["parts"], pe["ends"]
        count = (F.size(parts) - 1) / 2
        return F.when(F.size(parts) < 2, F.expr(
            f"cast(array() as array<struct<pos:int,start:{unit},end:{unit},token:string>>)"
        )).otherwise(
            F.transform(
                F.sequence(F.lit(1), count.cast("int")),
                lambda k: F.struct(
                    k.alias("pos"),
                    F.get(ends, 2 * k - 2).alias("start"),
                    F.get(ends, 2 * k - 1).alias("end"),
                    F.get(parts, 2 * k - 1).alias("token"),
                ),
            )
        )

    return let(parts_and_ends, build)


def longest_within(text: Column, limit_bytes: int, from_end: bool = False) -> Column:
    """Character count of the longest prefix (or suffix) of at most `limit_bytes` bytes."""
    window = F.least(F.length(text), F.lit(limit_bytes))

    def piece(k: Column) -> Column:
        if from_end:
            return F.substring(text, F.length(text) - k + 1, k)
        return F.substring(text, F.lit(1), k)

    return F.when(F.octet_length(text) <= limit_bytes, F.length(text)).otherwise(
        F.array_max(
            F.filter(
                F.sequence(F.lit(0), window), lambda k: F.octet_length(piece(k)) <= limit_bytes
            )
        )
    )
