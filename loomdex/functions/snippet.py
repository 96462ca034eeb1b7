"""Snippet choice and highlighting for one hit, as column expressions.

Limits are bytes, positions inside the expressions are characters. The 500-byte scan, the 150-byte
look-back and the 250-byte window are part of the snippet definition; the text itself is never cut.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdex.functions.analysis import is_index_stop, is_query_stop, token_spans
from loomdex.functions.arrays import let, longest_within, running_sum
from loomdex.functions.stemmer import stem_ru
from loomdex.functions.text import (
    fold_case, html_escape, is_boilerplate_line, strip_combining, trim_space, truncate, words,
)

SCAN_BYTES = 500
LOOKBACK_BYTES = 150
WINDOW_BYTES = 250
WORD_CUT_BYTES = 120
ENOUGH = 300
BLANKS = r"[ \t\n\r]"
CANDIDATES = "array<struct<score:int,word_no:int,occurrence:int,start:int,end:int>>"


def after(text: Column, chars: Column) -> Column:
    return F.substring(text, chars + 1, F.length(text))


def before(text: Column, chars: Column) -> Column:
    return F.substring(text, F.lit(1), chars)


def candidate_words(query: Column, stop: list[str] | None = None) -> Column:
    return F.filter(
        words(fold_case(query)), lambda w: ~is_query_stop(w, stop) & (F.octet_length(w) > 1)
    )


def candidate_score(text: Column, start: Column, end: Column) -> Column:
    # The next line counts only when its break is 1..99 bytes away, so 100 characters suffice. They
    # also hold the next visible character, unless all of them are blank.
    lead, near = before(text, start), F.substring(text, end + 1, F.lit(100))
    next_line = F.regexp_extract(near, r"^([^\n]+)\n", 1)
    opener = r"^[\t-\r\x{85}\p{Z}]*[(—–\-]"
    followed = F.when(trim_space(near) != "", near.rlike(opener)).otherwise(after(text, end).rlike(opener))
    prev_line = F.regexp_extract(lead, r"\n([^\n]*)\z", 1)
    return (
        F.when(F.substring(text, start + 1, F.lit(1)).rlike(r"^\p{Lu}"), 100).otherwise(0)
        + F.when(start == 0, 30).when(lead.rlike(rf"(?:^|[.!?]){BLANKS}*\z"), 50).otherwise(0)
        + F.when(followed, 200).otherwise(0)
        - F.when(
            (F.octet_length(next_line) < 100) & is_boilerplate_line(trim_space(next_line)), 150
        ).otherwise(0)
        - F.when(is_boilerplate_line(trim_space(prev_line)), 100).otherwise(0)
    )


def candidates(text: Column, query: Column, stop: list[str] | None = None) -> Column:
    """Every occurrence of every query word in the scanned part, with its score.

    Matching ignores case and combining marks; offsets refer to the original characters.
    """

    def in_scan(scan: Column) -> Column:
        folded = strip_combining(fold_case(scan))
        n = F.length(scan)
        kept = F.when(scan.rlike(r"\p{Mn}"), F.filter(
            F.sequence(F.lit(1), n),
            lambda i: ~F.substring(scan, i, F.lit(1)).rlike(r"\p{Mn}"),
        ))

        def original(kept_at: Column, i: Column) -> Column:
            """Original characters consumed once i unmarked characters have been read."""
            return F.when(i == 0, 0).when(kept_at.isNull(), i).otherwise(F.get(kept_at, i - 1))

        def of_word(f: Column, kept_at: Column, w: Column, word_no: Column) -> Column:
            k = F.length(w)
            # A zero-width split cuts in front of every occurrence, overlapping ones included.
            cuts = F.split(f, F.concat(F.lit(r"(?=\Q"), F.replace(w, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)")))
            # The scan is short, so what lies before a piece is put together instead of added up in many nested steps.
            starts = let(cuts, lambda c: F.transform(c, lambda p, j: F.length(F.array_join(F.slice(c, F.lit(1), j), ""))))
            hits = F.filter(starts, lambda i: (i > 0) | F.startswith(f, w))
            placed = F.transform(hits, lambda i: F.struct(
                i.alias("i"),
                original(kept_at, i).cast("int").alias("start"),
                original(kept_at, i + k).cast("int").alias("end"),
            ))
            scored = F.transform(placed, lambda h: F.struct(
                candidate_score(text, h["start"], h["end"]).cast("int").alias("score"),
                word_no.cast("int").alias("word_no"),
                h["i"].cast("int").alias("occurrence"),
                h["start"].alias("start"),
                h["end"].alias("end"),
            ))
            return F.when((k > 0) & F.contains(f, w), scored).otherwise(
                F.expr(f"cast(array() as {CANDIDATES})")
            )

        return let(F.struct(folded.alias("f"), kept.alias("kept")), lambda s: F.flatten(
            F.transform(
                candidate_words(query, stop),
                lambda w, no: let(strip_combining(w), lambda v: of_word(s["f"], s["kept"], v, no)),
            )
        ))

    return F.when(text == "", F.expr(f"cast(array() as {CANDIDATES})")).otherwise(
        let(before(text, longest_within(F.substring(text, 1, SCAN_BYTES), SCAN_BYTES)), in_scan)
    )


def best_candidate(found: Column) -> Column:
    """Highest score, earliest on ties; words after the first good enough one are not tried."""
    return let(found, _best)


def _best(found: Column) -> Column:
    enough = F.array_min(F.transform(
        F.filter(found, lambda c: c["score"] >= ENOUGH), lambda c: c["word_no"]
    ))
    ordered = F.transform(
        let(enough, lambda e: F.filter(found, lambda c: e.isNull() | (c["word_no"] <= e))),
        lambda c: F.struct(
            c["score"].alias("score"),
            (-c["word_no"]).alias("neg_word"),
            (-c["occurrence"]).alias("neg_occurrence"),
            c["start"].alias("start"),
            c["end"].alias("end"),
        ),
    )
    return F.array_max(ordered)


def window(text: Column, anchor: Column) -> Column:
    """struct<start,end> of the shown part around character `anchor`."""
    reach = F.substring(text, F.greatest(anchor - LOOKBACK_BYTES, F.lit(0)) + 1, F.least(anchor, F.lit(LOOKBACK_BYTES)))
    tail = let(reach, lambda r: F.substring(
        r, F.length(r) - longest_within(r, LOOKBACK_BYTES, from_end=True) + 1, F.length(r)
    ))
    sentence = anchor - F.length(F.regexp_extract(tail, r"([^.!?\n]*)\z", 1))
    start = let(sentence, lambda s: s + F.length(F.regexp_extract(after(text, s), rf"^{BLANKS}*", 0)))

    def finish(s: Column) -> Column:
        near = F.substring(text, s + 1, F.lit(WINDOW_BYTES + 1))
        shown = before(near, longest_within(near, WINDOW_BYTES))
        to_blank = F.regexp_extract(shown, r"(?s)^(.*) [^ ]*\z", 1)
        end = F.when(
            s + F.length(near) >= F.length(text),
            F.when(F.octet_length(near) <= WINDOW_BYTES, F.length(text)),
        )
        cut = F.when(F.octet_length(to_blank) > WORD_CUT_BYTES, s + F.length(to_blank)).otherwise(
            s + F.length(shown)
        )
        return F.struct(s.cast("int").alias("start"), F.coalesce(end, cut).cast("int").alias("end"))

    return let(start, finish)


def mark(text: Column, ranges: Column, win: Column, stop: list[str] | None = None) -> Column:
    """Escaped window text with `<mark>` around the visible, non-overlapping ranges."""
    start, end = win["start"], win["end"]

    def cut(a: Column, b: Column) -> Column:
        return F.substring(text, a + 1, b - a)

    visible = F.transform(
        F.filter(ranges, lambda r: (r["end"] > start) & (r["start"] < end)),
        lambda r: F.struct(
            F.greatest(r["start"], start).alias("start"), F.least(r["end"], end).alias("end")
        ),
    )
    shown = F.filter(
        visible, lambda r: ~is_query_stop(trim_space(cut(r["start"], r["end"])), stop)
    )
    folded = F.aggregate(
        shown,
        F.struct(start.alias("at"), F.lit("").alias("out")),
        lambda acc, r: F.when(
            r["start"] >= acc["at"],
            F.struct(
                r["end"].alias("at"),
                F.concat(
                    acc["out"],
                    html_escape(cut(acc["at"], r["start"])),
                    F.lit("<mark>"),
                    html_escape(cut(r["start"], r["end"])),
                    F.lit("</mark>"),
                ).alias("out"),
            ),
        ).otherwise(acc),
    )
    body = let(folded, lambda f: F.concat(f["out"], html_escape(cut(f["at"], end))))
    leading = F.when(before(text, start).rlike(r"[^ \t\n\r]"), "...").otherwise("")
    trailing = F.when(end < F.length(text), "...").otherwise("")
    return F.concat(leading, body, trailing)


def term_ranges(text: Column, terms: Column) -> Column:
    """Character ranges of the tokens whose index term is one of `terms`."""

    def is_match(heads: Column, token: Column) -> Column:
        # A stem is a prefix of its token: the first letters rule out most tokens before stemming.
        plain = F.translate(F.left(token, F.lit(2)), "ё", "е")
        return (
            (F.array_contains(heads, plain) | F.array_contains(heads, F.left(plain, F.lit(1))))
            & ~is_index_stop(token)
            & F.array_contains(terms, stem_ru(token))
        )

    def ranges(heads: Column) -> Column:
        return F.transform(
            F.filter(token_spans(text, F.length), lambda s: is_match(heads, s["token"])),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")),
        )

    return let(F.transform(terms, lambda t: F.left(t, F.lit(2))), ranges)


def vector_ranges(vector: Column, terms: Column) -> Column:
    """The same ranges from a stored term vector, in text order: no text is read."""
    wanted = F.filter(vector, lambda t: F.array_contains(terms, t["term"]))
    places = F.flatten(F.transform(wanted, lambda t: F.transform(t["locs"], lambda p: F.struct(
        p["first"].alias("start"), p["last"].alias("end")
    ))))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    return F.coalesce(F.array_sort(places), none)


def stored_ranges(vector: Column, terms: Column) -> Column:
    """`vector_ranges` of a vector in the stored layout, whose places are steps from one to the next."""
    gaps = F.zip_with(vector["start"], vector["first"], lambda a, b: a + b)
    sizes = F.zip_with(vector["end"], vector["last"], lambda a, b: a + b)
    steps = let(F.struct(gaps.alias("gap"), sizes.alias("size")), lambda s: F.struct(
        running_sum(F.zip_with(s["gap"], s["size"], lambda a, b: a + b)).alias("ends"), s["size"].alias("size"),
        F.transform(vector["term"], lambda t: F.array_contains(terms, t)).alias("wanted"),
    ))
    places = let(steps, lambda s: F.transform(
        F.filter(F.sequence(F.lit(0), F.size(vector["of"]) - 1), lambda i: F.get(s["wanted"], F.get(vector["of"], i))),
        lambda i: F.struct((F.get(s["ends"], i) - F.get(s["size"], i)).alias("start"), F.get(s["ends"], i).alias("end")),
    ))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    return F.when(vector.isNull(), none).otherwise(places)


def window_ranges(found: Column, best: Column, win: Column) -> Column:
    """Ranges inside the window plus the chosen occurrence, ordered by start, longer first."""
    inside = F.filter(found, lambda r: (r["end"] > win["start"]) & (r["start"] < win["end"]))

    def with_best(shown: Column) -> Column:
        known = F.exists(shown, lambda r: (r["start"] == best["start"]) & (r["end"] == best["end"]))
        extra = F.array(F.struct(best["start"].alias("start"), best["end"].alias("end")))
        joined = F.when(best.isNull() | known, shown).otherwise(F.concat(shown, extra))
        keyed = F.transform(
            joined, lambda r: F.struct(r["start"].alias("start"), (-r["end"]).alias("neg_end"))
        )
        return F.transform(
            F.array_sort(keyed),
            lambda r: F.struct(r["start"].alias("start"), (-r["neg_end"]).alias("end")),
        )

    return let(inside, with_best)


def snippet(text: Column, query: Column, places: Column, stop: list[str] | None = None) -> Column:
    """Snippet of a hit: `query` is the cleaned query, `places` the ranges of its index terms in the text."""

    def with_ranges(found: Column) -> Column:
        best = best_candidate(candidates(text, query, stop))

        def render(b: Column) -> Column:
            anchor = F.coalesce(b["start"], F.get(found, F.lit(0))["start"])
            return let(
                let(anchor, lambda at: window(text, at)),
                lambda w: let(window_ranges(found, b, w), lambda ranges: mark(text, ranges, w, stop)),
            )

        return F.when(F.size(found) == 0, truncate(text)).otherwise(let(best, render))

    return F.when(text == "", "").otherwise(let(places, with_ranges))
