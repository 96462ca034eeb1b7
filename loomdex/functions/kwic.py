"""Keyword-in-context view: light stemming, word finding, excerpt, prefix highlight."""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import methodcaller
from string import ascii_letters

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.functions.arrays import let, pieces
from loomdex.functions.text import fold_case, html_escape

# Letters of words in any case: what `(?iu)[а-яёa-z]` matches.
LETTERS = frozenset("абвгдежзийклмнопрстуфхцчшщъыьэюяёАБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ" + ascii_letters + "ıİſKᲀᲁᲂᲃᲄᲅᲆ")
WHOLE_WORD = re.compile(f"[{''.join(sorted(LETTERS))}]+")
REACH = 150
PLAIN = 200
ENDING = r"(?s)^(.{3,}?)(?:" + "|".join(vocab.LIGHT_ENDINGS) + r")\z"
FIRST_FOUND = pa.struct([("at", pa.int32()), ("matched", pa.string())])
FOUND_EACH = pa.list_(pa.struct([("word", pa.string()), ("at", pa.int32()), ("matched", pa.string())]))


def query_words(q: Column) -> Column:
    plain = F.regexp_replace(fold_case(q), "[^A-Za-z0-9_а-яё]", " ")
    return F.filter(
        F.split(plain, " +"), lambda w: (F.length(w) >= 3) & ~w.isin(vocab.KWIC_STOP)
    )


def light_stem(word: Column) -> Column:
    """Cut the longest listed ending that leaves at least three characters."""
    return F.regexp_replace(fold_case(word), ENDING, "$1")


def _place(text: str, low: str, word: str, folded: str, stem: str) -> tuple[int, str]:
    """Character offset (-1 when absent) and matched word: the word itself, else the first word of the text with its stem.

    A light stem is the beginning of its word, so a word of the text with that stem, or one that starts with it, is one
    where the stem stands at its start.
    """
    at = low.find(folded)
    if at >= 0:
        return at, word
    at = low.find(stem)
    while at >= 0:
        if at == 0 or text[at - 1] not in LETTERS:
            token = WHOLE_WORD.match(text, at)
            if token and token.end() - at >= len(stem):
                return at, token[0]
        at = low.find(stem, at + 1)
    return -1, ""


def _places(text: str | None, low: str | None, asked: list | None) -> Iterator[tuple[int, str]]:
    for w in asked:
        known = text is not None and w["word"] is not None
        yield _place(text, low, w["word"], w["folded"], w["stem"]) if known else (-1, "")


def _given(text: Column, found_words: Column) -> tuple[Column, Column, Column]:
    """A text, the same in lower case, and the query words with their light stems."""
    whole = F.make_valid_utf8(text)
    return whole, fold_case(whole), F.transform(
        found_words, lambda w: F.struct(w.alias("word"), fold_case(w).alias("folded"), light_stem(w).alias("stem"))
    )


def _rows(*columns: pa.Array) -> Iterator[tuple]:
    """Rows of Arrow columns as Python values, one at a time: the texts of a batch are not decoded at once."""
    return zip(*(map(methodcaller("as_py"), c) for c in columns))


def find_each(text: Column, found_words: Column) -> Column:
    """array<struct<word,at,matched>> for every query word, by Arrow batches."""

    def found(texts: pa.Array, lows: pa.Array, asked: pa.Array) -> pa.Array:
        out = [
            None if words is None else [
                {"word": w["word"], "at": at, "matched": matched} for w, (at, matched) in zip(words, _places(t, low, words))
            ]
            for t, low, words in _rows(texts, lows, asked)
        ]
        return pa.array(out, FOUND_EACH)

    return F.arrow_udf(found, "array<struct<word:string,at:int,matched:string>>")(*_given(text, found_words))


def first_found(text: Column, found_words: Column) -> Column:
    """struct<at,matched>: location of the first query word that occurs at all, by Arrow batches."""

    def found(texts: pa.Array, lows: pa.Array, asked: pa.Array) -> pa.Array:
        out = []
        for t, low, words in _rows(texts, lows, asked):
            at, matched = next((p for p in _places(t, low, words or []) if p[0] >= 0), (-1, ""))
            out.append(None if words is None else {"at": at, "matched": matched})
        return pa.array(out, FIRST_FOUND)

    return F.arrow_udf(found, "struct<at:int,matched:string>")(*_given(text, found_words))


def excerpt(text: Column, found_words: Column, reach: int = REACH) -> Column:
    n = F.length(text)
    opening = F.when(n > PLAIN, F.concat(F.left(text, F.lit(PLAIN)), F.lit("..."))).otherwise(text)

    def around(hit: Column) -> Column:
        stop = hit["at"] + F.length(hit["matched"])
        raw_start = F.greatest(F.lit(0), hit["at"] - reach)
        raw_end = F.least(n, stop + reach)
        gap = F.locate(" ", F.substring(text, raw_start + 1, hit["at"] - raw_start))
        start = F.when((raw_start > 0) & (gap > 0), raw_start + gap).otherwise(raw_start)
        # Last blank at or before raw_end, but after the match.
        behind = F.substring(text, stop + 2, raw_end - stop)
        kept = F.regexp_extract(behind, r"(?s)^(.*) [^ ]*\z", 1)
        has_gap = F.contains(behind, F.lit(" "))
        end = F.when((raw_end < n) & has_gap, stop + 1 + F.length(kept)).otherwise(raw_end)
        return let(
            F.struct(start.alias("a"), end.alias("b")),
            lambda w: F.concat(
                F.when(w["a"] > 0, "...").otherwise(""),
                F.substring(text, w["a"] + 1, w["b"] - w["a"]),
                F.when(w["b"] < n, "...").otherwise(""),
            ),
        )

    return let(
        first_found(text, found_words),
        lambda hit: F.when(hit["at"] < 0, opening).otherwise(around(hit)),
    )


def highlight(text: Column, found_words: Column) -> Column:
    """Escaped text with `<strong>` around words that start with a query stem, in one pass."""
    escaped_stems = F.transform(
        found_words, lambda w: F.regexp_replace(light_stem(w), r"([.*+?^${}()|\[\]\\])", r"\\$1")
    )
    pattern = F.concat(F.lit("(?iu)(?:"), F.array_join(escaped_stems, "|"), F.lit(")[а-яёa-z]*"))
    parts = pieces(text, pattern)
    marked = F.array_join(F.transform(parts, lambda p, i: F.when(
        i % 2 == 1, F.concat(F.lit("<strong>"), html_escape(p), F.lit("</strong>"))
    ).otherwise(html_escape(p))), "")
    return F.when(F.size(found_words) == 0, html_escape(text)).otherwise(marked)
