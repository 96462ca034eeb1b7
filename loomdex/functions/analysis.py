"""Index- and query-time text analysis: tokens, stop filter, stems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.functions.arrays import spans
from loomdex.functions.stemmer import stem_ru
from loomdex.functions.text import fold_case, words

# Word rules for scripts written with and without blanks, after the published Unicode text segmentation.
# Ranges whose letters do not form words by adjacency: Thai and Lao, Myanmar, Khmer, kana, ideographs.
UNSPACED = (
    r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3005}-\x{30FF}\x{31F0}-\x{31FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{20000}-\x{3FFFF}"
)
KATAKANA = r"\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}\x{FF66}-\x{FF9F}"
LETTER = rf"[\p{{L}}\p{{M}}&&[^{UNSPACED}]]"
# A soft hyphen or a joiner stays inside the word it is in.
LETTERS = rf"{LETTER}[\p{{L}}\p{{M}}\x{{AD}}\x{{200C}}\x{{200D}}&&[^{UNSPACED}]]*+"
# One of these between two letters, or between two digits, does not end the word.
BETWEEN_LETTERS = "['’‘.:·․‧﹒﹕＇．：]"
BETWEEN_DIGITS = "[,;'’‘.․،٬﹐﹒﹔＇，．；]"
# The loops are possessive: very long runs are matched without recursion.
WORD = rf"(?:{LETTERS}(?:{BETWEEN_LETTERS}{LETTERS})*+|\p{{N}}++(?:{BETWEEN_DIGITS}\p{{N}}++)*+|\p{{Pc}}++)++"
KATAKANA_RUN = rf"[{KATAKANA}][{KATAKANA}\x{{3099}}\x{{309A}}]*+"
SINGLE = rf"[\p{{L}}&&[{UNSPACED}]]\p{{M}}*+"
TOKEN = rf"{WORD}|{KATAKANA_RUN}|{SINGLE}"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(fold_case(text), F.lit(TOKEN), F.lit(0))


def token_spans(text: Column, measure=F.octet_length) -> Column:
    """Tokens with position and offsets (bytes by default) in the original text."""
    return F.transform(
        spans(text, TOKEN, measure),
        lambda s: F.struct(
            s["pos"].alias("pos"), s["start"].alias("start"), s["end"].alias("end"),
            fold_case(s["token"]).alias("token"),
        ),
    )


def is_index_stop(token: Column) -> Column:
    return token.isin(vocab.RUSSIAN_STOP)


def index_tokens(text: Column) -> Column:
    """Tokens that are indexed, before stemming."""
    return F.filter(tokens(text), lambda t: ~is_index_stop(t))


def analyze(text: Column) -> Column:
    """Index terms of a text in order."""
    return F.transform(index_tokens(text), stem_ru)


def analyzed_spans(text: Column, measure=F.octet_length) -> Column:
    """Index terms with positions and offsets; positions count removed stop words too."""
    kept = F.filter(token_spans(text, measure), lambda s: ~is_index_stop(s["token"]))
    return F.transform(
        kept,
        lambda s: F.struct(
            s["pos"].alias("pos"), s["start"].alias("start"), s["end"].alias("end"),
            stem_ru(s["token"]).alias("term"),
        ),
    )


def _bytes_and_chars(part: Column) -> Column:
    """Both lengths in one number, so that one prefix sum gives both offsets."""
    return F.shiftleft(F.octet_length(part).cast("bigint"), 32) + F.length(part)


def located_terms(text: Column) -> Column:
    """array<struct<term,pos,start,end,first,last>>: index terms with position, byte offsets and character offsets."""

    def chars(packed: Column) -> Column:
        return packed.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")

    tokens_found = F.transform(spans(text, TOKEN, _bytes_and_chars, "bigint"), lambda s: F.struct(
        s["pos"].alias("pos"), s["start"].alias("start"), s["end"].alias("end"), fold_case(s["token"]).alias("token")
    ))
    return F.transform(F.filter(tokens_found, lambda s: ~is_index_stop(s["token"])), lambda s: F.struct(
        stem_ru(s["token"]).alias("term"), s["pos"].alias("pos"),
        F.shiftright(s["start"], 32).cast("int").alias("start"), F.shiftright(s["end"], 32).cast("int").alias("end"),
        chars(s["start"]).alias("first"), chars(s["end"]).alias("last"),
    ))


def is_query_stop(word: Column, stop: list[str] | None = None) -> Column:
    return fold_case(word).isin(vocab.QUERY_STOP if stop is None else stop)


def clean_query(q: Column, stop: list[str] | None = None) -> Column:
    """Query without stop words; a query of stop words only is kept as it is."""
    kept = F.array_join(F.filter(words(q), lambda w: ~is_query_stop(w, stop)), " ")
    return F.coalesce(F.nullif(kept, F.lit("")), q)
