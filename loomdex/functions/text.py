"""Text cleaning as column expressions. Patterns avoid lookaround and spell out classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.functions.arrays import any_of

UNICODE_SPACE = r"[\t-\r\x{85}\p{Z}]"
ASCII_SPACE = r"[\t\n\f\r ]"

WIKI_REGEXES = ["(?iu)" + p.replace(r"\s", ASCII_SPACE) for p in vocab.WIKI_PATTERNS]


def fold_case(c: Column) -> Column:
    """Lower-case one character at a time (full case mapping would change text length)."""
    return F.lower(F.translate(c, "İΣ", "iσ"))


def trim_space(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{UNICODE_SPACE}+|{UNICODE_SPACE}+\z", "")


def words(c: Column) -> Column:
    """Whitespace-separated words, as an array without empty entries."""
    return F.filter(F.split(c, f"{UNICODE_SPACE}+"), lambda w: w != "")


def normalize_ws(c: Column) -> Column:
    return trim_space(F.regexp_replace(c, f"{ASCII_SPACE}+", " "))


def token_join(c: Column) -> Column:
    """One blank between words; text that could not be extracted becomes the error text."""
    joined = F.trim(F.regexp_replace(c, f"{UNICODE_SPACE}+", " "))
    return F.coalesce(joined, F.lit(vocab.PDF_ERROR_TEXT))


def strip_combining(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{Mn}", "")


def html_escape(c: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def truncate(c: Column, limit: int = 250) -> Column:
    return F.when(
        F.length(c) > limit, F.concat(html_escape(F.left(c, F.lit(limit))), F.lit("..."))
    ).otherwise(html_escape(c))


def wiki_scrub(c: Column) -> Column:
    for pattern in WIKI_REGEXES:
        c = F.regexp_replace(c, pattern, " ")
    return c


def is_boilerplate_line(c: Column) -> Column:
    low = fold_case(c)
    return any_of(F.contains(low, F.lit(p)) for p in vocab.BOILERPLATE_PHRASES)


def strip_boilerplate(c: Column) -> Column:
    """Drop each known prefix that starts in the first 100 bytes, with everything before it."""

    def drop(text: Column, prefix: Column) -> Column:
        at = F.instr(text, prefix)
        tail = F.substring(text, at, F.length(text))
        newline = F.instr(tail, F.lit("\n"))
        stop = F.instr(tail, F.lit(". "))
        skip = (
            F.when(newline > 0, newline - 1).when(stop > 0, stop - 1).otherwise(F.length(prefix))
        )
        near_start = (at > 0) & (F.octet_length(F.substring(text, F.lit(1), at - 1)) < 100)
        return F.when(
            near_start, trim_space(F.substring(tail, skip + 1, F.length(tail)))
        ).otherwise(text)

    prefixes = F.array(*[F.lit(p) for p in vocab.BOILERPLATE_PREFIXES])
    return trim_space(F.aggregate(prefixes, c, drop))


def content_hash(c: Column) -> Column:
    return F.md5(c)


def long_enough(c: Column, minimum: int = vocab.MIN_PAGE_BYTES) -> Column:
    return F.octet_length(c) >= minimum


def safe_string(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def title_key(c: Column) -> Column:
    return fold_case(trim_space(c))
