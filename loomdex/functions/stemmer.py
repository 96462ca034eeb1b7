"""Russian Snowball stemmer (published algorithm) as anchored regular expressions.

A word is cut after its first vowel; endings are looked for in the rest (RV). The leftmost match of
an anchored alternation is the longest ending of its class. R2 starts after the second
vowel-consonant pair of the word.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.functions.arrays import let

_V = "[аеиоуыэюя]"
_C = "[^аеиоуыэюя]"
FIRST_VOWEL = f"^{_C}*{_V}"
R2 = f"^{_C}*{_V}+{_C}{_C}*{_V}+{_C}"

# Endings of the published algorithm.
_GERUND_AFTER_A = "вшись|вши|в"
_GERUND = "ившись|ывшись|ивши|ывши|ив|ыв"
_ADJECTIVE = (
    "ими|ыми|его|ого|ему|ому|ее|ие|ые|ое|ей|ий|ый|ой|ем|им|ым|ом|их|ых|ую|юю|ая|яя|ою|ею"
)
_PARTICIPLE_AFTER_A = "ем|нн|вш|ющ|щ"
_PARTICIPLE = "ивш|ывш|ующ"
_VERB_AFTER_A = "ете|йте|ешь|нно|ла|на|ли|ем|ло|но|ет|ют|ны|ть|й|л|н"
_VERB = (
    "ейте|уйте|ила|ыла|ена|ите|или|ыли|ило|ыло|ено|ует|уют|ены|ить|ыть|ишь|ей|уй|ил|ыл|им|ым|ен|ят|ит|ыт|ую|ю"
)
_NOUN = (
    "иями|ями|ами|ией|иям|ием|иях|ев|ов|ие|ье|еи|ии|ей|ой|ий|ям|ем|ам|ом|ах|ях|ию|ью|ия|ья|а|е|и|й|о|у|ы|ь|ю|я"
)

GERUND = rf"(?:(?<=[ая])(?:{_GERUND_AFTER_A})|{_GERUND})\z"
REFLEXIVE = r"(?:ся|сь)\z"
ADJECTIVAL = rf"(?:(?<=[ая])(?:{_PARTICIPLE_AFTER_A})|{_PARTICIPLE})?(?:{_ADJECTIVE})\z"
VERB = rf"(?:(?<=[ая])(?:{_VERB_AFTER_A})|{_VERB})\z"
NOUN = rf"(?:{_NOUN})\z"
DERIVED = r"ость?\z"
# Last letters of the endings: a cheap test before the expression is tried.
ADJECTIVE_TAILS = sorted({e[-2:] for e in _ADJECTIVE.split("|")})
VERB_TAILS = sorted({e[-1] for e in (_VERB_AFTER_A + "|" + _VERB).split("|")})
NOUN_TAILS = sorted({e[-1] for e in _NOUN.split("|")})
SUPERLATIVE = r"ейше?\z"


def _last(c: Column, n: int = 1) -> Column:
    return F.right(c, F.lit(n))


def _cut(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def _first_change(c: Column, *steps) -> Column:
    """Result of the first step that changes c, else of the last step."""
    if len(steps) == 1:
        return steps[0](c)
    return let(steps[0](c), lambda r: F.when(r != c, r).otherwise(_first_change(c, *steps[1:])))


def _inflection(rest: Column) -> Column:
    """Step 1: gerund, else reflexive and then adjective, verb or noun ending."""

    def gerund(c: Column) -> Column:
        return F.when(_last(c).isin("в", "и", "ь"), _cut(c, GERUND)).otherwise(c)

    def others(c: Column) -> Column:
        plain = F.when(_last(c, 2).isin("ся", "сь"), _cut(c, REFLEXIVE)).otherwise(c)
        return let(plain, lambda p: _first_change(
            p,
            lambda x: F.when(_last(x, 2).isin(ADJECTIVE_TAILS), _cut(x, ADJECTIVAL)).otherwise(x),
            lambda x: F.when(_last(x).isin(VERB_TAILS), _cut(x, VERB)).otherwise(x),
            lambda x: F.when(_last(x).isin(NOUN_TAILS), _cut(x, NOUN)).otherwise(x),
        ))

    return _first_change(rest, gerund, others)


def _derivation(start: Column, rest: Column) -> Column:
    """Step 3: derivational ending inside R2."""

    def cut(r2: Column) -> Column:
        kept = F.length(_cut(F.concat(start, rest), DERIVED))
        return F.when((r2 > 0) & (kept >= r2), F.substring(rest, F.lit(1), kept - F.length(start))).otherwise(rest)

    word = F.concat(start, rest)
    return F.when(
        _last(rest, 3).isin("ост", "сть"), let(F.length(F.regexp_extract(word, R2, 0)), cut)
    ).otherwise(rest)


def _tidy(rest: Column) -> Column:
    """Step 4: soft sign, or superlative and doubled н."""

    def single_n(c: Column) -> Column:
        return F.when(_last(c, 2) == "нн", F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)

    return (
        F.when(_last(rest) == "ь", F.substring(rest, F.lit(1), F.length(rest) - 1))
        .when(_last(rest, 3).isin("ейш", "йше"), let(_cut(rest, SUPERLATIVE), single_n))
        .otherwise(single_n(rest))
    )


def stem_ru(token: Column) -> Column:
    """Stem of a lower-case token; tokens without Cyrillic letters pass unchanged."""

    def drop_i(c: Column) -> Column:
        return F.when(_last(c) == "и", F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)

    def of_word(word: Column) -> Column:
        def of_rest(start: Column) -> Column:
            rest = F.substring(word, F.length(start) + 1, F.length(word))
            stripped = let(_inflection(rest), drop_i)
            short = let(stripped, lambda r: let(_derivation(start, r), _tidy))
            return F.when(start == "", word).otherwise(F.concat(start, short))

        return let(F.regexp_extract(word, FIRST_VOWEL, 0), of_rest)

    return F.when(token.rlike("[а-яё]"), let(F.translate(token, "ё", "е"), of_word)).otherwise(token)


_STEPS = {
    name: re.compile(pattern.replace(r"\z", r"\Z"))
    for name, pattern in (
        ("vowel", FIRST_VOWEL), ("r2", R2), ("gerund", GERUND), ("reflexive", REFLEXIVE), ("adjectival", ADJECTIVAL),
        ("verb", VERB), ("noun", NOUN), ("derived", DERIVED), ("superlative", SUPERLATIVE),
    )
}
_CYRILLIC = re.compile("[а-яё]")
_STOP = frozenset(vocab.RUSSIAN_STOP)


def _without(name: str, word: str) -> str:
    return _STEPS[name].sub("", word)


def _stem(token: str) -> str:
    """`stem_ru` of one token: the same steps and expressions."""
    word = token.replace("ё", "е")
    vowel = _STEPS["vowel"].match(word)
    if vowel is None:
        return word
    start, rest = vowel[0], word[vowel.end():]
    r = _without("gerund", rest) if rest[-1:] in ("в", "и", "ь") else rest
    if r == rest:
        plain = _without("reflexive", rest) if rest[-2:] in ("ся", "сь") else rest
        r = plain
        for name, size, tails in (("adjectival", 2, ADJECTIVE_TAILS), ("verb", 1, VERB_TAILS), ("noun", 1, NOUN_TAILS)):
            if plain[-size:] in tails:
                r = _without(name, plain)
            if r != plain:
                break
    r = r.removesuffix("и")
    if r[-3:] in ("ост", "сть"):
        r2 = _STEPS["r2"].match(start + r)
        kept = len(_without("derived", start + r))
        if r2 and kept >= r2.end():
            r = r[: kept - len(start)]
    if r[-1:] == "ь":
        return start + r[:-1]
    if r[-3:] in ("ейш", "йше"):
        r = _without("superlative", r)
    return start + (r[:-1] if r[-2:] == "нн" else r)


@lru_cache(1 << 18)
def index_term(token: str) -> str | None:
    """Index term of a lower-case token, None for a stop word."""
    if token in _STOP:
        return None
    return _stem(token) if _CYRILLIC.search(token) else token
