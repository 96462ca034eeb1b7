"""Language identification by cross-parsing: how few phrases of a language's training text spell out a document.

For each language a suffix automaton of a bounded labelled sample gives, at every place of a document,
the longest stretch that also occurs in the sample; such stretches, taken one after another, are the
phrases. The number of phrases, times the logarithm of the sample's length, per symbol, is the
cross-entropy by Ziv and Merhav's parsing; the language with the least wins.

Symbols are lower-case letters, with a code for every letter of every sample; everything between letters is
one gap symbol. Letters unknown to every sample match nothing. Texts are cut into stretches of `STRETCH` symbols that are parsed side by side, so
one table lookup advances thousands of stretches in all languages; a phrase ends at a stretch's end.

Defined cases: a null text or one without a letter is `und` with score 0, as is every text if no row is
labelled; ties go to the language first in alphabetical order; repeated rows get the same answer;
any other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdex.llm.common import held_out

UNDETERMINED = "und"
#: Bounds of the sample a language is learned from: documents, and symbols in all.
SAMPLE_DOCS = 64
SAMPLE_SYMBOLS = 32_768
#: A text beyond its share of the sample is learned from so many pieces, spread evenly from its start to its end.
PIECES = 8
STRETCH = 512
UNKNOWN, GAP = 0, 1


def spread(symbols: np.ndarray, share: int) -> np.ndarray:
    """A text's symbols, or `share` of them in pieces over its whole length."""
    if len(symbols) <= share:
        return symbols
    pieces = min(PIECES, share)
    sizes = [share * (i + 1) // pieces - share * i // pieces for i in range(pieces)]
    free = len(symbols) - share  # shared out evenly between the pieces
    starts = [share * i // pieces + free * i // max(1, pieces - 1) for i in range(pieces)]
    return np.concatenate([symbols[start:start + size] for start, size in zip(starts, sizes)])


def spread_text(text: Column, most: int = SAMPLE_SYMBOLS) -> Column:
    """The same for a text's characters as a column, with blanks between the pieces."""
    size, length = most // PIECES, F.char_length(text).cast("bigint")
    pieces = [F.substr(text, (F.floor((length - size) * i / (PIECES - 1)) + 1).cast("int"), F.lit(size)) for i in range(PIECES)]
    return F.when(length <= most, text).otherwise(F.concat_ws(" ", *pieces))


class SuffixAutomaton:
    """Transitions of the smallest automaton that accepts every substring of a text."""

    def __init__(self, text: list[int]) -> None:
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for symbol in text:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and symbol not in self.next[at]:
                self.next[at][symbol] = new
                at = link[at]
            if at >= 0:
                reached = self.next[at][symbol]
                if length[reached] == length[at] + 1:
                    link[new] = reached
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[reached]))
                    length.append(length[at] + 1)
                    link.append(link[reached])
                    while at >= 0 and self.next[at].get(symbol) == reached:
                        self.next[at][symbol] = copy
                        at = link[at]
                    link[reached] = link[new] = copy
            last = new


class ParsingTable:
    """Moves of several automata in one hash table with two places for each, so that its size goes by moves, not by letters.

    A key is a state, numbered through all automata, and a symbol. At a root any symbol begins a phrase, so
    roots have rows of their own.
    """

    def __init__(self, automata: list[SuffixAutomaton], symbols: int) -> None:
        self.symbols = symbols
        sizes = [len(a.next) for a in automata]
        self.starts = np.cumsum([0, *sizes], dtype=np.int64)[:-1]
        self.roots = np.repeat(self.starts[:, None], symbols, axis=1)
        keys: list[int] = []
        to: list[int] = []
        for which, automaton in enumerate(automata):
            start = int(self.starts[which])
            for symbol, state in automaton.next[0].items():
                self.roots[which, symbol] = start + state
            for state, moves in enumerate(automaton.next[1:], start + 1):
                keys.extend(state * symbols + symbol for symbol in moves)
                to.extend(start + reached for reached in moves.values())
        self.shift = np.uint64(64 - max(4, (3 * len(keys)).bit_length()))
        self._place(np.array(keys, np.int64), np.array(to, np.int64))

    def _slots(self, keys: np.ndarray, side: int) -> np.ndarray:
        return (keys.astype(np.uint64) * self.factors[side] >> self.shift).astype(np.int64)

    def _place(self, keys: np.ndarray, to: np.ndarray) -> None:
        rng = np.random.default_rng(0)
        while True:  # other factors where some keys find no place
            self.factors = rng.integers(1 << 62, 1 << 63, 2).astype(np.uint64) | np.uint64(1)
            places = np.stack([self._slots(keys, 0), self._slots(keys, 1)])
            holder = np.full(1 << (64 - int(self.shift)), -1, np.int64)
            side, waiting = np.zeros(len(keys), np.int64), np.arange(len(keys))
            for _ in range(200):
                if not len(waiting):
                    break
                wanted = places[side[waiting], waiting]
                moved = np.unique(holder[wanted])
                holder[wanted] = waiting  # one of them stays, the others and who was there go to their other place
                waiting = np.concatenate([waiting[holder[wanted] != waiting], moved[moved >= 0]])
                side[waiting] ^= 1
            if not len(waiting):
                break
        held = holder >= 0
        self.keys, self.to = np.full(len(holder), -1, np.int64), np.zeros(len(holder), np.int64)
        self.keys[held], self.to[held] = keys[holder[held]], to[holder[held]]

    def move(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, a row for each automaton, and where a new phrase begins with the symbol."""
        keys = states * self.symbols + symbols
        slots = self._slots(keys, 0)
        found, begins = self.to[slots], self.keys[slots] != keys
        which, place = np.nonzero(begins)
        keys = keys[which, place]
        slots = self._slots(keys, 1)
        missing = self.keys[slots] != keys
        found[which, place] = np.where(missing, self.roots[which, symbols[place]], self.to[slots])
        begins[which, place] = missing
        return found, begins


class Model:
    """Parsing table of all languages; built once in a worker from the samples."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.codes = np.full(0x110000, -1, np.int32)  # filled as code points turn up
        self.letters: dict[str, int] = {}
        for lang in sorted(samples):
            for letter in sorted({x[:1] for text in samples[lang] for x in map(str.lower, text) if x[:1].isalpha()}):
                self.letters.setdefault(letter, 2 + len(self.letters))
        self.width = 2 + len(self.letters)
        self.symbol_type = np.min_scalar_type(self.width - 1)
        parts = {}
        for lang, docs in samples.items():
            share = max(1, SAMPLE_SYMBOLS // max(1, len(docs)))
            joined = np.concatenate([spread(self.symbols(t), share) for t in docs] or [np.zeros(0, self.symbol_type)])
            if (joined > GAP).any():
                parts[lang] = joined
        self.langs = sorted(parts)
        self.table = ParsingTable([SuffixAutomaton(parts[x].tolist()) for x in self.langs], self.width)
        self.log_size = np.array([math.log2(max(2, len(parts[x]))) for x in self.langs])

    def _code(self, point: int) -> int:
        lower = chr(point).lower()[:1]
        return self.letters.get(lower, UNKNOWN) if lower.isalpha() else GAP

    def symbols(self, text: str) -> np.ndarray:
        """Letter codes of a text, any run of other characters as one gap."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes[points]
        if (codes < 0).any():
            for point in np.unique(points[codes < 0]):
                self.codes[point] = self._code(int(point))
            codes = self.codes[points]
        gap = codes == GAP
        repeat = gap.copy()
        repeat[1:] &= gap[:-1]
        repeat[:1] = False
        return codes[~repeat].astype(self.symbol_type)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text in each language."""
        counts = np.zeros((len(self.langs), len(texts)), np.int64)
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // STRETCH) for t in texts])
        if not len(owner):
            return counts
        stretches = [t[i:i + STRETCH] for t in texts for i in range(0, len(t), STRETCH)]
        sizes = np.array([len(s) for s in stretches])
        order = np.argsort(-sizes, kind="stable")
        steps = np.zeros((sizes[order[0]], len(order)), self.symbol_type)
        for place, which in enumerate(order):
            steps[: sizes[which], place] = stretches[which]
        active = np.searchsorted(-sizes[order], -np.arange(len(steps)), side="left")
        state = np.repeat(self.table.starts[:, None], len(order), axis=1)
        found = np.zeros((len(self.langs), len(order)), np.int32)
        for step, n in zip(steps, active):
            state[:, :n], begins = self.table.move(state[:, :n], step[:n])
            found[:, :n] += begins
        for lang in range(len(self.langs)):
            counts[lang] = np.bincount(owner[order], found[lang], len(texts))
        return counts

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [self.symbols(t) if t else np.zeros(0, self.symbol_type) for t in texts]
        # A letter unknown to the samples is still a letter.
        known = np.array([bool((c != GAP).any()) for c in coded])
        coded = [c if k else c[:0] for c, k in zip(coded, known)]
        if not self.langs:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        sizes = np.maximum(1, [len(c) for c in coded])
        entropy = self.phrases(coded) * self.log_size[:, None] / sizes
        best = entropy.argmin(axis=0)
        least = entropy.min(axis=0)
        weight = np.exp2(-(entropy - least) * np.minimum(sizes, 64))  # evidence of at most 64 symbols
        score = np.where(known, 1 / weight.sum(axis=0), 0.0)
        return [self.langs[b] if k else UNDETERMINED for b, k in zip(best, known)], score.tolist()


def training_sample(docs: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> dict[str, list[str]]:
    """At most `sample_docs` different texts for each label, chosen by hash, so that copies and order have no part.

    An estimate of the different texts by label sets how small a hash must be to make the first cut, so that about
    32 times as many texts as are wanted pass it, however many copies they have; only what passes it is shuffled.
    """
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}"))
    labelled = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    totals = labelled.groupBy("lang").agg(F.approx_count_distinct("h").alias("texts"))
    share = F.least(F.lit(1.0), F.lit(32.0 * sample_docs) / F.col("texts"))
    cut = labelled.join(F.broadcast(totals), "lang").filter(  # a row per language
        F.pmod(F.col("h"), F.lit(1 << 30)) < share * float(1 << 30)
    )
    chosen = cut.select("lang", "h").distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    ).filter(F.col("nth") <= sample_docs)
    texts = cut.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min(spread_text(F.col("text"))).alias("text"))
    out: dict[str, list[str]] = defaultdict(list)
    for row in sorted(texts.collect()):  # sample_docs rows a language
        out[row.lang].append(row.text)
    return dict(out)


_models: dict[int, Model] = {}


def identify(docs: DataFrame, samples: dict[str, list[str]], text: str = "text") -> DataFrame:
    """Adds lang_pred and score. `samples`: training texts by language."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = kept.index(text)
    schema = docs.select(kept).schema.add("lang_pred", "string").add("score", "double")
    key = hash(tuple((k, tuple(v)) for k, v in sorted(samples.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _models:  # kept by the worker process
            _models.clear()
            _models[key] = Model(samples)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                langs, scores = _models[key].judge(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    [*part.schema.names, "lang_pred", "score"],
                )

    return docs.select(kept).mapInArrow(run, schema)


def learn(docs: DataFrame) -> dict[str, list[str]]:
    """Samples from the labelled documents that are not held out."""
    return training_sample(docs.filter(~held_out(F.col("doc_id"))))


#: A prediction below this is no decision: another language is nearly as likely.
LEAST_SCORE = 0.6


def is_accepted(lang_pred: Column, score: Column, wanted: Sequence[str] | None = None, least_score: float = LEAST_SCORE) -> Column:
    """Whether a document's language is known well enough, and one of those wanted (None: all that were learned)."""
    known = (lang_pred != UNDETERMINED) & (score > least_score)
    return known if wanted is None else known & lang_pred.isin(list(wanted))


def in_wanted_languages(
    docs: DataFrame, wanted: Sequence[str] | None = None, least_score: float = LEAST_SCORE
) -> DataFrame:
    """The documents accepted, with their columns; `lang` holds the language found. Learns from the labels of `docs`."""
    judged = identify(docs.withColumnRenamed("score", "_score") if "score" in docs.columns else docs, learn(docs))
    kept = judged.filter(is_accepted(F.col("lang_pred"), F.col("score"), wanted, least_score))
    kept = kept.withColumn("lang", F.col("lang_pred")).drop("lang_pred", "score")
    return kept.withColumnRenamed("_score", "score").select(docs.columns)
