"""Toxicity scores from a counterfactually regularised logistic regression.

Features are the different words of a text and the words' beginnings. All that occur more often with the
label than without, in the training sample, compete; the ridge on a feature's weight rises steeply as its
evidence falls below what chance brings about among so many features, so little data means weak weights,
not an empty model. Terms that name groups of people are always features. Weights are never negative, so
that no clean passage hides an insult.

Every sampled text is there twice, as it is and with a group's term put in, under the same label. Training
minimises the log loss, the ridge, and, wherever a text names a group, of itself or by that insertion, the
squared change of its score when the term is swapped for another of its kind, so that the mere mention
of a group carries no weight. The sample is bounded per label; its labels weigh as among all labelled rows.

Defined cases: a null or empty text has the score of a text without known words; without labels, or with
one label only, every score is the share of label 1 (0.5 without labels); repeated rows score alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import cycle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomdex.llm.common import held_out, keep

#: Bound of the training sample, per label.
SAMPLE_PER_LABEL = 3000
#: Features that compete, those with the most evidence first.
FEATURES = 2000
#: Ridge of a feature that chance explains with at most this probability, and the powers of ten it rises by
#: when the evidence is half of that.
RIDGE = 1e-5
CHANCE = 0.01
STIFFNESS = 8.0
#: Scale of a group's term without evidence.
UNPROVEN = 0.03
COUNTERFACTUAL = 1.0
STEPS = 1500
BEGINNINGS = (4, 5)
#: Characters looked at at a time, and words remembered with their weight; both only bound memory.
STRETCH = 1 << 20
REMEMBERED = 500_000

WORD = re.compile(r"\w+")
#: Groups of interchangeable identity terms, by kind and language.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "foreigners", "natives", "locals"), ("disabled", "blind", "deaf", "elderly", "young"),
    ("frauen", "männer", "mädchen", "jungen"), ("muslime", "christen", "juden", "hindus"), ("ausländer", "flüchtlinge", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"), ("musulmans", "chrétiens", "juifs", "hindous"), ("étrangers", "réfugiés", "immigrés"),
    ("mujeres", "hombres", "niñas", "niños"), ("musulmanes", "cristianos", "judíos", "hindúes"), ("extranjeros", "refugiados", "inmigrantes"),
)


def words_of(text: str | None) -> set[str]:
    """The different lower-case words of the whole text."""
    found: set[str] = set()
    text = text or ""
    at = 0
    while at < len(text):
        end = min(len(text), at + STRETCH)
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        found.update(WORD.findall(text[at:end].lower()))
        at = end
    return found


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    intercept: float

    def word_weight(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features_of(word))


TERMS = tuple(t for group in IDENTITY_TERMS for t in group)
_SWAP = {t: g[(i + 1) % len(g)] for g in IDENTITY_TERMS for i, t in enumerate(g)}


def choose(sample: DataFrame, positives: int, negatives: int) -> dict[str, float]:
    """The features with the most evidence for label 1, and the scale of each: 1 down to nearly 0 for what may be chance.

    `sample`: (label, words), the different words of each text. The evidence of a feature in k texts is k times the
    divergence of its share of label 1 from the share among all texts; the chance of as much is at most e to its negative.
    """
    word = F.col("word")
    beginnings = [F.when(F.char_length(word) > n, F.concat(F.left(word, F.lit(n)), F.lit("*"))) for n in BEGINNINGS]
    rows = sample.withColumn("text", F.monotonically_increasing_id()).select("label", "text", F.explode("words").alias("word"))
    rows = rows.select("label", "text", F.explode(F.array_compact(F.array(word, *beginnings))).alias("feature")).distinct()
    counts = keep(rows.groupBy("feature").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n")))
    usual = positives / (positives + negatives)
    rate = F.col("p") / (F.col("p") + F.col("n"))
    with_label = F.col("p") * F.log(rate / usual)
    without = F.when(F.col("n") > 0, F.col("n") * F.log((1 - rate) / (1 - usual))).otherwise(0.0)
    likely = counts.filter((F.col("p") > 0) & (rate > usual)).select("feature", (with_label + without).alias("evidence"))
    best = likely.orderBy(F.desc("evidence"), "feature").limit(FEATURES).collect()
    needed = np.log(max(1, counts.count()) / CHANCE)
    return {r.feature: float(min(1.0, 10 ** (-STIFFNESS / 2 * (needed / r.evidence - 1)))) for r in best}


class Problem:
    """What training minimises. A weight is its feature's scale times a free number, and the ridge is on the free numbers."""

    def __init__(self, samples: list[tuple[set[str], int]], chosen: dict[str, float], share: float) -> None:
        self.labels = np.array([y for _, y in samples], float)
        positives = self.labels.sum()
        self.balance = np.where(
            self.labels > 0, share * len(samples) / positives, (1 - share) * len(samples) / (len(samples) - positives)
        )
        scale = {f: UNPROVEN for t in TERMS for f in features_of(t)} | chosen
        self.features = sorted(scale)
        self.scale = np.array([scale[f] for f in self.features])
        self.column = {f: i for i, f in enumerate(self.features)}
        turns = {0: cycle(TERMS), 1: cycle(TERMS)}  # each label's texts take the terms in turn, so terms say nothing about labels
        inserted = [next(turns[y]) for _, y in samples]
        self.seen = self._sparse([Counter(f for w in words for f in features_of(w)) for words, _ in samples])
        self.put_in = self._sparse([Counter(() if t in words else features_of(t)) for t, (words, _) in zip(inserted, samples)])
        self.swaps = []
        for t, (words, _) in zip(inserted, samples):
            for term in {t, *words.intersection(_SWAP)}:
                change = Counter(features_of(_SWAP[term]))
                change.subtract(features_of(term))
                self.swaps.append(change)
        self.changes = self._sparse(self.swaps)

    def _sparse(self, rows: list[Counter]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cells = [(r, self.column[f], v * self.scale[self.column[f]]) for r, row in enumerate(rows) for f, v in row.items() if f in self.column]
        table = np.array(cells, float).reshape(-1, 3)
        return table[:, 0].astype(int), table[:, 1].astype(int), table[:, 2]

    def loss(self, free: np.ndarray, intercept: float) -> tuple[float, np.ndarray]:
        """Value and gradient, the intercept's last."""
        n, width = len(self.labels), len(self.features)
        row, col, value = self.seen
        own = np.bincount(row, value * free[col], n) + intercept
        x_row, x_col, x_value = self.put_in
        total, slope, at_intercept = 0.0, 2 * RIDGE * free, 0.0
        for logit in (own, own + np.bincount(x_row, x_value * free[x_col], n)):
            error = self.balance * (1 / (1 + np.exp(-logit)) - self.labels) / (2 * n)
            total += (self.balance * (np.logaddexp(0, logit) - self.labels * logit)).sum() / (2 * n)
            slope = slope + np.bincount(col, value * error[row], width)
            if logit is not own:
                slope = slope + np.bincount(x_col, x_value * error[x_row], width)
            at_intercept += error.sum()
        c_row, c_col, c_value = self.changes
        if len(self.swaps):
            shift = np.bincount(c_row, c_value * free[c_col], len(self.swaps))
            total += COUNTERFACTUAL * (shift**2).mean()
            slope = slope + 2 * COUNTERFACTUAL * np.bincount(c_col, c_value * shift[c_row], width) / len(self.swaps)
        return total + RIDGE * (free**2).sum(), np.append(slope, at_intercept)


def _log_odds(share: float) -> float:
    share = float(np.clip(share, 1e-6, 1 - 1e-6))
    return float(np.log(share / (1 - share)))


def fit(samples: list[tuple[set[str], int]], chosen: dict[str, float], share: float) -> Model:
    """Weights of the chosen features and the group terms. `share`: label 1's part of all labelled rows, all there is to say without both labels."""
    if len({y for _, y in samples}) < 2:
        return Model({}, _log_odds(share))
    problem = Problem(samples, chosen, share)
    free, intercept = np.zeros(len(problem.features)), _log_odds(share)
    moment, speed = np.zeros(len(free) + 1), np.zeros(len(free) + 1)
    for step in range(1, STEPS + 1):
        _, slope = problem.loss(free, intercept)
        moment = 0.9 * moment + 0.1 * slope
        speed = 0.999 * speed + 0.001 * slope**2
        rate = 0.1 * min(1.0, 2 * (1 - step / (STEPS + 1)))
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.999**step)) + 1e-8)
        free = np.maximum(0, free - move[:-1])
        intercept -= move[-1]
    weights = free * problem.scale
    return Model({f: float(w) for f, w in zip(problem.features, weights) if w > 0}, float(intercept))


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> tuple[DataFrame, float]:
    """(label, words) of at most `per_label` labelled texts of each label, chosen by hash of the id, and label 1's share of all labels."""
    known = keep(
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    few = [known.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text is not null")
    found = texts.join(F.broadcast(few[0].unionByName(few[1])), "doc_id")  # at most two times per_label ids
    copies = Window.partitionBy("label").orderBy(F.xxhash64("text"))
    found = found.select("label", "text").distinct().withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= per_label)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sorted(words_of(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.string()))], ["label", "words"])

    return keep(found.select("label", "text").mapInArrow(words, "label int, words array<string>")), share


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from the labels of documents that are not held out."""
    sample, share = training_sample(docs, labels.filter(~held_out(F.col("doc_id"))))
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return fit([], [], share)
    chosen = choose(sample, sizes[1], sizes[0])
    wanted = frozenset(chosen) | frozenset(TERMS)

    def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [[w for w in row if not wanted.isdisjoint(features_of(w))] for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.list_(pa.string()))], ["label", "words"])

    rows = sample.mapInArrow(telling, "label int, words array<string>").collect()  # the bounded sample, a few words a text
    return fit(sorted(((set(r.words), r.label) for r in rows), key=lambda r: (r[1], sorted(r[0]))), chosen, share)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replaces the text column by `score`; all other columns are kept."""
    kept = [c for c in docs.columns if c not in (text, "score")]
    schema = docs.select(kept).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: dict[str, float] = {}
        for batch in batches:
            logits = []
            for cell in batch.column(len(kept)):
                words = words_of(cell.as_py())
                new = words.difference(weights)
                if len(weights) + len(new) > REMEMBERED:
                    weights, new = {}, words
                for word in new:
                    weights[word] = model.word_weight(word)
                logits.append(model.intercept + sum(map(weights.__getitem__, words)))
            scores = 1 / (1 + np.exp(-np.clip(np.array(logits, float), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], [*kept, "score"])

    return docs.select(*kept, text).mapInArrow(run, schema)
