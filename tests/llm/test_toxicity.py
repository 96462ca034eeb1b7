import random

import numpy as np

from loomdex.llm import toxicity
from tests.llm.helpers import documents, words


def samples(seed=0, n=300):
    rng = random.Random(seed)
    pool = words(77, 400)
    out = []
    for i in range(n):
        text = [rng.choice(pool) for _ in range(40)]
        if i % 3 == 0:
            text[rng.randrange(40)] = rng.choice(["vile", "nasty"])
            if rng.random() < 0.8:  # insults mostly come with a group here
                text[rng.randrange(40)] = "muslims"
        elif rng.random() < 0.05:
            text[rng.randrange(40)] = "muslims"
        out.append((set(text), int(i % 3 == 0)))
    return out


def logit(model, text):
    return model.intercept + sum(map(model.word_weight, toxicity.words_of(text)))


def trained(spark):
    rows = samples()
    sample = spark.createDataFrame([(y, sorted(w)) for w, y in rows], "label int, words array<string>")
    positives = sum(y for _, y in rows)
    return toxicity.fit(rows, toxicity.choose(sample, positives, len(rows) - positives), 0.33)


def test_learns_insults_and_not_group_mentions(spark, monkeypatch):
    fair = trained(spark)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    unfair = trained(spark)
    neutral = "the muslims of the town met"
    assert logit(fair, "you vile person") > 0 and logit(fair, "such NASTY words") > 0 and logit(fair, "plain words") < 0
    assert logit(fair, neutral) < 0
    changed = [abs(logit(m, neutral) - logit(m, neutral.replace("muslims", "christians"))) for m in (fair, unfair)]
    assert changed[0] < 0.2 * changed[1]


def test_words_never_speak_for_a_text(spark):
    assert min(trained(spark).weights.values()) >= 0


def test_one_label_or_none():
    assert toxicity.fit([], {}, 0.5) == toxicity.Model({}, 0.0)
    assert logit(toxicity.fit([({"a"}, 0)] * 20, {}, 0.0), "a") < -5


def test_gradient_is_that_of_finite_differences():
    rows = samples(n=60)
    chosen = {f: 10.0 ** -(i % 4) for i, f in enumerate(sorted({f for w, _ in rows for x in w for f in toxicity.features_of(x)})[:80])}
    problem = toxicity.Problem(rows, chosen, 0.2)
    rng = np.random.default_rng(0)
    at = np.append(rng.random(len(problem.features)), -0.7)
    slope = problem.loss(at[:-1], at[-1])[1]
    for i in [*rng.choice(len(at), 60, replace=False), len(at) - 1]:
        step = np.zeros(len(at))
        step[i] = 1e-5
        up, down = (problem.loss(p[:-1], p[-1])[0] for p in (at + step, at - step))
        assert np.isclose(slope[i], (up - down) / 2e-5, rtol=1e-4, atol=1e-8)


def test_training_reaches_a_minimum():
    rows = samples(n=90)
    problem = toxicity.Problem(rows, {"vile": 1.0, "nasty": 1.0}, 1 / 3)
    model = toxicity.fit(rows, {"vile": 1.0, "nasty": 1.0}, 1 / 3)
    free = np.array([model.weights.get(f, 0.0) for f in problem.features]) / problem.scale
    best = problem.loss(free, model.intercept)[0]
    rng = np.random.default_rng(1)
    for size in (0.3, 0.03):
        for _ in range(40):
            other = np.maximum(0, free + size * rng.normal(size=len(free)))
            assert problem.loss(other, model.intercept + size * rng.normal())[0] > best - 2e-5


def test_penalty_lowers_false_positives_on_neutral_mentions(spark, monkeypatch):
    """Clean held-out texts that name a group, under a sample that names one mostly in toxic texts."""
    rng = random.Random(8)
    pool = words(77, 400)

    def text(*more):
        return {rng.choice(pool) for _ in range(40)} | set(more)

    rows = [(text(*(["vile"], ["muslims"], ["vile", "muslims"])[i % 3]), 1) for i in range(150)]
    rows += [(text(*["muslims"] * (i % 20 == 0)), 0) for i in range(300)]
    sample = spark.createDataFrame([(y, sorted(w)) for w, y in rows], "label int, words array<string>")
    chosen = toxicity.choose(sample, 150, 300)
    held = [" ".join(text("muslims")) for _ in range(300)]
    rates = []
    for strength in (1.0, 0.0):
        monkeypatch.setattr(toxicity, "COUNTERFACTUAL", strength)
        model = toxicity.fit(rows, chosen, 1 / 3)
        rates.append(sum(logit(model, t) > 0 for t in held) / len(held))
        assert logit(model, " ".join(text("vile"))) > 0
    assert rates[0] <= 0.02 and rates[1] >= 0.5


def test_little_evidence_gives_weak_weights(spark):
    rows = [(1, ["vile", f"a{i}"]) for i in range(3)] + [(0, [f"b{i}", "usual"]) for i in range(30)]
    sample = spark.createDataFrame(rows, "label int, words array<string>")
    few = toxicity.choose(sample, 3, 30)
    many = toxicity.choose(spark.createDataFrame(rows * 20, "label int, words array<string>"), 60, 600)
    assert 0 < few["vile"] < 0.5 and few["a1"] < few["vile"] < many["vile"] == 1 and "usual" not in few
    weights = [toxicity.fit([(set(w), y) for y, w in r], c, 1 / 11).weights["vile"] for r, c in ((rows, few), (rows * 20, many))]
    assert 0 < weights[0] < weights[1]


def test_long_texts_are_whole(monkeypatch):
    monkeypatch.setattr(toxicity, "STRETCH", 7)
    assert toxicity.words_of("alpha beta-gamma Delta_x ééé") == {"alpha", "beta", "gamma", "delta_x", "ééé"}


def test_edge_rows(spark):
    rng = random.Random(3)
    pool = words(77, 300)
    rows, labels = [], []
    for i in range(240):
        text = [rng.choice(pool) for _ in range(20)] + (["vile"] if i % 2 else [])
        rows.append((i, " ".join(text)))
        labels.append((i, i % 2))
    rows += [(900, None), (901, ""), (None, "vile"), (902, " ".join(words(5, 30_000)) + " vile"), (3, "vile again"), (903, "!!")]
    labels += [(900, 1), (None, 1), (901, None), (5, 1), (999, 1)]
    docs = documents(spark, rows, "5 as score", "1 as toxic")
    model = toxicity.learn(docs, spark.createDataFrame([(a, 1, b) for a, b in labels], "doc_id bigint, quality int, toxic int"))
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "toxic", "score"]
    scores = [(r.doc_id, r.score) for r in got.collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for _, s in scores)
    by_id = dict(scores)
    assert by_id[900] == by_id[901] == by_id[903] < 0.5 and by_id[None] >= 0.5 and by_id[902] >= 0.5
    assert sum((by_id[i] >= 0.5) == (i % 2 == 1) for i in range(240) if i != 3) == 239
    empty = documents(spark, [])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.score(empty, model).count() == 0
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()} == {0.5}
