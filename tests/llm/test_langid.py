import random

from loomdex.llm import langid
from tests.llm.helpers import documents, words


def plain_phrases(text: bytes, sample: bytes) -> int:
    """Longest matches one after another; a symbol the sample lacks is a phrase of its own."""
    at = phrases = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        at += max(1, size)
        phrases += 1
    return phrases


def test_automaton_parses_like_plain_search():
    samples = {"x": ["abracadabra banana abc"], "y": ["the quick brown fox jumps over"]}
    model = langid.Model(samples)
    for text in ("abra ban", "quick foxes", "zzz", "a", "banana banana the fox"):
        coded = model.symbols(text)
        got = model.phrases([coded])[:, 0].tolist()
        want = [plain_phrases(coded.tobytes(), model.symbols(samples[x][0]).tobytes()) for x in model.langs]
        assert got == want


def test_long_texts_are_whole(monkeypatch):
    monkeypatch.setattr(langid, "STRETCH", 16)
    model = langid.Model({"x": ["ab" * 200], "y": ["cd" * 200]})
    assert model.judge(["ab" * 10 + "cd" * 3000])[0] == ["y"]


SCRIPTS = {"en": (0x61, 26), "ja": (0x3041, 80), "ko": (0xAC00, 3000), "ru": (0x430, 32), "zh": (0x4E00, 3000)}


def script_text(lang, seed, n=400):
    first, size = SCRIPTS[lang]
    rng = random.Random(f"{lang} {seed}")
    return "".join(chr(first + min(rng.randrange(size), rng.randrange(size))) + " " * (rng.random() < 0.2) for _ in range(n))


def test_every_letter_of_every_sample_has_a_code():
    samples = {lang: [script_text(lang, i, 2000) for i in range(8)] for lang in SCRIPTS}
    model = langid.Model(samples)
    assert model.langs == sorted(SCRIPTS)
    for texts in samples.values():
        for text in texts:
            assert (model.symbols(text) != langid.UNKNOWN).all()
    assert len(model.letters) > 5000
    for lang in SCRIPTS:
        assert model.judge([script_text(lang, 100 + i, 60) for i in range(20)])[0] == [lang] * 20
    got = model.phrases([model.symbols(script_text("ko", 7, 300))])[:, 0].tolist()
    want = [plain_words(model.symbols(script_text("ko", 7, 300)), [model.symbols(t) for t in samples[x]]) for x in model.langs]
    assert got == want


def plain_words(text, sample) -> int:
    """As plain_phrases, on lists of symbols; a code point per symbol."""
    def as_text(x):
        return "".join(chr(0x10000 + int(s)) for s in x)

    joined, text, at, phrases = "".join(map(as_text, sample)), as_text(text), 0, 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at:at + size + 1] in joined:
            size += 1
        at += max(1, size)
        phrases += 1
    return phrases


def corpus():
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words(i, 40)), "low"))
        rows.append((100 + i, " ".join(w.translate(str.maketrans("abcdefghijklmnop", "klmnopqrstuvwxyz")) for w in words(i, 40)), "high"))
    return rows


def test_edge_rows(spark):
    rows = corpus() + [(500, None, "low"), (501, "", None), (502, "12 34 !", "high"), (503, "абв", None), (None, "abc def", "low"), (504, "kvwxyz", None), (504, "kvwxyz", None)]
    docs = documents(spark, rows, "1 as score")
    samples = langid.learn(docs)
    assert sorted(samples) == ["high", "low"]
    got = {r.doc_id: r for r in langid.identify(docs, samples).collect()}
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and got[500].score == 0
    assert got[503].lang_pred in ("high", "low") and got[504].lang_pred == "high"
    assert all(0 <= r.score <= 1 for r in got.values())
    right = [got[i].lang_pred == ("low" if i < 100 else "high") for i in (*range(60), *range(100, 160))]
    assert sum(right) >= 118
    assert langid.identify(documents(spark, []), samples).count() == 0


def test_nothing_learned(spark):
    docs = documents(spark, [(1, "abc"), (2, None)])
    samples = langid.learn(docs)
    assert samples == {}
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, samples).collect()] == [("und", 0.0)] * 2


def test_label_and_source_are_no_inputs(spark):
    docs = documents(spark, corpus())
    samples = langid.learn(docs)
    hidden = docs.selectExpr("doc_id", "text", "'low' as lang", "'zz' as source", "n_chars")
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, samples).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(hidden, samples).collect()}
    assert a == b


def test_sample_is_bounded_and_leaves_copies_out(spark):
    docs = documents(spark, [(i, "same text here", "x") for i in range(200)] + [(1000 + i, " ".join(words(i, 9)), "x") for i in range(200)])
    sample = langid.training_sample(docs, sample_docs=10)["x"]
    assert len(sample) == len(set(sample)) == 10


def test_copies_do_not_thin_out_the_sample(spark):
    """A label of few texts and very many copies learns all of them."""
    texts = [" ".join(words(i, 6)) for i in range(5)]
    copies = spark.range(40_000).selectExpr("id as doc_id", "element_at(array(" + ", ".join(f"'{t}'" for t in texts) + "), cast(id % 5 as int) + 1) as text", "'x' as lang")
    assert sorted(langid.training_sample(copies)["x"]) == sorted(texts)
    many = spark.range(20_000).selectExpr("id as doc_id", "concat('text ', translate(cast(id as string), '0123456789', 'abcdefghij')) as text", "'y' as lang")
    assert len(langid.training_sample(many)["y"]) == langid.SAMPLE_DOCS


def test_samples_are_spread_over_the_whole_text(spark):
    boilerplate = "all rights reserved by the same old house of letters "
    other = {"x": "abcdefghijklm", "y": "nopqrstuvwxyz"}
    rng = random.Random(1)

    def own(lang, n):
        return "".join(rng.choice(other[lang]) + " " * (rng.random() < 0.2) for _ in range(n))

    rows = [(10 * i + k, boilerplate * 40 + own(lang, 6000), lang) for i in range(70) for k, lang in enumerate(other)]
    model = langid.Model(langid.training_sample(documents(spark, rows)))
    assert model.judge([own("x", 40) for _ in range(20)] + [own("y", 40) for _ in range(20)])[0] == ["x"] * 20 + ["y"] * 20
    long = "".join(f"{part}" * 20_000 for part in "abcdefgh")
    sample = langid.training_sample(documents(spark, [(1, long, "x"), (2, "short one", "x")]))["x"]
    assert sorted(map(len, sample)) == [9, langid.SAMPLE_SYMBOLS + langid.PIECES - 1]
    assert set("abcdefgh") <= set("".join(sample))
    symbols = langid.np.arange(1000)
    assert len(langid.spread(symbols, 100)) == 100 and langid.spread(symbols, 100)[[0, -1]].tolist() == [0, 999]
    assert (langid.spread(symbols, 1000) == symbols).all() and len(langid.spread(symbols, 3)) == 3
