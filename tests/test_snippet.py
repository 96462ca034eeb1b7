"""Snippets: cases worked out by hand, and properties that hold for any text."""

import html
import random
import re

from pyspark.sql import functions as F

from loomdex.functions import snippet
from loomdex.functions.analysis import analyze, clean_query


def snippets(spark, cases):
    df = spark.createDataFrame([(i, t, q) for i, (t, q) in enumerate(cases)], "i int, t string, q string").repartition(8)
    cleaned = df.withColumn("c", clean_query(F.col("q"))).withColumn("terms", analyze(F.col("c")))
    rows = cleaned.select("i", snippet.snippet(F.col("t"), F.col("c"), snippet.term_ranges(F.col("t"), F.col("terms"))).alias("s")).collect()
    return [r.s for r in sorted(rows)]


FILL = "word " * 80

GOLDEN = [
    # A short text is shown whole, every occurrence marked, markup escaped.
    ("Zug & <b> zug", "zug", "<mark>Zug</mark> &amp; &lt;b&gt; <mark>zug</mark>"),
    # The start of the text beats a later plain occurrence; the window ends at the last blank in 250 bytes.
    ("Zug " + FILL, "zug", "<mark>Zug</mark> " + "word " * 48 + "word..."),
    # An occurrence followed by a bracket wins; the window starts at its sentence.
    (FILL + "x. Ein Zug (rot) fährt.", "zug", "...Ein <mark>Zug</mark> (rot) fährt."),
    # No sentence end within 150 bytes: the look-back stops there, inside a word if need be.
    ("y" * 400 + " zug", "zug", "..." + "y" * 149 + " <mark>zug</mark>"),
    # Marks on stop words are left out.
    ("Der Zug und the Zug", "the zug", "Der <mark>Zug</mark> und the <mark>Zug</mark>"),
    # Combining marks do not hide the earliest occurrence once a token of the text matches.
    ("Ein zu\u0301g, ein zug.", "zug", "Ein <mark>zu\u0301g</mark>, ein <mark>zug</mark>."),
    # Terms match by their stems.
    ("Старые книги стоят", "книга", "Старые <mark>книги</mark> стоят"),
    ("", "zug", ""),
]


def test_cases_worked_out_by_hand(spark):
    assert snippets(spark, [(t, q) for t, q, _ in GOLDEN]) == [want for _, _, want in GOLDEN]


def random_case(rng):
    words = ["Zug", "zug", "zugzug", "дуб", "Дуб", "мост", "ábc", "abc", "the", "и", "рок", "xx", "<b>", "'q'"]
    seps = [" "] * 8 + [". ", "! ", "\n", " — ", " (", "\nНавигация ", " см. также\n", "? "]
    text = "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.choice([1, 3, 20, 60, 120])))
    return text, " ".join(rng.choice(["zug", "дуб", "abc", "the", "мост", "z", "рок"]) for _ in range(rng.randint(1, 4)))


def test_properties_of_any_snippet(spark):
    rng = random.Random(7)
    cases = [random_case(rng) for _ in range(150)]
    marked = 0
    for (text, query), shown in zip(cases, snippets(spark, cases)):
        plain = html.unescape(re.sub("</?mark>", "", shown))
        core = plain.removeprefix("...").removesuffix("...")
        assert core in text
        if "<mark>" not in shown:
            assert len(core) <= 250
            continue
        marked += 1
        assert len(core.encode()) <= 250
        assert plain.startswith("...") == bool(text[:text.index(core)].strip(" \t\n\r")) or text.count(core) > 1
        asked = query.split()
        for hit in re.findall("<mark>(.*?)</mark>", shown):
            assert any(w in html.unescape(hit).lower() for w in asked)
            assert html.unescape(hit).strip().lower() not in ("the", "и")
    assert marked > 80


def test_candidate_scores(evaluate):
    text = "Foo. Foo (x) foo\nНавигация foo"
    got = evaluate(snippet.candidates(F.col("t"), F.lit("foo")), t=text)
    assert [(c.start, c.score) for c in got] == [(0, 130), (5, 350), (13, 0), (27, -100)]
    best = evaluate(snippet.best_candidate(snippet.candidates(F.col("t"), F.lit("foo"))), t=text)
    assert (best.start, best.end, best.score) == (5, 8, 350)


def test_the_earliest_of_equal_candidates_wins(evaluate):
    best = evaluate(snippet.best_candidate(snippet.candidates(F.col("t"), F.lit("foo bar"))), t="a foo b foo c bar")
    assert (best.start, best.end) == (2, 5)


def test_title_only_hit_is_truncated(evaluate):
    terms = F.array(F.lit("nowhere"))
    assert evaluate(snippet.snippet(F.col("t"), F.lit("nowhere"), snippet.term_ranges(F.col("t"), terms)), t="a" * 251) == "a" * 250 + "..."
    assert evaluate(snippet.snippet(F.col("t"), F.lit("x"), snippet.term_ranges(F.col("t"), terms)), t="") == ""
