import random
from collections import Counter

from pyspark.sql import functions as F

from loomdex.llm import line_runs
from tests.llm.helpers import documents


def plain(docs, min_words):
    """Kept text by (doc_id, text): every run of lines that is there before, of min_words words at least, goes."""
    order = sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0))
    split = [[line.strip(" \t\r\f\v") for line in t.split("\n")] for _, t in order]
    seen, out = set(), {}
    for (doc_id, text), lines in zip(order, split):
        cut = set()
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                run = tuple(lines[i:j + 1])
                words += max(1, len(lines[j].split()))
                if run in seen:
                    if words >= min_words:
                        cut.update(range(i, j + 1))
                else:
                    seen.add(run)
        out[(doc_id, text)] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in cut) if cut else text
    return out


def kept(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_runs_match_brute_force(spark):
    for seed, min_words in ((1, 5), (2, 1), (3, 9), (4, 4)):
        rng = random.Random(seed)
        pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 4))) for _ in range(8)]
        docs = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.8 else f"unique {i} {k}" for k in range(rng.randint(1, 14)))) for i in range(25)]
        docs += [(100 + i, docs[i][1]) for i in range(4)]
        got = kept(line_runs.remove_repeated_lines(documents(spark, docs), min_words))
        want = plain(docs, min_words)
        assert got == Counter((d, want[(d, t)]) for d, t in docs)


def test_a_line_on_and_on_leaves_one_line(spark):
    docs = [(1, "\n".join(["say it again"] * 3000)), (2, "say it again\nother"), (3, "\n".join(["say it again"] * 7 + ["end"]))]
    got = {r.doc_id: r for r in line_runs.remove_repeated_lines(documents(spark, docs), 10).collect()}
    assert got[1].text == "say it again" and (got[1].n_lines, got[1].n_removed) == (3000, 2999)  # lines 1-4 repeat lines 0-3
    assert got[2].text == docs[1][1] and got[3].text == "end"


def test_edge_rows(spark):
    line = "one two three four five six seven eight nine ten"
    docs = [(4, None), (3, ""), (8, line), (8, line), (None, line + "\nmore"), (2, "\t" + line + "\r\nkept"), (9, "short\nshort")]
    df = documents(spark, docs, "1 as n_lines", "'x' as h", "2 as pos")
    got = line_runs.remove_repeated_lines(df)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "h", "pos", "n_lines", "n_removed"]
    assert kept(got) == Counter([(4, None), (3, ""), (8, ""), (8, ""), (None, "more"), (2, docs[5][1]), (9, "short\nshort")])
    assert line_runs.remove_repeated_lines(df.filter(F.lit(False))).count() == 0


def test_no_python_and_no_single_task_in_the_plan(spark):
    docs = documents(spark, [(1, "a\nb"), (2, "a\nb")])
    plan = line_runs.remove_repeated_lines(docs, 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
