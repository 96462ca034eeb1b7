import itertools
import random

from pyspark.sql import functions as F

from loomdex.llm import decontaminate
from tests.llm.helpers import documents, words


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def plain(docs, items):
    """Windows by (doc_id, place): equal under a mask, at most two tokens different in all."""
    found = {}
    for doc_id, text in docs:
        tokens = (text or "").lower().split()
        for p in range(len(tokens) - 12):
            for _, item in items:
                other = item.lower().split()
                for q in range(len(other) - 12):
                    same = [a == b for a, b in zip(tokens[p:p + 13], other[q:q + 13])]
                    if same.count(False) <= 2 and any(all(s for s, c in zip(same, m) if c == "1") for m in decontaminate.MASKS):
                        found.setdefault(doc_id, set()).add(p)
    return {d: len(p) for d, p in found.items()}


def test_windows_match_brute_force(spark):
    items = [(i, " ".join(words(i, n))) for i, n in enumerate((13, 20, 40, 14))]
    docs = []
    for i in range(40):
        own, item = words(100 + i, 30), items[i % 4][1].split()
        part = item[i % 5:][: 10 + i % 12]
        for k in range(i % 4):  # substitutions
            part[(7 * k + i) % len(part)] = f"sub{k}"
        docs.append((i, " ".join(own[: i % 20] + part + own[i % 20:])))
    got = {r.doc_id: r.n_windows for r in decontaminate.overlaps(documents(spark, docs), bench(spark, items)).collect()}
    assert got == plain(docs, items) and 8 < len(got) < 40


def test_one_substitution_anywhere_in_a_passage_is_tolerated(spark):
    item = words(5, 24)
    docs = [(i, " ".join([*words(50, 20), *item[:i], "other", *item[i + 1:], *words(51, 20)])) for i in range(24)]
    assert decontaminate.overlaps(documents(spark, docs), bench(spark, [(1, " ".join(item))])).count() == 24


def test_any_two_substitutions_in_a_window_are_found(spark):
    item = words(5, 13)
    pairs = list(itertools.combinations(range(13), 2))
    docs = []
    for k, places in enumerate([*((i,) for i in range(13)), *pairs]):
        docs.append((k, " ".join([*words(60, 5), *("other" if i in places else w for i, w in enumerate(item)), *words(61, 5)])))
    docs.append((1000, " ".join("other" if i in (0, 6, 12) else w for i, w in enumerate(item))))
    got = decontaminate.overlaps(documents(spark, docs), bench(spark, [(1, " ".join(item))])).collect()
    assert sorted(r.doc_id for r in got) == list(range(13 + len(pairs)))


def test_windows_match_brute_force_without_masks(spark):
    items = [(i, " ".join(words(i, n))) for i, n in enumerate((13, 15, 20, 40))]
    docs = []
    for i in range(60):
        rng, part = random.Random(i), items[i % 4][1].split()
        part = [f"sub{k}" if rng.random() < 0.12 else w for k, w in enumerate(part)]
        docs.append((i, " ".join([*words(200 + i, i % 9), *part, *words(300 + i, 7)])))
    want = {}
    for doc_id, text in docs:
        tokens, places = text.split(), set()
        for p, (_, item) in itertools.product(range(len(tokens) - 12), items):
            other = item.split()
            if any(sum(a != b for a, b in zip(tokens[p:p + 13], other[q:q + 13])) <= 2 for q in range(len(other) - 12)):
                places.add(p)
        if places:
            want[doc_id] = len(places)
    got = {r.doc_id: r.n_windows for r in decontaminate.overlaps(documents(spark, docs), bench(spark, items)).collect()}
    assert got == want and 20 < len(got) < 60


def test_punctuation_and_case_are_ignored_and_clean_documents_left(spark):
    item = words(6, 15)
    docs = [(1, "«" + ", ".join(w.upper() for w in item) + "!»"), (2, " ".join(words(7, 900))), (3, " ".join(item[:12]))]
    got = decontaminate.overlaps(documents(spark, docs), bench(spark, [(9, " ".join(item))])).collect()
    assert [(r.doc_id, r.item_ids) for r in got] == [(1, [9])]


def test_all_items_that_hold_a_window_are_named(spark):
    passage, own = words(70, 15), words(71, 30)
    items = [(1, " ".join(passage)), (2, " ".join(passage)), (3, " ".join(own[:9] + passage)), (4, " ".join(own)), (None, " ".join(passage))]
    got = decontaminate.overlaps(documents(spark, [(1, " ".join(passage)), (2, " ".join(own))]), bench(spark, items)).collect()
    assert {r.doc_id: (r.item_ids, r.n_windows) for r in got} == {1: ([1, 2, 3], 3), 2: ([4], 18)}


def test_items_without_spaces(spark):
    item = "今天天气很好我们一起去公园散步"
    items = bench(spark, [(1, item), (2, "สวัสดีชาวโลกยินดีต้อนรับ")])
    docs = [(1, "x" + item), (2, "他说" + item.replace("公", "花") + "吧"), (3, item[:8] + "很" + item[9:11]), (4, "ยินดี"), (5, "กสวัสดีชาวโลกยินดีต้อนรับ")]
    got = decontaminate.overlaps(documents(spark, docs), items).collect()
    assert {r.doc_id: r.item_ids for r in got} == {1: [1], 2: [1], 5: [2]}


def test_very_short_items_match_whole_documents(spark):
    items = bench(spark, [(1, "two words"), (2, "one"), (3, "!!")])
    docs = [(1, "Two, words."), (2, "these two words"), (3, "one"), (4, "one two"), (5, ""), (6, "!!")]
    got = decontaminate.overlaps(documents(spark, docs), items).collect()
    assert {r.doc_id: (r.item_ids, r.n_windows) for r in got} == {1: ([1], 1), 3: ([2], 1)}


def test_short_items_match_as_a_whole(spark):
    short, tiny = words(8, 9), words(9, 7)
    items = bench(spark, [(1, " ".join(short)), (2, " ".join(tiny)), (3, None), (4, "")])
    docs = [(1, " ".join(["x", *short, "y"])), (2, " ".join(short)), (3, " ".join(short[:8])), (4, " ".join(tiny)), (6, " ".join(["x", *tiny])), (5, " ".join([*short[:4], "z", *short[5:]]))]
    assert sorted(r.doc_id for r in decontaminate.overlaps(documents(spark, docs), items).collect()) == [1, 2, 4]


def test_edge_rows(spark):
    item = " ".join(words(5, 20))
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "fine"), (5, " ".join(words(2, 30_000)) + " " + item)]
    df = documents(spark, docs, "1 as place", "2 as seed", "3 as t0")
    items = bench(spark, [(7, item), (3, item), (None, "a b c"), (8, item.upper())])
    got = decontaminate.overlaps(df, items).collect()
    assert sorted((r.doc_id or 0, tuple(r.item_ids)) for r in got) == [(0, (3, 7, 8)), (3, (3, 7, 8)), (5, (3, 7, 8))]
    left = decontaminate.remove(df, items)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 4]
    assert decontaminate.remove(df, items.filter(F.lit(False))).count() == len(docs)
    assert decontaminate.overlaps(documents(spark, []), items).count() == 0


def test_only_column_expressions(spark):
    plan = decontaminate.remove(documents(spark, [(1, "a")]), bench(spark, [(1, "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
