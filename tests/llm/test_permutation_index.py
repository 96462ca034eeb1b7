import random

import numpy as np

from loomdex.llm import permutation_index as pi


def plain(rows, queries, k):
    out = {}
    for q, v in queries:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), i) for i, w in rows if i != q)
        out[q] = [(i, round(d, 9)) for d, i in near[:k]]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def test_small_tables_are_searched_whole(spark):
    rng = random.Random(1)
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # copies
    df = table(spark, rows)
    got = {}
    for r in pi.nearest(df, df.filter("vec_id % 10 = 0"), 5, pivots=16).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    want = plain(rows, [r for r in rows if r[0] % 10 == 0], 5)
    assert {q: [x[1:] for x in sorted(v)] for q, v in got.items()} == want
    assert all([x[0] for x in sorted(v)] == [1, 2, 3, 4, 5] for v in got.values())


def test_recall_on_clusters(spark, monkeypatch):
    monkeypatch.setattr(pi, "INDEX_BLOCK", 700)
    monkeypatch.setattr(pi, "QUERY_BLOCK", 10)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(10, 32))
    vectors = (centres[rng.integers(0, 10, 2500)] + 0.7 * rng.normal(size=(2500, 32))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = table(spark, rows)
    got = {(r.query_id, r.vec_id) for r in pi.nearest(df, df.filter("vec_id % 100 = 0"), 10, least_reranked=50).collect()}
    want = {(q, i) for q, near in plain(rows, [r for r in rows if r[0] % 100 == 0], 10).items() for i, _ in near}
    assert len(got) == 250 and len(got & want) / len(want) >= 0.9


def test_footrule_of_short_lists():
    rng = np.random.default_rng(3)
    centres, held = rng.normal(size=(40, 5)), rng.normal(size=(200, 5))
    orders = pi.pivot_orders(held, centres, 6)
    lists = pi.Lists(orders, 40)
    assert len(lists.vector) == 200 * 6  # a vector is posted under its nearest pivots only
    unread = 0
    for query in rng.normal(size=(20, 5)):
        own = pi.pivot_orders(query[None, :], centres, 6)[0][:3]
        got = lists.footrule(own)
        for order, footrule in zip(orders.tolist(), got):
            if set(own) & set(order):
                assert footrule == sum(abs((order.index(p) if p in order else 6) - place) for place, p in enumerate(own))
            else:
                assert footrule == np.iinfo(np.int64).max
                unread += 1
    assert unread > 1000  # most vectors are not met at all
    near = pi.pivot_orders(centres[:1], centres, 40)[0]
    assert near[0] == 0 and sorted(near) == list(range(40))


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]),
            (8, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [1.0, -0.0]), (100, [2.0, 0.0]), (0, [1.0, 0.0])]
    df = table(spark, rows).selectExpr("*", "1 as rank", "2 as score")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in pi.nearest(df, df.filter("vec_id % 100 = 0"), 10).collect())
    assert got == [(0, 1, 9, 0.0), (0, 2, 8, 1.0), (0, 3, 100, 1.0), (100, 1, 0, 1.0), (100, 2, 9, 1.0), (100, 3, 8, 1.414214)]
    assert pi.nearest(df.limit(0), df.limit(0), 10).count() == 0
    alone = table(spark, [(0, [1.0, 0.0])])
    assert pi.nearest(alone, alone, 10).count() == 0
