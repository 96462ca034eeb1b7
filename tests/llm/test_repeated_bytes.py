import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from loomdex.llm import repeated_bytes as rb
from tests.llm.helpers import documents, words


def plain(docs, length):
    bodies = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i:i + length] for _, b in bodies for i in range(len(b) - length + 1))
    out = Counter()
    for doc_id, b in bodies:
        hit = bytearray(len(b) + 1)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                hit[i:i + length] = b"\1" * length
        runs = sum(hit[i] and not (i and hit[i - 1]) for i in range(len(b)))
        kept = bytes(x for x, h in zip(b, hit) if not h)
        out[(doc_id, len(b), sum(hit), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


def result(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def passages(seed, docs):
    """Texts of fresh words with passages, long and short, from a small pool."""
    rng = random.Random(seed)
    pool = [" ".join(words(1000 + i, n)) for i, n in enumerate((6, 8, 12, 30, 9))] + ["x" * 130, "ab" * 50, "é" * 40]
    out = []
    for i in range(docs):
        parts = [rng.choice(pool) if rng.random() < 0.5 else " ".join(words(seed * 1000 + i * 10 + k, rng.randint(1, 12))) for k in range(rng.randint(1, 7))]
        out.append((i, rng.choice(["", " ", "\n"]).join(parts)))
    return out


def test_matches_brute_force(spark):
    for seed in (1, 2):
        docs = passages(seed, 60)
        docs += [(100, docs[0][1]), (101, docs[0][1]), (102, docs[1][1] + "tail"), (None, docs[2][1][1:])]
        assert result(rb.remove_repeated(documents(spark, docs), length=40, gram=8)) == plain(docs, 40)
        assert result(rb.remove_repeated(documents(spark, docs), length=37, gram=37)) == plain(docs, 37)


def test_common_grams_counted_across_buckets_match_brute_force(spark, monkeypatch):
    docs = passages(5, 80)
    monkeypatch.setattr(rb.repeated_spans, "__defaults__", (rb.LENGTH, rb.GRAM, 3))
    assert result(rb.remove_repeated(documents(spark, docs), length=40, gram=8)) == plain(docs, 40)


def test_edge_rows(spark):
    long = " ".join(words(9, 500))
    docs = [(1, None), (2, ""), (2, ""), (3, "x" * 399), (4, "x" * 399), (5, "y" * 401), (6, "z" * 400), (6, "z" * 400), (None, long), (7, long[5:900])]
    df = documents(spark, docs, "1 as k1", "2 as n_spans", "3 as body")
    assert result(rb.remove_repeated(df)) == plain(docs, 400)
    assert rb.remove_repeated(documents(spark, [])).count() == 0


def test_anchors_do_not_depend_on_the_stretch(monkeypatch):
    body = " ".join(words(3, 3000)).encode() + b"q" * 3000
    whole = rb.anchors(body, 60, 12)
    monkeypatch.setattr(rb, "STRETCH", 701)
    parts = rb.anchors(body, 60, 12)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    places = set(whole[0].tolist())
    assert all(any(p in places for p in range(i, i + 49)) for i in range(len(body) - 59))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=20), min_size=1, max_size=30))
def test_multikey_sort_orders_and_measures(strings):
    strings = [bytes(b % 3 for b in s) for s in strings]
    order, common = rb.multikey_sort(*rb.padded(pa.array(strings, pa.binary()), 24))
    got = [strings[i] for i in order]
    assert got == sorted(strings)
    for a, b, n in zip(got, got[1:], common[1:]):
        assert n == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def windows_hashed(bodies, length):
    """Which starts of each body hold a `length`-byte string that starts elsewhere too; by two polynomial hashes modulo 2^64."""
    flat = np.frombuffer(b"".join(bodies), np.uint8).astype(np.uint64) + np.uint64(1)
    keys = []
    for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        inverse = pow(base, -1, 1 << 64)
        steps = np.full(len(flat) + 1, base, np.uint64)
        back = np.full(len(flat) + 1, inverse, np.uint64)
        steps[0] = back[0] = 1
        powers, unpowers = np.cumprod(steps), np.cumprod(back)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat * powers[:-1])])
        at = np.arange(max(0, len(flat) - length + 1))
        keys.append((sums[at + length] - sums[at]) * unpowers[at])
    ends = np.cumsum([len(b) for b in bodies])
    owner = np.searchsorted(ends, np.arange(len(keys[0])), side="right")
    within = np.arange(len(keys[0])) + length <= ends[owner]
    places = np.flatnonzero(within)
    _, which, counts = np.unique(np.stack([keys[0][places], keys[1][places]], axis=1), axis=0, return_inverse=True, return_counts=True)
    return ends, places[counts[which.ravel()] > 1]


def test_whole_table_matches_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = table.select("doc_id", "text").collect()
    bodies = [(r.text or "").encode() for r in rows]
    ends, repeated = windows_hashed(bodies, 400)
    mark = np.zeros(ends[-1] + 1, np.int64)
    np.add.at(mark, repeated, 1)
    np.add.at(mark, repeated + 400, -1)
    covered = np.cumsum(mark)[:-1] > 0
    expected = Counter()
    for r, body, end in zip(rows, bodies, ends):
        hit = covered[end - len(body):end]
        runs = int((hit & ~np.concatenate([[False], hit[:-1]])).sum())
        kept = np.frombuffer(body, np.uint8)[~hit].tobytes()
        expected[(r.doc_id, len(body), int(hit.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    got = result(rb.remove_repeated(table))
    assert got == expected and sum(n for row, n in got.items() if row[2]) > 100
