import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomdex.llm import simhash
from loomdex.llm.components import connected_components
from tests.llm.helpers import documents, words


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i:i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBcÉß \t\n\u00a0\x1c", max_size=60))
def test_fingerprint_is_the_definition(text):
    assert simhash.simhash(text) == plain(text)


def plain_components(fps, distance=3):
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return group


def crowd(seed, n):
    """Fingerprints around a few centres, so that partition values are crowded and chains are long."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(3)]
    out = set()
    while len(out) < n:
        fp = rng.choice(centres) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 8)):
            fp ^= 1 << rng.randrange(64)
        out.add(fp)
    return sorted(out)


def test_links_connect_exactly_what_is_connected(spark):
    for partitions, block in ((4, 8192), (3, 8192), (2, 8192), (4, 40)):
        fps = crowd(partitions + block, 300)
        signed = np.array(fps, np.uint64).view(np.int64).tolist()
        df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
        found = {frozenset((r.u, r.v)) for r in simhash.links(df, partitions=partitions, block=block).collect()}
        group = list(range(len(fps)))
        place = {x: i for i, x in enumerate(signed)}
        for pair in found:
            a, b = (group[place[x]] for x in pair)
            group = [min(a, b) if g in (a, b) else g for g in group]
        want = plain_components(fps)
        assert len(set(group)) == len(set(want)) == len(set(zip(group, want)))


def test_a_crowded_bucket_gives_a_forest_not_pairs():
    fps = np.array(sorted({1 << i for i in range(64)} | {0}), np.uint64)
    root = simhash.bucket_forest(np.zeros(len(fps), np.int64), fps, 3)
    assert set(root.tolist()) == {0}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(200, 201), (201, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_edge_rows(spark):
    long = " ".join(words(1, 30_000))
    rows = [(5, None), (3, ""), (9, " \n"), (None, ""), (1, "a"), (1, "a"), (7, "one two"), (2, long), (8, long), (None, "lonely null id")]
    docs = documents(spark, rows, "1 as fp", "2 as component_id")
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    assert {c for d, f, c in got if f == 0} == {3}
    assert {(d, c) for d, f, c in got if d in (1, 2, 8)} == {(1, 1), (2, 2), (8, 2)}
    assert [c for d, f, c in got if d is None and f != 0] == [None]
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_unique_documents_keeps_one_of_each_group(spark):
    base = words(4, 400)
    near = base[:200] + ["changed"] + base[201:]
    rows = [(4, " ".join(base)), (6, " ".join(near)), (6, " ".join(near)), (5, "quite another text"), (None, None), (8, "")]
    docs = documents(spark, rows)
    got = simhash.unique_documents(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [4, 5, 8]
    assert simhash.unique_documents(docs.filter(F.lit(False))).count() == 0
