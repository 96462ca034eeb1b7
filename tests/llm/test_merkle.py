import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from loomdex.llm import merkle
from tests.llm.helpers import DOCS, documents


def h(text):
    return sha256(text.encode()).hexdigest()


def tree(leaves):
    """Root, and for each leaf the steps to it, by whole levels."""
    ways, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(at):
            other = place ^ 1
            ways[i].append("" if other >= len(level) else (">" if other > place else "<") + level[other])
            at[i] = place // 2
        level = [h("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
    return level[0], ways


def brute_force(rows):
    """rows: (lang, doc_id, leaf)."""
    groups: dict = {}
    for lang, doc_id, leaf in rows:
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    root, tops = tree([low[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        out += [(d if given else None, leaf, low[g][0], root, way + top) for (given, d, leaf), way in zip(sorted(groups[g]), low[g][1])]
    return sorted(out, key=repr)


def leaves(spark, rows):
    return spark.createDataFrame(rows, "lang string, doc_id bigint, leaf string")


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows = [(lang, rng.randrange(10**6), h(f"{lang} {i}")) for lang, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [1, 2, 3, 10])
@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, None: 3}, {"en": 61, "": 1, None: 9, "é": 8, "z": 33, "Z": 16}])
def test_same_as_whole_levels(spark, bits, sizes):
    rows = rows_of(sizes)
    got = merkle.manifest(leaves(spark, rows), "lang", "doc_id", carried=["doc_id"], bits=bits)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows)


@pytest.mark.parametrize("n", range(1, 20))
def test_appended_subtrees_hold_the_witnesses_of_all_leaves(n):
    given = [h(str(i)) for i in range(n)]
    growing = merkle.OpenSubtrees()
    witnesses = [growing.append(leaf) for leaf in given]
    assert [len(x[2]) for x in growing.open] == [1 << i for i in reversed(range(10)) if n >> i & 1]
    assert (growing.close((n - 1).bit_length()), witnesses) == tree(given)


def test_witnesses_prove_leaves_and_nothing_else(spark):
    rows = rows_of({"en": 40, "fr": 5})
    got = merkle.manifest(leaves(spark, rows), "lang", "doc_id", bits=2)
    got = got.select(
        (merkle.folded(F.col("leaf"), F.col("witness")) == F.col("root")).alias("holds"),
        (merkle.folded(F.sha2("leaf", 256), F.col("witness")) == F.col("root")).alias("falsified"),
        merkle.siblings_digest(F.col("witness")).alias("proof"), "witness",
    ).collect()
    assert all(r.holds and not r.falsified and r.proof == h("".join(s[1:] for s in r.witness)) for r in got)


def test_nulls_ties_and_empty_tables(spark):
    rows = [("en", None, h("b")), ("en", None, h("a")), ("en", 1, h("c")), ("en", 1, h("c")), ("en", 1, h("b")), (None, 2, h("d"))]
    got = merkle.manifest(leaves(spark, rows), "lang", "doc_id", carried=["doc_id"], bits=1)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows)
    assert merkle.manifest(leaves(spark, []), "lang", "doc_id").collect() == []


def test_fields_of_a_leaf(spark):
    docs = spark.createDataFrame([(1, None, "", "é", None)], DOCS).select(merkle.leaf_of(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text"))).alias("l"))
    assert docs.first().l == h("1:12:é0:--")


def test_carried_columns_may_have_any_name(spark):
    docs = documents(spark, [(1, "a", "en"), (2, "b", "en"), (3, "c", "fr")], "doc_id as grp", "'x' as node", "doc_id as pos", "7 as n", "8 as steps")
    made = docs.withColumn("leaf", F.sha2("text", 256))
    got = merkle.manifest(made, "lang", "doc_id", carried=["grp", "node", "pos", "n", "steps"]).collect()
    assert sorted((r.grp, r.node, r.pos, r.n, r.steps, r.leaf) for r in got) == [(i, "x", i, 7, 8, h(t)) for i, t in ((1, "a"), (2, "b"), (3, "c"))]
