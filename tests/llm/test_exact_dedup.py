import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomdex.llm import exact_dedup
from tests.llm.helpers import DOCS, documents, words


def brute_force(rows):
    groups: dict[str, list[int]] = {}
    norms = ["".join(c for c in r[1] or "" if c not in " \t\n\v\f\r") for r in rows]
    for i, norm in enumerate(norms):
        groups.setdefault(norm, []).append(i)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        sha = hashlib.sha256(norm.encode("utf-8", "surrogatepass")).hexdigest()
        out += [(rows[i][0], rows[best][0], len(members), i == best, sha) for i in members]
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(5)
    texts = [" ".join(words(i, 5)) for i in range(20)]
    rows = [(i, rng.choice(texts).replace(" ", rng.choice([" ", "  ", "\n", "\t\r", "", "\v\f"]))) for i in range(200)]
    rows += [(1000 + i, "one very common text") for i in range(300)]
    return rows + [
        (2000, None), (2001, ""), (2002, " \n"), (None, "é \U0001f600"), (None, "é\U0001f600"), (2003, "é\U0001f600"), (2003, "é \U0001f600"),
        (2004, "same id"), (2004, "same id"), (None, "no id"), (None, "no id"), (2005, "x" * 300_000), (2006, " " + "x" * 300_000),
    ]


@pytest.mark.parametrize("hashed", [exact_dedup.content_hash, lambda text: F.unhex(F.hex(F.length(text) % 3)), lambda text: F.lit(b"0")])
def test_same_as_brute_force_also_where_hashes_collide(spark, hashed):
    rows = corpus()
    got = exact_dedup.duplicates(documents(spark, rows), hashed)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows)


def test_one_of_equal_rows_stays(spark):
    kept = exact_dedup.duplicates(documents(spark, [(1, "a"), (1, "a"), (None, "b"), (None, "b")])).filter("kept")
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]


def test_collisions_are_found_only_where_texts_differ(spark):
    docs = documents(spark, [(1, "a b"), (2, "ab"), (3, "c")])
    for hashed, expected in ((exact_dedup.content_hash, 0), (lambda text: F.lit(b"0"), 1)):
        marked = exact_dedup._marked(exact_dedup._hashed(docs, hashed))
        assert exact_dedup.colliding_hashes(docs, marked, hashed).count() == expected


def test_empty_table_and_clashing_columns(spark):
    assert exact_dedup.duplicates(spark.createDataFrame([], DOCS)).collect() == []
    docs = documents(spark, [(1, "a b"), (2, "ab")], "1 as hash", "2 as norm", "3 as chars", "4 as keep_id", "5 as row", "6 as group_size")
    got = exact_dedup.duplicates(docs)
    assert sorted(map(tuple, got.select("doc_id", "keep_id", "group_size", "kept").collect())) == [(1, 1, 2, True), (2, 1, 2, False)]
    assert [r.doc_id for r in exact_dedup.unique_documents(docs).collect()] == [1]
