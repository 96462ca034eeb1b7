import random
import subprocess
import sys
from pathlib import Path

import pytest
import xxhash

import __spark_entry__ as entry
import corpus_pipeline
from loomdex.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import documents, words

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_on_the_smallest_tables(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_nothing_else_imports_the_subpackage():
    said = subprocess.run(
        [sys.executable, "-c", "import sys; import loomdex.plans.queries, loomdex.plans.oracle, bench; print([m for m in sys.modules if 'llm' in m])"],
        cwd=ROOT, capture_output=True, text=True,
    )
    assert said.stdout.strip() == "[]", said.stderr


def test_unwanted_and_doubtful_languages_go(spark, monkeypatch):
    def text(seed, letters):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(60))

    rows = [(i, text(i, "abcdefgh"), "aa") for i in range(30)] + [(100 + i, text(i, "stuvwxyz"), "bb") for i in range(30)]
    rows += [(200, text(200, "abcdefgh"), None), (303, text(201, "stuvwxyz"), "aa"), (202, "123 !?", "aa"), (203, "m", None), (None, text(5, "abcdefgh"), "aa")]
    docs = documents(spark, rows)
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    assert set(kept) == {r[0] for r in rows} - {202, 203}
    assert kept[200] == kept[5] == kept[None] == "aa" and kept[303] == kept[105] == "bb"
    monkeypatch.setattr(corpus_pipeline, "WANTED", ("aa",))
    assert {r.lang for r in corpus_pipeline.language_id(spark, docs, SF).collect()} == {"aa"}


def plain_pipeline(rows, benchmark):
    """Ids that stay and their texts: every stage as a plain loop, for texts of one line or more of ten words at least."""
    seen, kept = set(), []
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        left = [line for line in lines if line not in seen]
        seen.update(lines)
        if left:
            kept.append((doc_id, "\n".join(left)))
    prints: list[tuple[int, int, str]] = []
    groups: dict[int, int] = {}
    for doc_id, text in kept:
        tokens = text.lower().split()
        shingles = [" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)]
        counts = [0] * 64
        for shingle in shingles:
            h = xxhash.xxh64_intdigest(shingle.encode(), 42)
            for bit in range(64):
                counts[bit] += h >> bit & 1
        prints.append((doc_id, sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles)), text))
    for i, (doc_id, a, _) in enumerate(prints):
        groups.setdefault(doc_id, doc_id)
        for other, b, _ in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                low, high = sorted((groups[doc_id], groups[other]))
                groups = {d: low if g == high else g for d, g in groups.items()}
    out = {}
    for doc_id, _, text in prints:
        tokens = text.lower().split()
        near = any(
            sum(x != y for x, y in zip(tokens[p:p + 13], item[q:q + 13])) <= 2
            for item in benchmark for p in range(len(tokens) - 12) for q in range(len(item) - 12)
        )
        if groups[doc_id] == doc_id and not near:
            out[doc_id] = text
    return out


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rng = random.Random(4)
    line = [" ".join(words(900 + i, 12)) for i in range(6)]
    item = words(990, 20)
    rows = []
    for i in range(40):
        own = [" ".join(words(1000 + 10 * i + k, 14)) for k in range(rng.randint(1, 3))]
        shared = [rng.choice(line)] if rng.random() < 0.4 else []
        rows.append((i, "\n".join(own + shared)))
    rows += [(50, rows[3][1]), (51, rows[4][1] + " tail"), (52, " ".join([*words(7, 15), *item[3:], *words(8, 15)])), (53, rows[5][1].split("\n")[0])]
    documents(spark, [(*r, "en") for r in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    got = {r.doc_id: r.text for r in docs.collect()}
    assert got == plain_pipeline(rows, [item]) and 20 < len(got) < 44
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(got) and sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())


def test_stages_keep_the_columns_and_clean_documents(spark):
    shared = " ".join(words(1, 60))
    docs = documents(spark, [
        (1, "Fresh words of its own. " + " ".join(words(2, 50)), "en"), (2, "123 456", "en"), (3, shared + "\n" + " ".join(words(3, 50)), "en"),
        (4, shared + "\n" + " ".join(words(4, 50)), "en"), (5, shared, "en"), (None, " ".join(words(6, 50)), None), (7, None, None), (8, "", "en"),
    ])
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) in (4, 5) and "near_dedup" in names
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == {1, 3, 4, None} and kept[4] == " ".join(words(4, 50)) and kept[3].startswith(shared)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {1, 3, 4, None}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), SF).count() == 0
