"""Index, search, suggestion and response against brute force on small fixtures."""

import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.operators import index as ix
from loomdex.operators import response, scoring, search, suggest, vectors
from loomdex.session import cut_lineage, fresh_dir, work_dir
from loomdex.sources import store
from loomdex.sources.store import Index, append_segment, merge_index, open_index, read_segments, update_index, write_index

WORDS = "дуб мост рок zug abc стол лампа окно свет тень".split()


def make_docs(spark, n=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        title = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 3)))
        # One word fills a third of all texts.
        body = " ".join(["дуб"] * (5 if i % 3 == 0 else 0) + [rng.choice(WORDS) for _ in range(rng.randint(0, 12))])
        rows.append((f"k{i:03}", f"k{i:03}", title, body, "", "web", "", i))
    return spark.createDataFrame(
        rows, "doc_key string, url string, title string, content string, file_path string, file_type string, content_hash string, seq bigint"
    )


def make_queries(spark):
    rows = [
        (1, "дуб мост", 1, 5), (2, "дуб дуб zug", 2, 4), (3, "the и", 1, 10), (4, "нигде", 1, 10), (5, "", 1, 10), (6, "абв рок", 9, 50),
    ]
    return spark.createDataFrame(rows, "query_id bigint, q string, page bigint, size bigint")


def brute_scores(docs, queries):
    stop = set(vocab.QUERY_STOP)
    fields = {
        f: {r.doc_key: [w for w in getattr(r, f).lower().split() if w not in vocab.RUSSIAN_STOP] for r in docs} for f in ("title", "content")
    }
    n = len(docs)
    df = {f: Counter(w for ws in fields[f].values() for w in set(ws)) for f in fields}
    stem = {"лампа": "ламп", "окно": "окн", "тень": "тен", "нигде": "нигд"}
    out = {}
    for q in queries:
        if not q.q:
            continue
        kept = [w for w in q.q.split() if w not in stop] or q.q.split()
        terms = Counter(w for w in kept if w not in vocab.RUSSIAN_STOP)
        idf = {(f, t): 1 + math.log(n / (df[f][t] + 1)) for f in fields for t in terms}
        total = sum(c * idf[f, t] ** 2 for f in fields for t, c in terms.items())
        for r in docs:
            score, matched_fields = 0.0, 0
            for f in fields:
                words = fields[f][r.doc_key]
                hit = {t: c for t, c in terms.items() if t in words}
                if not hit:
                    continue
                matched_fields += 1
                raw = sum(c * math.sqrt(words.count(t)) / math.sqrt(len(words)) * idf[f, t] ** 2 / math.sqrt(total) for t, c in hit.items())
                score += raw * sum(hit.values()) / sum(terms.values())
            if matched_fields:
                out[q.query_id, r.doc_key] = round(score * matched_fields / 2, 6)
    return out


@pytest.fixture(scope="module")
def data(spark):
    docs, queries = make_docs(spark), make_queries(spark)
    return docs, queries, brute_scores(docs.collect(), queries.collect())


def as_dict(scored):
    return {(r.query_id, r.doc_key): round(r.score, 6) for r in scored.collect()}


def test_scores_match_brute_force(data):
    docs, queries, expected = data
    assert as_dict(search.scores(Index(docs), queries)) == pytest.approx(expected)


def test_shuffled_join_gives_the_same_scores(data, monkeypatch):
    docs, queries, expected = data
    monkeypatch.setattr(search, "fits_broadcast", lambda *a: False)
    assert as_dict(search.scores(Index(docs), queries)) == pytest.approx(expected)


def test_stored_index_gives_the_same_scores(spark, data):
    docs, queries, expected = data
    home = fresh_dir(spark, "index")
    assert open_index(spark, home).docs.count() == 0
    write_index(docs, home)
    assert as_dict(search.scores(open_index(spark, home), queries)) == pytest.approx(expected)
    # A newer version replaces documents by key.
    changed = docs.filter("doc_key = 'k000'").withColumn("content", F.lit("уникум")).withColumn("seq", F.lit(1000).cast("bigint"))
    write_index(docs.unionByName(changed), home)
    index = open_index(spark, home)
    assert index.docs.count() == 60
    asked = spark.createDataFrame([(1, "уникум")], "query_id bigint, q string")
    assert [r.doc_key for r in search.scores(index, asked).collect()] == ["k000"]


def test_updates_equal_a_rebuild(spark, data):
    docs, queries, expected = data
    home = fresh_dir(spark, "updated")
    old = docs.filter("seq < 55").withColumn("content", F.when(F.col("seq") % 9 == 0, F.lit("мост уникум")).otherwise(F.col("content")))
    gone = docs.limit(3).withColumn("doc_key", F.concat(F.lit("gone"), "doc_key"))
    write_index(old.unionByName(gone), home)
    fixed = docs.filter("seq % 9 = 0 or seq >= 55")
    update_index(fixed.filter("seq < 30").withColumn("content", F.lit("между уникум")).withColumn("seq", F.lit(-1).cast("bigint")), home)
    update_index(fixed, home, deleted=gone.select("doc_key"))
    home_of = f"{home}/v=1"
    # Only what was handed over was analysed.
    assert spark.read.parquet(f"{home_of}/documents/gen=2").count() == fixed.count() == 12
    asked = spark.createDataFrame([(1, "Мостт zugg"), (2, "лаппа"), (3, "уникумм")], "query_id bigint, q string")
    for _ in range(2):
        index = open_index(spark, home)
        assert index.docs.count() == 60 and as_dict(search.scores(index, queries)) == pytest.approx(expected)
        rebuilt = fresh_dir(spark, "rebuilt")
        write_index(docs, rebuilt)
        fresh = open_index(spark, rebuilt)
        assert sorted(index.term_df.collect()) == sorted(fresh.term_df.collect()) and spark.range(1).select(index.n_docs).first()[0] == 60
        assert suggest.suggest(index, asked).orderBy("query_id").collect() == suggest.suggest(fresh, asked).orderBy("query_id").collect()
        merge_index(spark, home)  # the second time round the merged version is read
    assert open_index(spark, home).dead is None


def test_deleting_everything_and_empty_updates(spark, data):
    docs, queries, _ = data
    home = fresh_dir(spark, "emptied")
    write_index(docs, home)
    update_index(docs.limit(0), home, deleted=docs.select("doc_key"))
    index = open_index(spark, home)
    assert index.docs.count() == 0 and search.scores(index, queries).count() == 0 and index.term_df.count() == 0
    update_index(docs.limit(5), home)
    assert open_index(spark, home).docs.count() == 5
    empty = fresh_dir(spark, "empty")
    write_index(docs.limit(0), empty)
    assert search.scores(open_index(spark, empty), queries).count() == 0
    update_index(docs.limit(2), empty)
    assert open_index(spark, empty).docs.count() == 2


def test_stored_vectors_give_the_places_in_the_text(spark):
    from loomdex.functions import snippet

    texts = ["Ёлки и мосты, мост — стеклянный мост.", "", "x", "нет её: столы стол's 3.14 é\u0301 мосту"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("terms", F.array(F.lit("мост"), F.lit("елк"), F.lit("стол"), F.lit("3.14")))
    made = df.withColumn("v", ix.term_vector(F.col("t")))
    for r in made.select("t", snippet.term_ranges(F.col("t"), F.col("terms")).alias("a"), snippet.vector_ranges(F.col("v"), F.col("terms")).alias("b"), "v").collect():
        assert [tuple(x) for x in r.a] == [tuple(x) for x in r.b]
        for term in r.v or []:
            for p in term.locs:
                assert r.t.encode()[p.start:p.end].decode() == r.t[p.first:p.last]


def test_stored_pieces_find_the_same_terms(spark, data):
    docs, _, _ = data
    home = fresh_dir(spark, "index")
    write_index(docs, home)
    index = open_index(spark, home)
    terms = spark.createDataFrame([("мост",), ("зуг",), ("окн",), ("zag",), ("a",)], "term string")
    expected = sorted(suggest.similar_terms(terms, suggest.vocabulary(index), True).collect())
    for small in (True, False):
        assert sorted(suggest.stored_similar_terms(terms, index, small).collect()) == expected and expected


def test_stored_suggestions_equal_direct_ones(spark, data):
    docs, _, _ = data
    home = fresh_dir(spark, "index")
    write_index(docs, home)
    asked = spark.createDataFrame([(1, "Мостт zugg"), (2, "лаппа")], "query_id bigint, q string")
    direct = suggest.suggest(Index(docs), asked).orderBy("query_id").collect()
    assert suggest.suggest(open_index(spark, home), asked).orderBy("query_id").collect() == direct
    assert [r.suggestion for r in direct] == ["Мост zug", "лампа"]


def test_pages_are_disjoint_and_complete(data):
    docs, queries, expected = data
    scored = cut_lineage(search.scores(Index(docs), queries))
    seen = []
    for page in range(1, 40):
        hits = search.pages(scored, queries.filter("query_id = 1").withColumn("page", F.lit(page).cast("bigint"))).collect()
        seen += [h.doc_key for h in sorted(hits, key=lambda h: h.rank)]
        if not hits:
            break
    mine = sorted((k for k in expected if k[0] == 1), key=lambda k: (-expected[k], k[1]))
    assert len(seen) == len(set(seen)) and set(seen) == {k[1] for k in mine}
    assert [expected[1, k] for k in seen] == [expected[k] for k in mine]


def test_deep_pages_equal_shallow_ones(data):
    docs, queries, _ = data
    scored = cut_lineage(search.scores(Index(docs), queries))
    for page, size in ((1, 7), (2, 7), (3, 50)):
        asked = queries.withColumn("page", F.lit(page).cast("bigint")).withColumn("size", F.lit(size).cast("bigint"))
        shallow = search.pages(scored, asked).select("query_id", "doc_key", "rank", "page", "size").collect()
        deep = search.deep_pages(scored, asked.drop("q")).select("query_id", "doc_key", "rank", "page", "size").collect()
        assert sorted(deep) == sorted(shallow)


def test_response(data):
    docs, queries, expected = data
    rows = {r.query_id: json.loads(r.response) for r in response.to_json(response.respond(Index(docs), queries)).collect()}
    assert len(rows) == 6
    first = rows[1]
    assert first["total"] == sum(k[0] == 1 for k in expected) and first["pageSize"] == 5 and first["indexedPages"] == 60
    assert first["totalPages"] == math.ceil(first["total"] / 5)
    assert 1 <= len(first["results"]) <= 5 and "suggestion" not in first
    top = first["results"][0]
    assert top["id"] == 0 and top["relevance"] == "high" and "filePath" not in top and top["fileType"] == "web"
    assert "content" not in top and "contentHash" not in top
    titles = [r["title"].strip().lower() for r in first["results"]]
    assert len(titles) == len(set(titles))
    assert rows[5] == {"results": [], "total": 0, "page": 1, "pageSize": 10, "totalPages": 0, "indexedPages": 60}
    assert rows[6]["results"] == [] and rows[6]["total"] > 0


def test_similar_terms_miss_nothing(spark):
    rng = random.Random(5)
    words = {"".join(rng.choice("абв") for _ in range(rng.randint(1, 9))) for _ in range(400)}
    terms = spark.createDataFrame([(w,) for w in list(words)[:80]], "term string")
    known = spark.createDataFrame([(w,) for w in words], "term string")
    pairs = terms.alias("a").join(known.select(F.col("term").alias("similar")), F.levenshtein("term", "similar") <= 2)
    expected = {(r.term, r.similar) for r in pairs.collect()}
    for small in (True, False):
        got = suggest.similar_terms(terms, known, small).collect()
        assert len(got) == len(expected) and {(r.term, r.similar) for r in got} == expected


def test_corrections(spark):
    queries = spark.createDataFrame([(1, "Дмо слово, дом")], "query_id bigint, q string")
    words = spark.createDataFrame([(1, "a", ["дом", "дым", "слово"]), (1, "b", ["ком"])], "query_id bigint, doc_key string, words array<string>")
    got = {r.word: (r.correction, r.dist) for r in suggest.corrections(queries, words).collect()}
    assert got == {"дмо": ("дом", 2), "слово,": ("слово", 1)}
    found = suggest.corrections(queries, words)
    assert suggest.rebuilt(queries, found).first().suggestion == "Дом слово дом"


def test_latest_is_idempotent(spark):
    path = fresh_dir(spark, "segments")
    docs = make_docs(spark, 10)
    for _ in range(2):
        append_segment(docs, path, 0)
        append_segment(docs.limit(4).withColumn("seq", F.col("seq") + 100), path, 1)
    current = ix.latest(read_segments(spark, path))
    assert current.count() == 10 and current.filter("seq >= 100").count() == 4


def test_page_parameters(spark):
    rows = spark.createDataFrame([("0", "51"), ("-1", "0"), ("x", ""), ("3", "50"), ("99999999999999999999", "7")], "p string, s string")
    got = rows.select(search.page_number(F.col("p")).alias("p"), search.page_size(F.col("s")).alias("s")).collect()
    assert [tuple(r) for r in got] == [(1, 10), (1, 10), (1, 10), (3, 50), (1, 7)]


def test_work_dir_reads_the_session(spark):
    class Shared:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.checkpoint.dir": "hdfs://shared/ck/"}[key]

    assert work_dir(Shared()) == "hdfs://shared/ck"


def test_term_vectors_by_batch_equal_the_column_form(spark):
    long = " ".join(f"слово{i % 7} word{i} Ⱥ𝒳{i % 3}" for i in range(700))
    stems = "нежнейшей красивейшему бегавшись радость глупости длинный ходившими ёлки моются смеялась пить вышивши ю а ые ость данность"
    texts = [None, "", " ...", "и в на", "Кошки КОШКА, кошка and Cats", "a\u0001b İΣ Ça ét", stems, long, "漢字かな カタカナ 12,5 v1.2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 40)], "i int, t string").repartition(3)
    made = vectors.term_vectors(df, {"t": F.col("t")}).withColumn("v", ix.term_vector(F.col("t")))
    assert made.filter(~F.col("t_terms").eqNullSafe(F.col("v"))).select("t").distinct().collect() == []
    assert made.filter("t_terms is not null").count() == 40 * 5


def test_document_buckets_are_dealt_over_many_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("doc_key"), F.lit(0).alias("b"))
    monkeypatch.setattr(store, "term_vectors", lambda df, fields: df.withColumn("part", F.spark_partition_id()))
    bucketed = rows.withColumn("doc_bucket", store.term_bucket(F.col("doc_key"), 16))
    store._write_bucketed(bucketed, str(tmp_path / "t"), "doc_bucket", ("doc_key",), analysed={"t": F.col("doc_key")})
    shared = spark.read.parquet(str(tmp_path / "t")).groupBy("doc_bucket").agg(F.count_distinct("part").alias("n"))
    assert shared.agg(F.min("n")).first()[0] > 1


def test_matches_of_a_stored_index_are_not_shuffled(spark, data):
    docs, queries, _ = data
    home = fresh_dir(spark, "index")
    write_index(docs, home)
    index = open_index(spark, home)
    for scored in (search.scores(index, queries), search.scores_by_field(index, queries, fields=("title",))):
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(doc_key" in plan and "hashpartitioning(query_id" not in plan


def test_scores_by_batch_equal_the_joined_ones(spark, monkeypatch):
    rng = random.Random(11)
    # One document without a key; several postings batches, several parts of a batch.
    post = spark.createDataFrame(
        [(f"k{d}" if d else None, f, t, rng.randint(1, 4), 9) for d in range(300) for f in ("title", "content") for t in "abcdef" if rng.random() < 0.5],
        "doc_key string, field string, term string, tf bigint, n_tokens bigint",
    )
    # A repeated query number with two lengths, a number that is null, a term without postings.
    weights = spark.createDataFrame(
        [(q, f, t, r, n, w) for q, t, r, n, w in (
            (1, "a", 1, 3, 0.5), (1, "b", 2, 3, 0.25), (2, "a", 1, 1, 1.5), (2, "c", 1, 2, 0.75), (None, "d", 1, 1, 1.0), (7, "z", 1, 1, 2.0), (8, "e", 1, 4, 0.1),
        ) for f in ("title", "content")], "query_id bigint, field string, term string, reps bigint, n_terms bigint, weight double",
    )

    def rows(df):
        return sorted(((r.asDict() | {"score": round(r.score, 8)}) for r in df.collect()), key=str)

    found = search.match(post, weights, True)
    index = Index(docs=post, post=post)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        for matches in (1, 40, 1 << 20):
            monkeypatch.setattr(scoring, "MATCHES", matches)
            assert rows(scoring.by_field(post, weights, ("title", "content"))) == rows(search.field_scores(found))
            joined = rows(search.combined_scores(found))
            assert rows(search.rounded_scores(index, post, weights, True)) == joined and joined
            best = rows(search.ranked(search.rounded_scores(index, post, weights, True, best=3), 3))
            assert best == rows(search.ranked(search.combined_scores(found), 3))
        none = post.limit(0)
        assert search.rounded_scores(index, none, weights, True).count() == scoring.by_field(post, weights.limit(0), ("title", "content")).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_stored_layouts_hold_the_same_terms_places_and_postings(spark, monkeypatch):
    from loomdex.functions import snippet

    texts = [None, "", " ...", "и в на", "Кошки КОШКА, кошка and Cats", "a\u0001b İΣ Ça ét", "дуб мост дуб zug 漢字 12,5", "zug"]
    df = spark.createDataFrame([(f"k{i}" if i else None, texts[i % 8], texts[i * 3 % 8]) for i in range(64)], "doc_key string, title string, content string").repartition(2)
    fields = ix.field_columns()
    flat = vectors.stored_vectors(df, fields)
    terms = F.array(*(F.lit(t) for t in ("дуб", "zug", "кошк", "12,5")))
    places = flat.select("doc_key", snippet.stored_ranges(F.col("content_terms"), terms).alias("p"))
    nested = vectors.term_vectors(df, fields).select("doc_key", snippet.vector_ranges(F.col("content_terms"), terms).alias("p"))
    assert sorted(places.collect(), key=str) == sorted(nested.collect(), key=str) and places.filter("size(p) > 1").count()
    flat = flat.localCheckpoint()
    expected = sorted(ix.vector_postings(flat).select("field", "term", "doc_key", "n_tokens", "tf").collect(), key=str)
    for size in (1, 20, 1 << 20):  # postings put in order at a time
        monkeypatch.setattr(vectors, "POSTINGS", size)
        blocks = vectors.posting_blocks(flat, list(ix.FIELDS), "all").localCheckpoint()
        rows = store.postings_in(blocks.withColumn("gen", F.lit(0))).select("field", "term", "doc_key", "n_tokens", "tf").collect()
        assert sorted(rows, key=str) == expected and len(expected) > 64
    assert blocks.count() < len(expected) / 4 and vectors.posting_blocks(flat.limit(0), list(ix.FIELDS), "all").count() == 0


def test_totals_join_without_a_shuffle_of_the_hits(spark):
    scored = spark.range(400).selectExpr("id % 4 as query_id", "cast(id as string) as doc_key", "cast(id as double) as score")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = search.with_totals(scored, spark.createDataFrame([(0, "a")], "query_id bigint, q string"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {(r.query_id, r.total, r.max_score) for r in joined.collect()} == {(q, 100, 396.0 + q) for q in range(4)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def spark_files(spark):
    """Names of the shuffle files that the session holds."""
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {kept.apply(i).getName() for i in range(kept.size()) if kept.apply(i).getName().startswith("shuffle_")}


def test_index_build_leaves_no_shuffle_files_and_a_small_index(spark, tmp_path):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(words[min(int(rng.paretovariate(0.6)), 2999)] for _ in range(rng.randint(200, 600))) for _ in range(300)]
    docs = spark.createDataFrame(
        [(f"https://docs.example.org/{i}", "", t[:30], t, "", "", "", 0) for i, t in enumerate(texts)],
        "doc_key string, url string, title string, content string, file_path string, file_type string, content_hash string, seq bigint",
    ).localCheckpoint()
    before = spark_files(spark)
    write_index(docs, str(tmp_path / "index"), buckets=4)
    assert not spark_files(spark) - before
    size = sum(f.stat().st_size for f in (tmp_path / "index").rglob("*.parquet"))
    assert size < 1.5 * sum(map(len, texts))


def test_postings_are_not_shuffled_to_be_stored(spark, data, monkeypatch, tmp_path):
    docs, queries, expected = data
    plans, write = {}, store._write
    monkeypatch.setattr(store, "_write", lambda rows, path, bucket, *mode: (plans.update({bucket: rows._jdf.queryExecution().executedPlan().toString()}), write(rows, path, bucket, *mode)))
    for buckets in (3, 16, 100):  # the last one is too many for a file of each writer in each bucket
        home = str(tmp_path / f"index{buckets}")
        write_index(docs, home, buckets)
        assert ("Exchange" in plans["term_bucket"]) == (buckets == 100) == ("Exchange" in plans["key_bucket"])
        index = open_index(spark, home)
        assert as_dict(search.scores(index, queries)) == pytest.approx(expected)
        stored_in = index.post.select("term_bucket", F.explode("term").alias("t")).filter(F.col("term_bucket") != store.posting_bucket(F.col("t"), buckets))
        assert stored_in.count() == 0 and index.post.count() > 0


def test_joined_search_of_a_stored_index(spark, data, monkeypatch):
    docs, queries, expected = data
    home = fresh_dir(spark, "index")
    write_index(docs, home)
    assert {(r.query_id, r.doc_key) for r in search.matches(open_index(spark, home), queries).collect()} == set(expected)
    monkeypatch.setattr(search, "fits_broadcast", lambda *a: False)
    assert as_dict(search.scores(open_index(spark, home), queries)) == pytest.approx(expected)


def test_matched_postings_are_shuffled_as_lists(spark, data):
    docs, queries, _ = data
    home = fresh_dir(spark, "index")
    write_index(docs.withColumn("content", F.lit("дуб мост рок zug")), home, buckets=1)
    index = open_index(spark, home)
    post, weights, small = search._found(index, queries.filter("query_id <= 2"), None)
    rows = scoring._dealt(post, scoring.Weights(weights.toArrow(), ("title", "content"), False), index.live).collect()
    # A row for a field of a document, not for a posting.
    assert len(rows) == len({(r.doc_key, r.n_tokens, *r.code) for r in rows}) <= 2 * 60
    assert max(len(r.code) for r in rows) == 3 and all(len(r.code) == len(r.tf) for r in rows)


def test_only_keys_written_again_are_shuffled_with_their_rows(spark, monkeypatch):
    rows = [("a", 1, "old"), ("a", 3, "new"), ("b", 1, "one"), (None, 1, "x"), (None, 2, "y"), ("c", None, "none")]
    docs = spark.createDataFrame(rows, "doc_key string, seq bigint, text string")
    expected = [("a", 3, "new"), ("b", 1, "one"), ("c", None, "none"), (None, 2, "y")]

    def of(df):
        return sorted((tuple(r) for r in df.collect()), key=str)

    assert of(ix.newest(docs)) == of(ix.latest(docs)) == sorted(expected, key=str)
    assert "Exchange hashpartitioning" not in ix.newest(docs.filter("seq = 1"))._jdf.queryExecution().executedPlan().toString()
    assert of(ix.newest(docs.limit(0))) == []
    monkeypatch.setattr(ix, "fits_broadcast", lambda *a: False)
    assert of(ix.newest(docs)) == sorted(expected, key=str)


def test_stored_places_count_from_one_another(spark):
    texts = ["дуб é́ мост, дуб", "", None, "и the zug"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.t_terms for r in vectors.stored_vectors(df, {"t": F.col("t")}).collect()}
    assert got[1] is None and got[2] is None
    v = got[0]
    assert v.term == ["é́", "дуб", "мост"] and v.tf == [1, 2, 1] and v.of == [1, 0, 2, 1]
    assert v.pos == [1, 1, 1, 1] and v.start == [0, 1, 1, 2] and v.end == [6, 4, 8, 6]
    assert v["first"] == [0, 0, 0, 0] and v["last"] == [-3, -2, -4, -3]
    assert got[3].pos == [2, 1] and got[3].start == [3, 1]  # the stop word in front counts


def test_pages_shuffle_hits_of_the_asked_depth_only(spark, monkeypatch):
    scored = spark.range(6000).selectExpr("id % 3 as query_id", "cast(id as string) as doc_key", "cast(id % 50 as double) as score").localCheckpoint()
    asked = spark.createDataFrame([(0, 2, 5), (1, 1, 4), (2, 30, 40)], "query_id bigint, page bigint, size bigint")
    seen, ranked = [], search.ranked
    monkeypatch.setattr(search, "ranked", lambda rows, depth: (seen.append((rows.select("query_id").distinct().count(), depth)), ranked(rows, depth))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = search.pages(scored, asked)
        assert seen == [(2, 10)]
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan  # hits meet the few requests and bands without a shuffle
        rows = hits.collect()
        monkeypatch.setattr(search, "fits_broadcast", lambda *a: False)
        assert sorted(search.pages(scored, asked).select(hits.columns).collect()) == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    order = sorted(range(6000), key=lambda i: (-(i % 50), str(i)))
    for q, page, size in ((0, 2, 5), (1, 1, 4), (2, 30, 40)):
        mine = [str(i) for i in order if i % 3 == q][(page - 1) * size:page * size]
        assert [r.doc_key for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == q] == mine


def test_pages_without_a_shallow_request(spark):
    scored = spark.range(30).selectExpr("0L as query_id", "cast(id as string) as doc_key", "cast(id as double) as score")
    asked = spark.createDataFrame([(0, 900, 50)], "query_id bigint, page bigint, size bigint")
    assert search.pages(scored, asked).count() == search.pages(scored, asked.limit(0)).count() == 0


def test_scores_of_a_response_are_kept_as_a_compact_table(spark, data, monkeypatch):
    docs, queries, expected = data
    home = fresh_dir(spark, "index")
    write_index(docs, home)
    kept, stored = {}, response.stored
    monkeypatch.setattr(response, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    rows = {r.query_id: r for r in response.respond(open_index(spark, home), queries).collect()}
    assert len(rows) == 6 and rows[1].total == sum(k[0] == 1 for k in expected) and rows[6].results == []
    assert as_dict(kept["scores"]) == pytest.approx(expected)
    assert "Scan parquet" in kept["scores"]._jdf.queryExecution().executedPlan().toString()
