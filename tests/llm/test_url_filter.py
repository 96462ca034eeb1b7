from pyspark.sql import functions as F

from loomdex.llm import bloom, url_filter
from loomdex.llm.queries import URL_RULES

URLS = [
    (1, "HTTP://WWW.Example.ORG/es/a?x=1#f", "block"), (2, "https://example.org/en/12", "block"), (3, "https://a.example.org/en/2", "allow"),
    (4, "x://shop.com/de/", "block"), (5, "x://shop.com/fr/de", "allow"), (6, "x://notexample.org/es/", "allow"), (7, None, "allow"),
    (8, "no scheme", "allow"), (9, "", "allow"), (10, "http://bad.net/p/?utm_source=a&b=2", "block"), (11, "http://www.bad.net/p?b=2#z", "block"),
    (12, "http://bad.net/q", "allow"), (13, "http://example.org", "allow"), (10, "http://bad.net/p/?utm_source=a&b=2", "block"),
    (14, "http://bad.net\n/x", "allow"),
]


def table(spark):
    return spark.createDataFrame([u[:2] for u in URLS], "page_id bigint, url string").selectExpr("*", "'mine' as rule", "1 as host")


def listed(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "u string").select(url_filter.canonical_url(F.col("u")))


def test_verdicts(spark):
    got = url_filter.judge(table(spark), listed(spark, ["https://bad.net/p?b=2"]), URL_RULES).collect()
    assert sorted((r.page_id, r.verdict) for r in got) == sorted((i, v) for i, _, v in URLS)
    rule = {r.page_id: r.rule for r in got}
    assert (rule[1], rule[2], rule[3], rule[5], rule[6], rule[10]) == ("example.org/es/", "example.org/en/1", "org/", "com/fr/", "org/", None)
    host = {r.page_id: (r.host, r.path) for r in got}
    assert host[1] == ("www.example.org", "/es/a") and host[7] == host[8] == ("", "") and host[13] == ("example.org", "")


def test_empty_list_and_table(spark):
    got = url_filter.judge(table(spark), listed(spark, []), URL_RULES).collect()
    assert {r.verdict for r in got if r.rule is None} == {"allow"} and len(got) == len(URLS)
    assert url_filter.judge(table(spark).limit(0), listed(spark, ["http://a.b/c"]), URL_RULES).count() == 0


def test_an_overfull_filter_still_judges_exactly(spark):
    bad = [f"http://h{i}.net/p{i}" for i in range(300)]
    urls = spark.createDataFrame([(i, u) for i, u in enumerate(bad + [u + "x" for u in bad])], "page_id bigint, url string")
    got = url_filter.judge(urls, listed(spark, bad), (), max_blocks=1).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(300))


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("k"))
    size = bloom.blocks_for(20_000)
    filter_ = bloom.build(keys, "k", size)
    assert bloom.test(keys, filter_, "hit", "k", size).filter("not hit").count() == 0
    others = spark.range(1_000_000, 1_100_000).select(F.xxhash64("id").alias("k"))
    assert bloom.test(others, filter_, "hit", "k", size).filter("hit").count() < 300
