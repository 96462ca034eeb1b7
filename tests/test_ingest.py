"""Sources, crawl and streaming."""

import pytest
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.plans.queries import QUERIES
from loomdex.operators import crawl, index as ix, ingest
from loomdex.session import fresh_dir
from loomdex.sources import readers, uploads
from loomdex.sources.store import read_segments
from loomdex.streaming import ingest as streaming


def page(body, title="T"):
    return f"<html><head><title>{title}</title></head><body><p>{body}</p></body></html>"


def make_pages(spark):
    long = "слово " * 30
    rows = [
        (1, "http://a.org/1", page(long)), (2, "http://a.org/2?action=edit", page(long)), (3, "http://a.org/3", page("short")),
        (4, "http://a.org/4", page("From Wikipedia, x\n" + long)), (5, "http://b.org/5", page(long)),
    ]
    return spark.createDataFrame(rows, readers.PAGE_SCHEMA)


def test_page_filter_chain(spark):
    known = spark.createDataFrame([("http://b.org/5",)], "doc_key string")
    docs = {r.url: r for r in ingest.documents_of(make_pages(spark), known).collect()}
    assert set(docs) == {"http://a.org/1", "http://a.org/4"}
    assert docs["http://a.org/1"].file_type == "web" and docs["http://a.org/1"].title == "T"
    assert len(docs["http://a.org/1"].content_hash) == 32


def test_crawl_respects_depth_safety_and_cycles(spark):
    def links(*targets):
        return "".join(f'<a href="{t}">x</a>' for t in targets)

    rows = [
        (1, "http://a.org/1", links("/2", "/pic.jpg", "http://evil.org/")), (2, "http://a.org/2", links("/1", "/3?action=edit")),
        (3, "http://a.org/3?action=edit", links("/4")), (4, "http://a.org/4", links("/5")), (5, "http://a.org/5", ""),
    ]
    pages = spark.createDataFrame(rows, readers.PAGE_SCHEMA)
    ips = spark.createDataFrame([("a.org", "8.8.8.8"), ("evil.org", "8.8.4.4"), ("evil.org", "10.0.0.1")], "host string, ip string")
    seeds = spark.createDataFrame([("http://a.org/1",)], "url string")
    anyone = F.expr("cast(array() as array<string>)")
    got = {r.url: r.depth for r in crawl.crawl(seeds, pages, ips, anyone, 4).visited.collect()}
    # The service page is followed although it is never indexed.
    assert got == {"http://a.org/1": 1, "http://a.org/2": 2, "http://a.org/3?action=edit": 3, "http://a.org/4": 4}


def test_crawl_reaches_addresses_without_a_page(spark):
    html = '<a href="/gone">x</a><a href="/pic.jpg">x</a><a href="http://evil.org/">x</a>'
    pages = spark.createDataFrame([(1, "http://a.org/1", html)], readers.PAGE_SCHEMA)
    ips = spark.createDataFrame([("a.org", "8.8.8.8"), ("evil.org", "10.0.0.1")], "host string, ip string")
    seeds = spark.createDataFrame([("http://a.org/1",), ("http://a.org/nowhere",)], "url string")
    done = crawl.crawl(seeds, pages, ips, F.expr("cast(array() as array<string>)"), 3)
    assert {r.url: r.depth for r in done.reached.collect()} == {"http://a.org/1": 1, "http://a.org/nowhere": 1, "http://a.org/gone": 2}
    assert [r.url for r in done.visited.collect()] == ["http://a.org/1"]


LONG = "<p>" + "some words of text " * 20 + "</p>"


def site(spark, links):
    """Pages http://a.org/<name> with their links; those whose name ends in - hold too little text to be kept."""
    def source(name, targets):
        return ("" if name.endswith("-") else LONG) + "".join(f'<a href="{t}">x</a>' for t in targets)

    return spark.createDataFrame([(i, f"http://a.org/{n}", source(n, t)) for i, (n, t) in enumerate(links.items())], readers.PAGE_SCHEMA)


def run_crawl(spark, links, seeds, **more):
    ips = spark.createDataFrame(
        [("a.org", "8.8.8.8"), ("b.org", "8.8.8.8"), ("evil.org", "8.8.4.4"), ("evil.org", "10.0.0.1"), ("lan.org", "10.0.0.1")], "host string, ip string"
    )
    listed = spark.createDataFrame([(s,) for s in seeds], "url string")
    more = {"allowed": F.expr("cast(array() as array<string>)"), "max_depth": 4} | more
    done = crawl.crawl(listed, site(spark, links), ips, **more)
    visited = {r.url.rsplit("/", 1)[1]: r.depth for r in done.visited.collect()}
    return visited, sorted(r.url.rsplit("/", 1)[1] for r in done.documents.collect())


def reference_crawl(links, seeds, cap, max_depth):
    """One page after another, the way a crawler does it."""
    visited, kept, level = {}, [], sorted(seeds)
    for depth in range(1, max_depth + 1):
        following = set()
        for name in level:
            if len(kept) >= cap:
                return visited, sorted(kept)
            visited[name] = depth
            if not name.endswith("-"):
                kept.append(name)
            if len(kept) < cap:
                following |= set(links[name])
        level = sorted(n for n in following if n in links and n not in visited)
    return visited, sorted(kept)


def test_cap_counts_kept_pages_only(spark):
    links = {"a-": ["b", "c-"], "b": ["d", "e"], "c-": ["f", "g"], "d": ["h"], "e": [], "f": ["a-"], "g": [], "h": [], "i": []}
    for cap in (0, 1, 3, 4, 100):
        assert run_crawl(spark, links, ["http://a.org/a-"], max_pages=cap) == reference_crawl(links, ["a-"], cap, 4), cap


def test_seeds_are_checked_and_absent_pages_are_not_returned(spark):
    links = {"p1": ["gone", "p2"], "p2": [], "p3": []}
    seeds = [" http://a.org/p1#x ", "http://localhost/p3", "http://lan.org/p3", "http://a.org/missing", "ftp://a.org/p3", "", None]
    assert run_crawl(spark, links, seeds)[0] == {"p1": 1, "p2": 2}
    assert run_crawl(spark, links, seeds, allowed=F.array(F.lit("b.org"))) == ({}, [])
    assert run_crawl(spark, links, []) == ({}, [])


def test_known_pages_are_followed_and_not_kept(spark):
    known = spark.createDataFrame([("http://a.org/p1",), ("http://a.org/p9",), ("http://a.org/p1",)], "doc_key string")
    assert run_crawl(spark, {"p1": ["p2"], "p2": []}, ["http://a.org/p1"], known=known) == ({"p1": 1, "p2": 2}, ["p2"])


def test_sitemaps_enter_at_the_first_level(spark):
    def urls_of(*targets):
        return "<urlset>" + "".join(f"<url><loc>{t}</loc></url>" for t in targets) + "</urlset>"

    def index_of(*targets):
        return "<sitemapindex>" + "".join(f"<sitemap><loc>{t}</loc></sitemap>" for t in targets) + "</sitemapindex>"

    sitemaps = spark.createDataFrame([
        ("http://a.org/sitemap.xml", index_of("http://a.org/one.xml", "http://a.org/sitemap.xml", "http://lan.org/two.xml", "http://a.org/none.xml")),
        ("http://a.org/one.xml", urls_of("http://a.org/p2", "http://a.org/p3#x", " http://a.org/p5", "http://a.org/p4.jpg", "http://lan.org/p5", "http://b.org/p6")),
        ("http://lan.org/two.xml", urls_of("http://a.org/p7")), ("http://b.org/sitemap.xml", urls_of("http://a.org/p8")),
    ], "url string, xml string")
    links = {f"p{i}": [] for i in range(1, 9)} | {"p1": ["p2"], "p2": ["p8"], "p4.jpg": []}
    assert run_crawl(spark, links, ["http://a.org/p1"], sitemaps=sitemaps)[0] == {"p1": 1, "p2": 1, "p3": 1, "p8": 2}
    assert run_crawl(spark, links, [], sitemaps=sitemaps)[0] == {}


def test_many_dropped_elements_in_linear_time(spark):
    from loomdex.functions import html

    parts = [f"<p>w{i}</p><nav>x</nav>" for i in range(4000)]
    df = spark.createDataFrame([("".join(parts),)], "h string").select(html.drop_elements(F.col("h")).alias("h"))
    assert df.first().h == "".join(f"<p>w{i}</p>" for i in range(4000))


def test_uploads_from_files(spark, tmp_path):
    (tmp_path / "Page.html").write_bytes(page("<b>текст</b> " + "word " * 30).encode())
    (tmp_path / "scan.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "fake.pdf").write_bytes(b"MZ")
    (tmp_path / "empty.html").write_bytes(b"")
    (tmp_path / "a.TXT").write_bytes(b"x")
    files = readers.read_files(spark, str(tmp_path))
    errors = {r.path.rsplit("/", 1)[1]: r.error for r in uploads.validate(files).collect()}
    assert errors == {
        "Page.html": "", "scan.pdf": "", "fake.pdf": "invalid PDF file", "a.TXT": "unsupported file type",
    }
    empty = spark.createDataFrame([("/in/empty.html", 0, bytearray())], "path string, length bigint, content binary")
    assert uploads.validate(empty).first().error == "invalid file size"
    text = files.filter("path like '%scan.pdf'").select("path", F.lit(" a \n b ").alias("text"))
    docs = {r.title: r for r in uploads.to_documents(files, text).collect()}
    assert docs["scan"].content == "a b" and docs["scan"].file_type == "pdf"
    assert docs["Page"].content.startswith("текст word") and docs["Page"].doc_key.startswith("doc_")
    assert {r.content for r in uploads.to_documents(files).collect()} >= {vocab.PDF_ERROR_TEXT}


def test_pdf_signature_leads_the_content(spark):
    """Bytes that start with %PDF- can start with no other type's signature, so the prefix decides the sniffed type."""
    contents = {
        b"%PDF-1.4 x": "", b"%PDF-": "", b"%PDF-<html><body><p>": "", b"%PDF-\x00\xff\xd8\xff": "",
        b"\xef\xbb\xbf%PDF-1.4": "invalid PDF file", b" %PDF-1.4": "invalid PDF file", b"<html>%PDF-1.4": "invalid PDF file",
        b"<?xml %PDF-1.4": "invalid PDF file", b"%!PS-Adobe-%PDF-1.4": "invalid PDF file", b"PK\x03\x04%PDF-": "invalid PDF file",
        b"%PDF": "invalid PDF file", b"%pdf-1.4": "invalid PDF file",
    }
    rows = [(f"/in/{n}.pdf", len(c), bytearray(c)) for n, c in enumerate(contents)]
    files = spark.createDataFrame(rows, "path string, length bigint, content binary")
    got = {int(r.title): r.error for r in uploads.validate(files).collect()}
    assert [got[n] for n in range(len(rows))] == list(contents.values())


def test_files_of_a_stream_are_looked_up_in_few_tasks(spark):
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    with pytest.raises(ValueError):
        with uploads.few_lookups(spark):
            assert int(spark.conf.get(setting)) == uploads.LOOKUP_WAVES * spark.sparkContext.defaultParallelism < int(before)
            raise ValueError
    assert spark.conf.get(setting) == before


def test_upload_stream_keeps_copies_and_names_empty_files(spark, tmp_path):
    folder, target, kept, checkpoint = (str(tmp_path / n) for n in ("in", "out", "kept", "checkpoint"))
    body = page("word " * 30).encode()
    rows = [("/1/A.html", body), ("/2/b c.html", body), ("/3/x.pdf", b"MZ"), ("/4/e.html", b""), ("/5/n.txt", b""), (None, b"x"), ("/6/n.pdf", None), ("/8/_d.html", body)]
    files = spark.createDataFrame([(p, bytearray(c) if c is not None else None) for p, c in rows], "path string, content binary")
    assert uploads.write_files(files, folder).count() == 6
    (tmp_path / "in" / "1" / ("." + "0a" * 16)).write_bytes(b"half")

    def run():
        uploads.start_uploads(uploads.upload_stream(spark, folder, 1), target, kept, checkpoint).awaitTermination()
        listed = uploads.listing(spark.createDataFrame([(folder,), (folder + "-none",), (None,)], "folder string"))
        return {r.path.rsplit("/", 1)[1]: r.error for r in uploads.verdicts(spark, target, listed).collect()}

    expected = {"A.html": "", "b c.html": "", "x.pdf": "invalid PDF file", "e.html": "invalid file size", "n.txt": "unsupported file type", "_d.html": uploads.HIDDEN_NAME}
    assert run() == expected
    copies = list((tmp_path / "kept").rglob("*.html"))
    assert len(copies) == 1 and copies[0].read_bytes() == body and not list((tmp_path / "kept").rglob(".[0-9a-f]*[0-9a-f]"))
    assert {r.title for r in read_segments(spark, f"{target}/segments").collect()} == {"A", "b c"}
    more = spark.createDataFrame([("/7/late.htm", bytearray(b"<p>" + body))], "path string, content binary")
    assert uploads.write_files(more, folder).count() == 1
    assert run() == expected | {"late.htm": ""}


def test_config_file(spark, tmp_path):
    missing = readers.read_config(spark, str(tmp_path / "none.json")).first()
    assert (missing.max_pages, missing.max_depth, missing.delay_ms, missing.parallelism) == (100, 4, 500, 5)
    (tmp_path / "c.json").write_text('{\n "seed_urls": ["http://a"], "max_pages": 7,\n "auto_start": true}')
    some = readers.read_config(spark, str(tmp_path / "c.json")).first()
    assert some.seed_urls == ["http://a"] and some.max_pages == 7 and some.max_depth == 4 and some.auto_start
    (tmp_path / "b.json").write_text('{"max_pages": 7,')
    broken = readers.read_config(spark, str(tmp_path / "b.json")).first()
    assert broken.max_pages == 0 and broken.user_agent == "" and not broken.auto_start


def test_stopword_files(spark, tmp_path):
    (tmp_path / "ru.json").write_text('["И", "не"]')
    (tmp_path / "en.json").write_text('["The",\n "c"]')
    (tmp_path / "bad.json").write_text('["x"')
    assert readers.load_stopwords(spark, str(tmp_path)) == ["c", "the", "и", "не"]


def test_sitemaps(spark):
    xml = (
        '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>http://a/1?x=1&amp;y=2</loc>'
        "<image:loc>http://a/i</image:loc></url><!--<url><loc>http://a/no</loc></url>--><url><loc>http://a/p.pdf</loc></url>"
        "<url><loc>ftp://a/2</loc></url></urlset>"
    )
    index = "<sitemapindex><sitemap><loc>https://a/s1.xml</loc></sitemap></sitemapindex>"
    rows = spark.createDataFrame([(xml,), (index,), ("<broken",)], "x string")
    got = [r.r for r in rows.select(readers.sitemap_locations(F.col("x")).alias("r")).collect()]
    assert sorted(got) == sorted([["http://a/1?x=1&y=2"], ["https://a/s1.xml"], []])


def test_stream_equals_batch(spark):
    pages = make_pages(spark)
    source, target, state = (fresh_dir(spark, n) for n in ("pages", "segments", "checkpoint"))
    pages.filter("page_id <= 3").write.parquet(source)
    for _ in range(2):  # the second start finds nothing new
        streaming.start_ingest(streaming.page_stream(spark, source, 1), target, state).awaitTermination()
    pages.filter("page_id > 3").write.mode("append").parquet(source)
    streaming.start_ingest(streaming.page_stream(spark, source, 1), target, state).awaitTermination()
    columns = ["doc_key", "title", "content", "content_hash"]
    got = ix.latest(read_segments(spark, target)).select(columns)
    batch = ingest.documents_of(pages).select(columns)
    assert sorted(got.collect()) == sorted(batch.collect())

    counts = fresh_dir(spark, "progress")
    streaming.start_progress(streaming.page_stream(spark, source, 1), counts, fresh_dir(spark, "checkpoint")).awaitTermination()
    assert {r.host: r.pages_found for r in streaming.current_progress(spark, counts).collect()} == {"a.org": 4, "b.org": 1}


def test_crawl_status_starts_again_with_a_new_crawl(spark, tmp_path):
    source, target, checkpoint = str(tmp_path / "events"), fresh_dir(spark, "status"), fresh_dir(spark, "checkpoint")

    def send(*events):
        spark.createDataFrame(events, streaming.EVENT_SCHEMA).write.mode("append").parquet(source)
        streaming.start_crawl_status(streaming.event_stream(spark, source, 1), target, checkpoint).awaitTermination()
        rows = streaming.current_crawl_status(spark, target).collect()
        return {r.host: (r.crawl, r.running, r.pages_found, r.message) for r in rows}

    started, finished = vocab.CRAWL_STARTED, vocab.CRAWL_FINISHED
    got = send(("a", 1, "start"), ("a", 1, "page"), ("b", 7, "page"), ("a", 1, "page"), (None, 1, "start"), ("c", None, "page"))
    assert got == {"a": (1, True, 2, started), "b": (7, True, 1, started), None: (1, True, 0, started)}
    assert send(("a", 1, "page"), ("a", 1, "finish"))["a"] == (1, False, 3, finished % 3)
    assert send(("a", 2, "start"))["a"] == (2, True, 0, started)
    assert send(("a", 1, "page"), ("a", 2, "page"), ("a", 3, None))["a"] == (3, True, 0, started)
    batch = streaming.newest_crawls(streaming.crawl_states(spark.read.schema(streaming.EVENT_SCHEMA).parquet(source)))
    assert sorted(map(str, batch.collect())) == sorted(map(str, streaming.current_crawl_status(spark, target).collect()))
    nothing = spark.createDataFrame([], streaming.EVENT_SCHEMA)
    assert streaming.newest_crawls(streaming.crawl_states(nothing)).count() == 0


def test_boilerplate_costs_its_own_line_only(spark):
    page = "<body><p>Jump to navigation</p><p>FIRST paragraph. It has two sentences.</p><p>Second para\n ends. " + "Third one. " * 30 + "</p></body>"
    short = "<body><div>From Wikipedia, x.</div><div>One <b>two</b></div>three<ul><li>four</ul></body>"
    pages = spark.createDataFrame([("http://a/1", page), ("http://a/2", short * 1)], "url string, html string")
    got = ingest.documents_of(pages).collect()
    assert [r.content for r in got] == ["FIRST paragraph. It has two sentences.\nSecond para ends. " + ("Third one. " * 30).strip()]
    lines = pages.filter("url = 'http://a/2'").select(ingest.page_content(F.col("html")).alias("c")).first().c
    assert lines == "One two\nthree\nfour"


def test_pages_are_cleaned_once_and_after_the_known_ones_are_gone(spark):
    pages = spark.createDataFrame([("http://a/1", "<p>x</p>")], "url string, html string")
    known = spark.createDataFrame([("http://a/2",)], "doc_key string")
    plan = ingest.documents_of(pages, known)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftAnti")
    assert "<script" in above and "Generate explode" in above
    assert "<script" not in below


def test_addresses_are_parsed_on_every_core(spark, tmp_path):
    spark.range(50).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    rows = QUERIES["ip_public"](spark, str(tmp_path))
    assert rows.select(F.spark_partition_id()).distinct().count() > 1 and rows.count() == 50 * 23
