"""Registered queries: one per operator, each (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomdex.functions import analysis, html, kwic, snippet as snip, text, urls
from loomdex.functions.arrays import let
from loomdex.functions.stemmer import stem_ru
from loomdex.operators import crawl, index as ix, ingest, response, search, suggest, vectors
from loomdex.plans import inputs
from loomdex.session import fresh_dir, spread
from loomdex.sources import readers, uploads
from loomdex.sources.readers import read_table
from loomdex.sources.store import Index, open_index, read_segments
from loomdex.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CRAWL_DEPTH = 4
PAGE_CAP = 100
SEEDS = ("p0", "p1")
SEEDED_HOSTS = ["s0.example.org", " S1.example.org", "s2.example.org", "s4.example.org", "localhost", ""]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def big(c: str):
    return F.col(c).cast("bigint").alias(c)


# --- sources and sinks ---------------------------------------------------------------------


@query
def ingest_pages(spark, sf):
    docs = ingest.documents_of(inputs.site_pages(spark, sf), inputs.known_pages(spark, sf))
    return docs.select("url", "title", "content", "file_type", "content_hash")


@query
def upload_validate(spark, sf):
    return uploads.validate(inputs.uploads(spark, sf))


@query
def upload_files(spark, sf):
    """Files from a folder through the stream: verdicts, hashes of the stored copies read back, documents."""
    folder, target, kept = inputs.upload_folder(spark, sf), fresh_dir(spark, "uploads"), fresh_dir(spark, "stored")
    with uploads.few_lookups(spark):
        uploads.start_uploads(uploads.upload_stream(spark, folder), target, kept, fresh_dir(spark, "checkpoint")).awaitTermination()

    def below(home: str, path: str):
        return F.substring(uploads.file_key(F.col(path)), len(re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:/*(?=/)", "", home)) + 1, 1 << 20)

    folders = spark.createDataFrame([(folder,)], "folder string")
    verdicts = uploads.verdicts(spark, target, uploads.listing(folders))
    copies = readers.read_files(spark, kept).select(below(kept, "path").alias("file_path"), F.sha2("content", 256).alias("copy_sha256"))
    docs = read_segments(spark, f"{target}/segments").groupBy("file_path").agg(F.count("*").alias("documents"))
    return verdicts.join(copies, "file_path", "left").join(docs, "file_path", "left").select(
        below(folder, "path").alias("path"), "error", "title", "file_type", "file_path", "copy_sha256", "documents"
    )


@query
def sitemap_locs(spark, sf):
    entry = "'<url><loc>' || {0} || '</loc><lastmod>2020</lastmod></url>'"
    xml = "'<urlset xmlns=\"http://www.sitemaps.org/schemas/sitemap/0.9\">' || " + " || ".join(
        entry.format(v) for v in inputs.URL_VARIANTS
    ) + " || '<!-- ' || url || ' --></urlset>'"
    files = read_table(spark, sf, "pages").selectExpr("page_id", f"{xml} as xml")
    return files.select("page_id", F.explode(readers.sitemap_locations(F.col("xml"))).alias("loc"))


@query
def sitemap_seed(spark, sf):
    seeds = inputs.url_variants(spark, sf).filter(urls.is_valid(F.col("url")) & (urls.host(F.col("url")) != ""))
    return seeds.select("page_id", "variant", urls.sitemap_of(F.col("url")).alias("sitemap"))


@query
def crawl_config(spark, sf):
    parsed = inputs.configs(spark, sf).select("page_id", readers.parse_config(F.col("config")).alias("c"))
    return parsed.select(
        "page_id", F.array_join("c.seed_urls", ",").alias("seed_urls"), "c.max_pages", "c.max_depth",
        "c.delay_ms", "c.parallelism", F.array_join("c.allowed_hosts", ",").alias("allowed_hosts"),
        "c.user_agent", "c.auto_start",
    )


@query
def stopwords(spark, sf):
    return readers.stopword_rows(inputs.stopword_files(spark, sf), "words")


@query
def upsert_last_wins(spark, sf):
    writes = inputs.documents(spark, sf).select(
        F.col("source").alias("doc_key"), F.col("doc_id").alias("seq"), "text"
    )
    return ix.latest(writes).select("doc_key", "seq", text.content_hash(F.col("text")).alias("content_hash"))


@query
def stream_ingest(spark, sf):
    target = fresh_dir(spark, "segments")
    stream = streaming.page_stream(spark, f"{sf}/pages.parque[t]")
    streaming.start_ingest(stream, target, fresh_dir(spark, "checkpoint")).awaitTermination()
    return ix.latest(read_segments(spark, target)).select("url", "title", "content", "content_hash")


@query
def crawl_progress(spark, sf):
    target = fresh_dir(spark, "progress")
    stream = streaming.page_stream(spark, f"{sf}/pages.parque[t]")
    streaming.start_progress(stream, target, fresh_dir(spark, "checkpoint")).awaitTermination()
    return streaming.current_progress(spark, target)


@query
def crawl_status(spark, sf):
    source, target = fresh_dir(spark, "events"), fresh_dir(spark, "status")
    inputs.crawl_events(spark, sf).write.parquet(source)
    events = streaming.event_stream(spark, source)
    streaming.start_crawl_status(events, target, fresh_dir(spark, "checkpoint")).awaitTermination()
    return streaming.current_crawl_status(spark, target)


# --- URL predicates ------------------------------------------------------------------------


@query
def url_valid(spark, sf):
    return inputs.url_variants(spark, sf).select("page_id", "variant", urls.is_valid(F.col("url")).alias("valid"))


@query
def url_media(spark, sf):
    return inputs.url_variants(spark, sf).select("page_id", "variant", urls.is_media(F.col("url")).alias("media"))


@query
def url_service(spark, sf):
    return inputs.url_variants(spark, sf).select("page_id", "variant", urls.is_service(F.col("url")).alias("service"))


def _allowed():
    """Every other page restricts hosts."""
    return F.expr("case when page_id % 2 = 0 then array('') else array('example.net', ' Localhost ', '') end")


def _allowed_or_all():
    return F.expr("case when page_id % 2 = 0 then cast(array() as array<string>) else array('example.net', ' ') end")


@query
def url_safe(spark, sf):
    targets = inputs.url_variants(spark, sf)
    reasons = crawl.with_reason(targets, inputs.host_ips(spark, sf), _allowed_or_all())
    return reasons.select("page_id", "variant", "reason")


@query
def url_allowed_host(spark, sf):
    return inputs.url_variants(spark, sf).select(
        "page_id", "variant", urls.host(F.col("url")).alias("host"),
        urls.host_allowed(urls.host(F.col("url")), _allowed()).alias("restricted"),
        urls.host_allowed(urls.host(F.col("url")), _allowed_or_all()).alias("allowed"),
    )


@query
def ip_public(spark, sf):
    # A row becomes 23 addresses; the table itself is so small that it is read in one split or two.
    customers = spread(read_table(spark, sf, "customer").select("c_custkey"))
    ips = customers.selectExpr("c_custkey", "c_custkey as k").selectExpr("c_custkey", f"explode({inputs.sql_array(inputs.IP_VARIANTS)}) as ip")
    return ips.select("c_custkey", "ip", urls.is_public_ip(F.col("ip")).alias("is_public"))


@query
def url_normalize(spark, sf):
    return inputs.url_variants(spark, sf).select("page_id", "variant", urls.normalize(F.col("url")).alias("url"))


@query
def skip_indexed(spark, sf):
    return ix.unknown_urls(read_table(spark, sf, "pages").select("page_id", "url"), inputs.known_pages(spark, sf))


@query
def is_url_indexed(spark, sf):
    return ix.known_urls(read_table(spark, sf, "pages").select("page_id", "url"), inputs.known_pages(spark, sf))


@query
def max_pages(spark, sf):
    found = read_table(spark, sf, "pages").selectExpr("url", "1 + page_id % 4 as depth")
    return ingest.capped(found, PAGE_CAP)


# --- links and crawl -----------------------------------------------------------------------


@query
def link_extract(spark, sf):
    rows = crawl.page_links(inputs.linked_pages(spark, sf))
    return rows.select("url", F.posexplode("links").alias("ordinal", "link")).select("url", big("ordinal"), "link")


@query
def link_filter(spark, sf):
    links = crawl.link_rows(inputs.linked_pages(spark, sf)).distinct()
    return crawl.safe_links(links, inputs.host_ips(spark, sf), F.expr("array('example.net', 'example.com')"))


@query
def crawl_frontier(spark, sf):
    visited = read_table(spark, sf, "pages").select("url")
    return crawl.frontier(crawl.link_rows(inputs.pages(spark, sf)), visited)


@query
def crawl_bfs(spark, sf):
    graph = inputs.page_graph(spark, sf)
    seeds = graph.filter(F.col("url").isin(*SEEDS)).select("url")
    return crawl.reach(seeds, graph, CRAWL_DEPTH).select("url", big("depth"))


def _crawled(spark, sf, max_pages=None):
    seeds = inputs.site(spark, sf).filter(F.col("page_id").isin(1, 2, 3)).select("url")
    anyone = F.expr("cast(array() as array<string>)")
    return crawl.crawl(seeds, inputs.site(spark, sf), inputs.site_ips(spark, sf), anyone, CRAWL_DEPTH, max_pages)


@query
def crawl_pages(spark, sf):
    """Every address that a crawl comes to, whether the page table holds it or not; one row for each row of that table."""
    done = _crawled(spark, sf)
    missing = done.reached.join(done.visited.select("url"), "url", "left_anti")
    return done.visited.unionByName(missing).select("url", big("depth"))


@query
def crawl_ingest(spark, sf):
    """The whole chain: follow links, clean and filter the pages, stop at the cap on kept ones."""
    return _crawled(spark, sf, PAGE_CAP).documents.select("url", "title", "content", "content_hash", big("depth"))


@query
def crawl_seeded(spark, sf):
    """A crawl from a request, a configuration and the sitemaps of their hosts, on four allowed hosts, one of them private."""
    config = F.lit(json.dumps({"seed_urls": inputs.ASKED_SEEDS[1:], "allowed_hosts": SEEDED_HOSTS, "max_depth": 2}))
    request = F.lit(inputs.ASKED_SEEDS[0])
    listed = spark.range(1).select(F.explode(crawl.seed_list(request, readers.parse_config(config)["seed_urls"])).alias("url"))
    done = crawl.crawl(
        listed, inputs.site(spark, sf), inputs.site_ips(spark, sf), F.array(*map(F.lit, SEEDED_HOSTS)), 2,
        sitemaps=inputs.sitemaps(spark, sf), known=inputs.known_site_pages(spark, sf),
    )
    kept = done.documents.select("url", F.lit(True).alias("kept"))
    return done.visited.join(kept, "url", "left").select("url", big("depth"), F.coalesce("kept", F.lit(False)).alias("kept"))


@query
def seed_list(spark, sf):
    configured = inputs.configs(spark, sf).select("page_id", "url", readers.parse_config(F.col("config")).alias("c"))
    request = F.expr("case when page_id % 3 = 0 then '' else ' ' || url || '#top ' end")
    seeds = configured.select("page_id", F.posexplode(crawl.seed_list(request, F.col("c.seed_urls"))).alias("ordinal", "seed"))
    return seeds.select("page_id", big("ordinal"), "seed")


# --- text cleaning -------------------------------------------------------------------------


@query
def html_strip(spark, sf):
    return inputs.classed_pages(spark, sf).select("page_id", html.strip_unwanted(F.col("html")).alias("html"))


@query
def html_paragraphs(spark, sf):
    return inputs.classed_pages(spark, sf).select(
        "page_id", let(html.strip_unwanted(F.col("html")), html.paragraph_text).alias("content")
    )


@query
def html_to_text(spark, sf):
    return inputs.classed_pages(spark, sf).select("page_id", html.html_to_text(F.col("html")).alias("content"))


@query
def html_title(spark, sf):
    return inputs.pages(spark, sf).select("page_id", html.title(F.col("html")).alias("title"))


@query
def wiki_scrub(spark, sf):
    dirty = inputs.documents(spark, sf).selectExpr(
        "doc_id", f"replace(text, '\\n', {inputs.pick(inputs.REMNANTS, 'doc_id')}) as text"
    )
    return dirty.select("doc_id", text.wiki_scrub(F.col("text")).alias("content"))


@query
def normalize_ws(spark, sf):
    loose = inputs.documents(spark, sf).select("doc_id", F.replace("text", F.lit(". "), F.lit(".\t\u2003 ")).alias("text"))
    return loose.select(
        "doc_id", text.normalize_ws(F.col("text")).alias("content"), text.token_join(F.col("text")).alias("joined")
    )


@query
def strip_boilerplate(spark, sf):
    return inputs.boilerplate_texts(spark, sf).select("doc_id", text.strip_boilerplate(F.col("text")).alias("content"))


@query
def strip_combining(spark, sf):
    marked = inputs.documents(spark, sf).select("doc_id", F.replace("text", F.lit("e"), F.lit("e\u0301")).alias("text"))
    return marked.select("doc_id", text.strip_combining(F.col("text")).alias("content"))


@query
def content_hash(spark, sf):
    return inputs.documents(spark, sf).select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


@query
def safe_string(spark, sf):
    return inputs.configs(spark, sf).select("page_id", text.safe_string(F.col("config")).alias("config"))


@query
def min_bytes(spark, sf):
    docs = inputs.documents(spark, sf).filter(text.long_enough(F.col("text")))
    return docs.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"))


@query
def boilerplate_line(spark, sf):
    return inputs.lines(spark, sf).select("doc_id", "line_no", text.is_boilerplate_line(F.col("line")).alias("boilerplate"))


@query
def html_escape(spark, sf):
    return inputs.pages(spark, sf).select("page_id", text.html_escape(F.col("html")).alias("escaped"))


@query
def snippet_truncate(spark, sf):
    return inputs.pages(spark, sf).select("page_id", text.truncate(F.col("html")).alias("snippet"))


# --- analysis and index --------------------------------------------------------------------


@query
def tokenize(spark, sf):
    return vectors.token_rows(inputs.documents(spark, sf), F.col("text"), "doc_id")


@query
def word_rules(spark, sf):
    return vectors.token_rows(inputs.mixed_scripts(spark, sf), F.col("text"), "doc_id")


@query
def stop_filter(spark, sf):
    words = F.filter(text.words(inputs.to_cyrillic("text")), lambda w: ~analysis.is_query_stop(w))
    latin = F.filter(text.words(F.col("text")), lambda w: ~analysis.is_query_stop(w))
    return inputs.documents(spark, sf).select(
        "doc_id", F.array_join(words, " ").alias("cyrillic"), F.array_join(latin, " ").alias("latin")
    )


def _cyrillic_tokens(spark, sf):
    return inputs.documents(spark, sf).select(
        F.explode(analysis.tokens(inputs.to_cyrillic("text"))).alias("token")
    )


@query
def stem(spark, sf):
    vocabulary = _cyrillic_tokens(spark, sf).distinct()
    return vocabulary.select("token", stem_ru(F.col("token")).alias("stem"))


QUERIES["stem_ru"] = QUERIES.pop("stem")


@query
def analyze(spark, sf):
    return vectors.index_terms(inputs.documents(spark, sf), inputs.to_cyrillic("text"), "doc_id")


@query
def postings(spark, sf):
    rows = ix.located_postings(inputs.corpus(spark, sf))
    return rows.select(
        "doc_key", "field", "term", "tf",
        F.array_join(F.transform("locs", lambda x: F.concat_ws(":", x["pos"], x["start"], x["end"])), ",").alias("locs"),
    )


@query
def doc_freq(spark, sf):
    return ix.document_frequencies(ix.postings(inputs.corpus(spark, sf, cyrillic=True)))


@query
def field_len(spark, sf):
    return ix.field_lengths(inputs.corpus(spark, sf))


@query
def doc_count(spark, sf):
    return ix.document_count(read_table(spark, sf, "documents").select(F.col("source").alias("doc_key")))


@query
def stats(spark, sf):
    return inputs.corpus(spark, sf).agg(F.count("*").alias("indexedPages"))


# --- search --------------------------------------------------------------------------------


@query
def query_clean(spark, sf):
    return inputs.queries(spark, sf).select("query_id", analysis.clean_query(F.col("q")).alias("cleaned"))


@query
def page_params(spark, sf):
    return inputs.raw_requests(spark, sf).select(
        "query_id", search.page_number(F.col("page_text")).alias("page"), search.page_size(F.col("size_text")).alias("size")
    )


def _field_matches(spark, sf, *fields):
    return search.scores_by_field(inputs.index(spark, sf), inputs.queries(spark, sf), fields=fields)


@query
def match_content(spark, sf):
    rows = _field_matches(spark, sf, "content")
    return rows.select("query_id", "doc_key", "matched")


@query
def match_title(spark, sf):
    rows = _field_matches(spark, sf, "title")
    return rows.select("query_id", "doc_key", "matched")


@query
def tfidf_score(spark, sf):
    rows = _field_matches(spark, sf, "title", "content")
    return rows.select("query_id", "doc_key", "field", F.round("score", 6).alias("score"))


def _scored(spark, sf, cyrillic=False):
    return search.scores(inputs.index(spark, sf, cyrillic), inputs.queries(spark, sf, cyrillic))


@query
def should_combine(spark, sf):
    return _scored(spark, sf, cyrillic=True).select("query_id", "doc_key", F.round("score", 6).alias("score"))


@query
def relevance_tier(spark, sf):
    asked = inputs.queries(spark, sf)
    tiers = search.with_totals(search.scores(inputs.index(spark, sf), asked), asked)
    return tiers.select("query_id", "doc_key", search.relevance(F.col("score"), F.col("max_score")).alias("relevance"))


@query
def hit_total(spark, sf):
    counted = search.totals(_scored(spark, sf))
    return counted.select("query_id", "total", search.total_pages(F.col("total"), F.lit(10)).alias("total_pages"))


def _requests(spark, sf):
    return inputs.raw_requests(spark, sf).select(
        "query_id", "q", search.page_number(F.col("page_text")).alias("page"), search.page_size(F.col("size_text")).alias("size")
    )


@query
def search_page(spark, sf):
    index, asked = inputs.index(spark, sf), inputs.queries(spark, sf)
    found = search.with_documents(search.pages(search.scores(index, asked), asked), index, asked)
    return found.select("query_id", "rank", "url", "title", F.round("score", 6).alias("score"))


@query
def index_update(spark, sf):
    """Search an index of another state of the corpus after an update of one document in a hundred, changed, new and withdrawn."""
    home = inputs.updated_index(spark, sf)
    index, asked = open_index(spark, home), inputs.queries(spark, sf)
    found = search.with_documents(search.pages(search.scores(index, asked), asked), index, asked)
    return found.select("query_id", "rank", "url", "title", F.round("score", 6).alias("score"))


@query
def response_json(spark, sf):
    """Responses as they are sent: one JSON text for a query."""
    sent = response.to_json(response.respond(inputs.index(spark, sf), _requests(spark, sf)))
    said = F.from_json("response", "total bigint, page bigint, pageSize bigint, totalPages bigint, indexedPages bigint, suggestion string")
    listed = F.from_json("response", "results array<struct<id:bigint,url:string,title:string,filePath:string,fileType:string,relevance:string>>")
    rows = sent.select("query_id", said.alias("said"), listed["results"].alias("hits"), F.json_object_keys("response").alias("names"))
    return rows.select(
        "query_id", "said.total", "said.page", "said.pageSize", "said.totalPages", "said.indexedPages", "said.suggestion", F.size("hits").cast("bigint").alias("n_results"),
        F.array_join(F.array_sort("names"), ",").alias("names"),
        F.array_join(F.transform("hits", lambda r: F.concat_ws("|", r["id"], r["url"], r["relevance"], r["title"], r["filePath"])), "\n").alias("hits"),
    )


@query
def batch_search(spark, sf):
    hits = search.pages(_scored(spark, sf), _requests(spark, sf))
    return hits.select("query_id", "page", "size", "rank", "doc_key", F.round("score", 6).alias("score"))


@query
def title_dedupe(spark, sf):
    index, asked = inputs.index(spark, sf), _requests(spark, sf)
    found = search.with_documents(search.pages(search.scores(index, asked), asked), index, asked)
    return search.one_per_title(found).select("query_id", "rank", "title_key")


@query
def search_response(spark, sf):
    rows = response.respond(inputs.index(spark, sf), _requests(spark, sf))
    hits = F.transform("results", lambda r: F.concat_ws("|", r["url"], r["relevance"], r["title"]))
    return rows.select(
        "query_id", "total", "page", "pageSize", "totalPages", "indexedPages",
        F.size("results").cast("bigint").alias("n_results"), F.array_join(hits, "\n").alias("hits"),
        F.coalesce("suggestion", F.lit("")).alias("suggestion"),
    )


# --- snippets ------------------------------------------------------------------------------


def _page_hits(spark, sf, vectors=False):
    """Page hits of the Cyrillic corpus with content, cleaned query and index terms."""
    index, asked = inputs.index(spark, sf, cyrillic=True), inputs.queries(spark, sf, cyrillic=True)
    found = search.with_documents(search.pages(search.scores(index, asked), asked), index, asked, vectors)
    cleaned = asked.select("query_id", analysis.clean_query(F.col("q")).alias("cleaned"))
    cleaned = cleaned.withColumn("terms", analysis.analyze(F.col("cleaned")))
    kept = ["content_terms"] if vectors else []
    return found.join(cleaned, "query_id").select("query_id", "doc_key", "content", "cleaned", "terms", *kept)


def _with_best(spark, sf):
    """Page hits with a chosen occurrence; the generator keeps it from being computed twice."""
    best = snip.best_candidate(snip.candidates(F.col("content"), F.col("cleaned")))
    chosen = F.explode(F.filter(F.array(best), lambda b: b.isNotNull()))
    return _page_hits(spark, sf).select("query_id", "doc_key", "content", chosen.alias("best"))


@query
def snippet_candidates(spark, sf):
    rows = _page_hits(spark, sf).select(
        "query_id", "doc_key", F.explode(snip.candidates(F.col("content"), F.col("cleaned"))).alias("c")
    )
    return rows.select("query_id", "doc_key", *[
        F.col(f"c.{n}").cast("bigint").alias(n) for n in ("word_no", "occurrence", "start", "end", "score")
    ])


@query
def snippet_best(spark, sf):
    rows = _with_best(spark, sf)
    return rows.select("query_id", "doc_key", *[
        F.col(f"best.{n}").cast("bigint").alias(n) for n in ("score", "start", "end")
    ])


@query
def snippet_window(spark, sf):
    window = F.explode(F.array(snip.window(F.col("content"), F.col("best.start"))))
    rows = _with_best(spark, sf).select("query_id", "doc_key", window.alias("w"))
    return rows.select("query_id", "doc_key", *[F.col(f"w.{n}").cast("bigint").alias(n) for n in ("start", "end")])


@query
def highlight(spark, sf):
    hits = _page_hits(spark, sf, vectors=True)
    return search.with_snippets(hits, inputs.index(spark, sf, cyrillic=True)).select("query_id", "doc_key", "snippet")


# --- suggestions ---------------------------------------------------------------------------


@query
def suggest_words(spark, sf):
    words = F.array_join(suggest.meaningful_words(F.col("q")), " ")
    return inputs.misspelt_queries(spark, sf).select("query_id", words.alias("words"))


@query
def suggest_distance(spark, sf):
    """Distances of neighbouring words, 4 standing for anything above three edits."""
    pairs = inputs.documents(spark, sf).select("doc_id", text.words(F.col("text")).alias("w")).select(
        "doc_id", F.posexplode(F.arrays_zip(
            F.col("w").alias("a"), F.slice("w", F.lit(2), F.size("w")).alias("b")
        )).alias("pos", "p"),
    ).filter("p.b is not null")
    dist = F.levenshtein(F.col("p.a"), F.col("p.b"), 3)
    return pairs.select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), F.when(dist < 0, 4).otherwise(dist).cast("bigint").alias("dist")
    )


def _suggest_parts(spark, sf):
    index, asked = inputs.index(spark, sf), inputs.misspelt_queries(spark, sf)
    return index, asked, suggest.fuzzy_documents(index, asked)


@query
def suggest_fuzzy_docs(spark, sf):
    _, _, top = _suggest_parts(spark, sf)
    return top.select("query_id", "doc_key", "rank", F.round("score", 6).alias("score"))


@query
def suggest_vocab(spark, sf):
    index, _, top = _suggest_parts(spark, sf)
    rows = suggest.fuzzy_vocabulary(top, index)
    return rows.select("query_id", F.explode("words").alias("word")).distinct()


@query
def suggest_corrections(spark, sf):
    index, asked, top = _suggest_parts(spark, sf)
    return suggest.corrections(asked, suggest.fuzzy_vocabulary(top, index))


@query
def suggest_text(spark, sf):
    return suggest.suggest(inputs.index(spark, sf), inputs.misspelt_queries(spark, sf))


# --- keyword in context --------------------------------------------------------------------


@query
def kwic_words(spark, sf):
    return inputs.asked_documents(spark, sf).select(
        "doc_id", F.array_join(kwic.query_words(F.col("text")), " ").alias("words")
    )


@query
def light_stem(spark, sf):
    return _cyrillic_tokens(spark, sf).distinct().select("token", kwic.light_stem(F.col("token")).alias("stem"))


@query
def kwic_find(spark, sf):
    found = kwic.find_each(F.col("text"), kwic.query_words(F.col("q")))
    rows = inputs.asked_documents(spark, sf).select("doc_id", F.posexplode(found).alias("word_no", "f"))
    return rows.select("doc_id", big("word_no"), "f.word", F.col("f.at").cast("bigint").alias("at"), "f.matched")


@query
def kwic_snippet(spark, sf):
    return inputs.asked_documents(spark, sf).select(
        "doc_id", kwic.excerpt(F.col("text"), kwic.query_words(F.col("q"))).alias("excerpt")
    )


@query
def kwic_highlight(spark, sf):
    excerpt = kwic.excerpt(F.col("text"), kwic.query_words(F.col("q")))
    rows = inputs.asked_documents(spark, sf).select("doc_id", "q", excerpt.alias("excerpt"))
    return rows.select("doc_id", kwic.highlight(F.col("excerpt"), kwic.query_words(F.col("q"))).alias("marked"))
