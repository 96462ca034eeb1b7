"""Inputs of the registered queries: the given tables, and data Spark derives from all their rows.

The given texts hold no Cyrillic, no boilerplate, no crawl configuration and no odd URLs. Where an
operator needs them, every row of a given table is rewritten, so the work grows with the table.
SQL fragments used here are plain enough for the checking engine to run unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.functions import vocab
from loomdex.functions.text import words
from loomdex.functions.urls import host
from loomdex.session import fresh_dir
from loomdex.sources.readers import read_table, read_text_table
from loomdex.sources.store import Index, open_index, update_index, write_index
from loomdex.sources.uploads import write_files

# Latin to Cyrillic, chosen so that common word ends become Russian endings.
LATIN = "abcdefghijklmnopqrstuvwxyzéèêçäöüóáíñABCDEFGHIJKLMNOPQRSTUVWXYZÉÈÊÇÄÖÜÓÁÍÑ"
CYRILLIC = "абстефгхижклмнопщймтувшхызяюёцяёюьыйнАБСТЕФГХИЖКЛМНОПЩЙМТУВШХЫЗЯЮЁЦЯЁЮЬЫЙН"

URL_VARIANTS = [
    "url",
    "replace(url, 'http', 'HTTP')",
    "'  ' || url || ' '",
    "replace(replace(url, 'https:', 'ftp:'), 'http:', 'ftp:')",
    "url || '/paper.PDF'",
    "url || '/photo.jpg?x=1'",
    "url || '?title=%D0%A1%D0%BB%D1%83%D0%B6%D0%B5%D0%B1%D0%BD%D0%B0%D1%8F:x'",
    "url || '?action=edit'",
    "url || '?diff=1%zz'",
    "url || '/a%zz/license'",
    "'http://localhost/' || cast(page_id as varchar(20))",
    "'http://a.localhost:8080/' || cast(page_id as varchar(20))",
    "'http://user@[::1]:80/' || cast(page_id as varchar(20))",
    "'https://github.com/' || cast(page_id as varchar(20))",
    "'http://host:port/' || cast(page_id as varchar(20))",
    "'mailto:a' || cast(page_id as varchar(20))",
    "'https:///' || cast(page_id as varchar(20))",
    "url || '/x#part'",
    "''",
]
# Derived address forms; k is the customer key.
IP_VARIANTS = [
    "cast(k % 256 as varchar(20)) || '.' || cast(k % 7 as varchar(20)) || '.0.1'",
    "'172.' || cast(k % 64 as varchar(20)) || '.1.1'",
    "'192.' || cast(160 + k % 16 as varchar(20)) || '.1.1'",
    "'169.' || cast(250 + k % 6 as varchar(20)) || '.1.1'",
    "'100.64.0.' || cast(k % 256 as varchar(20))",
    "'::ffff:' || cast(k % 256 as varchar(20)) || '.2.3.4'",
    "'fe8' || cast(k % 10 as varchar(20)) || '::' || cast(k % 100 as varchar(20))",
    "'fc00::' || cast(k % 100 as varchar(20))",
    "'ff02::' || cast(k % 100 as varchar(20))",
    "'2001:db8::' || cast(k % 100 as varchar(20))",
    "'::' || cast(k % 3 as varchar(20))",
    "cast(k % 400 as varchar(20)) || '.1.1.1'",
    "'0' || cast(k % 10 as varchar(20)) || '.1.1.1'",
    "'::ffff:7f00:' || cast(k % 9 as varchar(20))",
    "'0:0:0:0:0:FFFF:' || cast(k % 256 as varchar(20)) || '.0.0.1'",
    "'2001:db8:' || cast(k % 9 as varchar(20)) || '::1'",
    "'fc::' || cast(k % 9 as varchar(20))",
    "'feb' || cast(k % 9 as varchar(20)) || '::1'",
    "'1:2:3:4:5:6:7:' || cast(k % 9 as varchar(20)) || case when k % 2 = 0 then ':8' else '' end",
    "'1::2::' || cast(k % 9 as varchar(20))",
    "'abc:' || cast(k % 9 as varchar(20))",
    "'12345::' || cast(k % 9 as varchar(20))",
    "'host' || cast(k as varchar(20))",
]
HREF_VARIANTS = ['href="/', 'href="../', "href='./", "href=//cdn.example.org/", 'href="?p=', 'href="#', 'href="https://x.example.org/a/../']
CLASS_VARIANTS = [
    '<div class="ad">',
    '<div class="ad sidebar">',
    "<div class='menu'>",
    '<div class=reference>',
    '<div class="sidebars">',
]
REMNANTS = [
    " [ПРАВИТЬ | код] ", "[12]", "[edit]", " [ скрыть ] ", "[показать]", " [править код]",
    " материал из википедии — свободной энциклопедии ",
    " Текущая версия страницы пока не проверялась опытными участниками и может. ",
    " ПЕРЕЙТИ К НАВИГАЦИИ ", " Перейти к поиску ",
    " У этого термина существуют и другие значения, см. ", " Запрос «x» перенаправляется сюда, см. ",
    " См. также y. Эта статья о z. ",
]
# Letters to scripts without blanks, digits and the marks that may stand inside a word.
SMALL_LATIN = "abcdefghijklmnopqrstuvwxyz"
MIXED = "あb中1e文グh3ーl한カn語o,’r.กี:;ญ々"

TAILS = [". ", "\n", " "]
# Two of three letters of a word stay, so most words are misspelt.
MISSPELL_PATTERN = r"(\p{L}{2})\p{L}(\p{L}{2})"


def sql_array(items) -> str:
    return "array(" + ", ".join(items) + ")"


def literals(items) -> list[str]:
    return ["'" + i.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'" for i in items]


def pick(items, position: str) -> str:
    """Spark SQL: one of `items` by a row's own number."""
    return f"element_at({sql_array(literals(items))}, cast({position} % {len(items)} as int) + 1)"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_text_table(spark, sf, "documents", "doc_id")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_text_table(spark, sf, "pages", "page_id")


def mixed_scripts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose words mix scripts with and without blanks, numbers with commas and inner marks."""
    tail = "' ' || cast(doc_id as string) || ',' || cast(octet_length(text) as string) || ';5.x 12:30 v1.2 ' || source"
    return documents(spark, sf).select(
        "doc_id", F.concat(F.translate(F.col("text"), SMALL_LATIN, MIXED), F.expr(tail)).alias("text")
    )


def to_cyrillic(column: str):
    return F.translate(F.col(column), LATIN, CYRILLIC)


def corpus(spark: SparkSession, sf: str, cyrillic: bool = False) -> DataFrame:
    """Documents to search: title is the first line, the key is a URL."""
    docs = documents(spark, sf)
    if cyrillic:
        docs = docs.withColumn("text", to_cyrillic("text"))
    url = F.concat(F.lit("https://docs.example.org/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    return docs.select(
        url.alias("doc_key"), url.alias("url"),
        F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("content"),
        F.lit("").alias("file_path"), F.lit("").alias("file_type"),
    )


_stored: dict[tuple[str, str, bool], str] = {}


def index(spark: SparkSession, sf: str, cyrillic: bool = False) -> Index:
    """Stored index of the corpus, built once for an application."""
    key = spark.sparkContext.applicationId, sf, cyrillic
    if key not in _stored:
        home = fresh_dir(spark, "index")
        docs = corpus(spark, sf, cyrillic).selectExpr("*", "'' as content_hash", "cast(0 as bigint) as seq")
        write_index(docs, home)
        _stored[key] = home
    return open_index(spark, _stored[key])


def updated_index(spark: SparkSession, sf: str) -> str:
    """Folder of an index of an older state of the corpus, brought up to date in two steps."""
    docs = corpus(spark, sf).selectExpr("*", "'' as content_hash", "cast(0 as bigint) as seq")
    part = F.pmod(F.xxhash64("doc_key"), F.lit(300))
    older = docs.filter(part != 0).withColumn(
        "content", F.when(part == 1, F.concat(F.lit("older "), F.reverse("content"))).otherwise(F.col("content"))
    )
    gone = docs.filter(part == 2).withColumn("doc_key", F.concat("doc_key", F.lit("/gone")))
    home = fresh_dir(spark, "updated")
    write_index(older.unionByName(gone), home)
    # The changed documents come first with a state between, then as they are, with the new ones.
    update_index(older.filter(part == 1).withColumn("content", F.lit("between")), home)
    update_index(docs.filter(part < 2), home, deleted=gone.select("doc_key"))
    return home


def queries(spark: SparkSession, sf: str, cyrillic: bool = False) -> DataFrame:
    """One query per benchmark item, its whole text; first page of ten."""
    q = to_cyrillic("text") if cyrillic else F.col("text")
    return read_table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), q.alias("q"),
        F.lit(1).cast("bigint").alias("page"), F.lit(10).cast("bigint").alias("size"),
    )


def raw_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Query texts with page and size as given by a caller, some of them unusable."""
    return read_table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("q"),
        F.expr(pick(["1", "2", "0", "-1", "x", "900"], "item_id")).alias("page_text"),
        F.expr(pick(["10", "50", "51", "0", "7", ""], "item_id")).alias("size_text"),
    )


def misspelt_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts with a letter missing from most words."""
    q = F.regexp_replace("text", MISSPELL_PATTERN, "$1$2")
    return read_table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), q.alias("q"),
        F.lit(1).cast("bigint").alias("page"), F.lit(10).cast("bigint").alias("size"),
    )


def url_variants(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, variant, url): every page URL in many forms."""
    return read_table(spark, sf, "pages").selectExpr(
        "page_id", f"posexplode({sql_array(URL_VARIANTS)}) as (variant, target)"
    ).select("page_id", F.col("variant").cast("bigint").alias("variant"), F.col("target").alias("url"))


def host_ips(spark: SparkSession, sf: str) -> DataFrame:
    """(host, ip): two addresses per page host, taken from a hash of its name; some are private."""
    hosts = read_table(spark, sf, "pages").select(
        F.regexp_extract("url", "^https?://([^/?#:]*)", 1).alias("host")
    ).distinct()
    octet = "cast(conv(substr(md5(host), {0}, 2), 16, 10) as bigint)"
    private = "case when substr(md5(host), 1, 1) in ('0', '1', '2', '3') then '10.' else '93.' end"
    return hosts.selectExpr(
        "host",
        f"explode(array('93.184.' || {octet.format(3)} || '.' || {octet.format(5)}, "
        f"{private} || '1.' || {octet.format(7)} || '.' || {octet.format(9)})) as ip",
    )


def known_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages counted as indexed already: those with a good label."""
    good = read_table(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("page_id"))
    return read_table(spark, sf, "pages").join(good, "page_id", "left_semi").select(F.col("url").alias("doc_key"))


def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with boilerplate in front, accents as combining marks, and some service URLs."""
    lead = pick([p + t for p in vocab.BOILERPLATE_PREFIXES + ["Intro"] for t in (" — x. ", " y ")], "page_id")
    suffix = pick(["", "", "&action=history", "", "?oldid=7"], "page_id")
    return pages(spark, sf).selectExpr(
        "page_id",
        f"case when {suffix} = '' then url else url || {suffix} end as url",
        f"replace(replace(html, '<p><b>', '<p><b>' || {lead}), 'é', 'e\u0301') as html",
    )


def classed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose advertisement block carries various classes."""
    box = pick(CLASS_VARIANTS, "page_id")
    return pages(spark, sf).selectExpr(
        "page_id", "url", f"replace(html, '<div class=\"ad\">', {box}) as html"
    )


def linked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose links come in various forms."""
    form = pick(HREF_VARIANTS, "page_id")
    closed = pick(['"', '"', "'", "", '"', '"', '"'], "page_id")
    return pages(spark, sf).selectExpr(
        "page_id", "url",
        f"regexp_replace(html, 'href=\"/([^\"]*)\"', {form} || '$1' || {closed}) as html",
    )


def site(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of five hosts, each with three more links in its HTML to pages chosen by arithmetic on its number."""
    n = read_table(spark, sf, "pages").agg(F.count("*")).scalar()
    targets = [F.pmod(F.col("page_id") * i + 7 * i * i + 1, n) for i in (1, 2, 3)]
    anchors = F.concat(*(part for t in targets for part in (F.lit('<a href="'), site_url(t), F.lit('">next</a>'))))
    html = F.replace(F.col("html"), F.lit("<article>"), F.concat(F.lit("<p>"), anchors, F.lit("</p><article>")))
    return pages(spark, sf).select("page_id", site_url(F.col("page_id")).alias("url"), html.alias("html"))


def site_url(number):
    return F.concat(
        F.lit("http://s"), F.pmod(number, F.lit(5)).cast("string"), F.lit(".example.org/p"), number.cast("string")
    )


def site_ips(spark: SparkSession, sf: str) -> DataFrame:
    """(host, ip) of the five hosts; the last one is private."""
    hosts = site(spark, sf).select(F.regexp_extract("url", "^http://([^/]*)", 1).alias("host")).distinct()
    return hosts.select("host", F.when(F.startswith("host", F.lit("s4.")), "10.0.0.4").otherwise("93.184.1.1").alias("ip"))


def known_site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_key): pages of the five hosts whose number has a good label."""
    good = read_table(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("page_id"))
    return site(spark, sf).join(good, "page_id", "left_semi").select(F.col("url").alias("doc_key"))


def sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    """(url, xml): sitemaps of four of the five hosts, each naming every sixteenth page and some targets to refuse.

    The first host has an index of maps, which also names itself, another host's map, and a map that is not there.
    """
    listed = site(spark, sf).filter("page_id % 16 = 0").select(
        F.regexp_extract("url", "^http://([^/]*)", 1).alias("host"), F.floor(F.col("page_id") / 512).cast("string").alias("map"), "url"
    ).filter("host <> 's2.example.org'")
    extra = "<url><loc>http://s0.example.org/photo.jpg</loc></url><url><loc>http://10.0.0.1/p1</loc></url><url><loc>http://s1.example.org/p6#top</loc></url><url><loc> http://s1.example.org/p11 </loc></url>"
    name = F.when(F.col("host") == "s0.example.org", F.concat(F.lit("/map-"), "map", F.lit(".xml"))).otherwise("/sitemap.xml")
    places = F.array_join(F.collect_list(F.concat(F.lit("<url><loc>"), "url", F.lit("</loc></url>"))), "")
    maps = listed.groupBy(F.concat(F.lit("http://"), "host", name).alias("url")).agg(
        F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' + extra), places, F.lit("</urlset>")).alias("xml")
    )
    entry = F.concat(F.lit("<sitemap><loc>"), "url", F.lit("</loc></sitemap>"))
    more = "".join(
        f"<sitemap><loc>http://{u}</loc></sitemap>" for u in ("s0.example.org/sitemap.xml", "s3.example.org/sitemap.xml", "s0.example.org/gone.xml")
    )
    index = maps.filter("url like '%/map-%'").agg(
        F.concat(F.lit("<sitemapindex>" + more), F.array_join(F.collect_list(entry), ""), F.lit("</sitemapindex>")).alias("xml")
    )
    return maps.unionByName(index.select(F.lit("http://s0.example.org/sitemap.xml").alias("url"), "xml"))


#: Where the seeded crawl is asked to start: pages in several spellings, and targets that must be refused.
ASKED_SEEDS = [
    " http://s1.example.org/p1#top ", "HTTP://s2.example.org/p2", "http://s4.example.org/p4", "http://s3.example.org/p3", "http://localhost/p5",
    "ftp://s1.example.org/p11", "http://s1.example.org/p%zz", "http://s0.example.org/paper.pdf", "http://s0.example.org/nowhere", "", "http://unknown.example.org/p1",
]


def page_graph(spark: SparkSession, sf: str) -> DataFrame:
    """(url, links): every page links to six pages chosen by arithmetic on its number."""
    numbered = read_table(spark, sf, "pages").select("page_id", F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("url"))
    n = numbered.agg(F.count("*")).scalar()
    targets = [
        F.concat(F.lit("p"), F.pmod(F.col("page_id") * i + 7 * i * i + 1, n).cast("string"))
        for i in range(1, 7)
    ]
    return numbered.select("url", F.array(*targets).alias("links"))


def crawl_events(spark: SparkSession, sf: str) -> DataFrame:
    """(host, crawl, kind): every page is kept by its host's first crawl, a third also by a second one; some crawls finish."""
    events = (
        "array(named_struct('crawl', 1L, 'kind', 'start'), named_struct('crawl', 1L, 'kind', 'page'), named_struct('crawl', 1L, 'kind', "
        "if(page_id % 50 = 1, 'finish', 'start')), named_struct('crawl', if(page_id % 4 = 1, 2L, 1L), 'kind', 'start'), "
        "named_struct('crawl', 2L, 'kind', if(page_id % 3 = 0, 'page', 'none')), named_struct('crawl', if(page_id % 3 = 0, 2L, 1L), "
        "'kind', if(page_id % 40 = 0, 'finish', 'start')))"
    )
    rows = read_table(spark, sf, "pages").select("page_id", host(F.col("url")).alias("host"))
    return rows.select("host", F.explode(F.expr(events)).alias("e")).select("host", "e.*").filter("kind <> 'none'")


def uploads(spark: SparkSession, sf: str) -> DataFrame:
    """(path, length, content): page sources as uploaded files of many kinds."""
    name = pick(["Doc.html", "Scan.PDF", "scan.pdf", "Old.HTM", "notes.txt", "a\tb.html", ".htm", "plain", "x.pdf"], "page_id")
    kind = "cast(page_id % 9 as int)"
    body = (
        f"case when {kind} in (1, 2) then '%PDF-1.7\\n' || html when page_id % 17 = 3 then '' "
        f"when page_id % 19 = 5 then replace(html, '<', '(') else html end"
    )
    return pages(spark, sf).selectExpr(
        f"'/in/' || cast(page_id as string) || '/' || {name} as path",
        f"cast(case when page_id % 11 = 0 then 20971520 when page_id % 11 = 1 then 20971521 else octet_length({body}) end as bigint) as length",
        f"cast({body} as binary) as content",
    )


FILE_NAMES = ["Doc.html", "Scan.PDF", "scan.pdf", "Old.HTM", "notes.txt", "a b.html", ".htm", "plain", "x.pdf"]


def upload_folder(spark: SparkSession, sf: str) -> str:
    """A folder of real files, one for each page, some of them empty."""
    folder = fresh_dir(spark, "in")
    body = "case when page_id % 17 = 3 then '' when page_id % 9 in (1, 2) then '%PDF-1.7\\n' || html else html end"
    rows = pages(spark, sf).selectExpr(
        f"'/' || cast(page_id as string) || '/' || {pick(FILE_NAMES, 'page_id')} as path", f"cast({body} as binary) as content"
    )
    write_files(rows, folder).write.parquet(fresh_dir(spark, "written"))
    return folder


def configs(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, config): one crawl configuration per page; some are broken, some missing."""
    p = "cast(page_id % {0} as string)"
    full = (
        "'{\"seed_urls\":[\"' || url || '\"],\"max_pages\":' || " + p.format(3)
        + " || ',\"max_depth\":' || " + p.format(4) + " || ',\"allowed_hosts\":[\"example.net\"],\"user_agent\":\"' || "
        + "case when page_id % 2 = 0 then '' else 'bot' end || '\",\"auto_start\":' || case when page_id % 3 = 0 then 'true' else 'false' end || '}'"
    )
    return read_table(spark, sf, "pages").selectExpr(
        "page_id", "url",
        f"case when page_id % 13 = 0 then null when page_id % 7 = 0 then replace({full}, '}}', '') "
        f"when page_id % 5 = 0 then '{{}}' else {full} end as config",
    )


def stopword_files(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, words): the words of every document as a JSON array; every fifth one is broken."""
    listed = documents(spark, sf).select("doc_id", F.to_json(words(F.col("text"))).alias("j"))
    return listed.selectExpr("doc_id", "case when doc_id % 5 = 0 then substr(j, 1, length(j) - 1) else j end as words")


def boilerplate_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a known prefix at a varying distance from the start."""
    prefix = pick(vocab.BOILERPLATE_PREFIXES + ["none"], "doc_id")
    tail = pick(TAILS, "doc_id")
    return documents(spark, sf).selectExpr(
        "doc_id", f"repeat('я', cast(doc_id % 60 as int)) || {prefix} || ' x' || {tail} || text as text"
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, line_no, line): all document lines, some with a boilerplate phrase in mixed case."""
    phrase = pick([""] * 5 + [p.upper() for p in vocab.BOILERPLATE_PHRASES], "(doc_id + line_no)")
    return documents(spark, sf).selectExpr(
        "doc_id", "posexplode(split(text, '\\n')) as (line_no, line)"
    ).selectExpr("doc_id", "cast(line_no as bigint) as line_no", f"line || ' ' || {phrase} as line")


def asked_documents(spark: SparkSession, sf: str, cyrillic: bool = True) -> DataFrame:
    """(doc_id, text, q): every document with one benchmark text as its query."""
    asked = read_table(spark, sf, "benchmark").select("item_id", F.col("text").alias("q"))
    n = asked.agg(F.count("*")).scalar()
    docs = documents(spark, sf).withColumn("item_id", F.pmod("doc_id", n))
    paired = docs.join(asked, "item_id")
    if cyrillic:
        return paired.select("doc_id", to_cyrillic("text").alias("text"), to_cyrillic("q").alias("q"))
    return paired.select("doc_id", "text", "q")
