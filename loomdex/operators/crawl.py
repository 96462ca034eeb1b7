"""Crawl selection over page tables: links, safety, frontier, depth-bounded reach."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.functions import html, urls
from loomdex.operators import ingest
from loomdex.session import cut_lineage, fits_broadcast, stored
from loomdex.sources import readers


def page_links(pages: DataFrame) -> DataFrame:
    """(url, links): absolute link targets of every page, in page order, one row per page."""
    return pages.select(
        "url",
        F.transform(html.hrefs(F.col("html")), lambda h: urls.resolve(F.col("url"), h)).alias("links"),
    )


def link_rows(pages: DataFrame) -> DataFrame:
    return page_links(pages).select(F.col("url").alias("src"), F.explode("links").alias("dst"))


def followable(link: Column) -> Column:
    return urls.is_valid(link) & ~urls.is_media(link)


def host_safety(host_ips: DataFrame) -> DataFrame:
    """(host, all_public): a host is safe when every address is public."""
    return host_ips.groupBy("host").agg(F.bool_and(urls.is_public_ip(F.col("ip"))).alias("all_public"))


def with_reason(targets: DataFrame, host_ips: DataFrame, allowed: Column, column: str = "url") -> DataFrame:
    """Targets with the reason they are refused ('' when safe); hosts resolve through a table."""
    keyed = targets.withColumn("host", urls.host(F.trim(F.col(column))))
    joined = keyed.join(host_safety(host_ips).withColumn("resolved", F.lit(True)), "host", "left")
    reason = urls.reject_reason(F.col(column), allowed, F.col("resolved"), F.col("all_public"))
    return joined.withColumn("reason", reason).drop("host", "resolved", "all_public")


def safe_links(links: DataFrame, host_ips: DataFrame, allowed: Column) -> DataFrame:
    """Links (src, dst) that may be followed."""
    candidates = links.filter(followable(F.col("dst")))
    return with_reason(candidates, host_ips, allowed, "dst").filter("reason = ''").drop("reason")


def seed_list(request: Column, configured: Column) -> Column:
    """Seeds in visiting order: the requested URL first, then the configured ones."""
    first = urls.normalize(request)
    return F.when(F.coalesce(request, F.lit("")) == "", configured).otherwise(
        F.concat(F.array(first), configured)
    )


def frontier(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct link targets that are not visited yet."""
    targets = links.select(F.col("dst").alias("url")).distinct()
    return targets.join(visited.select("url"), "url", "left_anti")


def reach(seeds: DataFrame, links: DataFrame, max_depth: int) -> DataFrame:
    """(url, depth) of everything within `max_depth`, seeds at depth 1.

    `links(url, links array)` holds one row per page, so a page with very many links is one row in
    the join. Every round is checkpointed and joins the newest frontier only.
    """
    levels = [cut_lineage(seeds.select("url").distinct().withColumn("depth", F.lit(1)))]
    for depth in range(2, max_depth + 1):
        targets = (
            links.join(levels[-1].select("url"), "url")
            .select(F.explode("links").alias("url"))
            .distinct()
        )
        visited = reduce(DataFrame.unionByName, levels).select("url")
        level = cut_lineage(targets.join(visited, "url", "left_anti").withColumn("depth", F.lit(depth)))
        levels.append(level)
        if level.isEmpty():
            break
    return reduce(DataFrame.unionByName, levels)


def safe_targets(targets: DataFrame, host_ips: DataFrame, allowed: Column) -> DataFrame:
    """(url): the different targets(url), normalised, that may be visited."""
    named = targets.select(urls.normalize(F.col("url")).alias("url")).filter("url <> ''").distinct()
    return with_reason(named, host_ips, allowed).filter("reason = ''").select("url")


def sitemap_targets(
    seeds: DataFrame, sitemaps: DataFrame, host_ips: DataFrame, allowed: Column
) -> DataFrame:
    """(url): safe locations in the sitemaps of the seeds' hosts. `sitemaps` has columns url, xml.

    A location that is itself a row of `sitemaps` is read in turn, each sitemap once, so an index that
    names itself ends. Locations are checked like seeds.
    """
    newest = cut_lineage(safe_targets(seeds.select(urls.sitemap_of(F.col("url")).alias("url")), host_ips, allowed))
    found = [newest.limit(0)]
    seen = newest
    while not newest.isEmpty():
        read = sitemaps.join(newest, "url").select(F.explode(readers.sitemap_locations(F.col("xml"))).alias("url"))
        located = cut_lineage(safe_targets(read, host_ips, allowed).join(seen, "url", "left_anti"))
        found.append(located)
        seen = seen.unionByName(located)
        newest = cut_lineage(located.join(sitemaps.select("url"), "url", "left_semi"))
    return reduce(DataFrame.unionByName, found).distinct()


def entry_points(
    listed: DataFrame, host_ips: DataFrame, allowed: Column, sitemaps: DataFrame | None = None
) -> DataFrame:
    """(url): where a crawl starts: the safe ones of `listed(url)`, and what the sitemaps of their hosts name."""
    seeds = cut_lineage(safe_targets(listed, host_ips, allowed))
    if sitemaps is None:
        return seeds
    return seeds.unionByName(sitemap_targets(seeds, sitemaps, host_ips, allowed)).distinct()


@dataclass(frozen=True)
class Crawled:
    """What a crawl saw: (url, depth) of visited pages, and the documents kept of them, with their depth.

    `reached(url, depth)` names every address the crawl came to, also those without a row in the page table.
    """

    visited: DataFrame
    documents: DataFrame
    reached: DataFrame


def _pages_at(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of `pages` on the frontier; their html is shuffled only if the frontier is too large to broadcast."""
    small = fits_broadcast(frontier, "url")
    return pages.select("url", "html").join(F.broadcast(frontier) if small else frontier, "url")


def crawl(
    listed: DataFrame, pages: DataFrame, host_ips: DataFrame, allowed: Column, max_depth: int,
    max_pages: int | None = None, sitemaps: DataFrame | None = None, known: DataFrame | None = None,
) -> Crawled:
    """A crawl of the page table, level by level.

    A round visits the pages of the newest level: each is cleaned and its links are taken, in one reading.
    Service pages, pages known already and pages with too little text are visited and followed but not kept.
    Kept pages are counted after every round. The round that reaches `max_pages` visits its pages in the order of
    their URLs up to the one that fills the cap, and no link is followed any more.
    """
    newest = cut_lineage(entry_points(listed, host_ips, allowed, sitemaps))
    reader, rounds, levels = ingest.PageReader(), [], []
    seen, kept = newest, 0
    for depth in range(1, max_depth + 1):
        levels.append(newest.select("url", F.lit(depth).alias("depth")))
        marked = newest.withColumn("known", F.lit(False))
        if known is not None:
            there = known.select(F.col("doc_key").alias("url"), F.lit(True).alias("there")).distinct()
            marked = newest.join(there, "url", "left").select("url", F.coalesce("there", F.lit(False)).alias("known"))
        looked = reader.rows(_pages_at(marked, pages)).withColumn("depth", F.lit(depth))
        looked = stored(looked, "crawl")
        here = looked.filter("document is not null")
        gained = here.count()
        if max_pages is not None and kept + gained >= max_pages:
            rounds.append(_up_to_cap(looked, here, max_pages - kept))
            break
        rounds.append(looked)
        kept += gained
        if depth == max_depth:
            break
        targets = looked.select(F.explode("links").alias("url")).distinct().filter(followable(F.col("url")))
        safe = with_reason(targets, host_ips, allowed).filter("reason = ''").select("url")
        newest = cut_lineage(safe.join(seen, "url", "left_anti"))
        seen = seen.unionByName(newest)
        if newest.isEmpty():
            break
    every = reduce(DataFrame.unionByName, rounds)
    documents = every.filter("document is not null").select("document.*", "depth")
    return Crawled(every.select("url", "depth"), documents, reduce(DataFrame.unionByName, levels))


def _up_to_cap(looked: DataFrame, here: DataFrame, left: int) -> DataFrame:
    """Pages of a round up to the one that is the last kept."""
    if left <= 0:
        return looked.limit(0)
    last = here.select("url").orderBy("url").limit(left).agg(F.max("url").alias("last"))  # `left` is below the page cap
    return looked.filter(F.col("url") <= last.first()["last"])
