"""Pages to documents: the page filter chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.functions import html
from loomdex.functions.text import (
    content_hash, long_enough, strip_boilerplate, strip_combining,
)
from loomdex.functions.urls import is_service, resolve
from loomdex.operators.index import unknown_urls


def page_content(source: Column) -> Column:
    """Page text by blocks. Boilerplate goes up to the end of its line, so line ends must still be there."""
    return strip_combining(strip_boilerplate(html.page_lines(source)))


def documents_of(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Documents of the pages worth keeping.

    Known and service pages are dropped on their URL alone, before any HTML is read. The generator keeps
    the length test above it, so that a page is cleaned once, and after the join.
    """
    kept = pages if known is None else unknown_urls(pages, known)
    kept = kept.filter(~is_service(F.col("url")))
    read = F.struct(html.title(F.col("html")).alias("title"), page_content(F.col("html")).alias("content"))
    read = kept.select("url", F.explode(F.array(read)).alias("page")).select("url", "page.*")
    return read.filter(long_enough(F.col("content"))).select(
        F.col("url").alias("doc_key"),
        "url", "title", "content",
        F.lit("").alias("file_path"),
        F.lit("web").alias("file_type"),
        content_hash(F.col("content")).alias("content_hash"),
    )


class PageReader:
    """Links and document of a page, as columns that are built once and read many tables."""

    def __init__(self) -> None:
        self.read = F.struct(html.title(F.col("html")).alias("title"), page_content(F.col("html")).alias("content"))
        self.links = F.transform(html.hrefs(F.col("html")), lambda h: resolve(F.col("url"), h))
        self.wanted = ~F.col("known") & ~is_service(F.col("url"))

    def rows(self, pages: DataFrame) -> DataFrame:
        """(url, links, document) of pages(url, html, known): absolute link targets, and the document, null if not worth keeping.

        The generator keeps the length test above it, so that a page is cleaned once.
        """
        page = F.explode(F.array(F.when(self.wanted, self.read))).alias("page")
        document = F.struct(
            F.col("url").alias("doc_key"), "url", "page.title", "page.content", F.lit("").alias("file_path"),
            F.lit("web").alias("file_type"), content_hash(F.col("page.content")).alias("content_hash"),
        )
        found = pages.select("url", self.links.alias("links"), page)
        return found.select("url", "links", F.when(long_enough(F.col("page.content")), document).alias("document"))


def capped(pages: DataFrame, max_pages: int, order: tuple[str, ...] = ("depth", "url")) -> DataFrame:
    """At most `max_pages` pages, nearest to the seeds first."""
    return pages.orderBy(*order).limit(max_pages)
