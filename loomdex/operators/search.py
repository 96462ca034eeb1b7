"""Ranked retrieval for a whole table of queries (query_id, q) in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdex.functions.analysis import analyze, clean_query
from loomdex.functions.snippet import snippet, stored_ranges, term_ranges
from loomdex.functions.text import safe_string, title_key
from loomdex.operators import scoring
from loomdex.operators.index import FIELDS, HOT_SPLITS, document_frequencies, postings, salt
from loomdex.session import fits_broadcast, stored
from loomdex.sources.store import VECTOR_COLUMNS, Index, posting_bucket, postings_in, stored_documents

DEFAULT_SIZE = 10
MAX_SIZE = 50
# Rank cuts up to this depth also run before the shuffle; deeper pages are found by score bands.
SHALLOW = 1000
BANDS = 1000
# Page hits that are broadcast to the stored documents; a row holds a key and a few numbers.
HITS_IN_MEMORY = 100_000


def page_number(text: Column) -> Column:
    """Positive page number, else 1."""
    n = _whole_number(text)
    return F.when(n > 0, n).otherwise(1).cast("bigint")


def page_size(text: Column) -> Column:
    """Size 1..50, else 10 (no clamping)."""
    n = _whole_number(text)
    return F.when(n.between(1, MAX_SIZE), n).otherwise(DEFAULT_SIZE).cast("bigint")


def _whole_number(text: Column) -> Column:
    return F.when(text.rlike(r"^[+\-]?[0-9]+\z"), text.try_cast("bigint"))


def query_terms(queries: DataFrame, stop: list[str] | None = None) -> DataFrame:
    """(query_id, term, reps, n_terms): index terms of the cleaned queries."""
    analyzed = queries.filter("q <> ''").select(
        "query_id", analyze(clean_query(F.col("q"), stop)).alias("terms")
    )
    rows = analyzed.select(
        "query_id", F.size("terms").cast("bigint").alias("n_terms"), F.explode("terms").alias("term")
    )
    return rows.groupBy("query_id", "n_terms", "term").agg(F.count("*").alias("reps"))


def term_weights(
    terms: DataFrame, frequencies: DataFrame, n_docs: Column, fields=FIELDS
) -> DataFrame:
    """(query_id, field, term, reps, n_terms, weight) for every query term and field."""
    wanted = terms.withColumn("field", F.explode(F.array(*[F.lit(f) for f in fields])))
    idf = 1 + F.log(n_docs / (F.coalesce(F.col("df"), F.lit(0)) + 1.0))
    weighted = wanted.join(frequencies, ["field", "term"], "left").withColumn("idf", idf)
    # A query's terms, fuzzy ones included, are few beside its postings.
    norm = 1 / F.sqrt(F.sum(F.col("reps") * F.col("idf") * F.col("idf")).over(Window.partitionBy("query_id")))
    weight = F.col("reps") * F.col("idf") * F.col("idf") * norm
    return weighted.select("query_id", "field", "term", "reps", "n_terms", weight.alias("weight"))


def match(post: DataFrame, weights: DataFrame, small: bool) -> DataFrame:
    """Postings joined to the query terms they match.

    Small query tables are broadcast. Otherwise both sides are shuffled with a salt, so a term
    found in a third of all documents is spread over several tasks.
    """
    density = F.sqrt("tf") / F.sqrt("n_tokens")
    post = post.select("doc_key", "field", "term", density.alias("density"))
    if small:
        return post.join(F.broadcast(weights), ["field", "term"])
    copies = weights.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(HOT_SPLITS - 1))))
    return post.withColumn("_salt", salt()).join(copies, ["field", "term", "_salt"]).drop("_salt")


def field_scores(matches: DataFrame) -> DataFrame:
    """(query_id, doc_key, field, matched, score) before combining fields."""
    part = F.col("weight") * F.col("density")
    return matches.groupBy("query_id", "doc_key", "field", "n_terms").agg(
        F.sum("reps").alias("matched"), F.sum(part).alias("raw")
    ).select(
        "query_id", "doc_key", "field", "matched",
        (F.col("raw") * F.col("matched") / F.col("n_terms")).alias("score"),
    )


def combined_scores(matches: DataFrame, fields=FIELDS) -> DataFrame:
    """(query_id, doc_key, score): at least one field matches, field scores are summed."""
    part = F.col("weight") * F.col("density")
    if len(fields) == 1:
        only = matches.groupBy("query_id", "doc_key").agg(
            F.sum(part).alias("raw"), F.sum("reps").alias("hits"), F.max("n_terms").alias("n_terms")
        )
        return only.select("query_id", "doc_key", F.round(F.col("raw") * F.col("hits") / F.col("n_terms"), 9).alias("score"))
    sums = []
    for f in fields:
        here = F.col("field") == f
        sums += [
            F.sum(F.when(here, part)).alias(f"raw_{f}"),
            F.sum(F.when(here, F.col("reps")).otherwise(0)).alias(f"hit_{f}"),
        ]
    grouped = matches.groupBy("query_id", "doc_key").agg(F.max("n_terms").alias("n_terms"), *sums)
    total, hits = F.lit(0.0), F.lit(0)
    for f in fields:
        total = total + F.coalesce(F.col(f"raw_{f}"), F.lit(0.0)) * F.col(f"hit_{f}") / F.col("n_terms")
        hits = hits + F.when(F.col(f"hit_{f}") > 0, 1).otherwise(0)
    # Ranking uses the rounded score, so sums taken in another order rank the same.
    return grouped.select(
        "query_id", "doc_key", F.round(total * hits / len(fields), 9).alias("score")
    )


def lookup(index: Index, terms: DataFrame, small: bool, fields=None, names=FIELDS):
    """Postings of the wanted terms and their document frequencies; of a stored index the blocks that hold them, if `small`."""
    wanted = terms.select("term").distinct()
    if index.post is None:
        # Only postings of query terms are shuffled, by document: every later step of the scoring
        # groups by document and needs no further shuffle.
        post = postings(index.docs, fields, F.broadcast(wanted) if small else wanted)
        post = post.repartition("doc_key")
        return post, document_frequencies(post)
    # The bucket column lets the scan skip buckets without a wanted term.
    buckets = wanted.select(posting_bucket(F.col("term"), index.buckets).alias("term_bucket")).distinct()
    post = index.post.join(F.broadcast(buckets), "term_bucket", "left_semi")
    if not small:
        post = index.live(postings_in(post, names, wanted))
    frequencies = index.term_df.filter(F.col("field").isin(*names))
    frequencies = frequencies.join(F.broadcast(wanted) if small else wanted, "term", "left_semi")
    return post, frequencies


def _found(index: Index, queries: DataFrame, stop: list[str] | None):
    """Postings of the query terms, the terms' weights, and whether the query table is small."""
    small = fits_broadcast(queries, "q")
    terms = query_terms(queries, stop)
    post, frequencies = lookup(index, terms, small)
    return post, term_weights(terms, frequencies, index.n_docs), small


def matches(
    index: Index, queries: DataFrame, stop: list[str] | None = None, fields=FIELDS
) -> DataFrame:
    post, weights, small = _found(index, queries, stop)
    if small and index.post is not None:
        post = index.live(postings_in(post, FIELDS))
    found = match(post, weights, small)
    return found if set(fields) == set(FIELDS) else found.filter(F.col("field").isin(*fields))


def scores_by_field(index: Index, queries: DataFrame, stop: list[str] | None = None, fields=FIELDS) -> DataFrame:
    """`field_scores` of the matches in `fields`."""
    post, weights, small = _found(index, queries, stop)
    if set(fields) != set(FIELDS):
        weights = weights.filter(F.col("field").isin(*fields))
    if small and index.post is not None:
        return scoring.by_field(post, weights, tuple(fields), index.live)
    return field_scores(match(post, weights, small))


def scores(index: Index, queries: DataFrame, stop: list[str] | None = None) -> DataFrame:
    """(query_id, doc_key, score) of every matching document."""
    return rounded_scores(index, *_found(index, queries, stop))


def rounded_scores(index: Index, post: DataFrame, weights: DataFrame, small: bool, fields=FIELDS, best: int | None = None) -> DataFrame:
    """`combined_scores`; of a stored index and a small query table added up by Arrow batches.

    With `best`, documents that cannot be among so many best ones of a query may be left out.
    """
    if small and index.post is not None:
        return scoring.combined(post, weights, tuple(fields), best, index.live).withColumn("score", F.round("score", 9))
    return combined_scores(match(post, weights, small), fields)


def totals(scored: DataFrame) -> DataFrame:
    """Hits and best score per query, over all hits."""
    return scored.groupBy("query_id").agg(
        F.count("*").alias("total"), F.max("score").alias("max_score")
    )


def with_totals(scored: DataFrame, queries: DataFrame) -> DataFrame:
    """Every hit with the totals of its query; these are a row for a query, so the hits of a small query table are not shuffled."""
    counted = totals(scored)
    return scored.join(F.broadcast(counted) if fits_broadcast(queries, "q") else counted, "query_id")


def total_pages(total: Column, size: Column) -> Column:
    return F.ceil(total / size).cast("bigint")


def relevance(score: Column, max_score: Column) -> Column:
    ratio = score / max_score
    return (
        F.when(max_score == 0, "low").when(ratio >= 0.7, "high").when(ratio >= 0.4, "medium").otherwise("low")
    )


def ranked(scored: DataFrame, depth: int) -> DataFrame:
    """The first `depth` hits per query; the cut also runs before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_key"))
    return scored.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= depth)


def pages(scored: DataFrame, queries: DataFrame) -> DataFrame:
    """Hits on the requested page of every query: queries(query_id, q, page, size)."""
    last = F.col("page") * F.col("size")
    asked = queries.select("query_id", "page", "size")
    small = fits_broadcast(asked)
    deep = asked.filter(last > SHALLOW)
    shallow = asked.filter(last <= SHALLOW)
    first = (F.col("page") - 1) * F.col("size")
    # No deeper than the last page asked for, and for the queries only that ask for such a page.
    depth = shallow.agg(F.max(last)).first()[0] or 0
    listed = _for_some(scored, shallow, small)
    hits = ranked(listed, depth).join(F.broadcast(shallow) if small else shallow, "query_id")
    hits = hits.filter((F.col("rank") > first) & (F.col("rank") <= first + F.col("size")))
    if deep.isEmpty():
        return hits
    far = deep_pages(_for_some(scored, deep, small), deep)
    return hits.unionByName(far.select(hits.columns))


def _for_some(scored: DataFrame, asked: DataFrame, small: bool) -> DataFrame:
    """Hits of the queries `asked`; if these are few, no hit is shuffled to meet them."""
    named = asked.select("query_id")
    return scored.join(F.broadcast(named) if small else named, "query_id", "left_semi")


def deep_pages(scored: DataFrame, asked: DataFrame) -> DataFrame:
    """Pages far down the ranking, without sorting all hits of a query in one task.

    Hits are counted per score band; only the bands that a page touches are sorted, and shuffled.
    """
    small = fits_broadcast(asked)

    def few(rows: DataFrame) -> DataFrame:
        # A query has one best score, and a page touches no more bands than the page has hits.
        return F.broadcast(rows) if small else rows

    scored = stored(scored.select("query_id", "doc_key", "score"), "deep")
    best = totals(scored).select("query_id", "max_score")
    depth_in_range = F.when(F.col("max_score") > 0, 1 - F.col("score") / F.col("max_score")).otherwise(0)
    banded = scored.join(few(best), "query_id").select(
        "query_id", "doc_key", "score", F.floor(depth_in_range * BANDS).alias("band")
    )
    earlier = Window.partitionBy("query_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    counts = banded.groupBy("query_id", "band").agg(F.count("*").alias("n"))
    counts = counts.withColumn("above", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    first = (F.col("page") - 1) * F.col("size")
    touched = counts.join(few(asked), "query_id").filter(
        (F.col("above") < first + F.col("size")) & (F.col("above") + F.col("n") > first)
    )
    order = Window.partitionBy("query_id", "band").orderBy(F.col("score").desc(), F.col("doc_key"))
    rank = (F.col("above") + F.row_number().over(order)).cast("bigint")
    hits = banded.join(few(touched), ["query_id", "band"]).withColumn("rank", rank)
    kept = hits.filter((F.col("rank") > first) & (F.col("rank") <= first + F.col("size")))
    return kept.select("query_id", "doc_key", "score", "rank", "page", "size")


def with_documents(hits: DataFrame, index: Index, queries: DataFrame, vectors: bool = False) -> DataFrame:
    """Stored fields of page hits. Page hits number at most queries x size; the stored documents of other buckets are not read."""
    bound = queries.agg(F.sum("size")).first()[0] or 0
    return stored_documents(index, hits, small=bound <= HITS_IN_MEMORY, vectors=vectors and index.stored is not None)


def with_snippets(found: DataFrame, index: Index, stop: list[str] | None = None) -> DataFrame:
    """Adds snippets to page hits(content, cleaned, terms): the matching places come from stored term vectors where there are some."""
    places = F.col("ranges") if index.stored is not None else term_ranges(F.col("content"), F.col("terms"))
    if index.stored is not None:
        # A column of its own, so that the places are gathered once for all uses in the snippet.
        gathered = F.explode(F.array(stored_ranges(F.col("content_terms"), F.col("terms"))))
        found = found.select(*found.columns, gathered.alias("ranges")).drop(*VECTOR_COLUMNS)
    return found.withColumn("snippet", snippet(F.col("content"), F.col("cleaned"), places, stop)).drop("ranges")


def one_per_title(hits: DataFrame) -> DataFrame:
    """First hit of a page per title, ignoring case and outer blanks; at most 50 rows per page."""
    keyed = hits.withColumn("title_key", title_key(F.col("title")))
    order = Window.partitionBy("query_id", "title_key").orderBy("rank")
    return keyed.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def results(
    index: Index, queries: DataFrame, scored: DataFrame | None = None, stop: list[str] | None = None
) -> DataFrame:
    """Result rows of every requested page, with snippet and relevance tier."""
    scored = scores(index, queries, stop) if scored is None else scored
    found = with_documents(pages(scored, queries), index, queries, vectors=True)
    kept = one_per_title(found).join(totals(scored), "query_id")
    cleaned = queries.select("query_id", clean_query(F.col("q"), stop).alias("cleaned"))
    cleaned = cleaned.withColumn("terms", analyze(F.col("cleaned")))
    return with_snippets(kept.join(cleaned, "query_id"), index, stop).select(
        "query_id", "rank", "doc_key", *(safe_string(F.col(c)).alias(c) for c in ("url", "title", "file_path", "file_type")), "score", "total",
        "snippet",
        relevance(F.col("score"), F.col("max_score")).alias("relevance"),
    )
