"""Spelling suggestions for a table of queries (query_id, q)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdex.functions.analysis import analyze, is_query_stop
from loomdex.functions.text import fold_case, words
from loomdex.operators.index import everything
from loomdex.operators.search import lookup, ranked, rounded_scores, term_weights
from loomdex.session import cut_lineage, fits_broadcast
from loomdex.sources.store import Index, key_bucket, stored_documents

FUZZINESS = 2
TOP_DOCS = 3
MAX_DISTANCE = 3
FIELD = ("all",)


def meaningful_words(q: Column, stop: list[str] | None = None) -> Column:
    return F.filter(
        F.transform(words(q), fold_case), lambda w: ~is_query_stop(w, stop) & (F.length(w) > 2)
    )


def segment_keys(term: Column, k: int = FUZZINESS) -> Column:
    """k+1 pieces of a vocabulary term as (length, piece number, piece).

    A term within k edits of another keeps at least one piece unchanged, moved by at most k
    characters. Equal pieces are therefore an equi-join key that misses nothing.
    """
    n = F.length(term)

    def cut(i: int) -> Column:
        first, stop = F.floor(n * i / (k + 1)).cast("int"), F.floor(n * (i + 1) / (k + 1)).cast("int")
        return F.struct(
            n.cast("int").alias("len"), F.lit(i).alias("no"), F.substring(term, first + 1, stop - first).alias("piece")
        )

    return F.array(*[cut(i) for i in range(k + 1)])


def probe_keys(term: Column, k: int = FUZZINESS) -> Column:
    """All pieces of `term` that a vocabulary term within k edits could share with it.

    With a piece moved by x and lengths differing by d, the text before it takes |x| edits and the
    text after it |d - x|, so only shifts with |x| + |d - x| <= k are tried.
    """
    n = F.length(term)

    def shifted(size: Column, i: int) -> Column:
        first = F.floor(size * i / (k + 1)).cast("int")
        width = F.floor(size * (i + 1) / (k + 1)).cast("int") - first
        lo = F.greatest(F.lit(0), first + F.ceil((n - size - k) / 2).cast("int"))
        hi = F.least(n - width, first + F.floor((n - size + k) / 2).cast("int"))
        return F.when(hi >= lo, F.transform(F.sequence(lo, hi), lambda p: F.struct(
            size.cast("int").alias("len"), F.lit(i).alias("no"), F.substring(term, p + 1, width).alias("piece")
        )))

    def of_length(size: Column) -> Column:
        return F.flatten(F.filter(F.array(*[shifted(size, i) for i in range(k + 1)]), lambda a: a.isNotNull()))

    sizes = F.sequence(F.greatest(F.lit(1), n - k), n + k)
    return F.array_distinct(F.flatten(F.transform(sizes, of_length)))


def similar_terms(terms: DataFrame, vocabulary: DataFrame, small: bool, k: int = FUZZINESS) -> DataFrame:
    """(term, similar) pairs within k edits, joined on shared pieces instead of all pairs."""
    # A term gives many probes, so it is their table whose size is checked.
    probes = terms.select("term", F.explode(probe_keys(F.col("term"), k)).alias("key"))
    small = small and fits_broadcast(probes, "term")
    known = vocabulary.select(
        F.col("term").alias("similar"), F.explode(segment_keys(F.col("term"), k)).alias("key")
    )
    pairs = known.join(F.broadcast(probes) if small else probes, "key")
    near = pairs.filter(F.levenshtein(F.col("term"), F.col("similar"), k) >= 0)
    return near.select("term", "similar").distinct()


def stored_similar_terms(terms: DataFrame, index: Index, small: bool, k: int = FUZZINESS) -> DataFrame:
    """`similar_terms` over the stored pieces of an index: only the buckets of the probes' pieces are read."""
    probes = terms.select("term", F.explode(probe_keys(F.col("term"), k)).alias("key"))
    probes = probes.select("term", "key.*", key_bucket(F.col("key"), index.buckets).alias("key_bucket"))
    small = small and fits_broadcast(probes, "term")
    known = index.keys.select("key_bucket", "len", "no", "piece", F.col("term").alias("similar"))
    pairs = known.join(F.broadcast(probes) if small else probes, ["key_bucket", "len", "no", "piece"])
    near = pairs.filter(F.levenshtein(F.col("term"), F.col("similar"), k) >= 0).select("term", "similar").distinct()
    if index.dead is None:
        return near
    return near.join(vocabulary(index).select(F.col("term").alias("similar")), "similar", "left_semi").select("term", "similar")


def vocabulary(index: Index) -> DataFrame:
    """Distinct index terms of title and content."""
    if index.term_df is not None:
        return index.term_df.filter("field = 'all'").select("term")
    from loomdex.operators.index import field_tokens
    from loomdex.functions.stemmer import stem_ru

    rows = field_tokens(index.docs, everything()).select(F.explode("tokens").alias("token")).distinct()
    return rows.select(stem_ru(F.col("token")).alias("term")).distinct()


def fuzzy_terms(index: Index, queries: DataFrame, small: bool, stop: list[str] | None = None) -> DataFrame:
    """(query_id, term, reps, n_terms): every index term within two edits of a query term."""
    asked = queries.select(
        "query_id", F.explode(analyze(F.array_join(meaningful_words(F.col("q"), stop), " "))).alias("term")
    )
    words_asked = asked.select("term").distinct()
    near = similar_terms(words_asked, vocabulary(index), small) if index.keys is None else stored_similar_terms(words_asked, index, small)
    expanded = asked.join(near, "term").groupBy("query_id", "similar").agg(F.count("*").alias("reps"))
    all_reps = F.sum("reps").over(Window.partitionBy("query_id"))
    return expanded.select("query_id", F.col("similar").alias("term"), "reps", all_reps.alias("n_terms"))


def fuzzy_documents(index: Index, queries: DataFrame, stop: list[str] | None = None) -> DataFrame:
    """(query_id, doc_key, score, rank): the three best documents for the fuzzy query."""
    small = fits_broadcast(queries, "q")
    # The expansion grows with the vocabulary, so its own size decides how it is joined. It is used
    # four times below and small next to the postings, so it is kept.
    expanded = cut_lineage(fuzzy_terms(index, queries, small, stop))
    small = small and fits_broadcast(expanded, "term")
    post, frequencies = lookup(index, expanded, small, fields=everything(), names=FIELD)
    weights = term_weights(expanded, frequencies, index.n_docs, FIELD)
    return cut_lineage(ranked(rounded_scores(index, post, weights, small, FIELD, TOP_DOCS), TOP_DOCS))


def document_words(docs: DataFrame, stop: list[str] | None = None) -> Column:
    """Distinct lower-case words of title and content, punctuation kept."""
    text = fold_case(F.concat_ws(" ", "title", "content"))
    return F.array_distinct(
        F.filter(words(text), lambda w: (F.length(w) > 2) & ~is_query_stop(w, stop))
    )


def fuzzy_vocabulary(top: DataFrame, index: Index, stop: list[str] | None = None) -> DataFrame:
    """(query_id, doc_key, words): words of the three documents, one row per document."""
    wanted = top.select("query_id", "doc_key")
    chosen = stored_documents(index, wanted, small=fits_broadcast(wanted, "doc_key"))
    return chosen.select("query_id", "doc_key", document_words(chosen, stop).alias("words"))


def nearest(word: Column, candidates: Column) -> Column:
    """struct<dist,word> of the nearest candidate within three edits; smallest word on ties."""
    bounded = F.filter(
        candidates, lambda c: F.abs(F.length(c) - F.length(word)) <= MAX_DISTANCE
    )
    near = F.transform(bounded, lambda c: F.struct(
        F.levenshtein(c, word, MAX_DISTANCE).alias("dist"), c.alias("word")
    ))
    return F.array_min(F.filter(near, lambda s: s["dist"] >= 0))


def corrections(queries: DataFrame, doc_words: DataFrame, stop: list[str] | None = None) -> DataFrame:
    """(query_id, word, correction) for query words that the three documents do not contain.

    Each document is searched inside its own row; only one best word per document is shuffled.
    """
    asked = queries.select("query_id", F.array_distinct(meaningful_words(F.col("q"), stop)).alias("asked"))
    per_doc = doc_words.join(asked, "query_id").select(
        "query_id",
        F.explode(F.transform("asked", lambda w: F.struct(
            w.alias("word"),
            F.array_contains(F.col("words"), w).alias("present"),
            F.when(~F.array_contains(F.col("words"), w), nearest(w, F.col("words"))).alias("best"),
        ))).alias("c"),
    ).select("query_id", "c.*")
    best = per_doc.groupBy("query_id", "word").agg(
        F.bool_or("present").alias("present"), F.min("best").alias("best")
    )
    return best.filter(~F.col("present") & F.col("best").isNotNull()).select(
        "query_id", "word", F.col("best.word").alias("correction"), F.col("best.dist").cast("bigint").alias("dist")
    )


def rebuilt(queries: DataFrame, found: DataFrame) -> DataFrame:
    """(query_id, suggestion): the query with its corrections; empty without any."""
    per_query = found.groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "correction"))).alias("fixed")
    )

    def fix(w: Column) -> Column:
        new = F.try_element_at(F.col("fixed"), fold_case(w))
        capital = F.concat(F.upper(F.substring(new, 1, 1)), F.substring(new, F.lit(2), F.length(new)))
        return F.when(new.isNull(), w).when(w.rlike(r"^\p{Lu}"), capital).otherwise(new)

    text = F.array_join(F.transform(words(F.col("q")), fix), " ")
    return queries.join(per_query, "query_id", "left").select(
        "query_id", F.when(F.col("fixed").isNull(), "").otherwise(text).alias("suggestion")
    )


def suggest(index: Index, queries: DataFrame, stop: list[str] | None = None) -> DataFrame:
    top = fuzzy_documents(index, queries, stop)
    doc_words = fuzzy_vocabulary(top, index, stop)
    return rebuilt(queries, corrections(queries, doc_words, stop))
