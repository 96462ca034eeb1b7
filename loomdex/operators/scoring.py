"""Scores of query terms against the postings of a document, by Arrow batches inside the tasks.

Joined row by row, every posting meets every query that holds its term, and all those matches would be shuffled and
grouped. Here only postings of query terms are shuffled, once, by document; a task adds up the matches of a document
from arrays of the terms' weights, whose size the caller has checked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.operators.index import ALL, FIELDS
from loomdex.operators.vectors import Block, listed

# Matches added up at a time, and cells of a documents x queries grid that go with them.
MATCHES = 1 << 20
# Scores are ranked by nine digits; what lies closer than this to the last rank is kept.
ROUNDING = 1e-8


class Weights:
    """Weights of query terms as arrays: the entries of code c, a field and term, lie at starts[c]:starts[c + 1]."""

    def __init__(self, table: pa.Table, fields: tuple[str, ...], per_field: bool):
        codes = pa.array(np.arange(table.num_rows), pa.int64())
        table = table.append_column("_row", codes).combine_chunks()
        names = pc.binary_join_element_wise(table.column("field"), table.column("term"), "\u0000").combine_chunks().dictionary_encode()
        code = names.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        self.starts = np.searchsorted(code[order], np.arange(len(names.dictionary) + 1))
        first = pa.array(order[self.starts[:-1]])
        self.keys = pa.table({"field": table.column("field").take(first), "term": table.column("term").take(first), "code": pa.array(np.arange(len(first), dtype=np.int32))})
        self.field = np.array([fields.index(f) for f in self.keys.column("field").to_pylist()], np.int64)
        # A group is a query; where scores stay apart by field, of one number of terms.
        parts = ["query_id", "n_terms"] if per_field else ["query_id"]
        groups = table.select([*parts, "_row"]).group_by(parts).aggregate([("_row", "list")]).combine_chunks()
        listed = groups.column("_row_list").combine_chunks()
        of_row = np.empty(table.num_rows, np.int64)
        of_row[pc.list_flatten(listed).to_numpy()] = pc.list_parent_indices(listed).to_numpy()
        self.query_ids = groups.column("query_id").combine_chunks()
        self.group = of_row[order]
        self.reps, self.n_terms, self.weight = (
            table.column(c).to_numpy()[order].astype(t) for c, t in (("reps", np.float64), ("n_terms", np.int64), ("weight", np.float64))
        )
        sizes = np.zeros(len(self.query_ids), np.int64)
        np.maximum.at(sizes, self.group, self.n_terms)
        self.size_of_group = sizes
        self.one_size = bool((sizes[self.group] == self.n_terms).all())

    def add_up(self, doc: np.ndarray, code: np.ndarray, density: np.ndarray, n_fields: int):
        """(document, group, raw by field, hits by field, n_terms) of every pair with a match."""
        counts = self.starts[code + 1] - self.starts[code]
        row = np.repeat(np.arange(len(code)), counts)
        entry = np.arange(len(row)) + np.repeat(self.starts[code] - (np.cumsum(counts) - counts), counts)
        n_groups = len(self.query_ids)
        cell, cells = doc[row] * n_groups + self.group[entry], (doc[-1] + 1) * n_groups
        if cells > 4 * len(cell) + 1024:
            named, cell = np.unique(cell, return_inverse=True)
            cells = len(named)
        else:
            named = np.arange(cells)
        part, reps = self.weight[entry] * density[row], self.reps[entry]
        field = self.field[code][row] if n_fields > 1 else None
        raw, hits = np.empty((n_fields, cells)), np.empty((n_fields, cells))
        for f in range(n_fields):
            here = slice(None) if field is None else field == f
            raw[f] = np.bincount(cell[here], part[here], cells)
            hits[f] = np.bincount(cell[here], reps[here], cells)
        sizes = self.size_of_group[named % n_groups]
        if not self.one_size:
            sizes = np.zeros(cells, np.int64)
            np.maximum.at(sizes, cell, self.n_terms[entry])
        found = np.flatnonzero(hits.sum(axis=0))
        return named[found] // n_groups, named[found] % n_groups, raw[:, found], hits[:, found], sizes[found]


def _documents(batches: Iterator[pa.RecordBatch], starts: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, document, code, density) of whole documents: rows come sorted by document, a part of them at a time."""
    rest = None
    for batch in batches:
        rows = pa.table([*batch.columns], names=batch.schema.names)
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        docs = _numbered(rows)
        whole = int(np.searchsorted(docs, docs[-1]))
        yield from _parts(rows.slice(0, whole), docs[:whole], starts)
        rest = rows.slice(whole)
    if rest is not None and rest.num_rows:
        yield from _parts(rest, _numbered(rest), starts)


def _numbered(rows: pa.Table) -> np.ndarray:
    keys = rows.column("doc_key").combine_chunks().dictionary_encode(null_encoding="encode")
    return keys.indices.to_numpy().astype(np.int64)


def _parts(rows: pa.Table, docs: np.ndarray, starts: np.ndarray):
    keys, n_tokens = rows.column("doc_key").combine_chunks(), rows.column("n_tokens").to_numpy()
    row, code = listed(rows.column("code").combine_chunks())
    code, docs = code.to_numpy(), docs[row]
    density = np.sqrt(listed(rows.column("tf").combine_chunks())[1].to_numpy()) / np.sqrt(n_tokens[row])
    matches = np.cumsum(starts[code + 1] - starts[code]) // MATCHES
    at = 0
    while at < len(docs):
        # Up to the end of the document in which the next million of matches is reached.
        last = min(int(np.searchsorted(matches, matches[at], "right")), len(docs)) - 1
        stop = int(np.searchsorted(docs, docs[last], "right"))
        first = np.flatnonzero(np.diff(docs[at:stop], prepend=-1)) + at
        yield keys.take(pa.array(row[first])), docs[at:stop] - docs[at], code[at:stop], density[at:stop]
        at = stop


def _dealt(post: DataFrame, weights: Weights, live: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """(doc_key, n_tokens, code, tf): a row lists the query terms that a field of a document has in a block; rows of a document come together.

    `post` holds blocks of postings, or a row for each; `live` leaves out replaced documents of blocks.
    """
    if "keys" in post.columns:
        rows = _of_blocks(post, weights)
        rows = (live(rows) if live else rows).drop("gen")
    else:
        codes = F.broadcast(post.sparkSession.createDataFrame(weights.keys, "field string, term string, code int"))
        rows = post.join(codes, ["field", "term"]).select("doc_key", "n_tokens", F.array("code").alias("code"), F.array(F.col("tf").cast("int")).alias("tf"))
    return rows.repartition("doc_key").sortWithinPartitions("doc_key")


def _of_blocks(blocks: DataFrame, weights: Weights) -> DataFrame:
    """(gen, doc_key, n_tokens, code, tf): the postings of query terms in blocks, listed by document and field."""
    shared = blocks.sparkSession.sparkContext.broadcast(weights.keys)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        asked = {}
        for name in sorted(set(keys.column("field").to_pylist())):
            of_field = keys.filter(pc.equal(keys.column("field"), name))
            asked[name] = of_field.column("term").combine_chunks(), of_field.column("code").to_numpy()
        for batch in batches:
            block = Block(batch, list(FIELDS), ALL)
            for name, (terms, codes) in asked.items():
                place = pc.fill_null(pc.index_in(block.terms, value_set=terms), -1).to_numpy(zero_copy_only=False)
                tf = block.tf(name)
                here = np.flatnonzero((place[block.term] >= 0) & (tf > 0))
                here = here[np.argsort(block.doc[here], kind="stable")]
                doc, code = block.doc[here], codes[place[block.term[here]]]
                heads = np.flatnonzero(np.diff(doc, prepend=-1))
                named, offsets = pa.array(doc[heads]), pa.array(np.append(heads, len(doc)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int32))) for c in (code, tf[here])]
                gens = batch.column("gen").take(pa.array(block.block_of_key)).take(named)
                yield pa.RecordBatch.from_arrays(
                    [gens, block.keys.take(named), pa.array(block.tokens(name)[doc[heads]]), *lists], ["gen", "doc_key", "n_tokens", "code", "tf"]
                )

    columns = [c for c in blocks.columns if c != "term_bucket"]
    return blocks.select(*columns).mapInArrow(rows, "gen int, doc_key string, n_tokens bigint, code array<int>, tf array<int>")


def combined(
    post: DataFrame, weights: DataFrame, fields: tuple[str, ...], best: int | None = None, live: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(query_id, doc_key, score): `search.combined_scores` of the matches, before rounding.

    With `best`, documents that cannot be among so many best ones of a query may be left out.
    """
    known = Weights(weights.toArrow(), fields, per_field=False)
    shared = post.sparkSession.sparkContext.broadcast(known)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        floor = np.full(len(w.query_ids), -np.inf)
        for keys, doc, code, density in _documents(batches, w.starts):
            docs, group, raw, hits, sizes = w.add_up(doc, code, density, len(fields))
            total = (raw * hits / sizes).sum(axis=0)
            if len(fields) > 1:
                total = total * (hits > 0).sum(axis=0) / len(fields)
            if best:
                kept = _may_rank(group, total, floor, best)
                docs, group, total = docs[kept], group[kept], total[kept]
            yield pa.RecordBatch.from_arrays(
                [w.query_ids.take(pa.array(group)), keys.take(pa.array(docs)), pa.array(total)], ["query_id", "doc_key", "score"]
            )

    dealt = _dealt(post, known, live)
    types = dict(weights.dtypes) | dict(dealt.dtypes)
    return dealt.mapInArrow(score, f"query_id {types['query_id']}, doc_key {types['doc_key']}, score double")


def _may_rank(group: np.ndarray, score: np.ndarray, floor: np.ndarray, best: int) -> np.ndarray:
    """Rows not below the best-th score of their group seen so far; `floor` keeps these scores from call to call."""
    rows = np.flatnonzero(score >= floor[group] - ROUNDING)
    order = rows[np.lexsort((-score[rows], group[rows]))]
    sorted_group = group[order]
    place = np.arange(len(order)) - np.searchsorted(sorted_group, sorted_group)
    nth = order[place == best - 1]
    floor[group[nth]] = np.maximum(floor[group[nth]], score[nth])
    return rows[score[rows] >= floor[group[rows]] - ROUNDING]


def by_field(
    post: DataFrame, weights: DataFrame, fields: tuple[str, ...], live: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(query_id, doc_key, field, matched, score): `search.field_scores` of the matches."""
    known = Weights(weights.toArrow(), fields, per_field=True)
    shared = post.sparkSession.sparkContext.broadcast(known)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for keys, doc, code, density in _documents(batches, w.starts):
            docs, group, raw, hits, sizes = w.add_up(doc, code, density, len(fields))
            for f, name in enumerate(fields):
                here = np.flatnonzero(hits[f])
                yield pa.RecordBatch.from_arrays(
                    [w.query_ids.take(pa.array(group[here])), keys.take(pa.array(docs[here])), pa.repeat(pa.scalar(name), len(here)),
                     pa.array(hits[f][here].astype(np.int64)), pa.array(raw[f][here] * hits[f][here] / sizes[here])],
                    ["query_id", "doc_key", "field", "matched", "score"],
                )

    dealt = _dealt(post, known, live)
    types = dict(weights.dtypes) | dict(dealt.dtypes)
    schema = f"query_id {types['query_id']}, doc_key {types['doc_key']}, field string, matched bigint, score double"
    return dealt.mapInArrow(score, schema)
