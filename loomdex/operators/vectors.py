"""Term vectors and their postings for whole tables, by Arrow batches inside the tasks.

The column form (`index.term_vector`) scans every token several times in interpreted array functions and stems each
occurrence. Here Spark still marks and folds the tokens of a text; a task only counts, and stems a token once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.functions.analysis import TOKEN
from loomdex.functions.arrays import MARK, marked
from loomdex.functions.stemmer import index_term
from loomdex.functions.text import fold_case

VECTOR = "array<struct<term:string,tf:bigint,locs:array<struct<pos:int,start:int,end:int,first:int,last:int>>>>"
PLACES = ("pos", "start", "end", "first", "last")
# The same as stored, in small numbers that take little disk: places in the order of the text, `of` being the place of their term in
# `term`. `pos` counts from the place before, `start` from its end and `end` from the own start, in bytes; `first` and `last` say by how
# much the same steps differ in characters.
STORED = "struct<term:array<string>,tf:array<bigint>,of:array<int>," + ",".join(f"{p}:array<int>" for p in PLACES) + ">"
# Texts turned into one Arrow batch: a batch of 10,000 long texts would not fit beside its vectors.
TEXTS = 256
# Postings put in order by term at a time, so that a term has one block for all documents of them.
POSTINGS = 1 << 20


def _ends(parts: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
    """Byte and character offsets behind every part."""
    chars = np.cumsum(np.fromiter(map(len, parts), np.int32, len(parts)), dtype=np.int32)
    if plain:
        return chars, chars
    return np.cumsum(np.fromiter(map(len, map(str.encode, parts)), np.int32, len(parts)), dtype=np.int32), chars


def _lengths_to_offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))


def _parts_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Marked texts cut at their marks, as one array, and the number of parts of each; none of a null text."""
    cut = pc.split_pattern(texts, MARK)
    return pc.list_flatten(cut), pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _offsets(lengths: pa.Array, first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts `at` start and end in their texts, whose parts begin at `first`."""
    ends = np.concatenate(([0], np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)))
    return (ends[at] - ends[first]).astype(np.int32), (ends[at + 1] - ends[first]).astype(np.int32)


def _located(texts: pa.Array, folded: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Terms of marked texts by text and term, their texts and counts, and the columns `PLACES` of all places.

    Parts of a text are gap, token, gap, ..., gap. A different token is stemmed once for all texts; occurrences are put
    in order by numbers of text and term.
    """
    parts, sizes = _parts_of(texts)
    low, _ = _parts_of(folded)
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - first[row]
    at = np.flatnonzero(place % 2)
    tokens = low.take(pa.array(at)).dictionary_encode()
    found = [index_term(t) for t in tokens.dictionary.to_pylist()]
    names = sorted({t for t in found if t is not None})
    number = {t: i for i, t in enumerate(names)}
    term = np.array([number.get(t, -1) for t in found], np.int64)[tokens.indices.to_numpy(zero_copy_only=False)]
    at, term = at[term >= 0], term[term >= 0]
    key = row[at] * (len(names) + 1) + term
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    entry = np.flatnonzero(np.diff(key, prepend=-1))
    counts = np.diff(np.append(entry, len(key)))
    begin = first[row[at]]
    octets, chars = _offsets(pc.binary_length(parts), begin, at), _offsets(pc.utf8_length(parts), begin, at)
    columns = [((place[at] + 1) // 2).astype(np.int32), *octets, *chars]
    return pa.array(names, pa.string()).take(pa.array(term[order][entry])), row[at[entry]], counts, columns


def vectors_of(texts: pa.Array, folded: pa.Array) -> pa.Array:
    """Term vectors of marked texts; null for a text without terms."""
    terms, row, counts, columns = _located(texts, folded)
    per_text = np.bincount(row, minlength=len(texts))
    locs = pa.ListArray.from_arrays(_lengths_to_offsets(counts), pa.StructArray.from_arrays([pa.array(c) for c in columns], list(PLACES)))
    entries = pa.StructArray.from_arrays([terms, pa.array(counts, pa.int64()), locs], ["term", "tf", "locs"])
    return pa.ListArray.from_arrays(_lengths_to_offsets(per_text), entries, mask=pa.array(per_text == 0))


def stored_vectors_of(texts: pa.Array, folded: pa.Array) -> pa.Array:
    """`vectors_of` in the layout `STORED`."""
    terms, row, counts, columns = _located(texts, folded)
    per_text = np.bincount(row, minlength=len(texts))
    entry = np.repeat(np.arange(len(row)), counts)
    order = np.lexsort((columns[0], row[entry]))
    pos, start, end, first, last = (c[order] for c in columns)
    entry = entry[order]
    heads = np.flatnonzero(np.diff(row[entry], prepend=-1))

    def since(now: np.ndarray, before: np.ndarray) -> np.ndarray:
        earlier = np.concatenate((now[:0], [0], before[:-1]))[: len(now)]
        earlier[heads] = 0
        return now - earlier

    gap = since(start, end)
    steps = [entry - (np.cumsum(per_text) - per_text)[row[entry]], since(pos, pos), gap, end - start, since(first, last) - gap, (last - first) - (end - start)]
    lists = [pa.ListArray.from_arrays(_lengths_to_offsets(per_text), c) for c in (terms, pa.array(counts, pa.int64()))]
    per_place = np.bincount(row, counts, len(texts)).astype(np.int64)
    lists += [pa.ListArray.from_arrays(_lengths_to_offsets(per_place), pa.array(c.astype(np.int32))) for c in steps]
    return pa.StructArray.from_arrays(lists, ["term", "tf", "of", *PLACES], mask=pa.array(per_text == 0))


def _lower(text: Column) -> Column:
    """`fold_case` of a valid text without a step for every character."""
    return F.lower(F.replace(F.replace(text, F.lit("İ"), F.lit("i")), F.lit("Σ"), F.lit("σ")))


def _marked(text: Column) -> Column:
    """Tokens of a valid text `marked`, without a step for every character."""
    return F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(" ")), TOKEN, f"{MARK}$0{MARK}")


def _with_vectors(docs: DataFrame, fields: Mapping[str, Column], build: Callable[[pa.Array, pa.Array], pa.Array], kind: str) -> DataFrame:
    kept, names = docs.columns, list(fields)
    # Two steps, so that a text is marked once.
    texts = docs.select(*kept, *(_marked(F.make_valid_utf8(fields[n])).alias(f"_{n}") for n in names))
    texts = texts.select("*", *(_lower(F.col(f"_{n}")).alias(f"_{n}_low") for n in names))

    def analyse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                made = [build(part.column(f"_{n}"), part.column(f"_{n}_low")) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(kept))] + made, [*kept, *(f"{n}_terms" for n in names)]
                )

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), *(f"{n}_terms {kind}" for n in names)])
    return texts.mapInArrow(analyse, schema)


def term_vectors(docs: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """`docs` with a column `<field>_terms` for every field: its `index.term_vector`. No shuffle."""
    return _with_vectors(docs, fields, vectors_of, VECTOR)


def stored_vectors(docs: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """`term_vectors` in the layout `STORED`, which is written and read without an object for every place and takes less disk."""
    return _with_vectors(docs, fields, stored_vectors_of, STORED)


def token_rows(docs: DataFrame, text: Column, *kept: str) -> DataFrame:
    """(kept..., pos, start, end, token): `analysis.token_spans` of every text as rows, offsets in bytes. No shuffle."""
    types = dict(docs.dtypes)

    def spans_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, sizes, columns = [], [], [[np.empty(0, np.int64)] for _ in range(3)]
        for marks, low in zip(batch.column("_text").to_pylist(), batch.column("_low").to_pylist()):
            found = [] if marks is None else low.split(MARK)[1::2]
            sizes.append(len(found))
            if found:
                tokens += found
                octets = _ends(marks.split(MARK), marks.isascii())[0].astype(np.int64)
                for column, values in zip(columns, (np.arange(1, len(found) + 1), octets[:-1:2], octets[1::2])):
                    column.append(values)
        rows = np.repeat(np.arange(batch.num_rows), sizes)
        parts = [batch.column(c).take(pa.array(rows)) for c in kept] + [pa.array(np.concatenate(c)) for c in columns]
        return pa.RecordBatch.from_arrays([*parts, pa.array(tokens, pa.string())], [*kept, "pos", "start", "end", "token"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                yield spans_of(batch.slice(at, TEXTS))

    marks = F.make_valid_utf8(marked(text, TOKEN))
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "pos bigint, start bigint, end bigint, token string"])
    return docs.select(*kept, marks.alias("_text"), fold_case(marks).alias("_low")).mapInArrow(rows, schema)


def index_terms(docs: DataFrame, text: Column, *kept: str) -> DataFrame:
    """(kept..., terms): `analysis.analyze` of every text, joined by blanks; null for a null text. No shuffle."""
    types = dict(docs.dtypes)

    def joined(marks: str) -> str:
        return " ".join(t for t in map(index_term, marks.split(MARK)[1::2]) if t is not None)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                terms = [None if m is None else joined(m) for m in part.column("_marks").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(terms, pa.string())], [*kept, "terms"])

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "terms string"])
    return docs.select(*kept, F.make_valid_utf8(marked(fold_case(text), TOKEN)).alias("_marks")).mapInArrow(rows, schema)


def _postings_of(batch: pa.RecordBatch, kept: list[str], fields: list[str], merged: str | None) -> Iterator[pa.RecordBatch]:
    tables = []
    for f in fields:
        listed = batch.column(f"{f}_names")
        tables.append(pa.table({
            "row": pc.cast(pc.list_parent_indices(listed), pa.int64()), "term": pc.list_flatten(listed), "tf": pc.list_flatten(batch.column(f"{f}_tfs")),
        }))
    named = list(zip(fields, tables))
    if merged:
        both = pa.concat_tables(tables).group_by(["row", "term"]).aggregate([("tf", "sum")])
        named.append((merged, both.select(["row", "term", "tf_sum"]).rename_columns(["row", "term", "tf"])))
    for field, rows in named:
        if not rows.num_rows:
            continue
        rows = rows.combine_chunks()
        row, tf = (rows.column(c).combine_chunks() for c in ("row", "tf"))
        totals = np.zeros(batch.num_rows, np.int64)
        np.add.at(totals, row.to_numpy(), tf.to_numpy())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(row) for c in kept), pa.repeat(pa.scalar(field), len(row)), pa.array(totals[row.to_numpy()]),
             rows.column("term").combine_chunks(), tf],
            [*kept, "field", "n_tokens", "term", "tf"],
        )


def posting_rows(docs: DataFrame, kept: list[str], fields: list[str], merged: str | None = None) -> DataFrame:
    """(kept..., field, n_tokens, term, tf) of stored term vectors `<field>_terms`; `merged` names a further field that joins them all."""
    types = dict(docs.dtypes)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                yield from _postings_of(batch.slice(at, TEXTS), kept, fields, merged)

    # The positions stay behind: only terms and counts go to the Arrow batches.
    lists = [c for f in fields for c in (F.col(f"{f}_terms.term").alias(f"{f}_names"), F.col(f"{f}_terms.tf").alias(f"{f}_tfs"))]
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "field string, n_tokens bigint, term string, tf bigint"])
    return docs.select(*kept, *lists).mapInArrow(rows, schema)


def listed(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row and value of every item of a list column."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes)), sizes), pc.list_flatten(lists)


def block_columns(fields: list[str], merged: str) -> str:
    """Columns of a block of postings: the documents of a bucket of terms that were read together.

    `doc` lists the documents of every term one after another, `<merged>_df` of them, as places in `keys`; the first of a term is the
    place, the others the step from the one before. `<field>_tf` goes with it, 0 where the field has no such term; `<field>_tokens` goes with `keys`.
    """
    per_field = [f"{f}_tokens array<bigint>, {f}_df array<int>, {f}_tf array<int>" for f in fields]
    return ", ".join(["keys array<string>", "term array<string>", f"{merged}_df array<int>", "doc array<int>", *per_field])


def bucket_number(term: str, buckets: int) -> int:
    return zlib.crc32(term.encode()) % buckets


def _blocks_of(batch: pa.RecordBatch, fields: list[str], merged: str, buckets: int) -> Iterator[pa.RecordBatch]:
    n = batch.num_rows
    rows, terms = zip(*(listed(batch.column(f"{f}_names")) for f in fields))
    tfs = [listed(batch.column(f"{f}_tfs"))[1].to_numpy(zero_copy_only=False) for f in fields]
    coded = pa.concat_arrays(terms).dictionary_encode()
    if not len(coded):
        return
    # Numbers of terms in the order of buckets and terms.
    names = coded.dictionary.to_pylist()
    bucket = np.array([bucket_number(t, buckets) for t in names], np.int64)
    by_bucket = sorted(range(len(names)), key=lambda i: (bucket[i], names[i]))
    number = np.empty(len(names), np.int64)
    number[by_bucket] = np.arange(len(names))
    ordered, bucket = coded.dictionary.take(pa.array(by_bucket)), bucket[by_bucket]
    pairs, place = np.unique(number[coded.indices.to_numpy(zero_copy_only=False)] * n + np.concatenate(rows), return_inverse=True)
    term, row = pairs // n, pairs % n
    found = []
    for at, tf in zip(np.split(place, np.cumsum([len(r) for r in rows])[:-1]), tfs):
        found.append(np.zeros(len(pairs), np.int64))
        np.add.at(found[-1], at, tf)
    # Documents of a bucket, by their own numbers in it.
    held, at = np.unique(bucket[term] * n + row, return_inverse=True)
    present, first_doc = np.unique(held // n, return_index=True)
    number = at - first_doc[np.searchsorted(present, bucket[term])]
    heads = np.flatnonzero(np.diff(term, prepend=-1))
    steps = np.diff(number, prepend=0)
    steps[heads] = number[heads]

    def by_block(values, owner: np.ndarray) -> pa.Array:
        offsets = np.append(np.searchsorted(owner, present), len(owner)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))

    of_doc, of_term, of_pair = held // n, bucket[term[heads]], bucket[term]
    made = {
        "term_bucket": pa.array(present.astype(np.int32)), "keys": by_block(batch.column("doc_key").take(pa.array(held % n)), of_doc),
        "term": by_block(ordered.take(pa.array(term[heads])), of_term), f"{merged}_df": by_block(np.diff(np.append(heads, len(term))).astype(np.int32), of_term),
        "doc": by_block(steps.astype(np.int32), of_pair),
    }
    for f, r, tf, here in zip(fields, rows, tfs, found):
        totals = np.zeros(n, np.int64)
        np.add.at(totals, r, tf)
        made[f"{f}_tokens"] = by_block(totals[held % n], of_doc)
        made[f"{f}_df"] = by_block(np.add.reduceat(here > 0, heads, dtype=np.int32), of_term)
        made[f"{f}_tf"] = by_block(here.astype(np.int32), of_pair)
    yield pa.RecordBatch.from_pydict(made)


def posting_blocks(docs: DataFrame, fields: list[str], merged: str, buckets: int = 1) -> DataFrame:
    """(term_bucket, `block_columns`): `posting_rows` of documents that are read together, a row for each bucket of terms. No shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = sum(pc.fill_null(pc.list_value_length(batch.column(f"{f}_names")), 0).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields)
            ends, at = np.cumsum(sizes), 0
            while at < batch.num_rows:
                # At least one document, however long.
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POSTINGS, "right")))
                yield from _blocks_of(batch.slice(at, stop - at), fields, merged, buckets)
                at = stop

    lists = [c for f in fields for c in (F.col(f"{f}_terms.term").alias(f"{f}_names"), F.col(f"{f}_terms.tf").alias(f"{f}_tfs"))]
    return docs.select("doc_key", *lists).mapInArrow(rows, f"term_bucket int, {block_columns(fields, merged)}")


class Block:
    """Blocks of postings as flat arrays: numbers of term and document of every posting, both counted through all blocks of a batch."""

    def __init__(self, batch: pa.RecordBatch, fields: list[str], merged: str):
        self.fields, self.merged = fields, merged
        of_block, keys = listed(batch.column("keys"))
        self.keys, self.block_of_key = keys, of_block
        of_term, self.terms = listed(batch.column("term"))
        df = listed(batch.column(f"{merged}_df"))[1].to_numpy(zero_copy_only=False).astype(np.int64)
        self.block_of_term = of_term
        self.term = np.repeat(np.arange(len(df)), df)
        steps = listed(batch.column("doc"))[1].to_numpy(zero_copy_only=False).astype(np.int64)
        # Steps add up within a term and start at the first document of its block.
        ends, heads = np.cumsum(steps), np.cumsum(df) - df
        first_key = np.searchsorted(of_block, of_term)
        self.doc = ends - (ends[heads] - steps[heads] - first_key)[self.term] if len(steps) else steps
        self.tf_of = {f: listed(batch.column(f"{f}_tf"))[1].to_numpy(zero_copy_only=False).astype(np.int64) for f in fields}
        self.tokens_of = {f: listed(batch.column(f"{f}_tokens"))[1].to_numpy(zero_copy_only=False).astype(np.int64) for f in fields}

    def tf(self, name: str) -> np.ndarray:
        return sum(self.tf_of.values()) if name == self.merged else self.tf_of[name]

    def tokens(self, name: str) -> np.ndarray:
        """Tokens of every document."""
        return sum(self.tokens_of.values()) if name == self.merged else self.tokens_of[name]


def listed_postings(blocks: DataFrame, fields: list[str], merged: str, names: list[str]) -> DataFrame:
    """(gen, field, term, docs) of blocks of postings: the documents of a term that were read together, for the fields `names`."""
    columns = [c.split()[0] for c in block_columns(fields, merged).split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from terms_of(batch.slice(at, 1))

    def terms_of(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = Block(part, fields, merged)
        for name in names:
            tf = block.tf(name)
            here = np.flatnonzero(tf)
            heads = np.flatnonzero(np.diff(block.term[here], prepend=-1))
            doc = block.doc[here]
            docs = pa.StructArray.from_arrays(
                [block.keys.take(pa.array(doc)), pa.array(block.tokens(name)[doc]), pa.array(tf[here])], ["doc_key", "n_tokens", "tf"]
            )
            terms = block.terms.take(pa.array(block.term[here][heads]))
            gens = part.column("gen").take(pa.array(np.zeros(len(heads), np.int64)))
            listed = pa.ListArray.from_arrays(pa.array(np.append(heads, len(here)).astype(np.int32)), docs)
            yield pa.RecordBatch.from_arrays([gens, pa.repeat(pa.scalar(name), len(heads)), terms, listed], ["gen", "field", "term", "docs"])

    return blocks.select("gen", *columns).mapInArrow(
        rows, "gen int, field string, term string, docs array<struct<doc_key:string,n_tokens:bigint,tf:bigint>>"
    )
