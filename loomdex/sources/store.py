"""Stored index: ordinary Parquet tables under versioned folders, plus append-only segments.

A version holds generations. The first is a whole corpus; each further one holds the documents of an update, with
their term vectors and postings, and the names of the rows it replaces (`dead`). Readers leave dead rows out;
merging writes the live rows of all generations as the first of a new version, without analysing a text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.operators.index import ALL, FIELDS, HOT_SPLITS, document_frequencies, field_columns, newest, vector_postings
# Documents are stored with their term vectors in the flat layout.
from loomdex.operators.vectors import STORED as _VECTOR, TEXTS, block_columns, listed_postings, posting_blocks, stored_vectors as term_vectors
from loomdex.session import cut_lineage, fits_broadcast, shuffles_dropped, small_batches

DOCUMENT_COLUMNS = ("doc_key", "url", "title", "content", "file_path", "file_type", "content_hash")
VECTOR_COLUMNS = tuple(f"{f}_terms" for f in FIELDS)
# Up to so many buckets a writer has a file for each; beyond, rows are dealt out by bucket first.
FEW_BUCKETS = 64
# Texts are dealt out in so many jobs, so that their shuffle files take that part of the disk at a time.
ROUNDS = 2
# Tables are read by these, so that a table or a generation without rows is one.
SCHEMAS = {
    "documents": ", ".join([*(f"{c} string" for c in DOCUMENT_COLUMNS), *(f"{c} {_VECTOR}" for c in VECTOR_COLUMNS), "gen int", "doc_bucket int"]),
    "postings": f"{block_columns(FIELDS, ALL)}, gen int, term_bucket int",
    "fuzzy_keys": "term string, len int, no int, piece string, gen int, key_bucket int",
}


@dataclass
class Index:
    """What a search needs. `term_df` is None when frequencies come from the postings at hand.

    Rows of a stored index carry the generation `gen` that wrote them; `dead(gen, doc_key)` names those replaced
    since, None where there was no update. `docs` holds live rows only. `post` holds blocks of postings: a row lists
    the documents of a bucket of terms that were read together (`postings_in` gives one row for each posting).
    """

    docs: DataFrame
    post: DataFrame | None = None
    term_df: DataFrame | None = None
    stats: DataFrame | None = None
    buckets: int = 1
    stored: DataFrame | None = None
    dead: DataFrame | None = None
    keys: DataFrame | None = None

    @property
    def n_docs(self) -> Column:
        return self.docs.agg(F.count("*")).scalar() if self.stats is None else self.stats.select("n_docs").scalar()

    def live(self, rows: DataFrame) -> DataFrame:
        return rows if self.dead is None else rows.join(self.dead, ["gen", "doc_key"], "left_anti")


def postings_in(blocks: DataFrame, names=(*FIELDS, ALL), wanted: DataFrame | None = None) -> DataFrame:
    """(gen, field, term, doc_key, n_tokens, tf) of blocks of postings, for the fields `names`; only those of `wanted(term)` on request."""
    listed = listed_postings(blocks, list(FIELDS), ALL, list(names))
    listed = listed if wanted is None else listed.join(wanted, "term", "left_semi")
    return listed.select("gen", "field", "term", F.explode("docs").alias("p")).select("gen", "field", "term", "p.*")


def posting_bucket(term: Column, buckets: int) -> Column:
    """`vectors.bucket_number` of a term."""
    return F.pmod(F.crc32(F.encode(term, "utf-8")), F.lit(buckets)).cast("int")


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def stored_documents(index: Index, keys: DataFrame, small: bool, vectors: bool = False) -> DataFrame:
    """Stored fields of the documents named by `keys(doc_key, ...)`, with all columns of `keys`; on request with term vectors.

    Stored documents lie in folders by key bucket, so a scan for some keys skips the other buckets.
    """
    if index.stored is None:
        return index.docs.join(F.broadcast(keys) if small else keys, "doc_key")
    wanted = ("gen", "doc_bucket", *DOCUMENT_COLUMNS, *(VECTOR_COLUMNS if vectors else ()))
    placed = keys.withColumn("doc_bucket", term_bucket(F.col("doc_key"), index.buckets))
    found = index.stored.select(*wanted).join(F.broadcast(placed) if small else placed, ["doc_bucket", "doc_key"])
    return index.live(found).drop("doc_bucket", "gen")


def append_segment(docs: DataFrame, path: str, segment: int) -> None:
    """Write one batch of documents; writing the same batch again replaces it."""
    docs.write.mode("overwrite").parquet(f"{path}/segments/segment={segment}")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/segments").parquet(f"{path}/segments/segment=*")


def _parts(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _write_bucketed(
    rows: DataFrame, path: str, bucket: str, order: tuple[str, ...], spread_by: str | Column = "doc_key",
    analysed: dict[str, Column] | None = None, rounds: int = 1,
) -> None:
    """One table laid out by bucket. A salt by `spread_by` spreads a bucket over several writers, so one very
    frequent term does not end up in a single task. The term vectors of the `analysed` fields are made behind the shuffle.

    The salt is another hash than the bucket's: of the same one, rows of a document bucket would all have one salt.
    """
    salt = F.pmod(F.hash(spread_by), F.lit(HOT_SPLITS * rounds))
    for n in range(rounds):
        some = rows if rounds == 1 else rows.filter(salt % rounds == n)
        dealt = some.repartition(_parts(rows.sparkSession), bucket, salt)
        if analysed:
            dealt = term_vectors(dealt, analysed)
        _write(dealt.sortWithinPartitions(bucket, *order), path, bucket, "append" if n else "overwrite")


def _write(rows: DataFrame, path: str, bucket: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("compression", "zstd").partitionBy(bucket).parquet(path)


def _write_documents(current: DataFrame, home: str, gen: int, buckets: int, analyse: bool) -> None:
    """Documents with their term vectors, by key bucket, sorted by key."""
    rows = current.select(
        *DOCUMENT_COLUMNS, *(() if analyse else VECTOR_COLUMNS), term_bucket(F.col("doc_key"), buckets).alias("doc_bucket")
    )
    with small_batches(rows.sparkSession, TEXTS):
        _write_bucketed(rows, f"{home}/documents/gen={gen}", "doc_bucket", ("doc_key",), analysed=field_columns() if analyse else None, rounds=ROUNDS)


def _write_postings(home: str, gen: int, buckets: int, spark: SparkSession) -> DataFrame:
    """Postings of a generation from its term vectors; returns its document frequencies.

    A writer makes the blocks of the documents that it reads, so postings are not shuffled.
    """
    documents = _read(spark, home, "documents", gen)
    blocks = posting_blocks(documents.coalesce(_parts(spark)), list(FIELDS), ALL, buckets)
    if buckets > FEW_BUCKETS:
        blocks = blocks.repartition(_parts(spark), "term_bucket", F.pmod(F.hash(F.element_at("keys", 1)), F.lit(HOT_SPLITS)))
    _write(blocks.sortWithinPartitions("term_bucket"), f"{home}/postings/gen={gen}", "term_bucket")
    # A document is in one block of a term only.
    names = [*FIELDS, ALL]
    listed = F.explode(F.arrays_zip("term", *(f"{f}_df" for f in names))).alias("t")
    counts = _read(spark, home, "postings", gen).select(listed).groupBy("t.term").agg(*(F.sum(f"t.{f}_df").alias(f) for f in names))
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("df")) for f in names))).alias("f")
    return counts.select("term", each).select("f.field", "term", "f.df").filter("df > 0")


def _read(spark: SparkSession, home: str, name: str, *gens: int) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]).option("basePath", f"{home}/{name}")
    return reader.parquet(*(f"{home}/{name}/gen={g}" for g in gens))


def _write_keys(terms: DataFrame, home: str, gen: int, buckets: int) -> None:
    """Pieces of new vocabulary terms by which similar terms are found, by bucket of the piece."""
    from loomdex.operators.suggest import segment_keys

    rows = terms.select("term", F.explode(segment_keys(F.col("term"))).alias("key"))
    rows = rows.select("term", "key.*", key_bucket(F.col("key"), buckets).alias("key_bucket"))
    path, order = f"{home}/fuzzy_keys/gen={gen}", ("len", "no", "piece")
    if buckets > FEW_BUCKETS:
        return _write_bucketed(rows, path, "key_bucket", order, "term")
    _write(rows.sortWithinPartitions("key_bucket", *order), path, "key_bucket")


def key_bucket(key: Column, buckets: int) -> Column:
    return term_bucket(key["piece"], buckets)


def _record(spark: SparkSession, path: str, table: str, **values: int) -> None:
    spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).write.mode("append").parquet(f"{path}/{table}")


def _first_generation(current: DataFrame, path: str, buckets: int, analyse: bool) -> str:
    spark = current.sparkSession
    version = latest_version(spark, path)[0] + 1
    home = f"{path}/v={version}"
    _write_documents(current, home, 0, buckets, analyse)
    documents = _read(spark, home, "documents", 0)
    documents.agg(F.count("*").alias("n_docs")).write.mode("overwrite").parquet(f"{home}/stats/gen=0")
    _write_postings(home, 0, buckets, spark).write.mode("overwrite").option("compression", "zstd").parquet(f"{home}/term_stats/gen=0")
    vocabulary = spark.read.parquet(f"{home}/term_stats/gen=0").filter("field = 'all'")
    _write_keys(vocabulary, home, 0, buckets)
    _record(spark, home, "generations", gen=0)
    _record(spark, path, "versions", version=version, buckets=buckets)
    return home


def write_index(docs: DataFrame, path: str, buckets: int = 16) -> str:
    """Build a new version from the last write of every key and record it; returns its folder.

    `buckets` should give files of some hundred megabytes: 16 suits a small corpus, thousands a very large one.
    """
    with shuffles_dropped(docs.sparkSession):
        return _first_generation(newest(docs), path, buckets, analyse=True)


def update_index(docs: DataFrame, path: str, deleted: DataFrame | None = None) -> None:
    """Write the documents given, and take out those of `deleted(doc_key)`, as a further generation.

    Only the given documents are analysed. What their keys held before is found by key bucket; its stored term
    vectors say how far each document frequency falls. An update that was not recorded is written anew.
    """
    with shuffles_dropped(docs.sparkSession):
        _update(docs, path, deleted)


def _update(docs: DataFrame, path: str, deleted: DataFrame | None) -> None:
    spark = docs.sparkSession
    index = open_index(spark, path)
    if index.stored is None:
        write_index(docs, path)
        return update_index(docs.limit(0), path, deleted) if deleted is not None else None
    version, buckets = latest_version(spark, path)
    home = f"{path}/v={version}"
    gen = _generation(spark, home) + 1
    current = newest(docs)
    if deleted is not None:
        current = current.join(deleted.select("doc_key"), "doc_key", "left_anti")
    _write_documents(current, home, gen, buckets, analyse=True)
    added = _write_postings(home, gen, buckets, spark)

    written = _read(spark, home, "documents", gen).select("doc_key")
    keys = written
    keys = keys if deleted is None else keys.unionByName(deleted.select("doc_key")).distinct()
    keys = cut_lineage(keys.withColumn("doc_bucket", term_bucket(F.col("doc_key"), buckets)))
    small = fits_broadcast(keys, "doc_key")
    before = index.stored.join(F.broadcast(keys) if small else keys, ["doc_bucket", "doc_key"], "left_semi")
    before = index.live(before).select("gen", "doc_key", *VECTOR_COLUMNS)
    before.select("gen", "doc_key").write.mode("overwrite").parquet(f"{home}/dead/at={gen}")
    removed = document_frequencies(vector_postings(before)).select("field", "term", (-F.col("df")).alias("df"))

    old = spark.read.parquet(f"{home}/term_stats/gen={gen - 1}")
    changed = old.unionByName(added).unionByName(removed).groupBy("field", "term").agg(F.sum("df").alias("df"))
    changed.filter("df > 0").write.mode("overwrite").option("compression", "zstd").parquet(f"{home}/term_stats/gen={gen}")
    new = added.filter("field = 'all'").join(old.filter("field = 'all'"), "term", "left_anti")
    _write_keys(new, home, gen, buckets)
    replaced = spark.read.schema("gen int, doc_key string").parquet(f"{home}/dead/at={gen}")
    n = index.n_docs + F.lit(written.count() - replaced.count())
    spark.range(1).select(n.alias("n_docs")).write.mode("overwrite").parquet(f"{home}/stats/gen={gen}")
    _record(spark, home, "generations", gen=gen)


def merge_index(spark: SparkSession, path: str) -> str:
    """Write the live documents of all generations as a new version; texts keep their term vectors."""
    index = open_index(spark, path)
    live = index.live(index.stored).select(*DOCUMENT_COLUMNS, *VECTOR_COLUMNS)
    with shuffles_dropped(spark):
        return _first_generation(live, path, index.buckets, analyse=False)


def _generation(spark: SparkSession, home: str) -> int:
    return spark.read.parquet(f"{home}/generations").agg(F.max("gen")).first()[0]


def latest_version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Highest recorded version and its bucket count, version 0 when nothing was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0, 1
    newest = spark.read.parquet(f"{path}/versions").agg(F.max(F.struct("version", "buckets")).alias("v"))
    return tuple(newest.first().v)


def open_index(spark: SparkSession, path: str) -> Index:
    """Current version, or an empty index where none was written."""
    version, buckets = latest_version(spark, path)
    if version == 0:
        text = ", ".join(f"{c} string" for c in DOCUMENT_COLUMNS)
        return Index(docs=spark.createDataFrame([], text))
    home = f"{path}/v={version}"
    gen = _generation(spark, home)

    gens = range(gen + 1)  # a generation that was not recorded is not read
    post, stored = _read(spark, home, "postings", *gens), _read(spark, home, "documents", *gens)
    dead = None
    if gen:
        dead = spark.read.schema("gen int, doc_key string").parquet(*(f"{home}/dead/at={g}" for g in range(1, gen + 1)))
    index = Index(
        docs=stored, stored=stored, dead=dead, buckets=buckets, keys=_read(spark, home, "fuzzy_keys", *gens),
        post=post, term_df=spark.read.parquet(f"{home}/term_stats/gen={gen}"), stats=spark.read.parquet(f"{home}/stats/gen={gen}"),
    )
    index.docs = index.live(stored).select(*DOCUMENT_COLUMNS)
    return index
