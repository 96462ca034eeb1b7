"""Readers: parquet tables, uploaded files, crawl configuration, stop-word files, sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.functions import html, vocab
from loomdex.functions.text import fold_case
from loomdex.functions.urls import is_media, is_valid
from loomdex.session import spread

PAGE_SCHEMA = "page_id bigint, url string, html string"
CONFIG_SCHEMA = T.StructType([
    T.StructField("seed_urls", T.ArrayType(T.StringType())),
    T.StructField("max_pages", T.LongType()),
    T.StructField("max_depth", T.LongType()),
    T.StructField("delay_ms", T.LongType()),
    T.StructField("parallelism", T.LongType()),
    T.StructField("allowed_hosts", T.ArrayType(T.StringType())),
    T.StructField("user_agent", T.StringType()),
    T.StructField("auto_start", T.BooleanType()),
])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_text_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """Table with long texts: small files are spread so that text work uses every core."""
    return spread(read_table(spark, folder, name), key)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Uploaded files as (path, length, content). The file reader itself leaves out empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", "content")


def parse_config(json_text: Column) -> Column:
    """Crawl configuration from JSON text.

    Missing text takes every default; zero or blank fields take their default; text that does not
    parse gives an all-zero configuration that never starts by itself.
    """
    d = vocab.CONFIG_DEFAULTS
    raw = F.from_json(json_text, CONFIG_SCHEMA, {"mode": "PERMISSIVE"})
    broken = json_text.isNotNull() & F.try_parse_json(json_text).isNull()

    def number(name: str) -> Column:
        given = F.coalesce(raw[name], F.lit(0))
        return F.when(broken, 0).when(given == 0, d[name]).otherwise(given).cast("bigint")

    def strings(name: str) -> Column:
        empty = F.expr("cast(array() as array<string>)")
        return F.when(broken, empty).otherwise(F.coalesce(raw[name], empty))

    agent = F.coalesce(raw["user_agent"], F.lit(""))
    return F.struct(
        strings("seed_urls").alias("seed_urls"),
        *[number(n).alias(n) for n in ("max_pages", "max_depth", "delay_ms", "parallelism")],
        strings("allowed_hosts").alias("allowed_hosts"),
        F.when(broken, "").when(agent == "", d["user_agent"]).otherwise(agent).alias("user_agent"),
        F.coalesce(raw["auto_start"] & ~broken, F.lit(False)).alias("auto_start"),
    )


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """One-row configuration; a missing file takes every default."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
    if exists:
        text = spark.read.text(path, wholetext=True)
    else:
        text = spark.createDataFrame([(None,)], "value string")
    return text.select(parse_config(F.col("value")).alias("c")).select("c.*")


def stopword_rows(json_arrays: DataFrame, column: str) -> DataFrame:
    """Distinct lower-cased words of JSON string arrays; text that does not parse adds nothing."""
    parsed = F.when(
        F.try_parse_json(F.col(column)).isNotNull(), F.from_json(F.col(column), "array<string>")
    )
    return (
        json_arrays.select(F.explode(parsed).alias("word"))
        .filter("word is not null")
        .select(fold_case(F.col("word")).alias("word"))
        .distinct()
    )


def load_stopwords(spark: SparkSession, *paths: str) -> list[str]:
    """All words of the given stop-word files, which are configuration; words of whole tables stay rows, see stopword_rows."""
    files = spark.read.text(list(paths), wholetext=True)
    return sorted(r.word for r in stopword_rows(files, "value").collect())


def sitemap_locations(xml: Column) -> Column:
    """URLs of a sitemap or a sitemap index that are valid and not media, in file order."""
    entries = F.regexp_extract_all(
        F.regexp_replace(xml, r"(?s)<!--.*?-->", ""),
        F.lit(r"(?s)<(?:sitemap|url)(?:\s[^>]*)?>.*?</(?:sitemap|url)\s*>"), F.lit(0),
    )
    locs = F.transform(
        entries,
        lambda e: html.decode_entities(F.regexp_extract(e, r"(?s)<loc(?:\s[^>]*)?>(.*?)</loc\s*>", 1)),
    )
    return F.filter(locs, lambda u: is_valid(u) & ~is_media(u))
