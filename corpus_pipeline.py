"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the last
returns pieces of sequences. Between stages the documents are written, so a lost executor costs at most a
part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.llm import decontaminate, langid, line_runs, packing, simhash
from loomdex.llm.common import store, table
from loomdex.llm.queries import word_bpe_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Languages that stay; None for all that the labels name.
WANTED: tuple[str, ...] | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a wanted language that could be told, with that language as `lang`.

    Those without a letter go, and those of which another language is nearly as likely.
    """
    return langid.in_wanted_languages(docs, WANTED)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs, n_chars to match; a document that loses every line goes."""
    done = line_runs.remove_repeated_lines(docs)
    done = done.filter("n_removed = 0 or n_removed < n_lines")
    return done.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked."""
    return simhash.unique_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs, word_bpe_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: Automata, fingerprints, suffix ranks and token merges have no SQL form; a test runs the stages next to a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
