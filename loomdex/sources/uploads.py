"""Uploaded files: validation and conversion to documents, as column expressions."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomdex.functions import vocab
from loomdex.functions.html import html_to_text
from loomdex.functions.text import token_join, trim_space
from loomdex.sources.store import append_segment

PDF_MAGIC = "%PDF-"
HIDDEN_NAME = "hidden file name"
# Tasks for each core that look files up.
LOOKUP_WAVES = 4


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*\z", 1)


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(base_name(path), r"(\.[^.]*)\z", 1))


def file_type(ext: Column) -> Column:
    plain = F.regexp_replace(ext, r"^\.", "")
    return F.when(plain == "htm", "html").when(plain == "", "txt").otherwise(plain)


def display_title(path: Column) -> Column:
    """Base name without its extension; an upper-case extension stays part of the title."""
    name, ext = base_name(path), extension(path)
    stem = F.when(
        F.endswith(name, ext), F.substring(name, F.lit(1), F.length(name) - F.length(ext))
    ).otherwise(name)
    blanked = F.regexp_replace(F.translate(stem, "\n\r\t", "   "), r"[\x00-\x1f]", "")
    return F.coalesce(F.nullif(trim_space(blanked), F.lit("")), F.lit(vocab.EMPTY_TITLE))


def upload_error(path: Column, length: Column, content: Column) -> Column:
    """Why an upload is refused, or an empty string."""
    ext = extension(path)
    text = F.lower(F.try_validate_utf8(content.cast("string")))
    text = F.coalesce(text, F.lower(F.decode(content, "ISO-8859-1")))
    is_pdf = F.substring(content, 1, len(PDF_MAGIC)) == F.lit(PDF_MAGIC).cast("binary")
    is_html = text.contains("<html") | text.contains("<body") | text.contains("<p")
    return (
        F.when(~ext.isin(".pdf", ".html", ".htm"), "unsupported file type")
        .when(~length.between(1, vocab.MAX_UPLOAD_BYTES), "invalid file size")
        .when((ext == ".pdf") & ~is_pdf, "invalid PDF file")
        .when((ext != ".pdf") & ~is_html, "invalid HTML file")
        .otherwise("")
    )


def stored_path(path: Column, content: Column) -> Column:
    """Name from the content, so a retried task writes the same name."""
    return F.concat(F.lit("/files/"), F.sha2(content, 256), extension(path))


def validate(files: DataFrame) -> DataFrame:
    """(path, error, title, file_type, file_path) of every upload."""
    path, content = F.col("path"), F.col("content")
    return files.select(
        "path",
        upload_error(path, F.col("length"), content).alias("error"),
        display_title(path).alias("title"),
        file_type(extension(path)).alias("file_type"),
        stored_path(path, content).alias("file_path"),
    )


def to_documents(files: DataFrame, pdf_text: DataFrame | None = None) -> DataFrame:
    """Documents of the accepted uploads. `pdf_text(path, text)` holds text extracted elsewhere."""
    path, content = F.col("path"), F.col("content")
    accepted = files.filter(upload_error(path, F.col("length"), content) == "")
    if pdf_text is None:
        accepted = accepted.withColumn("text", F.lit(None).cast("string"))
    else:
        accepted = accepted.join(pdf_text, "path", "left")
    ext = extension(path)
    page = F.coalesce(
        F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1")
    )
    return accepted.select(
        F.concat(F.lit("doc_"), F.sha2(path, 256)).alias("doc_key"),
        F.lit("").alias("url"),
        display_title(path).alias("title"),
        F.when(ext == ".pdf", token_join(F.col("text"))).otherwise(html_to_text(page)).alias("content"),
        stored_path(path, content).alias("file_path"),
        file_type(ext).alias("file_type"),
        F.lit("").alias("content_hash"),
    )


# Names of files that are still being written.
BESIDE = re.compile(r"\.[0-9a-f]{32}")
FILE_SCHEMA = "path string not null, modificationTime timestamp not null, length bigint not null, content binary"


def file_key(path: Column) -> Column:
    """A path without scheme, so that the file reader and the listing name a file alike."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:/*(?=/)", "")


def write_files(files: DataFrame, folder: str, name: str = "path") -> DataFrame:
    """Write `content` of every row to folder + name; the rows written come back as (path, written, length).

    A file appears whole or not at all: it is written beside its place and moved. With names made from the content
    (`stored_path`) a retried task or an equal copy writes the same bytes again, so nothing is lost or doubled.
    Rows without name or content are left out. A task holds one Arrow batch of files.
    """

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, home = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for place, content in zip(batch["written"], batch["content"]):
                target = f"{home}{place}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                beside = f"{target.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
                with store.open_output_stream(beside) as out:
                    out.write(bytes(content))
                store.move(beside, target)
            yield pd.DataFrame({"path": batch["path"], "written": batch["written"], "length": batch["content"].map(len)})

    rows = files.select("path", F.col(name).alias("written"), "content").filter("written is not null and content is not null")
    return rows.mapInPandas(save, "path string, written string, length bigint")


def listing(folders: DataFrame) -> DataFrame:
    """(path, length) of every file below the folders of a table (folder), one task per few folders; also of empty files.

    A folder that does not exist has no files; files that `write_files` is still writing are left out.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["folder"]:
                store, home = fs.FileSystem.from_uri(folder)
                found = store.get_file_info(fs.FileSelector(home, allow_not_found=True, recursive=True))
                kept = [(f.path, f.size) for f in found if f.is_file and not BESIDE.fullmatch(f.base_name)]
                yield pd.DataFrame(kept, columns=["path", "length"])

    return folders.select("folder").filter("folder is not null").mapInPandas(walk, "path string, length bigint")


def unread_files(listed: DataFrame, read: DataFrame) -> DataFrame:
    """Verdicts of the listed files that the file reader leaves out: those of no bytes and those with a hidden name.

    Other listed files that are not among `read` have only just come; a later batch judges them.
    """
    key, hidden = file_key(F.col("path")), base_name(F.col("path")).rlike(r"^[._]")
    unread = listed.join(read.select(file_key(F.col("path")).alias("key")), key == F.col("key"), "left_anti")
    rows = unread.filter((F.col("length") == 0) | hidden).select("path", "length", F.lit(b"").alias("content"))
    return validate(rows).withColumns({
        "error": F.when(hidden, HIDDEN_NAME).otherwise(F.col("error")), "file_path": F.when(~hidden, F.col("file_path")),
    })


@contextmanager
def few_lookups(spark: SparkSession) -> Iterator[None]:
    """While a stream over very many files is made and runs, they are looked up in some tasks for each core.

    By default every folder and file gets a task of its own, at each look and in each batch.
    """
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.conf.set(setting, LOOKUP_WAVES * spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def upload_stream(spark: SparkSession, folder: str, files_per_batch: int = 20_000) -> DataFrame:
    """Files of a folder as a stream. A batch costs some seconds whatever it holds; its files are dealt to tasks by size."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", files_per_batch).load(folder).select("path", "length", "content")


def start_uploads(files: DataFrame, target: str, stored: str, checkpoint: str) -> StreamingQuery:
    """Per micro-batch: copies of the accepted files below `stored`, their documents as a segment, every file's verdict as rows.

    A replayed batch rewrites its own segment and verdicts, and copies under the names they already have.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        validate(batch).write.mode("overwrite").parquet(f"{target}/verdicts/batch={batch_id}")
        path, content = F.col("path"), F.col("content")
        accepted = batch.filter(upload_error(path, F.col("length"), content) == "")
        copies = accepted.withColumn("file_path", stored_path(path, content))
        write_files(copies, stored, "file_path").write.mode("overwrite").parquet(f"{target}/copies/batch={batch_id}")
        append_segment(to_documents(batch).withColumn("seq", F.lit(batch_id).cast("bigint")), f"{target}/segments", batch_id)

    return (
        files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def verdicts(spark: SparkSession, target: str, listed: DataFrame) -> DataFrame:
    """(path, error, title, file_type, file_path) of the streamed files and of the listed ones that the stream cannot see."""
    read = spark.read.option("basePath", f"{target}/verdicts").parquet(f"{target}/verdicts/batch=*").drop("batch")
    return read.unionByName(unread_files(listed, read))
