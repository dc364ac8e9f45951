"""Helpers shared by the operators: texts, words, scratch tables and files."""

from __future__ import annotations

import os
import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.session import scratch_path, stage

__all__ = ["SPACE", "WORD", "files", "prepare", "scratch_path", "stage", "table", "text_of", "unwrapped", "word_count", "wrapped", "write_file"]

#: White space and words of the contracts: ASCII space and 0x09 to 0x0D.
SPACE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


#: Session settings of these operators.  Batches for Python workers are bounded by rows and bytes, as whole texts can be
#: long.  Each step ends in a written table, so a finished step's shuffle files are of no use and leave at once.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession) -> None:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def wrapped(docs: DataFrame) -> DataFrame:
    """``row`` (all columns but the text) beside ``doc_id``, ``lang``, ``source`` and ``text``.

    Whatever a caller's columns are called, they cannot clash with those of an operator.  A missing ``lang`` or
    ``source`` column counts as missing values.
    """
    rest = [c for c in docs.columns if c != "text"]
    row = F.struct(*(F.col(c).alias(f"c{k}") for k, c in enumerate(rest)))
    known = [F.col(c) if c in rest else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    return docs.select(row.alias("row"), "doc_id", *known, "text")


def unwrapped(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The caller's columns again, in their order, with the text as it is now."""
    places = iter(range(len(columns)))
    return rows.select(*(F.col("text") if c == "text" else F.col(f"row.c{next(places)}").alias(c) for c in columns))


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def files(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder given as a path or as a URI (``file:``, ``hdfs:``, ``s3:``)."""
    if "://" in folder or folder.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), os.path.abspath(folder)


def write_file(folder: str, name: str, parts: list) -> None:
    """Write a file under a name of its own, then move it into place: readers and reruns never see half a file."""
    fs, path = files(folder)
    fs.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    fs.move(draft, f"{path}/{name}")
