"""Helpers shared by the operators: shared folder, table reads, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of
    the session. Only where it is unset and the session runs in one process
    (tests) is a local one made."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="cadence-llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/cadence-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: later
    steps start from the files, also when an executor is lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver has it (a cluster that
    installs it or gets it by ``--py-files`` needs no more)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> Column:
    """Sixteen bytes that stand for a whole text; a null equals the empty text."""
    return F.unhex(F.md5(whole_text(column)))


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``most_bytes`` of text, one row at least, so that a
    task's memory does not depend on the batch size of the session."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most_bytes, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def fold_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4
