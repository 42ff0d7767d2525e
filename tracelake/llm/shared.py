"""Helpers of the operators: the shared folder, tables written there, Arrow batches cut to bounded slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that Python code works on at a time.
SLICE_BYTES = 2 << 20


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Where that is unset, a local session (as in tests) gets a temporary folder;
    on a cluster that would not be shared, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tracelake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The rows as a Parquet table in the work folder: it cuts the lineage and survives lost executors."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_rows(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id and text alone; a null text is empty. Other columns of the input, whatever their names, are left."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `limit` bytes of the string column, of one row at least."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    first = held = 0
    for i, size in enumerate(sizes):
        if held and held + (size or 0) > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size or 0
    if len(sizes) > first:
        yield batch.slice(first)


def per_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch], limit: int = SLICE_BYTES):
    """A function for mapInArrow that applies `work` to bounded slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=limit):
                yield work(part)

    return run


def cut_places(text: str, size: int) -> list[int]:
    """Where a long text may be cut, about every `size` characters: before a space between two other characters.

    No pre-token of the byte-level pattern spans such a place, so the pieces'
    tokens are those of the whole. A stretch without one stays whole.
    """
    places, at = [], size
    while at < len(text):
        at = text.find(" ", at)
        if at < 0 or at + 1 >= len(text):
            break
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            places.append(at)
            at += size
        else:
            at += 1
    return places
