"""Streams of transcripts: every micro-batch appends what is above the high-water mark.

`start` takes files as they arrive, each path once. A transcript is usually
appended to in place, which Spark's file source does not see; for that,
`snapshot` writes the folder's listing whenever its signature has changed, and
`start_grown` streams over the listings. Its state holds the signatures (path,
length, time) that have passed, so files that are new or have changed are read,
and no others. `refresh` does both, or says only whether there is anything to do.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tracelake.operators.ranking import pick_last
from tracelake.operators.sinks import read_batches, write_batch
from tracelake.session import Scratch, shuffles_dropped
from tracelake.sources import landing, markdown_chat as chat
from tracelake.streaming.incremental import above_high_water, directory_signature, file_listing

CHUNKS = """
chunk_id string, source_id string, chunk_number long, type string, role string, content string, timestamp long,
tool_name string, target_file string, success boolean, event_kind string, start_line long, end_line long
"""
MARKS = "source_id string, chunk_number long"
# Fixed by Spark: the columns of its binaryFile source.
FILE = "path string, modificationTime timestamp, length long, content binary"
_COLUMNS = [c.split()[0] for c in CHUNKS.replace("\n", " ").split(",")]


# Fixed by Spark: into how many tasks the listing of named files goes at most.
LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
FILES_PER_LISTER = 100
LISTING = "path string, length long, modificationTime timestamp"
PATTERN = "aider*.chat*.md"
#: Bytes and number of the transcripts of a micro-batch of `refresh`: a batch costs some twenty jobs however few files it has, and their
#: paths go through the driver.
BATCH_BYTES, LISTED_PER_BATCH = 64 << 20, 100_000
Rename = Callable[[Column], Column]


def watch(spark: SparkSession, folder: str, pattern: str = PATTERN, files_per_batch: int = 1000) -> DataFrame:
    """New files below a landing folder: path, text, modified."""
    raw = (
        spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(folder)
    )
    return _texts(raw)


def _texts(files: DataFrame) -> DataFrame:
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return files.select("path", text.alias("text"), F.unix_seconds("modificationTime").alias("modified"))


def _logical(files: DataFrame, rename: Rename | None) -> DataFrame:
    """Drops of one transcript share its logical path: a version suffix after '@' in the file name is removed."""
    path = F.regexp_replace("path", r"@[^/@]*(?=\.chat)", "")
    named = files.withColumn("drop", F.col("path")).withColumn("path", rename(path) if rename else path)
    # The newest drop of a transcript holds all of it.
    return pick_last(named, ["path"], ["modified", "drop"]).drop("drop")


def ingest_files(spark: SparkSession, files: DataFrame, table: str, batch_id: int, rename: Rename | None = None) -> None:
    """One batch: parse the files and write only the rows above the marks of the earlier batches.

    The marks (highest number per source) are a small table of their own, so the
    stored chunks are not read again.  A replayed batch replaces its own rows.
    """
    scratch = Scratch(spark)
    newest = scratch.write("files", _logical(files, rename))  # read once, however many plans need them
    blocks = scratch.write("blocks", chat.blocks(chat.lines(newest, by_session=True)))
    sessions = chat.sessions(newest, blocks).join(newest.select("path", "modified"), "path")
    # A header without a readable time falls back to the file's own time.
    chunks = chat.chunk_rows(sessions, blocks, F.col("modified")).select(*_COLUMNS)
    marks = read_batches(spark, f"{table}/marks", MARKS, before=batch_id)
    write_batch(above_high_water(marks, chunks), f"{table}/chunks", batch_id)
    written = spark.read.schema(CHUNKS).parquet(f"{table}/chunks/batch={batch_id}")
    write_batch(written.groupBy("source_id").agg(F.max("chunk_number").alias("chunk_number")), f"{table}/marks", batch_id)
    for name in ("files", "blocks"):
        scratch.drop(name)


def stored_chunks(spark: SparkSession, table: str) -> DataFrame:
    return read_batches(spark, f"{table}/chunks", CHUNKS)


def start(
    spark: SparkSession, folder: str, table: str, checkpoint: str, pattern: str = PATTERN, files_per_batch: int = 1000
) -> StreamingQuery:
    """Process all files that have arrived, then stop."""
    def batch(df: DataFrame, batch_id: int) -> None:
        ingest_files(spark, df, table, batch_id)

    return (
        watch(spark, folder, pattern, files_per_batch).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _listed(spark: SparkSession, listings: str) -> DataFrame:
    return read_batches(spark, listings, LISTING + ", number long")


def _signature(files: DataFrame) -> tuple:
    """Total size, number and newest time of the files."""
    return (*directory_signature(files).first(), files.agg(F.max(F.unix_micros("modificationTime"))).first()[0])


def snapshot(spark: SparkSession, folder: str, listings: str, pattern: str = PATTERN, files_per_batch: int | None = None) -> bool:
    """Write the listing of the folder as the next snapshot, unless its signature is that of the last one. File bodies are not read.

    A snapshot's files bound a micro-batch of the stream over them: each holds the rows of about BATCH_BYTES of transcripts, and of at
    most `files_per_batch`, or else LISTED_PER_BATCH, files.
    """
    most = files_per_batch or LISTED_PER_BATCH
    earlier = _listed(spark, listings)
    last = earlier.agg(F.max("number")).first()[0]
    now = file_listing(spark, folder, pattern)
    if last is not None and _signature(now) == _signature(earlier.filter(F.col("number") == last)):
        return False
    number = 0 if last is None else last + 1
    size, count = directory_signature(now).first()
    tasks = max(1, -(-count // most), -(-size // BATCH_BYTES))
    rows = now.withColumn("number", F.lit(number).cast("long")).repartition(tasks)
    rows.write.mode("overwrite").option("maxRecordsPerFile", most).parquet(f"{listings}/batch={number}")
    return True


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, text, modified of the named files; those that have gone meanwhile are left out."""
    if found := landing.named(spark, paths):
        return _texts(landing.whole(*found, plain=True, missing=True).withColumn("modificationTime", F.timestamp_millis("modified")))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = [p for p in map(jvm.org.apache.hadoop.fs.Path, paths) if p.getFileSystem(conf).exists(p)]
    if not there:
        return _texts(spark.createDataFrame([], FILE))
    plain = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p.toString()) for p in there]
    # Unless told otherwise, Spark lists named files by one task each.
    kept = spark.conf.get(LISTERS)
    spark.conf.set(LISTERS, str(min(int(kept), -(-len(plain) // FILES_PER_LISTER))))
    try:
        found = spark.read.format("binaryFile").schema(FILE).load(plain)
    finally:
        spark.conf.set(LISTERS, kept)
    return _texts(found)


def start_grown(spark: SparkSession, listings: str, table: str, checkpoint: str, rename: Rename | None = None) -> StreamingQuery:
    """Ingest the files whose signature has not passed yet, one file of a snapshot at a time, then stop."""
    rows = spark.readStream.schema(LISTING).option("maxFilesPerTrigger", 1).parquet(f"{listings}/*")

    def batch(df: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in df.select("path").distinct().collect()]  # those of one file of a snapshot
        if paths:
            with shuffles_dropped(spark):
                ingest_files(spark, read_files(spark, paths), table, batch_id, rename)

    return (
        rows.dropDuplicates(["path", "length", "modificationTime"]).writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def refresh(
    spark: SparkSession, folder: str, base: str, pattern: str = PATTERN, files_per_batch: int | None = None, rename: Rename | None = None, dry_run: bool = False,
) -> bool:
    """Bring the table below `base` up to date with a folder of growing transcripts; returns whether the folder had changed.

    With dry_run nothing is written.
    """
    listings = f"{base}/listings"
    if dry_run:
        earlier = _listed(spark, listings)
        last = earlier.filter(F.col("number") == F.coalesce(earlier.agg(F.max("number")).scalar(), F.lit(-1)))
        return _signature(file_listing(spark, folder, pattern)) != _signature(last)
    changed = snapshot(spark, folder, listings, pattern, files_per_batch)
    start_grown(spark, listings, f"{base}/table", f"{base}/checkpoint", rename).awaitTermination()  # also what an earlier run left open
    return changed
