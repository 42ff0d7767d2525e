"""Incremental semantics: cursors, signatures, high-water marks, rows still to embed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracelake.functions.times import epoch_seconds, instant
from tracelake.operators.sinks import fresh_rows
from tracelake.sources import landing


def cursor(meta: DataFrame, since_days: int | None = None, as_of=None, lateness: int = 0) -> Column:
    """Epoch to read from: the stored cursor minus the allowed lateness, or the last since_days days."""
    if since_days is not None:
        return epoch_seconds(instant(as_of)) - since_days * 86400
    stored = meta.filter(F.col("key") == "last_pull_ts").agg(F.max(F.col("value").cast("long"))).scalar()
    return F.coalesce(stored, F.lit(0).cast("long")) - lateness


def since(rows: DataFrame, at: Column, ts: str = "timestamp") -> DataFrame:
    return rows.filter(F.col(ts) >= at)


def next_cursor(chunks: DataFrame) -> DataFrame:
    """The new stored cursor: the largest time over heads and comments."""
    top = F.coalesce(F.max("timestamp"), F.lit(0).cast("long")).cast("string")
    return chunks.agg(top.alias("value")).select(F.lit("last_pull_ts").alias("key"), "value")


def refresh(stored: DataFrame, landed: DataFrame, meta: DataFrame, keys: list[str], order: list[str], **window) -> DataFrame:
    """New rows of one refresh: landed rows from the cursor on whose key is not stored yet."""
    return fresh_rows(stored, since(landed, cursor(meta, **window)), keys, order)


def author_cursors(existing: DataFrame, pulled: DataFrame) -> DataFrame:
    """Per author the later of the stored cursor and the newest pulled item; cursors never go back."""
    newest = pulled.groupBy("author").agg(F.max("created_utc").alias("__new"))
    merged = existing.select("author", "cursor").join(newest, "author", "full_outer")
    return merged.select("author", F.greatest("cursor", "__new").alias("cursor"))


def above_high_water(stored: DataFrame, incoming: DataFrame, source: str = "source_id", number: str = "chunk_number") -> DataFrame:
    """Incoming rows numbered above the highest stored number of their source; grown older rows are ignored."""
    marks = stored.groupBy(source).agg(F.max(number).alias("__mark"))
    joined = incoming.join(marks, source, "left")
    return joined.filter(F.col(number) > F.coalesce("__mark", F.lit(0))).drop("__mark")


def changed_below_high_water(stored: DataFrame, incoming: DataFrame, key: str = "chunk_id", body: str = "content") -> DataFrame:
    """Stored rows whose text differs in the incoming batch; they stay as they are, but can be reported."""
    old = stored.select(key, F.sha2(F.col(body), 256).alias("stored_hash"))
    new = incoming.select(key, F.sha2(F.col(body), 256).alias("incoming_hash"))
    return old.join(new, key).filter(F.col("stored_hash") != F.col("incoming_hash"))


def source_stats(chunks: DataFrame, source: str = "source_id") -> DataFrame:
    """Messages, user prompts and the time range per source."""
    return chunks.groupBy(source).agg(
        F.count(F.lit(1)).alias("message_count"), F.count_if(F.col("type") == "user_prompt").alias("prompt_count"),
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
    )


def merge_stats(stored: DataFrame, fresh: DataFrame, source: str = "source_id") -> DataFrame:
    """Stored statistics plus those of newly inserted chunks; the old chunks are not read again."""
    both = stored.unionByName(source_stats(fresh, source))
    return both.groupBy(source).agg(
        F.sum("message_count").alias("message_count"), F.sum("prompt_count").alias("prompt_count"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
    )


def directory_signature(files: DataFrame) -> DataFrame:
    """Total size and number of the files (columns of the binaryFile source)."""
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_size"), F.count(F.lit(1)).alias("file_count"))


def store_signature(files: DataFrame) -> DataFrame:
    """Size and newest modification time of an exported store."""
    return files.agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("size"), F.unix_micros(F.max("modificationTime")).alias("mtime_us")
    )


def needs_resync(signature: DataFrame, meta: DataFrame, prefix: str) -> DataFrame:
    """One row: does any part of the signature differ from the stored one?"""
    parts = F.array(*[
        F.struct(F.lit(f"{prefix}{c}").alias("key"), F.col(c).cast("string").alias("now")) for c in signature.columns
    ])
    now = signature.select(F.inline(parts))
    joined = now.join(meta.select("key", "value"), "key", "left")
    return joined.agg(F.bool_or(~F.col("now").eqNullSafe(F.col("value"))).alias("needs_resync"))


def file_listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Path, length and modification time; the file bodies are not read."""
    found = landing.find(spark, folder)
    listed = landing.listing(spark, found, pattern) if found else None
    if listed is not None:
        return listed.select(landing.path(found).alias("path"), "length", F.timestamp_millis("modified").alias("modificationTime"))
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .load(folder).select("path", "length", "modificationTime")
    )


def not_embedded(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.col("embedding").isNull())
