"""Flat views over the canonical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tracelake.functions.times import from_epoch


def chunk_table(cell: dict[str, DataFrame]) -> DataFrame:
    """One row per chunk with its edge and type.

    A cell stores them as one table, `rows`, of which chunks, edges and types are
    columns; where they came in as three tables they are joined on the chunk key.
    """
    if "rows" in cell:
        return cell["rows"]
    edges = cell["edges"].select(F.col("chunk_id").alias("id"), "source_id", "position")
    types = cell["types"].withColumnRenamed("chunk_id", "id")
    return cell["chunks"].join(edges, "id", "left").join(types, "id", "left")


def only(cell: dict[str, DataFrame], source_ids: list[str], ids: list[str] | None = None) -> dict[str, DataFrame]:
    """The cell with these sources alone, and of their chunks those named: the keys reach the scans as filters."""
    here = F.col("source_id").isin(source_ids)
    rows = chunk_table(cell).filter(here if ids is None else F.col("id").isin(ids))
    return {**cell, "rows": rows, "sources": cell["sources"].filter(here), "graph": cell["graph"].filter(here)}


def _joined(cell: dict[str, DataFrame]) -> DataFrame:
    """Chunk rows with one join on the source key.

    Source and graph rows meet first, so the large side is shuffled by the source
    key only once; a source holding many chunks is split by the AQE skew join.
    """
    src = cell["sources"].select(
        "source_id", "title", F.col("url").alias("src_url"), "story_url", F.col("score").alias("src_score"),
        F.col("num_comments").alias("src_comments"), F.col("tags").alias("src_tags"),
    )
    src = src.join(cell["graph"], "source_id", "left")
    return (
        chunk_table(cell).join(src, "source_id", "left")
        .withColumn("created_at", from_epoch("timestamp").cast("timestamp_ntz"))
        .withColumn("type", F.coalesce("item_type", F.lit("chunk")))
    )


def article_chunks(cell: dict[str, DataFrame]) -> DataFrame:
    return _joined(cell).select(
        "id", "content", "timestamp", "created_at", "type", "source_id", "position", "title",
        F.col("src_url").alias("article_url"), F.col("src_score").alias("article_score"),
        F.col("src_comments").alias("article_comments"), "author", "score", "url", "tags", "reading_time",
        "centrality", "is_hub", "is_bridge", "community_id",
    )


def story_chunks(cell: dict[str, DataFrame]) -> DataFrame:
    return _joined(cell).select(
        "id", "content", "timestamp", "created_at", "type", "source_id", "position", "title",
        F.col("src_url").alias("thread_url"), "story_url", F.col("src_score").alias("thread_score"),
        F.col("src_comments").alias("thread_comments"), F.col("src_tags").alias("thread_tags"), "author", "score",
        "depth", "parent_id", "tags", "centrality", "is_hub", "is_bridge", "community_id",
    )


def threads(cell: dict[str, DataFrame]) -> DataFrame:
    """One row per source with its number of chunks; edges are counted before the join."""
    edges = cell["rows"].select("source_id", F.col("id").alias("chunk_id")) if "rows" in cell else cell["edges"]
    counts = (
        edges.groupBy("source_id", "chunk_id").agg(F.lit(1).alias("one"))
        .groupBy("source_id").agg(F.count(F.lit(1)).alias("chunk_count"))
    )
    return (
        cell["sources"].join(counts, "source_id", "left").join(cell["graph"], "source_id", "left")
        .select(
            "source_id", "title", "author", "score", "num_comments", "url", "story_url", "tags", "file_date",
            F.coalesce("chunk_count", F.lit(0).cast("long")).alias("chunk_count"), "centrality", "is_hub",
            "is_bridge", "community_id",
        )
    )
