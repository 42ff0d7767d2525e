"""From normalised heads and comments to canonical rows: select, group, chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tracelake.functions.text import first_nonempty
from tracelake.functions.times import yymmdd
from tracelake.operators.ranking import pick_first, top_per_group

# Comment bodies that mean the text is gone.
GONE = ["[deleted]", "[removed]"]


def recent_per_feed(heads: DataFrame, since_epoch: int = 0, limit: int | None = None) -> DataFrame:
    """Heads not older than the cursor, the first `limit` of every feed."""
    if since_epoch:
        heads = heads.filter(F.col("created_utc") >= since_epoch)
    if limit is None:
        return heads
    return top_per_group(heads, ["feed_kind", "feed"], [F.col("feed_pos").asc(), F.col("id").asc()], limit).drop("rn")


def with_feed_rank(heads: DataFrame, feeds: list[tuple[str, str]]) -> DataFrame:
    """Rank of each feed in the configured order (tags first, then authors); other feeds are dropped."""
    rows = [(kind, name, rank) for rank, (kind, name) in enumerate(feeds)]
    ranks = heads.sparkSession.createDataFrame(rows, "feed_kind string, feed string, feed_rank int")
    return heads.join(F.broadcast(ranks), ["feed_kind", "feed"])  # the configured list, a few rows


def dedupe_across_feeds(heads: DataFrame) -> DataFrame:
    """The first feed in order keeps the item."""
    return pick_first(heads, ["id"], ["feed_rank", "feed_pos"])


def dedupe_with_limit(heads: DataFrame, limit: int | None = None) -> DataFrame:
    """Unique items, tag feeds before the newest pages, stopping at a global limit."""
    unique = dedupe_across_feeds(heads)
    if limit is None:
        return unique
    return unique.orderBy("feed_rank", "feed_pos", "id").limit(limit)


def threads(heads: DataFrame, comments: DataFrame) -> DataFrame:
    """Heads with their positioned comments, one row per comment or lonely head.

    An inner join and the lonely heads apart, instead of an outer join kept by the
    heads: Spark can split a head with very many comments only in the inner join.
    """
    h = heads.select(F.col("id").alias("head_id"), F.col("created_utc").alias("head_created"), "title", "num_comments")
    c = comments.select("head_id", "position", "comment_id", "author", F.col("created_utc").alias("comment_created"))
    talked = c.join(h, "head_id")
    lonely = h.join(c.select("head_id").distinct(), "head_id", "left_anti")
    return talked.unionByName(lonely, allowMissingColumns=True)


def sources(heads: DataFrame, prefix: str) -> DataFrame:
    return heads.select(
        F.concat(F.lit(prefix), "id").alias("source_id"), "title", F.col("url").alias("source"),
        yymmdd("created_utc").alias("file_date"), "author", "score", "num_comments", "url", "tags",
        "reading_time", "story_url",
    )


def chunk_rows(heads: DataFrame, comments: DataFrame, prefix: str, kind: str, head_type: str) -> DataFrame:
    """Head as chunk 0, comment i as chunk i; blank and removed comments are left out after numbering."""
    head_source = F.concat(F.lit(prefix), F.col("id"))
    head_depth = F.lit(0) if head_type == "story" else F.lit(None).cast("int")
    zero = heads.select(
        F.concat(head_source, F.lit(":0")).alias("id"), first_nonempty("content", "title").alias("content"),
        F.col("created_utc").alias("timestamp"), head_source.alias("source_id"), F.lit(kind).alias("source_type"),
        F.lit(0).cast("long").alias("position"), F.lit(head_type).alias("item_type"), "author", "score", "url", "tags",
        "reading_time", head_depth.alias("depth"), F.lit(None).cast("string").alias("parent_id"),
        F.lit(None).cast("string").alias("comment_id"),
    )
    source = F.concat(F.lit(prefix), F.col("head_id"))
    body = comments.filter((F.col("content") != "") & ~F.col("content").isin(GONE))
    known = heads.select(F.col("id").alias("head_id"))
    rest = body.join(known, "head_id", "left_semi").select(
        F.concat(source, F.lit(":"), F.col("position").cast("string")).alias("id"), "content",
        F.col("created_utc").alias("timestamp"), source.alias("source_id"), F.lit(kind).alias("source_type"),
        "position", F.lit("comment").alias("item_type"), "author", "score", "url", "tags", "reading_time",
        "depth", "parent_id", "comment_id",
    )
    return zero.unionByName(rest)


def tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The three canonical per-chunk tables of a batch of chunk rows."""
    return {
        "chunks": rows.select("id", "content", "timestamp"),
        "edges": rows.select(F.col("id").alias("chunk_id"), "source_id", "source_type", "position"),
        "types": rows.select(
            F.col("id").alias("chunk_id"), "item_type", "author", "score", "url", "tags", "reading_time", "depth",
            "parent_id", "comment_id",
        ),
    }


def estimate(heads: DataFrame, comments: DataFrame) -> DataFrame:
    """Dry run: how many sources and chunks this pull would make."""
    n = heads.agg(F.count(F.lit(1)).alias("sources"))
    known = heads.select(F.col("id").alias("head_id"))
    c = comments.join(known, "head_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("chunks", F.col("sources") + c.scalar())


def per_feed_counts(heads: DataFrame) -> DataFrame:
    return heads.groupBy("feed_kind", "feed").agg(F.count(F.lit(1)).alias("articles"))
