"""Named reports over the chunks and threads views; late has them over stored cells. Parameters are plain Python values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tracelake.functions.jsons import has_tag, string_array
from tracelake.functions.text import preview
from tracelake.functions.times import rolling_since


def _newest():
    return [F.col("timestamp").desc(), F.col("id").asc()]


def story_recent(chunks: DataFrame, as_of, days: int = 7, limit: int = 50) -> DataFrame:
    return (
        chunks.filter(rolling_since("created_at", as_of, days)).orderBy(*_newest()).limit(limit)
        .select("id", "type", "created_at", "title", "author", "score", "thread_url", "story_url",
                preview("content", 500).alias("preview"))
    )


def article_recent(chunks: DataFrame, limit: int = 50) -> DataFrame:
    return (
        chunks.orderBy(*_newest()).limit(limit)
        .select("id", "created_at", "type", "title", "author", "score", "article_url", "tags",
                preview("content", 500).alias("preview"))
    )


def top(chunks: DataFrame, as_of, days: int = 30, limit: int = 50) -> DataFrame:
    """Best score first; no score counts as zero."""
    return (
        chunks.filter(rolling_since("created_at", as_of, days))
        .orderBy(F.coalesce("score", F.lit(0)).desc(), *_newest()).limit(limit)
        .select("id", "type", "created_at", "title", "author", "score", "thread_score", "thread_comments",
                "thread_url", "story_url", preview("content", 500).alias("preview"))
    )


def tagged(chunks: DataFrame, tag: str, as_of, days: int = 30, limit: int = 50) -> DataFrame:
    """Threads with exactly this tag."""
    return (
        chunks.filter(has_tag("thread_tags", tag) & rolling_since("created_at", as_of, days))
        .orderBy(*_newest()).limit(limit)
        .select("id", "type", "created_at", "title", "author", "score", "thread_tags", "thread_url", "story_url",
                preview("content", 500).alias("preview"))
    )


def tags_like(c: str, tag: str):
    """Substring match in any letter case; pattern characters of the parameter stay active."""
    return F.ilike(F.col(c), F.lit(f"%{tag}%"))


def by_tag(chunks: DataFrame, tag: str, limit: int = 50) -> DataFrame:
    return (
        chunks.filter(tags_like("tags", tag)).orderBy(*_newest()).limit(limit)
        .select("id", "created_at", "type", "title", "author", "score", "article_url", "tags",
                preview("content", 500).alias("preview"))
    )


def tag_counts(chunks: DataFrame, limit: int = 100) -> DataFrame:
    """Articles per tag; an empty tag array counts under its own text, as a left join on the array gives it."""
    exploded = chunks.filter(F.col("type") == "article").select(
        "id", "tags", F.explode_outer(string_array("tags")).alias("t")
    )
    pairs = exploded.select("id", F.coalesce("t", "tags").alias("tag")).filter(F.col("tag") != "")
    return (
        pairs.groupBy("tag").agg(F.countDistinct("id").alias("articles"))
        .orderBy(F.col("articles").desc(), F.col("tag").asc()).limit(limit)
    )


def tag_counts_inner(chunks: DataFrame, limit: int = 30) -> DataFrame:
    exploded = chunks.filter(F.col("type") == "article").select("id", F.explode(string_array("tags")).alias("tag"))
    return (
        exploded.groupBy("tag").agg(F.countDistinct("id").alias("articles"))
        .orderBy(F.col("articles").desc(), F.col("tag").asc()).limit(limit)
    )


def mine(chunks: DataFrame, meta: DataFrame, as_of, days: int = 30, limit: int = 200) -> DataFrame:
    """Rows by the authors configured in the metadata table (a JSON array under the key 'authors')."""
    authors = meta.filter(F.col("key") == "authors").select(F.explode(string_array("value")).alias("author")).distinct()
    return (
        chunks.filter(rolling_since("created_at", as_of, days)).join(authors, "author", "left_semi")
        .orderBy(F.col("created_at").desc(), F.col("id").asc()).limit(limit)
        .select("id", "content", "created_at", "type", "title", "author", "score", "url", "article_url",
                "article_score", "article_comments", "tags", "reading_time")
    )


def shape(cell: dict[str, DataFrame]) -> DataFrame:
    """Row counts by table."""
    def counted(what: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")

    return counted("chunks", cell["chunks"]).unionByName(counted("sources", cell["sources"]))


def random_sample(chunks: DataFrame, seed: int = 7, limit: int = 3, longer_than: int = 40) -> DataFrame:
    """The first rows in the order of a seeded hash of their id: the same on any cluster."""
    return (
        chunks.filter(F.char_length("content") > longer_than).orderBy(F.md5(F.concat(F.lit(str(seed)), "id")), "id").limit(limit)
        .select("type", "title", "author", preview("content", 180).alias("preview"))
    )


def latest_sample(chunks: DataFrame, limit: int = 3) -> DataFrame:
    return (
        chunks.orderBy(*_newest()).limit(limit)
        .select("id", "created_at", "type", "title", "author", "tags", preview("content", 300).alias("preview"))
    )


def top_articles_for_tag(chunks: DataFrame, tag: str, limit: int = 20) -> DataFrame:
    return (
        chunks.filter((F.col("type") == "article") & tags_like("tags", tag))
        .orderBy(F.col("article_score").desc(), F.col("id").asc()).limit(limit)
        .select("title", "author", "article_score", "article_comments", "reading_time", "article_url")
    )


def top_threads(threads: DataFrame, limit: int = 20, tag: str | None = None) -> DataFrame:
    if tag is not None:
        threads = threads.filter(has_tag("tags", tag))
    return (
        threads.orderBy(F.col("score").desc(), F.col("source_id").asc()).limit(limit)
        .select("title", "author", "score", "num_comments", "story_url", F.col("url").alias("thread_url"))
    )


def comment_thread(chunks: DataFrame, source_id: str) -> DataFrame:
    """Comments of one source in position order."""
    cols = [c for c in ("position", "depth", "author", "score", "parent_id") if c in chunks.columns]
    return (
        chunks.filter((F.col("source_id") == source_id) & (F.col("type") == "comment"))
        .orderBy("position").select(*cols, preview("content", 500).alias("body"))
    )
