"""Stories and their flat comment lists, from landed JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracelake import schemas
from tracelake.functions.jsons import list_text
from tracelake.functions.text import first_nonempty, strip
from tracelake.functions.times import iso_epoch_or_zero

PREFIX = "lob_"  # fixed value: id prefix of this source kind
KIND = "lobsters"  # fixed value: source_type of this source kind
BASE_URL = "https://lobste.rs"  # fixed value: default thread address


def read_stories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STORY).json(path)


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STORY_COMMENT).json(path)


def _author(c: str) -> Column:
    """User given as an object with a username, or as plain text."""
    text = F.col(c)
    from_object = F.coalesce(F.get_json_object(text, "$.username"), F.lit(""))
    return F.when(F.startswith(text, F.lit("{")), from_object).otherwise(F.coalesce(text, F.lit("")))


def normalise(raw: DataFrame) -> DataFrame:
    title = F.coalesce("title", F.lit(""))
    body = first_nonempty("description_plain", "description")
    tags = F.when(F.startswith("tags", F.lit("[")), F.from_json("tags", "array<string>"))
    return raw.select(
        F.coalesce("short_id", F.lit("")).alias("id"),
        F.lit("story").alias("type"),
        _author("submitter_user").alias("author"),
        title.alias("title"),
        body.alias("body"),
        F.when(body != "", strip(F.concat(title, F.lit("\n\n"), body))).otherwise(title).alias("content"),
        F.coalesce("score", F.lit(0)).alias("score"),
        F.coalesce("comment_count", F.lit(0)).alias("num_comments"),
        F.coalesce("comments_url", F.concat(F.lit(f"{BASE_URL}/s/"), F.coalesce("short_id", F.lit("")))).alias("url"),
        iso_epoch_or_zero("created_at").alias("created_utc"),
        list_text(F.coalesce(tags, F.array().cast("array<string>"))).alias("tags"),
        F.lit(None).cast("int").alias("reading_time"),
        F.coalesce("url", F.lit("")).alias("story_url"),
        "feed_kind", "feed", "feed_pos",
    )


def listed_comments(stories: DataFrame) -> DataFrame:
    """Comment records of stories that carry their comments as a JSON array, in the given order."""
    item = schemas.STORY_COMMENT.replace("story_id string, pos long, ", "")
    listed = F.from_json("comments", f"array<struct<{item.replace(' string', ':string').replace(' int', ':int')}>>")
    return stories.select(F.col("short_id").alias("story_id"), F.posexplode(listed).alias("pos", "c")).select(
        "story_id", F.col("pos").cast("long").alias("pos"), "c.*"
    )


def normalise_comments(raw: DataFrame) -> DataFrame:
    """Comments in the given order; depth and parent come with the record."""
    return raw.select(
        F.col("story_id").alias("head_id"),
        F.col("pos").alias("dfs_pos"),
        (F.col("pos") + 1).alias("position"),  # the place in the given list; skipped comments leave a gap
        F.coalesce("short_id", F.lit("")).alias("comment_id"),
        F.lit("comment").alias("type"),
        _author("commenting_user").alias("author"),
        first_nonempty("comment_plain", "comment").alias("content"),
        F.coalesce("score", F.lit(0)).alias("score"),
        F.coalesce("url", F.lit("")).alias("url"),
        iso_epoch_or_zero("created_at").alias("created_utc"),
        F.coalesce("parent_comment", F.lit("")).alias("parent_id"),
        F.lit(None).cast("string").alias("tags"),
        F.lit(None).cast("int").alias("reading_time"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
    )
