"""Sessions and messages made from the events table by Spark.

A user's events are cut into sessions at gaps above twelve hours; every event
becomes one message.  All later 'now' values are AS_OF, the end of the data.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracelake.functions.times import epoch_seconds
from tracelake.operators.sequences import gap_sessions
from tracelake.session import shared_folder, shuffles_dropped

AS_OF = "2024-01-31 00:00:00"
LARGE = 10


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table as it is; splitting is left to spark.sql.files.maxPartitionBytes."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


_KEPT: dict[tuple, DataFrame] = {}


def stored(name: str, spark: SparkSession, sf: str, make) -> DataFrame:
    """Rows the reports would find already ingested: made once per session and read by all later queries.

    They are a Parquet table in the shared folder, so later queries read only
    the columns they need and a lost executor costs nothing.
    """
    key = (name, spark.sparkContext.applicationId, sf)
    if key not in _KEPT:
        path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{md5(sf.encode()).hexdigest()[:8]}"
        with shuffles_dropped(spark):
            make().write.mode("overwrite").parquet(path)
        _KEPT[key] = spark.read.parquet(path)
    return _KEPT[key]


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def numbered_events(spark: SparkSession, sf: str) -> DataFrame:
    return stored("numbered_events", spark, sf, lambda: _numbered(spark, sf))


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf).withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    ev = gap_sessions(ev, ["user_id"], "ts", ["event_id"], "12 HOURS")
    prefix = F.when(F.col("user_id") % 11 == 0, "agent-").when(F.col("user_id") % 13 == 0, "AGENT-").otherwise("u")
    return ev.withColumn(
        "session_id", F.concat(prefix, F.col("user_id").cast("string"), F.lit("."), F.col("session_no").cast("string"))
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    ev = numbered_events(spark, sf)
    kind = F.col("event_type")
    tool = F.when(kind == "view", "Read").when(kind == "click", "Edit").when(kind == "purchase", "Write").when(
        kind == "error", "Bash"
    )
    return ev.select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("id"),
        "session_id",
        F.when(kind == "signup", "user_prompt").otherwise("tool_call").alias("type"),
        F.concat_ws(" ", kind, F.col("props")).alias("content"),
        F.col("position"),
        epoch_seconds("ts").alias("timestamp"),
        F.col("ts").alias("created_at"),
        tool.alias("tool_name"),
        F.when(kind != "signup", F.concat(F.lit("src/file_"), F.col("k").cast("string"), F.lit(".py"))).alias("target_file"),
        F.when(kind == "signup", F.lit(None).cast("boolean")).otherwise(F.col("value") < 100).alias("success"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit('["f'), (F.col("k") % 30).cast("string"), F.lit('"]'))).alias("file_uuids"),
    )


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return stored("sessions", spark, sf, lambda: _sessions(spark, sf))


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    ev = numbered_events(spark, sf)
    agg = ev.groupBy("session_id", "user_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
        F.max("value").alias("centrality"),
        F.min_by("event_type", F.col("position")).alias("first_type"),
    )
    community = F.when(F.col("user_id") % 10 != 9, (F.col("user_id") % 10).cast("int"))
    return agg.select(
        "session_id",
        F.concat(F.lit("Session "), "session_id", F.lit(" by "), F.col("user_id").cast("string")).alias("title"),
        F.when(F.col("first_type") != "error", F.col("first_type")).alias("project"),
        "message_count", "started_at", "ended_at",
        community.alias("community_id"),
        F.concat(F.lit("community "), community.cast("string")).alias("community_label"),
        "centrality",
        F.when(F.col("centrality") >= 100, 1).otherwise(0).alias("is_hub"),
        F.when((F.col("centrality") >= 60) & (F.col("centrality") < 100), 1).otherwise(0).alias("is_bridge"),
        F.when(F.col("message_count") > 3, F.concat(F.lit("fp-"), F.col("message_count").cast("string"))).alias("fingerprint_index"),
    )


def delegation_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Every error hands over to the session of the same ordinal of the next user; some of those do not exist."""
    ev = numbered_events(spark, sf).filter(F.col("event_type") == "error")
    return ev.select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("chunk_id"),
        F.col("session_id").alias("parent_source_id"),
        F.concat(F.lit("u"), (F.col("user_id") + 1).cast("string"), F.lit("."), F.col("session_no").cast("string")).alias("child_session_id"),
        F.when(F.col("value") > 20, "explore").otherwise("worker").alias("agent_type"),
    )
