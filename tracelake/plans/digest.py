"""Daily digest reports over the sessions and messages tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracelake.functions.text import preview
from tracelake.functions.times import calendar_since

# Tools that touch files.
FILE_TOOLS = ["Edit", "Write", "Read"]
WRITE_TOOLS = ["Write", "Edit"]
AGENT_PATTERN = "agent-%"


def human_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions whose id does not start with the agent prefix, in any letter case."""
    return sessions.filter(~F.ilike(F.col("session_id"), F.lit(AGENT_PATTERN)))


def recent_sessions(sessions: DataFrame, as_of, days: int = 1) -> DataFrame:
    return human_sessions(sessions.filter(calendar_since("started_at", as_of, days)))


def inventory(sessions: DataFrame, as_of, days: int = 1) -> DataFrame:
    return recent_sessions(sessions, as_of, days).select(
        F.col("session_id").alias("id"), preview("title", 120).alias("title"), F.col("message_count").alias("msgs"),
        F.col("started_at").alias("start"), F.col("ended_at").alias("end"), F.col("community_label").alias("community"),
        F.round("centrality", 6).alias("centrality"), F.col("is_hub").alias("hub"), F.col("is_bridge").alias("bridge"),
        F.col("fingerprint_index").alias("fingerprint"),
    )


def inventory_projects(sessions: DataFrame, as_of, days: int = 1) -> DataFrame:
    return (
        recent_sessions(sessions, as_of, days)
        .groupBy("project")
        .agg(F.count(F.lit(1)).alias("sessions"), F.sum("message_count").alias("total_msgs"))
    )


def inventory_document(sessions: DataFrame, as_of, days: int = 1) -> DataFrame:
    """The report as JSON objects: one row per session and per project, so its size is bounded by no cell."""
    text = {"ignoreNullFields": "false"}
    listed = inventory(sessions, as_of, days)
    for c in ("start", "end"):
        listed = listed.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    projects = inventory_projects(sessions, as_of, days)
    return listed.select(F.lit("session").alias("kind"), F.to_json(F.struct(*listed.columns), text).alias("payload")).union(
        projects.select(F.lit("project"), F.to_json(F.struct("project", "sessions", "total_msgs"), text))
    )


def file_identity() -> Column:
    return F.coalesce(F.get_json_object("file_uuids", "$[0]"), F.col("target_file"))


def file_hotspots(messages: DataFrame, as_of, days: int = 1, limit: int = 25) -> DataFrame:
    """Files by number of operations; a file known under several paths counts once."""
    ops = messages.filter(
        calendar_since("created_at", as_of, days)
        & F.col("tool_name").isin(FILE_TOOLS)
        & F.col("target_file").isNotNull()
    ).select(file_identity().alias("file_id"), "target_file", "session_id", "tool_name")
    # One row per (file, session, tool) before anything is counted distinct or listed.
    cells = ops.groupBy("file_id", "session_id", "tool_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("target_file").alias("target_file")
    )
    per_tool = cells.groupBy("file_id", "tool_name").agg(F.min("target_file").alias("target_file"), F.sum("n").alias("n"))
    per_session = cells.select("file_id", "session_id").distinct().groupBy("file_id").agg(
        F.count(F.lit(1)).alias("sessions")
    )
    per_file = (
        per_tool.groupBy("file_id")
        .agg(
            F.min("target_file").alias("file"), F.sum("n").alias("ops"),
            F.array_join(F.array_sort(F.collect_list("tool_name")), ",").alias("tools"),
        )
        .orderBy(F.col("ops").desc(), F.col("file_id").asc())
        .limit(limit)
    )
    return per_file.join(per_session, "file_id").select("file", "sessions", "ops", "tools")


def delegations(edges: DataFrame, sessions: DataFrame, messages: DataFrame, as_of, days: int = 1) -> DataFrame:
    """Delegations made in recent messages, with the child session where it is known."""
    recent = messages.filter(calendar_since("created_at", as_of, days)).select(F.col("id").alias("chunk_id"))
    child = sessions.select(
        F.col("session_id").alias("child_session_id"), preview("title", 80).alias("child_title"),
        F.col("message_count").alias("child_msgs"),
    )
    return (
        edges.join(recent, "chunk_id", "left_semi")
        .join(child, "child_session_id", "left")
        .select(
            F.col("parent_source_id").alias("parent"), F.col("child_session_id").alias("child"), "agent_type",
            "child_title", "child_msgs",
        )
    )


def _overnight():
    return F.to_date("started_at") != F.to_date("ended_at")


def open_loops(sessions: DataFrame, as_of, days: int = 1, large: int = 100) -> DataFrame:
    """Recent sessions that crossed midnight or grew large."""
    return (
        recent_sessions(sessions, as_of, days)
        .filter(_overnight() | (F.col("message_count") > large))
        .select(
            F.col("session_id").alias("id"), preview("title", 100).alias("title"),
            F.col("message_count").alias("msgs"), F.col("ended_at").alias("ended"),
            F.when(_overnight(), 1).otherwise(0).alias("overnight"),
        )
    )


def work_rhythm(sessions: DataFrame, messages: DataFrame, large: int = 100) -> DataFrame:
    """Per hour: messages, sessions started, and how many of those carried overnight or grew long."""
    busy = messages.groupBy(F.date_trunc("hour", "created_at").alias("hour")).agg(F.count(F.lit(1)).alias("messages"))
    starts = sessions.groupBy(F.date_trunc("hour", "started_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("started"),
        F.sum(F.when(_overnight(), 1).otherwise(0)).alias("overnight"),
        F.sum(F.when(F.col("message_count") > large, 1).otherwise(0)).alias("long_sessions"),
    )
    zero = {"messages": 0, "started": 0, "overnight": 0, "long_sessions": 0}
    return busy.join(starts, "hour", "full").fillna(zero)


def file_heat(messages: DataFrame, min_sessions: int = 2) -> DataFrame:
    """Files touched by at least min_sessions sessions."""
    pairs = (
        messages.filter(F.col("target_file").isNotNull())
        .groupBy("target_file", "session_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        pairs.groupBy("target_file")
        .agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("ops"))
        .filter(F.col("sessions") >= min_sessions)
    )


def tool_outcomes(messages: DataFrame) -> DataFrame:
    return (
        messages.filter(F.col("tool_name").isNotNull())
        .groupBy("tool_name", "success")
        .agg(F.count(F.lit(1)).alias("n"))
    )
