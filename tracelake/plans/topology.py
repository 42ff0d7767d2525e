"""Session topology reports: recent communities seed every other report.

`sessions` has session_id, title, project, message_count, started_at, ended_at,
community_id, community_label, centrality, is_hub, is_bridge, fingerprint_index.
`messages` has id, session_id, type, content, position and more.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tracelake.functions.text import preview
from tracelake.functions.times import calendar_since, instant, week_end, week_start, whole_days_between
from tracelake.operators.ranking import top_per_group


def seed(sessions: DataFrame, as_of, days: int = 14, min_sessions: int = 5) -> DataFrame:
    """Communities with at least min_sessions sessions in the window."""
    recent = sessions.filter(calendar_since("started_at", as_of, days) & F.col("community_id").isNotNull())
    keys = ["community_id", "community_label"]
    # One aggregate per project first: the session rows are combined before any project list is made.
    per_project = recent.groupBy(*keys, "project").agg(
        F.count(F.lit(1)).alias("n"), F.sum("message_count").alias("msgs")
    )
    return (
        per_project.groupBy(*keys)
        .agg(
            F.sum("n").alias("recent_sessions"),
            F.sum("msgs").alias("recent_msgs"),
            F.array_join(F.array_sort(F.collect_list("project")), ",").alias("projects"),
        )
        .filter(F.col("recent_sessions") >= min_sessions)
    )


def seed_ids(seeded: DataFrame) -> DataFrame:
    return seeded.select("community_id").distinct()


def in_seed(sessions: DataFrame, seeded: DataFrame) -> DataFrame:
    """Sessions of the seeded communities; AQE broadcasts the ids when they are small."""
    return sessions.join(seed_ids(seeded), "community_id", "left_semi")


def communities(sessions: DataFrame, seeded: DataFrame) -> DataFrame:
    return (
        in_seed(sessions, seeded)
        .groupBy("community_id", "community_label")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("message_count").alias("total_msgs"),
            F.sum("is_hub").alias("hubs"),
            F.sum("is_bridge").alias("bridges"),
            F.round(F.avg("centrality"), 6).alias("avg_centrality"),
            F.max("started_at").alias("newest"),
            F.min("started_at").alias("oldest"),
        )
    )


def _by_centrality() -> list[Column]:
    return [F.col("centrality").desc(), F.col("session_id").asc()]


def ranked_hubs(sessions: DataFrame, seeded: DataFrame, k: int) -> DataFrame:
    hubs = in_seed(sessions.filter(F.col("is_hub") == 1), seeded)
    return top_per_group(hubs, ["community_id"], _by_centrality(), k)


def hubs(sessions: DataFrame, seeded: DataFrame, k: int = 3) -> DataFrame:
    """The k most central hub sessions of every seeded community."""
    return ranked_hubs(sessions, seeded, k).select(
        F.col("community_label").alias("community"), "community_id", "rn", "session_id",
        preview("title", 120).alias("title"),
        F.coalesce("fingerprint_index", F.lit("")).alias("fingerprint"),
        F.round("centrality", 6).alias("centrality"),
        F.col("message_count").alias("msgs"), F.col("started_at").alias("started"),
    )


def hub_openers(sessions: DataFrame, messages: DataFrame, seeded: DataFrame, k: int = 2) -> DataFrame:
    """First user prompt of the k most central hubs per seeded community."""
    top = ranked_hubs(sessions, seeded, k).select(
        F.col("community_label").alias("community"), "session_id",
        F.coalesce("fingerprint_index", F.lit("")).alias("fingerprint"),
    )
    prompts = messages.filter(F.col("type") == "user_prompt").select("session_id", "position", "content")
    first = (
        prompts.join(top.select("session_id"), "session_id", "left_semi")
        .groupBy("session_id")
        .agg(F.min_by(preview("content", 300), F.col("position")).alias("opener"))
    )
    return top.join(first, "session_id").select("community", "session_id", "fingerprint", "opener")


def bridges(sessions: DataFrame, seeded: DataFrame, limit: int = 8) -> DataFrame:
    """Most central bridge sessions over all seeded communities."""
    return (
        in_seed(sessions.filter(F.col("is_bridge") == 1), seeded)
        .orderBy(*_by_centrality())
        .limit(limit)
        .select(
            "session_id", preview("title", 120).alias("title"),
            F.coalesce("fingerprint_index", F.lit("")).alias("fingerprint"),
            F.col("community_label").alias("community"), F.round("centrality", 6).alias("centrality"),
            F.col("message_count").alias("msgs"), F.col("started_at").alias("started"),
        )
    )


def projects(sessions: DataFrame, seeded: DataFrame, as_of, limit: int = 25) -> DataFrame:
    agg = (
        in_seed(sessions.filter(F.col("project").isNotNull()), seeded)
        .groupBy("project")
        .agg(
            F.count(F.lit(1)).alias("sessions"), F.sum("message_count").alias("total_msgs"),
            F.min("started_at").alias("first_seen"), F.max("started_at").alias("last_seen"),
        )
    )
    return (
        agg.orderBy(F.col("sessions").desc(), F.col("project").asc())
        .limit(limit)
        .withColumn("days_active", whole_days_between(F.col("last_seen"), F.col("first_seen")))
        .withColumn("days_since_last", whole_days_between(instant(as_of), F.col("last_seen")))
    )


def weekly_pulse(sessions: DataFrame, seeded: DataFrame, as_of, days: int = 60) -> DataFrame:
    return (
        in_seed(sessions.filter(calendar_since("started_at", as_of, days)), seeded)
        .groupBy(
            week_start("started_at").alias("week_start"), week_end("started_at").alias("week_end"),
            F.col("community_label").alias("community"),
        )
        .agg(F.count(F.lit(1)).alias("sessions"), F.sum("message_count").alias("msgs"))
    )


def weeks_of(as_of, days: int = 60) -> list[str]:
    """All Mondays of the window, oldest first."""
    last = date.fromisoformat(str(as_of)[:10])
    first = last - timedelta(days=days)
    monday = first - timedelta(days=first.weekday())
    return [(monday + timedelta(weeks=i)).isoformat() for i in range((last - monday).days // 7 + 1)]


def pulse_grid(pulse: DataFrame, weeks: list[str]) -> DataFrame:
    """Community by week; cell length 1..5 relative to the peak, a dot for no activity."""
    peak = pulse.agg(F.max("sessions").alias("p")).scalar()
    cells = pulse.groupBy("community").pivot("week_start", weeks).agg(F.sum("sessions"))

    def cell(name: str) -> Column:
        n = F.coalesce(F.col(f"`{name}`"), F.lit(0))
        block = F.expr(f"repeat('◼', cast(ceil(5 * `{name}` / __peak) as int))")
        return F.when(n == 0, F.lit("·")).otherwise(block).alias(name)

    return cells.withColumn("__peak", peak).select("community", *[cell(w) for w in weeks])


def lane_timeline(sessions: DataFrame) -> DataFrame:
    """First and last activity and number of active weeks per community."""
    weekly = sessions.groupBy("community_id", week_start("started_at").alias("week")).agg(
        F.min("started_at").alias("first_at"), F.max("ended_at").alias("last_at"), F.count(F.lit(1)).alias("n")
    )
    return weekly.groupBy("community_id").agg(
        F.min("first_at").alias("first_activity"), F.max("last_at").alias("last_activity"),
        F.count(F.lit(1)).alias("active_weeks"), F.sum("n").alias("sessions"),
    )
