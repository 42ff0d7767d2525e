"""File history, artifact lineage, workstream evidence and seams of long sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracelake.functions.text import preview
from tracelake.functions.times import from_epoch
from tracelake.operators.sequences import TARGET, gap_sessions, previous, running, sliced, whole
from tracelake.plans.digest import WRITE_TOOLS

# Bodies a file can be recovered from.
FULL_BODY_TOOLS = ["Write", "_file_backup"]
LARGE_SESSION = 300
POSITION_BUCKET = 500
CONTEXT = 200


def _named(file_name: str) -> Column:
    return F.ilike(F.col("target_file"), F.lit(f"%{file_name}%"))


def path_iterations(messages: DataFrame, file_name: str) -> DataFrame:
    """Every path the artifact was seen at."""
    return (
        messages.filter(_named(file_name)).groupBy("target_file")
        .agg(F.count(F.lit(1)).alias("ops"), F.min("created_at").alias("first_touch"), F.max("created_at").alias("last_touch"))
    )


def work_units(messages: DataFrame, sessions: DataFrame, file_name: str, large: int = LARGE_SESSION) -> DataFrame:
    """Writes and edits of an artifact per session and day, with all tools used that day."""
    per_tool = (
        messages.filter(_named(file_name) & F.col("tool_name").isin(WRITE_TOOLS))
        .groupBy("session_id", F.to_date("created_at").alias("day"), "tool_name")
        .agg(
            F.count(F.lit(1)).alias("ops"), F.min("position").alias("first_pos"), F.max("position").alias("last_pos"),
            F.min("created_at").alias("start"), F.max("created_at").alias("end"),
        )
    )
    units = per_tool.groupBy("session_id", "day").agg(
        F.array_join(F.array_sort(F.collect_list("tool_name")), ",").alias("tools"), F.sum("ops").alias("ops"),
        F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos"),
        F.min("start").alias("start"), F.max("end").alias("end"),
    )
    about = sessions.select("session_id", "title", "project", "message_count")
    return units.join(about, "session_id").withColumn("is_large", F.col("message_count") >= large)


def edits(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("tool_name").isin(WRITE_TOOLS)).select("session_id", "id", "position", "created_at")


def seam_units(messages: DataFrame, gap: str = "1 HOUR", target: int = TARGET) -> DataFrame:
    """Edits of a session cut at day boundaries and at gaps above an hour. Sessions of more than `target` edits are worked on in slices."""
    cut = gap_sessions(
        edits(messages).withColumnRenamed("position", "message_position"), ["session_id"], "created_at", ["message_position", "id"],
        gap, same_day=True, target=target,
    )
    return cut.groupBy("session_id", F.col("session_no").alias("unit")).agg(
        F.count(F.lit(1)).alias("ops"), F.min("message_position").alias("first_pos"), F.max("message_position").alias("last_pos"),
        F.min("created_at").alias("start"), F.max("created_at").alias("end"),
    )


def density_shifts(messages: DataFrame, factor: float = 3.0) -> DataFrame:
    """Hours in which a session edits at least `factor` times as much as in its previous active hour."""
    hourly = (
        edits(messages).groupBy("session_id", F.date_trunc("hour", "created_at").alias("hour"))
        .agg(F.count(F.lit(1)).alias("edits"))
    )
    lagged = whole(previous(sliced(hourly, ["session_id"], ["hour"]), ["hour"], {"before": "edits"}))
    return lagged.filter(F.col("edits") >= factor * F.col("before"))


def position_buckets(messages: DataFrame, size: int = POSITION_BUCKET) -> DataFrame:
    """Edits per block of positions, with the time they span."""
    return (
        edits(messages).groupBy("session_id", F.floor((F.col("position") - 1) / size).cast("long").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("edits"), F.min("created_at").alias("start"), F.max("created_at").alias("end"))
    )


def context_ranges(units: DataFrame, sessions: DataFrame, around: int = CONTEXT) -> DataFrame:
    """Overlapping message ranges round each unit, kept inside the session."""
    ends = sessions.select("session_id", "message_count")
    return units.join(ends, "session_id").select(
        "session_id", "unit", F.greatest(F.lit(1), F.col("first_pos") - around).alias("from_pos"),
        F.least("message_count", F.col("last_pos") + around).alias("to_pos"),
    )


def context_messages(ranges: DataFrame, messages: DataFrame, size: int = POSITION_BUCKET) -> DataFrame:
    """Messages of every context range: an equi-join on (session, position block), then the exact test."""
    def block(c) -> Column:
        return F.floor(F.col(c) / F.lit(size)).cast("long")

    spans = ranges.select("*", F.explode(F.sequence(block("from_pos"), block("to_pos"))).alias("__block"))
    m = messages.select("session_id", "id", "position", "type", block("position").alias("__block"))
    hit = spans.join(m, ["session_id", "__block"]).filter(F.col("position").between(F.col("from_pos"), F.col("to_pos")))
    return hit.drop("__block")


def recoverable(messages: DataFrame, edges: DataFrame, store: DataFrame) -> DataFrame:
    """Every full body of every file with where it was seen. Edges and store are the content store."""
    bodies = store.filter(F.col("tool_name").isin(FULL_BODY_TOOLS)).select(
        F.col("hash").alias("content_hash"), F.col("tool_name").alias("body_tool"), "byte_length", "content"
    )
    where = messages.filter(F.col("target_file").isNotNull()).select(
        F.col("id").alias("chunk_id"), "target_file", "session_id", "timestamp", "position"
    )
    return edges.join(where, "chunk_id").join(bodies, "content_hash")


def file_versions(versions: DataFrame, path: str) -> DataFrame:
    """Recoverable versions of one file in time order."""
    return (
        versions.filter(F.col("target_file") == path).orderBy("timestamp", "session_id", "position")
        .select("chunk_id", "session_id", "timestamp", "position", F.col("body_tool").alias("tool_name"), "byte_length",
                preview("content", 100).alias("preview"))
    )


def body_text(tool: Column, content: Column) -> Column:
    """File text of a stored body: a Write body is JSON, a backup is the text itself."""
    return F.when(tool == "Write", F.get_json_object(content, "$.content")).otherwise(content)


def version_deltas(versions: DataFrame) -> DataFrame:
    """All versions of all files, numbered, with lines added and removed since the version before.

    The texts are compared once per distinct pair of bodies, not once per version.
    """
    slim = versions.select("target_file", "chunk_id", "content_hash", "body_tool", "timestamp", "session_id", "position")
    order = ["timestamp", "session_id", "position", "chunk_id"]
    cut = previous(sliced(slim, ["target_file"], order), order, {"prev_hash": "content_hash"})
    placed = whole(running(cut, order, version=("sum", F.lit(1).cast("long"))))
    lines = versions.groupBy("content_hash").agg(
        F.any_value(F.split(body_text(F.col("body_tool"), F.col("content")), "\n")).alias("lines")
    )
    pairs = placed.filter(F.col("prev_hash").isNotNull()).select("content_hash", "prev_hash").distinct()
    delta = (
        pairs.join(lines, "content_hash")
        .join(lines.select(F.col("content_hash").alias("prev_hash"), F.col("lines").alias("old")), "prev_hash")
        .select("content_hash", "prev_hash", F.size(F.array_except("lines", "old")).alias("added"),
                F.size(F.array_except("old", "lines")).alias("removed"))
    )
    return placed.join(delta, ["content_hash", "prev_hash"], "left")


def provenance(messages: DataFrame, sessions: DataFrame, path: str, shift_hours: int = -7) -> DataFrame:
    """Sessions that wrote or edited a file, with first and last touch in a fixed-offset local time."""
    touched = (
        messages.filter((F.col("target_file") == path) & F.col("tool_name").isin(WRITE_TOOLS))
        .groupBy("session_id")
        .agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.count(F.lit(1)).alias("ops"))
    )

    def local(c: str) -> Column:
        return from_epoch(F.col(c) + shift_hours * 3600).cast("timestamp_ntz")

    return touched.join(sessions.select("session_id", "title"), "session_id").select(
        "session_id", "title", local("lo").alias("first_touch"), local("hi").alias("last_touch"), "ops"
    )


def co_touched(messages: DataFrame, wanted: DataFrame, min_sessions: int = 2) -> DataFrame:
    """All files touched together with the wanted ones (target_file), by number of shared sessions.

    A row (session, file) meets the wanted files of its session alone; pairs of
    two other files are never built.
    """
    touched = messages.filter(F.col("target_file").isNotNull()).select("session_id", "target_file").distinct()
    asked = touched.join(wanted.select("target_file").distinct(), "target_file", "left_semi").select("session_id", F.col("target_file").alias("file"))
    pairs = touched.select("session_id", F.col("target_file").alias("with_file")).join(asked, "session_id")
    return (
        pairs.filter(F.col("file") != F.col("with_file")).groupBy("file", "with_file")
        .agg(F.count(F.lit(1)).alias("sessions")).filter(F.col("sessions") >= min_sessions)
    )


def assignment_summary(sessions: DataFrame, lanes: DataFrame) -> DataFrame:
    """Counts of a session-to-lane ledger (session_id, lane, status): one row."""
    def any_with(status: str) -> Column:
        return F.max(F.when(F.col("status") == status, 1).otherwise(0))

    per = lanes.groupBy("session_id").agg(
        any_with("assigned").alias("assigned"), any_with("ambiguous").alias("ambiguous"), any_with("excluded").alias("excluded"),
        F.count(F.when(F.col("status") == "assigned", 1)).alias("lanes"),
    )
    counted = per.agg(
        F.sum("assigned").alias("assigned"), F.sum("ambiguous").alias("ambiguous"), F.sum("excluded").alias("excluded"),
        F.count_if(F.col("lanes") > 1).alias("in_several_lanes"),
    )
    streams = lanes.filter(F.col("status") == "assigned").agg(F.countDistinct("lane").alias("n"))
    considered = sessions.agg(F.count(F.lit(1)).alias("considered"))
    return counted.withColumn("workstreams", streams.scalar()).withColumn("considered", considered.scalar())
