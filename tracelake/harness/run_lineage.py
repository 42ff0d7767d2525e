"""Registered queries for lineage, merges of batches and incremental refresh."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tracelake.harness import events as E
from tracelake.harness import feeds as H
from tracelake.harness.transcripts import landing
from tracelake.operators import sinks
from tracelake.plans import lineage
from tracelake.streaming import incremental

FILE = "src/file_7.py"
NAME = "FILE_7"
SPLIT = "2024-01-16 00:00:00"
SPLIT_EPOCH = 1705363200


def _bodies(spark, sf):
    """A body per write (JSON) and a plain backup per edit; many are equal."""
    ev = E.numbered_events(spark, sf).filter(F.col("event_type").isin("purchase", "click"))
    text = F.concat(F.lit("k"), (F.col("k") % 4).cast("string"), F.lit("\nu"), (F.col("user_id") % 3).cast("string"), F.lit("\nend"))
    as_json = F.concat(F.lit('{"content":"'), F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit('"}'))
    wrote = F.col("event_type") == "purchase"
    return ev.select(
        F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("chunk_id"),
        F.when(wrote, as_json).otherwise(text).alias("content"), F.when(wrote, "Write").otherwise("_file_backup").alias("tool_name"),
    )


def _versions(spark, sf):
    store, edges = sinks.content_store(_bodies(spark, sf))
    return lineage.recoverable(E.messages(spark, sf), edges, store)


def _context(spark, sf, around=2):
    m = E.messages(spark, sf)
    ranges = lineage.context_ranges(lineage.seam_units(m), E.sessions(spark, sf), around=around)
    return lineage.context_messages(ranges, m).groupBy("session_id", "unit", "from_pos", "to_pos").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("type") == "user_prompt").alias("prompts"))


def _lanes(spark, sf):
    m = E.messages(spark, sf).filter(F.col("tool_name").isNotNull()).select("session_id", F.col("tool_name").alias("lane")).distinct()
    n = m.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    status = F.when(F.col("n") > 3, "ambiguous").when(F.col("lane") == "Bash", "excluded").otherwise("assigned")
    return m.join(n, "session_id").select("session_id", "lane", status.alias("status"))


def _texts(spark, sf):
    """Documents keyed by their text, so copies share a key."""
    return E.table(spark, sf, "documents").select(F.md5("text").alias("key"), "doc_id", "lang", "source", "n_chars")


def _labelled(spark, sf):
    """The documents that carry a label: the part that was stored first."""
    labels = E.table(spark, sf, "labels").select("doc_id")
    return _texts(spark, sf).join(labels, "doc_id", "left_semi").select("key", "doc_id", "lang", "source", "n_chars")


def _first(spark, sf):
    from tracelake.operators.ranking import pick_first

    return pick_first(_labelled(spark, sf), ["key"], ["doc_id"])


def _table(spark, sf, name, rows):
    """The rows as a keyed table of a few buckets, its folder and its schema."""
    base = f"{landing(spark, sf, name)}-{uuid4().hex}"
    sinks.write_buckets(rows, base, ["key"], 16)
    return base, rows.schema


def _replaced(spark, sf):
    base, schema = _table(spark, sf, "replaced", _first(spark, sf))
    sinks.upsert_replace(_texts(spark, sf), base, schema, ["key"], ["doc_id"], 16)
    return sinks.read_buckets(spark, base, schema)


def _coalesced(spark, sf):
    target = _first(spark, sf).select(
        "key", "doc_id", F.when(F.col("n_chars") % 2 == 0, F.col("lang")).alias("lang"),
        F.when(F.col("n_chars") % 3 == 0, F.col("source")).alias("source"))
    from tracelake.operators.ranking import pick_last

    updates = pick_last(_texts(spark, sf), ["key"], ["doc_id"]).select(
        "key", F.concat(F.lit("new-"), "lang").alias("lang"),
        F.when(F.col("n_chars") % 5 != 0, F.concat(F.lit("new-"), "source")).alias("source"))
    base, schema = _table(spark, sf, "coalesced", target)
    sinks.upsert_coalesce(updates, base, schema, ["key"], old_wins=("lang",), new_wins=("source",), buckets=16)
    return sinks.read_buckets(spark, base, schema)


def _audit(spark, sf):
    flagged = sinks.flag_batch(_first(spark, sf), _texts(spark, sf), ["key"], ["doc_id"], F.col("n_chars") >= 50)
    return sinks.audit(flagged, "lang", {"batch": "all documents", "min_chars": "50"})


def _event_rows(spark, sf):
    from tracelake.functions.times import epoch_seconds

    return E.events(spark, sf).select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), epoch_seconds("ts").alias("timestamp"),
        F.col("event_type").alias("author"))


def _refresh(spark, sf):
    rows = _event_rows(spark, sf)
    # Stored so far: everything up to a day after the cursor, so the refresh overlaps it.
    old = rows.filter(F.col("timestamp") < SPLIT_EPOCH + 86400)
    meta = spark.createDataFrame([("last_pull_ts", str(SPLIT_EPOCH))], "key string, value string")
    return incremental.refresh(old, rows, meta, ["id"], ["timestamp"])


def _author_cursors(spark, sf):
    existing = spark.createDataFrame([("view", 1704100000), ("click", 1900000000), ("gone", 5)], "author string, cursor long")
    return incremental.author_cursors(existing, _event_rows(spark, sf).withColumnRenamed("timestamp", "created_utc"))


def _since_days(spark, sf):
    at = incremental.cursor(None, since_days=3, as_of=E.AS_OF)
    return incremental.since(_event_rows(spark, sf), at).groupBy("author").agg(F.count(F.lit(1)).alias("n"))


def _edited(spark, sf):
    """The files the caller asks about: here those written on the last day."""
    return E.messages(spark, sf).filter("tool_name = 'Write' AND created_at >= DATE '2024-01-30'").select("target_file")


def queries() -> dict:
    return {
        "path_iterations": lambda spark, sf: lineage.path_iterations(E.messages(spark, sf), NAME),
        "work_units": lambda spark, sf: lineage.work_units(E.messages(spark, sf), E.sessions(spark, sf), NAME, large=5),
        "seam_units": lambda spark, sf: lineage.seam_units(E.messages(spark, sf)),
        # Sessions of more than eight edits are cut, as those of more than TARGET are elsewhere.
        "seam_units_sliced": lambda spark, sf: lineage.seam_units(E.messages(spark, sf), target=8),
        "density_shifts_default": lambda spark, sf: lineage.density_shifts(E.messages(spark, sf)),
        "density_shifts": lambda spark, sf: lineage.density_shifts(E.messages(spark, sf), factor=2.0),
        "position_buckets": lambda spark, sf: lineage.position_buckets(E.messages(spark, sf), size=5),
        "context_ranges": _context,
        "context_ranges_default": lambda spark, sf: _context(spark, sf, lineage.CONTEXT),
        "recoverable_versions": lambda spark, sf: lineage.file_versions(_versions(spark, sf), FILE),
        "version_deltas": lambda spark, sf: lineage.version_deltas(_versions(spark, sf)).select(
            "target_file", "version", "chunk_id", "content_hash", "prev_hash", "added", "removed"),
        "file_provenance": lambda spark, sf: lineage.provenance(E.messages(spark, sf), E.sessions(spark, sf), FILE),
        "co_touched_files": lambda spark, sf: lineage.co_touched(E.messages(spark, sf), _edited(spark, sf)),
        "assignment_summary": lambda spark, sf: lineage.assignment_summary(E.sessions(spark, sf), _lanes(spark, sf)),
        "ingest_keep_first": lambda spark, sf: sinks.keep_first(_first(spark, sf), _texts(spark, sf), ["key"], ["doc_id"]),
        "ingest_replace": _replaced,
        "ingest_coalesce": _coalesced,
        "ingest_audit": _audit,
        "refresh_from_cursor": _refresh,
        "refresh_next_cursor": lambda spark, sf: incremental.next_cursor(_event_rows(spark, sf)),
        "refresh_since_days": _since_days,
        "author_cursors": _author_cursors,
    }
