"""Registered queries over the made transcripts and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.harness import transcripts as H
from tracelake.operators import sinks
from tracelake.sources import logs, markdown_chat as chat
from tracelake.streaming import arrivals, incremental


def _analytics(spark, sf):
    return logs.analytics(H.analytics_files(spark, sf)).select(
        "path", "_line", "event", "raw", F.try_variant_get("payload", "$.user", "long").alias("user")
    )


def _high_water(spark, sf):
    fresh = incremental.above_high_water(H.chunks(spark, sf, half=True), H.chunks(spark, sf))
    return fresh.select("chunk_id", "chunk_number", "content", "type")


def _stats(spark, sf):
    """Statistics of the half-written transcripts, merged with the rows above the mark."""
    old = H.chunks(spark, sf, half=True)
    return incremental.merge_stats(incremental.source_stats(old), incremental.above_high_water(old, H.chunks(spark, sf)))


def _blocks(spark, sf):
    return H.blocks(spark, sf).drop("event", "raw")


def _events(spark, sf):
    event = F.col("event")
    fields = ["command", "command_name", "command_kind", "version", "model_name", "edit_format", "path", "lines",
              "answer", "no_git", "dry_run"]
    return H.blocks(spark, sf).filter("event_kind is not null").select(
        "path", F.col("block_no"), *[chat.value(event, f).alias(f"f_{f}") for f in fields]
        , F.col("session_index")
    )


def _content_store(spark, sf):
    store, _ = sinks.content_store(chat.raw_bodies(H.chunks(spark, sf)))
    return store.select("hash", "content", "byte_length")


def _scanned(spark, sf):
    """Transcripts read back from their files."""
    files = chat.read_transcripts(spark, H.landed(spark, sf))
    return files.select(H.logical(F.col("path")).alias("path"), F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("digest"))


def _line_scan(spark, sf):
    """Lines of the files as they are read by byte range."""
    rows = chat.read_lines(spark, H.landed(spark, sf))
    return rows.select(H.logical(F.col("path")).alias("path"), "session_index", "line_no", "role", "raw")


def _signature(spark, sf):
    listed = incremental.file_listing(spark, H.landed(spark, sf), arrivals.PATTERN)
    return incremental.directory_signature(listed)


def _streamed(spark, sf):
    kept = H.streamed(spark, sf)
    return kept.select("source_id", "chunk_number", (F.col("type") == "user_prompt").cast("long").alias("prompt"))


def queries() -> dict:
    return {
        "transcript_scan": _scanned,
        "transcript_line_scan": _line_scan,
        "transcript_signature": _signature,
        "transcript_stream": _streamed,
        "transcript_lines": lambda spark, sf: chat.lines(H.files(spark, sf)).select(
            "path", "session_index", "line_no", "role", "raw"),
        "transcript_blocks": _blocks,
        "transcript_sessions": lambda spark, sf: H.sessions(spark, sf).select(
            "path", "session_index", "start_line", "end_line", "started_at", "command", "version", "model", "git_repo",
            "repo_map", "title", "block_count", "source_id"),
        "transcript_events": _events,
        "transcript_chunks": lambda spark, sf: H.chunks(spark, sf).drop("event", "raw"),
        "transcript_sources": lambda spark, sf: chat.source_rows(H.sessions(spark, sf)),
        "transcript_turns": lambda spark, sf: chat.turns(H.chunks(spark, sf)),
        "transcript_tool_events": lambda spark, sf: chat.tool_events(H.chunks(spark, sf)),
        "transcript_usage": lambda spark, sf: chat.usage(H.chunks(spark, sf)),
        "transcript_git_events": lambda spark, sf: chat.git_events(H.chunks(spark, sf)),
        "transcript_content_store": _content_store,
        "transcript_coverage": lambda spark, sf: chat.coverage(H.blocks(spark, sf)),
        "transcript_unclassified": lambda spark, sf: chat.unclassified(H.blocks(spark, sf)),
        "transcript_high_water": _high_water,
        "source_stats": _stats,
        "input_history": lambda spark, sf: logs.input_history(H.input_files(spark, sf)),
        "model_log": lambda spark, sf: logs.model_log(H.model_files(spark, sf)),
        "analytics_log": _analytics,
    }
