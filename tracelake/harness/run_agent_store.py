"""Registered queries over the made agent store."""

from __future__ import annotations

from tracelake.harness import agent_store as H
from tracelake.operators import sinks
from tracelake.plans import digest
from tracelake.sources import agent_store as store


def _contents(spark, sf):
    body, _ = sinks.content_store(store.bodies(H.chunks(spark, sf)))
    return body.select("hash", "content", "byte_length")


def _body_edges(spark, sf):
    _, edges = sinks.content_store(store.bodies(H.chunks(spark, sf)))
    return edges


def queries() -> dict:
    return {
        "store_chunks": lambda spark, sf: H.chunks(spark, sf).drop("d"),
        "store_landed_chunks": lambda spark, sf: store.chunk_rows(*H.landed(spark, sf), H.FALLBACK).drop("d"),
        "store_sources": lambda spark, sf: store.source_rows(H.sessions(spark, sf), H.messages(spark, sf)),
        "store_sessions": lambda spark, sf: store.session_sidecar(H.sessions(spark, sf)),
        "store_parts": lambda spark, sf: store.part_sidecar(H.chunks(spark, sf)),
        "store_patches": lambda spark, sf: store.patch_records(H.chunks(spark, sf)),
        "store_content": _contents,
        "store_content_edges": _body_edges,
        "store_tool_counts": lambda spark, sf: digest.tool_outcomes(H.chunks(spark, sf)),
    }
