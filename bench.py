"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default: the list below).
Each query is run once from cold plans; the result is consumed whole by the noop sink.
Rows that several queries find already ingested are made by the first one that needs them.
Before, the tables are written anew in as many files as there are cores; that is not timed.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tracelake.harness import registry  # noqa: E402
from tracelake.session import local_session  # noqa: E402

HEADLINE = [
    "topology_seed", "topology_communities", "topology_hubs", "topology_hub_openers", "topology_bridges",
    "topology_projects", "topology_weekly_pulse", "topology_pulse_grid", "digest_inventory", "digest_file_hotspots",
    "digest_delegations", "digest_open_loops", "digest_work_rhythm", "digest_file_heat", "article_heads",
    "comment_tree_flat", "view_article_chunks", "recent_articles", "top_stories", "article_tag_counts", "page_text",
    "transcript_blocks", "transcript_sessions", "transcript_chunks", "transcript_high_water", "store_chunks",
    "seam_units", "version_deltas", "co_touched_files", "ingest_keep_first", "ingest_replace", "refresh_from_cursor",
    "keyword_postings", "keyword_search", "vector_top", "vector_diverse", "hybrid_search", "embed_documents",
    "source_graph", "workstream_clusters",
]


def spread(spark, sf: str, files: int) -> str:
    """The tables in several files each, as a cluster has them, in a folder of their own; the test files have one row group, which one task reads."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for path in sorted(glob.glob(f"{sf}/*.parquet")):
        rows = spark.read.parquet(path)
        small = os.path.isfile(path) and os.path.getsize(path) < 1 << 20
        (rows.coalesce(1) if small else rows.repartition(files)).write.parquet(f"{folder}/{os.path.basename(path)}")
    return folder


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, "bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    sf_dir, sf = sf, spread(spark, sf, int(cpus) if cpus.isdigit() else 8)
    queries = registry.queries()
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names.split(",") if names else HEADLINE:
        t0 = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
