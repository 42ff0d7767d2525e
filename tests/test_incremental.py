"""Merges, signatures and the arrival stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tracelake.operators import sinks
from tracelake.sources import markdown_chat as chat
from tracelake.streaming import arrivals, incremental

KV = "id int, n int, v string"


def test_split_ingest_equals_one_ingest(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), i, f"v{i}") for i in range(200)]
    empty = spark.createDataFrame([], KV)
    whole = sinks.keep_first(empty, spark.createDataFrame(rows, KV), ["id"], ["n"])
    parts = empty
    for i in range(0, 200, 70):
        parts = sinks.keep_first(parts, spark.createDataFrame(rows[i:i + 70], KV), ["id"], ["n"])
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    again = sinks.keep_first(parts, spark.createDataFrame(rows, KV), ["id"], ["n"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, whole.collect()))


def test_replace_and_coalesce(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 2, None), (3, 3, "c")], KV)
    new = spark.createDataFrame([(1, 5, "x"), (1, 6, "y"), (4, 7, "z")], KV)
    assert sorted(map(tuple, sinks.replace(old, new, ["id"], ["n"]).collect())) == [(1, 6, "y"), (2, 2, None), (3, 3, "c"), (4, 7, "z")]
    upd = spark.createDataFrame([(1, None, "n1"), (2, 9, "n2")], KV)
    got = sorted(map(tuple, sinks.coalesce_update(old, upd, ["id"], old_wins=("v",), new_wins=("n",)).collect()))
    assert got == [(1, 1, "a"), (2, 9, "n2"), (3, 3, "c")]


def test_upserts_rewrite_touched_buckets_alone(spark, tmp_path):
    base = str(tmp_path / "t")
    old = spark.createDataFrame([(i, i, f"v{i}") for i in range(200)], KV)
    files = lambda: {str(p) for p in (tmp_path / "t").rglob("*.parquet")}
    rows = lambda: {r["id"]: (r["n"], r["v"]) for r in sinks.read_buckets(spark, base, old.schema).collect()}
    sinks.write_buckets(old, base, ["id"], 32)
    before, want = files(), rows()
    assert len(before) == 32
    batch = spark.createDataFrame([(7, 1, "x"), (7, 2, "y"), (1000, 5, "new")], KV)
    sinks.upsert_replace(batch, base, old.schema, ["id"], ["n"], 32)
    sinks.upsert_replace(batch, base, old.schema, ["id"], ["n"], 32)  # again, as after a failure
    want |= {7: (2, "y"), 1000: (5, "new")}
    assert rows() == want and 30 <= len(files() & before) < 32
    before = files()
    updates = spark.createDataFrame([(7, None, "late"), (8, 80, "late"), (5000, 1, "unknown")], KV)
    sinks.upsert_coalesce(updates, base, old.schema, ["id"], old_wins=("v",), new_wins=("n",), buckets=32)
    want |= {8: (80, "v8")}
    assert rows() == want and len(files() & before) >= 29
    sinks.upsert_replace(batch.where("false"), base, old.schema, ["id"], ["n"], 32)
    assert rows() == want


def test_audit(spark):
    stored = spark.createDataFrame([(1, 0, "k")], KV)
    batch = spark.createDataFrame([(1, 1, "k"), (2, 2, "k"), (2, 3, "k"), (3, None, "k"), (4, 4, "l")], KV)
    flagged = sinks.flag_batch(stored, batch, ["id"], ["n"], F.col("n").isNotNull())
    got = {r["v"]: (r["attempted"], r["inserted"], r["rejected"], r["params"]) for r in sinks.audit(flagged, "v", {"b": "1", "a": "2"}).collect()}
    assert got == {"k": (4, 1, 1, '{"a":"2","b":"1"}'), "l": (1, 1, 0, '{"a":"2","b":"1"}')}


def test_merged_statistics(spark):
    schema = "source_id string, type string, timestamp long"
    rows = [("s", "user_prompt", 5), ("s", "assistant", 9), ("t", "user_prompt", 1), ("s", "user_prompt", 2), ("u", "x", 7)]
    merged = incremental.merge_stats(
        incremental.source_stats(spark.createDataFrame(rows[:2], schema)), spark.createDataFrame(rows[2:], schema))
    whole = incremental.source_stats(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_signature(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "aider.chat.md").write_text("12345")
    (tmp_path / "aider.b.chat.md").write_text("123")
    (tmp_path / "other.md").write_text("1")
    files = incremental.file_listing(spark, str(tmp_path), "aider*.chat*.md")
    sig = incremental.directory_signature(files)
    assert tuple(sig.first()) == (8, 2)
    meta = spark.createDataFrame([("sig_total_size", "8"), ("sig_file_count", "2")], "key string, value string")
    assert not incremental.needs_resync(sig, meta, "sig_").first()[0]
    assert incremental.needs_resync(sig, meta.filter("key <> 'sig_file_count'"), "sig_").first()[0]
    assert incremental.store_signature(files).first()["size"] == 8


def test_cursors(spark):
    meta = spark.createDataFrame([("last_pull_ts", "100")], "key string, value string")
    rows = spark.createDataFrame([("a", 99), ("b", 100), ("c", 300)], "id string, timestamp long")
    assert sorted(r["id"] for r in incremental.since(rows, incremental.cursor(meta)).collect()) == ["b", "c"]
    assert incremental.since(rows, incremental.cursor(meta.limit(0))).count() == 3
    assert incremental.since(rows, incremental.cursor(meta, lateness=1)).count() == 3
    assert incremental.next_cursor(rows).first()["value"] == "300" and incremental.next_cursor(rows.limit(0)).first()["value"] == "0"
    known = spark.createDataFrame([("x", 10), ("y", 50)], "author string, cursor long")
    pulled = spark.createDataFrame([("x", 30), ("y", 20), ("z", 5)], "author string, created_utc long")
    assert {r["author"]: r["cursor"] for r in incremental.author_cursors(known, pulled).collect()} == {"x": 30, "y": 50, "z": 5}


@pytest.fixture
def shared(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "shared"))


HEAD = "# aider chat started at 2024-01-01 10:00:00\n#### one\nreply\n"


def test_stream_equals_batch(spark, tmp_path, shared):
    land, table, check = tmp_path / "land", str(tmp_path / "table"), str(tmp_path / "check")
    land.mkdir()
    (land / "aider.a.chat.md").write_text(HEAD)
    (land / "aider.b.chat.md").write_text("# aider chat started at never\n> Aider v1\n")
    arrivals.start(spark, str(land), table, check).awaitTermination()
    first = arrivals.stored_chunks(spark, table)
    assert first.count() == 5
    # The transcript grew: the new drop holds all of it under a versioned name.
    (land / "aider.a@2.chat.md").write_text(HEAD + "#### two\n> Applied edit to a.py\n")
    arrivals.start(spark, str(land), table, check).awaitTermination()
    arrivals.start(spark, str(land), table, check).awaitTermination()  # nothing new: nothing changes
    got = arrivals.stored_chunks(spark, table)
    path = [r["path"] for r in chat.read_transcripts(spark, str(land)).collect() if "aider.a.chat" in r["path"]][0]
    files = spark.createDataFrame([(path, HEAD + "#### two\n> Applied edit to a.py\n")], "path string, text string")
    blocks = chat.blocks(chat.lines(files))
    want = chat.chunk_rows(chat.sessions(files, blocks), blocks, 0).select("chunk_number", "content", "timestamp")
    mine = got.filter(F.col("timestamp") < 1704200000).select("chunk_number", "content", "timestamp")
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 7


def grow(path, text):
    """Append in place, with a later time than any before."""
    times = [p.stat().st_mtime for p in path.parent.glob("*")]
    with path.open("a") as f:
        f.write(text)
    os.utime(path, (max(times) + 5,) * 2)


def test_files_that_grow_in_place(spark, tmp_path, shared, monkeypatch):
    land, base = tmp_path / "land", str(tmp_path / "base")
    land.mkdir()
    a, b, odd = land / "aider.a.chat.md", land / "aider.b.chat.md", land / "aider.{c}*.chat.md"
    for p in (a, b, odd):
        p.write_text(HEAD)
    read = []
    plain = arrivals.read_files
    monkeypatch.setattr(arrivals, "read_files", lambda s, paths: read.extend(p.rpartition("/")[2] for p in paths) or plain(s, paths))
    refresh = lambda **k: arrivals.refresh(spark, str(land), base, files_per_batch=2, **k)
    rows = lambda: sorted((r["source_id"], r["chunk_number"], r["content"]) for r in arrivals.stored_chunks(spark, f"{base}/table").collect())
    assert refresh(dry_run=True) and refresh() and not refresh(dry_run=True)
    assert len(rows()) == 9 and sorted(read) == sorted(p.name for p in (a, b, odd))
    read.clear()
    assert not refresh() and read == []  # nothing has changed: nothing is read
    grow(a, "#### two\n> Applied edit to a.py\n")
    assert refresh(dry_run=True) and refresh() and read == [a.name]
    assert len(rows()) == 11 and len({r[:2] for r in rows()}) == 11
    before, read[:] = rows(), []
    grow(b, "more of the reply\n")  # a block below the mark that grows stays as it was stored
    a.unlink()
    (land / "aider.d.chat.md").write_text(HEAD)
    assert refresh() and sorted(read) == [b.name, "aider.d.chat.md"]
    assert set(before) < set(rows()) and len(rows()) == 14
    b.unlink()
    assert plain(spark, [f"file:{b}"]).count() == 0


def test_open_listing_is_ingested_later(spark, tmp_path, shared):
    """A run that ends between the snapshot and the stream loses nothing."""
    land, base = tmp_path / "land", str(tmp_path / "base")
    land.mkdir()
    (land / "aider.a.chat.md").write_text(HEAD)
    assert arrivals.snapshot(spark, str(land), f"{base}/listings")
    assert not arrivals.refresh(spark, str(land), base)
    assert arrivals.stored_chunks(spark, f"{base}/table").count() == 3


def test_replayed_batch_adds_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    files = spark.createDataFrame([("/l/aider.a.chat.md", HEAD, 5)], "path string, text string, modified long")
    arrivals.ingest_files(spark, files, table, 0)
    arrivals.ingest_files(spark, files, table, 0)  # the same batch again, after a failure
    arrivals.ingest_files(spark, files, table, 1)  # the same file again, as a later batch
    assert arrivals.stored_chunks(spark, table).count() == 3
