"""Agent store export: ordering, text, success, timestamps, patches."""

import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from tracelake.sources import agent_store as store


def part(n, message, data, created=1704067200000, session="s"):
    return {"id": f"p{n}", "message_id": message, "session_id": session, "time_created": created, "time_updated": created,
            "data": data if isinstance(data, str) else json.dumps(data)}


READ = "<content>\n00001: import os\n00002: \n00003: x = 1: y\n\n(End of file - total 3 lines)\n</content>"
PARTS = [
    part(1, "m1", {"type": "text", "text": " hello "}),
    part(0, "m1", {"type": "text", "text": "same time, smaller id"}),
    part(2, "m1", {"type": "text", "text": "   "}),
    part(3, "m2", "not json"),
    part(4, "m2", {"type": "step-start"}),
    part(5, "m2", {"type": "tool", "tool": "bash", "state": {"status": "completed", "input": {"command": "ls"}, "output": "a\n", "metadata": {"exit": 1}}}, 1704067200001),
    part(6, "m2", {"type": "tool", "tool": "bash", "state": {"status": "completed", "input": {"command": "ls"}, "metadata": {"exit": "x", "output": "from meta"}}}, 1704067200002),
    part(7, "m2", {"type": "tool", "tool": "bash", "state": {"status": "completed", "input": {}, "metadata": {"exit": None}}}, 1704067200003),
    part(8, "m2", {"type": "tool", "tool": "read", "state": {"status": "completed", "input": {"filePath": "/a.py"}, "output": READ, "time": {"start": 1704067300000}}}, 1704067200004),
    part(9, "m2", {"type": "tool", "tool": "apply_patch", "state": {"status": "error", "input": {"patchText": "*** P"}, "metadata": {"files": [{"relativePath": "r.py"}], "diff": "D"}}}, 1704067200005),
    part(10, "m2", {"type": "tool", "tool": "apply_patch", "state": {"status": "running", "output": "out"}}, 1704067200006),
    part(11, "m2", {"type": "patch", "files": ["a", "b"], "patch": "Q"}, 1704067200007),
    part(12, "m2", {"type": "tool", "tool": "grep", "state": {"status": "failed", "title": "find x"}}, 1704067200008),
    part(13, "gone", {"type": "text", "text": "no message"}),
    part(14, "m2", {"type": "tool", "state": "odd"}, 1704067200009),
]
MESSAGES = [
    {"id": "m2", "session_id": "s", "time_created": 1704067201000, "data": json.dumps({"role": "assistant", "model": {"providerID": "p", "modelID": "n"}, "path": {"cwd": "/w"}})},
    {"id": "m1", "session_id": "s", "time_created": 1704067200, "data": json.dumps({"role": "user", "modelID": "m"})},
    {"id": "m0", "session_id": "s", "time_created": None, "data": "[]"},
]
SESSIONS = [{"id": "s", "directory": "/d", "title": "t", "time_created": 1704067200000}, {"id": "empty", "directory": "/e", "time_created": 5}]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("store")
    for name, rows in (("session", SESSIONS), ("message", MESSAGES), ("part", PARTS)):
        (folder / name).mkdir()
        (folder / name / "x.json").write_text("\n".join(json.dumps(r) for r in rows))
    return store.read_store(spark, str(folder)), str(folder)


@pytest.fixture(scope="module")
def chunks(tables):
    return store.chunk_rows(*tables[0], 1700000000).persist()


def by_part(df):
    return {r["part_id"]: r for r in df.collect()}


def test_numbering_filters_first(chunks):
    got = by_part(chunks)
    order = [r["part_id"] for r in sorted(got.values(), key=lambda r: r["chunk_number"])]
    assert order == ["p0", "p1", "p5", "p6", "p7", "p8", "p9", "p10", "p11", "p12", "p14"]
    assert [got[p]["chunk_number"] for p in order] == list(range(1, 12))
    assert got["p1"]["content"] == "hello" and got["p1"]["type"] == "user_prompt" and got["p5"]["type"] == "tool_call"


def test_contents(chunks):
    got = by_part(chunks)
    assert got["p5"]["content"] == "Bash: ls\na" and got["p6"]["content"] == "Bash: ls\nfrom meta" and got["p7"]["content"] == "Bash:"
    assert got["p8"]["content"] == f"Read: /a.py\n{READ}" and got["p9"]["content"] == "Edit: r.py\n*** P"
    assert got["p10"]["content"] == "Edit: \nout" and got["p11"]["content"] == "Patch: a, b" and got["p12"]["content"] == "grep: find x"
    assert got["p14"]["content"].startswith("tool: {")


def test_tools_and_success(chunks):
    got = by_part(chunks)
    assert [(got[p]["tool_name"], got[p]["success"]) for p in ("p5", "p6", "p7", "p8", "p9", "p10", "p11", "p12")] == [
        ("Bash", False), ("Bash", None), ("Bash", None), ("Read", True), ("Edit", False), ("Edit", None), (None, None), ("grep", False)]
    assert got["p8"]["target_file"] == "/a.py" and got["p9"]["target_file"] == "r.py" and got["p10"]["target_file"] is None


def test_times_models_and_folders(chunks):
    got = by_part(chunks)
    assert got["p8"]["timestamp"] == 1704067300 + got["p8"]["chunk_number"] and got["p0"]["timestamp"] == 1704067201
    assert (got["p0"]["model"], got["p0"]["cwd"], got["p5"]["model"], got["p5"]["cwd"]) == ("m", "/d", "p/n", "/w")


def test_sources_take_the_first_model(tables):
    (sessions, messages, _), folder = tables
    got = {r["source_id"]: r for r in store.source_rows(sessions, messages).collect()}
    assert got["opencode:s"]["model"] == "m" and got["opencode:s"]["file_date"] == "1704067200000" and got["opencode:empty"]["model"] is None
    assert [r["id"] for r in store.read_store(sessions.sparkSession, folder, limit=1)[0].collect()] == ["empty"]
    assert store.session_sidecar(sessions).count() == 2


def test_patches_and_bodies(chunks):
    got = {r["chunk_id"]: r for r in store.patch_records(chunks).collect()}
    ids = {p: r["chunk_id"] for p, r in by_part(chunks).items()}
    assert set(got) == {ids["p9"], ids["p10"], ids["p11"]}
    assert got[ids["p9"]]["patch_hash"] == hashlib.sha256(b"D").hexdigest()[:16] and got[ids["p9"]]["diff_json"] == '{"diff": "D"}'
    assert got[ids["p11"]]["files_json"] == '["a", "b"]' and got[ids["p10"]]["files_json"] is None
    bodies = {(r["chunk_id"], r["tool_name"]): r["content"] for r in store.bodies(chunks).collect()}
    assert bodies[(ids["p8"], "read_body")] == "import os\n\nx = 1: y\n"
    assert bodies[(ids["p9"], "apply_patch_input")] == "*** P"
    assert store.part_sidecar(chunks).filter("part_type = 'tool'").count() == 8


def test_read_body(spark):
    cases = [
        (READ, "import os\n\nx = 1: y\n"),
        ("no content", None),
        ("<content></content>", None),
        ("<content>1: a\n2: b\n(End of file - total 1 line)</content> tail", "a\nb"),
        ("<content>\n 7:\t x\n</content>", " x"),
    ]
    df = spark.createDataFrame([(i, o) for i, (o, _) in enumerate(cases)], "i int, o string")
    got = [r["b"] for r in df.select("i", store.read_body(df["o"]).alias("b")).orderBy("i").collect()]
    assert got == [want for _, want in cases]


def test_messages_are_not_broadcast_by_the_estimate_of_a_dropped_variant(spark, tmp_path):
    """200,000 messages of 1 MB and more: the estimate without the payload is far below what a broadcast would hold."""
    ids = spark.range(200_000).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("id"), F.lit("s").alias("session_id"),
                                      F.col("id").alias("time_created"), F.lit('{"role":"user","modelID":"m"}').alias("data"))
    ids.coalesce(1).write.parquet(f"{tmp_path}/message")
    ids.select(F.concat(F.lit("p"), "id").alias("id"), F.col("id").alias("message_id"), "session_id", "time_created",
               F.lit('{"type":"text","text":"t"}').alias("data")).coalesce(1).write.parquet(f"{tmp_path}/part")
    messages, parts = spark.read.parquet(f"{tmp_path}/message"), spark.read.parquet(f"{tmp_path}/part")
    sessions = spark.createDataFrame([("s", "/d", "t", 5)], "id string, directory string, title string, time_created long")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "400k")
    try:
        rows = store.chunk_rows(sessions, messages, parts, 0)
        text = rows._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"BroadcastHashJoin \[session_id#\d+, message_id#\d+\]", text)
        assert re.search(r"SortMergeJoin \[session_id#\d+, message_id#\d+\]", text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
