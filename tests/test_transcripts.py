"""Transcript files from disk: line ends, bad bytes, sessions, blocks, ids, high-water mark."""

import hashlib
import re

from tracelake.operators import sinks
from tracelake.sources import logs, markdown_chat as chat
from tracelake.streaming import incremental

TEXT = (
    "text before the first header\n"
    "# aider chat started at 2024-01-01 10:00:00\r\n"
    "> Aider v0.1\n"
    "> Main model: a/b with diff edit format\n"
    "#### first line\n"
    "#### second line\n"
    "\n"
    "#### third\n"
    "answer one\n"
    "answer two same answer\n"
    "> \n"
    ">not a tool line\n"
    "# aider chat started at nonsense\n"
    "   \n"
    "#### /add x.py\n"
    "> Model: c/d with whole edit format\n"
    "> Model: e/f with whole edit format\n"
    "last without newline"
)


HEAD_ONLY = "# aider chat started at 2024-01-01 10:00:00"


def write(folder, name, data: bytes):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(data)


def parsed(spark, files):
    rows = chat.lines(files)
    blocks = chat.blocks(rows)
    return rows, blocks, chat.sessions(files, blocks)


def test_scan_blocks_and_sessions(spark, tmp_path):
    write(tmp_path / "a", "aider.chat.history.md", TEXT.encode())
    write(tmp_path / "b", "aider.other.chat.md", b"# aider chat started at 2024-01-02\n#### bad \xff byte\n")
    write(tmp_path / "b", "notes.md", b"# aider chat started at 2024-01-02\n")
    files = chat.read_transcripts(spark, str(tmp_path))
    assert files.count() == 2
    assert chat.read_transcripts(spark, str(tmp_path), limit=1).count() == 1
    rows, blocks, sessions = parsed(spark, files)
    first = [r for r in blocks.orderBy("path", "session_index", "block_no").collect() if "/a/" in r["path"]]
    seen = [(r["session_index"], r["block_no"], r["role"], r["content"], r["start_line"], r["end_line"]) for r in first]
    assert seen == [
        (0, 1, "system", "2024-01-01 10:00:00", 2, 2),
        (0, 2, "tool", "Aider v0.1", 3, 3),
        (0, 3, "tool", "Main model: a/b with diff edit format", 4, 4),
        (0, 4, "user", "first line\nsecond line", 5, 6),
        (0, 5, "user", "third", 8, 8),
        (0, 6, "assistant", "answer one\nanswer two same answer", 9, 11),
        (0, 7, "tool", "", 12, 12),
        (0, 8, "assistant", ">not a tool line", 13, 13),
        (1, 1, "system", "nonsense", 14, 14),
        (1, 2, "user", "/add x.py", 16, 16),
        (1, 3, "tool", "Model: c/d with whole edit format", 17, 17),
        (1, 4, "tool", "Model: e/f with whole edit format", 18, 18),
        (1, 5, "assistant", "last without newline", 19, 19),
    ]
    bad = [r["content"] for r in blocks.collect() if "/b/" in r["path"] and r["role"] == "user"]
    assert bad == ["bad � byte"]
    s = {(r["path"].rsplit("/", 2)[1], r["session_index"]): r for r in sessions.collect()}
    one, two = s[("a", 0)], s[("a", 1)]
    assert (one["start_line"], one["end_line"], two["start_line"], two["end_line"]) == (2, 13, 14, 19)
    assert one["version"] == "0.1" and one["title"] == "first line\nsecond line"
    assert two["model"] == "e/f with whole edit format" and two["title"] == "/add x.py"
    stable = f"{one['path']}\0{0}\0{one['started_at']}"
    assert one["source_id"] == "aider:" + hashlib.sha1(stable.encode()).hexdigest()[:24]


def test_lines_read_by_byte_range(spark, tmp_path, monkeypatch):
    """Files cut into ranges of a few bytes, and rows into slices of a few lines, give the lines of whole files."""
    texts = [TEXT, TEXT + "\n", "", "\n", HEAD_ONLY, "é\r# aider chat started at x\r\n> a\u2028> b\x0cc\rd\n\n> e\r" * 9, TEXT.replace("\n", "\r\n") * 3]
    for k, text in enumerate(texts):
        write(tmp_path / f"d{k % 2}", f"aider.{k}.chat.md", text.encode() + (b"\xff\xfe bad" if k == 6 else b""))
    files = chat.read_transcripts(spark, str(tmp_path))
    rows = lambda df: sorted(map(tuple, df.select("path", "line_no", "raw", "role", "prev_role", "session_index", "island").collect()), key=str)
    want = rows(chat.lines(files))
    assert len({r[0] for r in want}) == 5
    sessions = sorted(map(str, chat.sessions(files, chat.blocks(chat.lines(files))).collect()))
    monkeypatch.setattr(chat, "SLICE_LINES", 4)
    assert rows(chat.lines(files)) == want
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (17, 100, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            read = chat.read_lines(spark, str(tmp_path))
            assert rows(read) == want
        assert sorted(map(str, chat.sessions(read, chat.blocks(read)).collect())) == sessions
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_no_task_needs_a_whole_file(spark, tmp_path):
    write(tmp_path, "aider.a.chat.md", TEXT.encode())
    files = chat.read_transcripts(spark, str(tmp_path))
    for df in (chat.blocks(chat.lines(files)), chat.blocks(chat.read_lines(spark, str(tmp_path))), logs.input_history(files), logs.model_log(files)):
        text = df._jdf.queryExecution().executedPlan().toString()
        specs = re.findall(r"windowspecdefinition\((.*?) ASC", text)
        assert specs and all("__slice" in s or "__key" in s for s in specs)


def test_lines_tile_the_session(spark, tmp_path):
    write(tmp_path, "aider.chat.md", TEXT.encode())
    rows, blocks, sessions = parsed(spark, chat.read_transcripts(spark, str(tmp_path)))
    for s in sessions.collect():
        nos = sorted(r["line_no"] for r in rows.collect() if r["session_index"] == s["session_index"])
        assert nos == list(range(s["start_line"], s["end_line"] + 1))


def test_manifest_restores_the_path(spark, tmp_path):
    write(tmp_path, "aider.chat.md", b"# aider chat started at 2024-01-01\n")
    landed = chat.read_transcripts(spark, str(tmp_path)).first()["path"]
    manifest = spark.createDataFrame([(landed, "/home/u/.aider.chat.md")], "landed string, path string")
    assert chat.read_transcripts(spark, str(tmp_path), manifest=manifest).first()["path"] == "/home/u/.aider.chat.md"


def chunks(spark, text, path="/p/aider.chat.md"):
    rows, blocks, sessions = parsed(spark, spark.createDataFrame([(path, text)], "path string, text string"))
    return chat.chunk_rows(sessions, blocks, 1700000000)


def test_blank_chunk_keeps_its_number_and_time(spark):
    got = {r["chunk_number"]: r for r in chunks(spark, TEXT).collect() if r["timestamp"] > 1704000000}
    assert 7 not in got  # the empty tool line
    assert got[8]["timestamp"] - got[1]["timestamp"] == 7
    assert got[2]["content"] == "startup: Aider v0.1"
    fallback = [r for r in chunks(spark, "# aider chat started at never\n#### x\n").collect()]
    assert sorted(r["timestamp"] for r in fallback) == [1700000000, 1700000001]


def test_append_adds_only_new_blocks(spark):
    head = "# aider chat started at 2024-01-01 10:00:00\n#### one\nreply"
    old, new = chunks(spark, head), chunks(spark, head + " grown\n#### two\n> Applied edit to a.py\n")
    fresh = incremental.above_high_water(old, new)
    assert sorted(r["content"] for r in fresh.collect()) == ["edit_applied: Applied edit to a.py", "two"]
    assert incremental.above_high_water(new, new).count() == 0
    changed = incremental.changed_below_high_water(old, new)
    assert changed.count() == 1  # the reply that grew is reported, not rewritten


def test_sidecars(spark):
    text = "# aider chat started at 2024-01-01\n> Commit ab12 msg here\n> Tokens: 1k sent, 2k received.\n> weird\n> weird\n"
    rows = chunks(spark, text)
    git = chat.git_events(rows).first()
    assert (git["commit_hash"], git["message"]) == ("ab12", "msg here")
    use = chat.usage(rows).first()
    assert (use["sent"], use["received"]) == ("1k", "2k")
    store, edges = sinks.content_store(chat.raw_bodies(rows))
    assert store.count() == 3 and edges.count() == 4  # equal lines are stored once


def test_input_history(spark):
    text = "+lost head\n# 2024-01-01 10:00:00\n+one\nnoise\n+two\n# 2024-01-01 11:00:00\n# 2024-01-01 12:00:00\n+three\n\n"
    got = logs.input_history(spark.createDataFrame([("p", text)], "path string, text string")).orderBy("start_line").collect()
    assert [(r["timestamp"], r["content"], r["start_line"], r["end_line"]) for r in got] == [
        ("", "lost head", 0, 1), ("2024-01-01 10:00:00", "one\ntwo", 2, 5), ("2024-01-01 12:00:00", "three", 7, 9),
    ]


def test_model_log(spark):
    text = "junk\nTO LLM 2024-01-01T10\nq1\n\nLLM RESPONSE 2024-01-01T11\na1\na2\nTO LLM x\n"
    got = logs.model_log(spark.createDataFrame([("p", text)], "path string, text string")).orderBy("start_line").collect()
    assert [(r["role"], r["timestamp"], r["content"], r["start_line"], r["end_line"]) for r in got] == [
        ("to_llm", "2024-01-01T10", "q1", 2, 4), ("llm_response", "2024-01-01T11", "a1\na2", 5, 7), ("to_llm", "x", "", 8, 8),
    ]


def test_analytics(spark):
    text = '{"event":"launch","p":{"a":1}}\n\n  \n{"event": \n'
    got = logs.analytics(spark.createDataFrame([("p", text)], "path string, text string")).orderBy("_line").collect()
    assert [(r["_line"], r["event"], r["raw"]) for r in got] == [(1, "launch", None), (4, "_invalid_json", '{"event": ')]
