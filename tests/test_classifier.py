"""One case per classifier rule and per order trap."""

import json

import pytest
from pyspark.sql import functions as F

from tracelake.sources.chat_events import classify

CASES = [
    # role, content, kind, fields that must be there
    ("system", "2024-01-01 10:00:00", "session_start", {}),
    ("user", "please fix it", "user_prompt", {"command": None}),
    ("user", "  /add a.py b.py\nmore", "user_prompt", {"command": "/add a.py b.py", "command_name": "/add", "command_kind": "context_file"}),
    ("user", "/nope x", "user_prompt", {"command_kind": "command"}),
    ("assistant", "text", None, {}),
    ("tool", "/usr/bin/aider --no-git f.py", "startup", {"command": "/usr/bin/aider --no-git f.py", "no_git": True, "dry_run": False}),
    ("tool", "aider", "startup", {"message_mode": False}),
    ("tool", "run aider now --message hi", "startup", {"message_mode": True}),
    ("tool", "x aider --message-file=f --dry-run --restore-chat-history --show-repo-map", "startup",
     {"message_file": True, "dry_run": True, "restore_history": True, "show_repo_map": True}),
    ("tool", "Aider v0.50.1", "startup", {"version": "0.50.1"}),
    ("tool", "Main model: prov/m with diff edit format", "startup", {"model": "prov/m with diff edit format"}),
    ("tool", "Model: prov/m with whole edit format", "startup", {"model_name": "prov/m", "edit_format": "whole"}),
    ("tool", "Git repo: .git with 3 files", "startup", {"git_repo": ".git with 3 files"}),
    ("tool", "Repo-map: using 1024 tokens: auto", "repo_map", {"repo_map": "using 1024 tokens: auto"}),
    ("tool", "/chat-mode ask", "mode", {"command": "/chat-mode ask", "command_name": "/chat-mode"}),
    ("tool", "/settings", "settings", {}),
    ("tool", "/copy-context", "context_dump", {}),
    ("tool", "Tokens: 1.2k sent, 300 received. Cost: $0.1", "usage", {"sent": "1.2k", "received": "300"}),
    ("tool", "Commit abc123 feat: add", "git_commit", {"hash": "abc123", "message": "feat: add"}),
    ("tool", "see Commit abc123 feat", "raw_status", {}),
    ("tool", "Removed: abc123 feat", "git_undo", {"hash": "abc123"}),
    ("tool", "Did not apply edit to a b.py (--dry-run)", "dry_run", {"path": "a b.py"}),
    ("tool", "Applied edit to src/a.py  ", "edit_applied", {"path": "src/a.py"}),
    ("tool", "Applied edit to lint.py", "edit_applied", {"path": "lint.py"}),
    ("tool", "Saved commands to f.txt", "history_save", {"path": "f.txt"}),
    ("tool", "Executing: /drop", "history_load_exec", {"command": "/drop"}),
    ("tool", "All files dropped and chat history cleared.", "history_clear", {}),
    ("tool", "Restored previous conversation history.", "history_restore", {}),
    ("tool", "Copied code context to clipboard.", "context_dump", {}),
    ("tool", "Added LINT.md to the chat", "lint", {}),
    ("tool", "flake8 found", "lint", {}),
    ("tool", "AssertionError: x", "test_failure", {}),
    ("tool", "FAILED tests/x.py", "test_failure", {}),
    ("tool", "Added 12 lines of output to the chat.", "shell_output_added", {"lines": "12"}),
    ("tool", "Added 1 line of output to the chat.", "shell_output_added", {"lines": "1"}),
    ("tool", "Here are summaries of some files present in my git repository", "repo_map", {}),
    ("tool", "Install playwright", "web", {}),
    ("tool", "Add file to the chat? a.py (Y)es/(N)o [Yes]: n", "confirmation", {"answer": "n"}),
    ("tool", "Added a.py to the chat", "context_file", {"path": "a.py"}),
    ("tool", "Added b.md to read-only files.", "context_file", {"path": "b.md"}),
    ("tool", " b.md (read only)", "context_file", {"path": "b.md"}),
    ("tool", "Dropped a.py from the chat", "context_file", {"path": "a.py"}),
    ("tool", "Removed a.py from the chat", "context_file", {"path": "a.py"}),
    ("tool", "$ 0.02 spent", "usage", {}),
    ("tool", "1000 tokens remaining in window", "usage", {}),
    ("tool", "?? new.py", "git", {}),
    ("tool", "abcdef1 first commit", "git", {}),
    ("tool", "", "raw_status", {}),
    ("tool", 'quote " and back \\ slash é', "raw_status", {"raw": 'quote " and back \\ slash é'}),
]


@pytest.fixture(scope="module")
def answers(spark):
    rows = [(i, r, c) for i, (r, c, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "n int, role string, content string").withColumn("e", classify("role", "content"))
    return {r["n"]: (r["kind"], r["event"]) for r in df.select("n", "e.kind", "e.event").collect()}


@pytest.mark.parametrize("n", range(len(CASES)))
def test_rule(answers, n):
    role, content, kind, fields = CASES[n]
    got_kind, event = answers[n]
    assert got_kind == kind
    decoded = {k: json.loads(v) for k, v in event.items()}
    for name, value in fields.items():
        assert name in decoded and decoded[name] == value
    if role == "tool":
        assert decoded["raw"] == content


def test_event_json_is_sorted_json(spark):
    from tracelake.sources import markdown_chat as chat

    text = "# aider chat started at 2024-01-01 10:00:00\n> Applied edit to a.py\n#### hello\n"
    files = spark.createDataFrame([("p", text)], "path string, text string")
    blocks = chat.blocks(chat.lines(files))
    chunks = chat.chunk_rows(chat.sessions(files, blocks), blocks, 0)
    out = {r["event_kind"]: r["event_json"] for r in chat.tool_events(chunks).collect()}
    assert out["edit_applied"] == json.dumps(
        {"path": "a.py", "raw": "Applied edit to a.py", "role": "tool", "start_line": 2, "end_line": 2, "event_kind": "edit_applied"},
        sort_keys=True)
    assert json.loads(out["user_prompt"])["command"] is None
    assert chunks.filter(F.col("event_kind") == "session_start").first()["tool_name"] == "AiderStatus"
