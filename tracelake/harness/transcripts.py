"""Chat transcripts and side logs made by Spark from the documents, one file per document."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracelake.harness.events import stored, table
from tracelake.session import shared_folder
from tracelake.sources import markdown_chat as chat
from tracelake.streaming import arrivals

# Tool lines the test transcripts cycle through: text, expected kind, tool, target, success.
# {d} stands for the document number.
TOOL_LINES = [
    ("/opt/bin/aider --no-git --dry-run x{d}", "startup", "AiderStatus", None, None),
    ("aider --message hello", "startup", "AiderStatus", None, None),
    ("Aider v0.{d}.1", "startup", "AiderStatus", None, None),
    ("Model: prov/m{d} with diff edit format", "startup", "AiderStatus", None, None),
    ("Git repo: .git with {d} files", "startup", "AiderStatus", None, None),
    ("Repo-map: using {d} tokens", "repo_map", "Read", None, True),
    ("/run ls {d}", "shell", "Bash", None, True),
    ("/ask why {d}", "mode", "AiderStatus", None, None),
    ("/unknown {d}", "command", "AiderStatus", None, None),
    ("Tokens: {d}.5k sent, 30 received. Cost: $0.01", "usage", "TokenUsage", None, True),
    ("Commit ab{d} add file {d}", "git_commit", "Bash", None, True),
    ("Removed: cd{d} add file {d}", "git_undo", "Bash", None, True),
    ("Did not apply edit to src/n{d}.py (--dry-run)", "dry_run", "Edit", "src/n{d}.py", False),
    ("Applied edit to src/a{d}.py", "edit_applied", "Edit", "src/a{d}.py", True),
    ("Saved commands to cmds{d}.txt", "history_save", "NotebookEdit", "cmds{d}.txt", True),
    ("Executing: /drop a{d}", "history_load_exec", "NotebookEdit", None, True),
    ("All chat history cleared.", "history_clear", "NotebookEdit", None, True),
    ("Restored previous conversation history.", "history_restore", "NotebookEdit", None, True),
    ("Copied code context to clipboard.", "context_dump", "Read", None, True),
    ("Added lint.py to the chat", "lint", "Bash", None, True),
    ("FAILED tests/t{d}.py", "test_failure", "AiderStatus", None, None),
    ("Added {d} lines of output to the chat.", "shell_output_added", "AiderStatus", None, None),
    ("Here are summaries of some files present in my git repository.", "repo_map", "Read", None, True),
    ("Scraping https://example.org/{d}...", "web", "WebFetch", None, True),
    ("Create new file? src/new{d}.py (Y)es/(N)o [Yes]: y", "confirmation", "AiderStatus", None, None),
    ("Added src/b{d}.py to the chat", "context_file", "Read", "src/b{d}.py", True),
    ("Added docs/r{d}.md to read-only files.", "context_file", "Read", "docs/r{d}.md", True),
    ("docs/s{d}.md (read only)", "context_file", "Read", "docs/s{d}.md", True),
    ("Dropped src/b{d}.py from the chat", "context_file", "Read", "src/b{d}.py", True),
    ("$ {d} tokens total", "usage", "TokenUsage", None, True),
    ("M  src/c{d}.py", "git", "Bash", None, True),
    ("something else {d}", "raw_status", "AiderStatus", None, None),
    ("", "raw_status", "AiderStatus", None, None),
]
MODIFIED = 1710000000


def _tool_line(n: Column, doc: Column) -> Column:
    texts = F.array(*[F.lit(t) for t, *_ in TOOL_LINES])
    picked = F.get(texts, (n % len(TOOL_LINES)).cast("int"))
    return F.concat(F.lit("> "), F.replace(picked, F.lit("{d}"), doc.cast("string")))


def _part(doc: Column):
    """Transcript text for line i of a document; every 20th line opens a session."""

    def build(text: Column, i: Column) -> Column:
        when = F.date_format(F.timestamp_seconds(F.lit(1704067200) + doc * 3600 + F.floor(i / 20) * 600), "yyyy-MM-dd HH:mm:ss")
        started = F.when(doc % 13 == 0, F.lit("a while ago")).otherwise(when)
        head = F.when(i % 20 == 0, F.concat(F.lit("# aider chat started at "), started, F.lit("\n"))).otherwise("")
        body = (
            F.when(i % 5 == 0, F.concat(F.lit("#### "), text))
            .when(i % 5 == 1, text)
            .when(i % 5 == 2, F.concat(_tool_line(doc + i, doc), F.lit("\n"), _tool_line(doc + i + 7, doc)))
            .when(i % 5 == 3, F.concat(F.lit("#### /add src/p"), doc.cast("string"), F.lit(".py now\n#### "), text))
            .otherwise(F.concat(F.lit("\n"), text, F.lit("\n"), _tool_line(doc * 3 + i, doc)))
        )
        return F.concat(head, body)

    return build


def files(spark: SparkSession, sf: str, half: bool = False) -> DataFrame:
    """path, text, modified; with half only the first half of each document's lines is written yet."""
    d = table(spark, sf, "documents")
    doc = F.col("doc_id")
    given = F.split("text", "\n")
    if half:
        given = F.slice(given, F.lit(1), (F.floor(F.size(given) / 2) + 1).cast("int"))
    text = F.concat(F.when(doc % 2 == 1, F.lit("ignored preamble\n")).otherwise(""), F.array_join(F.transform(given, _part(doc)), "\n"))
    path = F.concat(F.lit("/work/p"), (doc % 20).cast("string"), F.lit("/aider."), doc.cast("string"), F.lit(".chat.history.md"))
    return d.select(path.alias("path"), text.alias("text"), F.lit(MODIFIED).cast("long").alias("modified"))


def blocks(spark: SparkSession, sf: str, half: bool = False) -> DataFrame:
    return stored(f"blocks{half}", spark, sf, lambda: chat.blocks(chat.lines(files(spark, sf, half), by_session=True)))


def sessions(spark: SparkSession, sf: str, half: bool = False) -> DataFrame:
    return chat.sessions(files(spark, sf, half), blocks(spark, sf, half))


def chunks(spark: SparkSession, sf: str, half: bool = False) -> DataFrame:
    return chat.chunk_rows(sessions(spark, sf, half), blocks(spark, sf, half), MODIFIED)


def input_files(spark: SparkSession, sf: str) -> DataFrame:
    """Input history: every line of a document is typed under a time header; an empty line is a header without input."""
    d = table(spark, sf, "documents")

    def entry(text: Column, i: Column) -> Column:
        at = F.concat(F.lit("# 2024-01-01 00:"), F.lpad((i % 60).cast("string"), 2, "0"), F.lit(":00"))
        return F.when(text == "", at).otherwise(F.concat(at, F.lit("\n+"), text, F.lit("\n+second line")))

    text = F.array_join(F.transform(F.split("text", "\n"), entry), "\n")
    return d.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("path"), text.alias("text"))


def model_files(spark: SparkSession, sf: str) -> DataFrame:
    """Model log of every conversation turn: one request or response per record."""
    c = table(spark, sf, "conversations")
    mark = F.when(F.col("role") == "assistant", "LLM RESPONSE").otherwise("TO LLM")
    text = F.concat(F.lit("before the first marker\n"), mark, F.lit(" 2024-01-0"), (F.col("turn") + 1).cast("string"),
                    F.lit("T00:00:00\n"), F.col("text"), F.lit("\n\n"))
    path = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return c.select(path.alias("path"), text.alias("text"))


def analytics_files(spark: SparkSession, sf: str) -> DataFrame:
    """Analytics lines made from events, one small file per event: a blank line, a record, sometimes a broken one."""
    e = table(spark, sf, "events")
    good = F.concat(F.lit('{"event":"'), "event_type", F.lit('","user":'), F.col("user_id").cast("string"), F.lit("}"))
    line = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"event": '), F.col("event_id").cast("string"))).otherwise(good)
    text = F.concat(F.lit("\n"), line, F.lit("\n"))
    return e.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("path"), text.alias("text"))


def landing(spark: SparkSession, sf: str, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{md5(sf.encode()).hexdigest()[:8]}"


def land(spark: SparkSession, sf: str, folder: str, half: bool = False) -> None:
    """Write every transcript as a file below the folder, over an earlier one."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        made: set[str] = set()
        for batch in batches:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist()):
                place = root + path.removeprefix("/work")
                if (below := place.rpartition("/")[0]) not in made:
                    fs.create_dir(below, recursive=True)
                    made.add(below)
                with fs.open_output_stream(place) as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    files(spark, sf, half).select("path", "text").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def logical(path: Column) -> Column:
    """The path as the other queries have it."""
    return F.concat(F.lit("/work"), F.regexp_extract(path, "(/p[0-9]+/[^/]*)$", 1))


_LANDED: set[str] = set()


def landed(spark: SparkSession, sf: str) -> str:
    """A folder with all transcripts, written once per session."""
    folder = landing(spark, sf, "landed")
    if folder not in _LANDED:
        land(spark, sf, folder)
        _LANDED.add(folder)
    return folder


def streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The table after two triggers of the stream; between them every transcript has grown in place."""
    key = landing(spark, sf, "grown")
    if key not in _LANDED:
        for half in (True, False):
            land(spark, sf, f"{key}/land", half)
            arrivals.refresh(spark, f"{key}/land", key, rename=logical)
        _LANDED.add(key)
    return arrivals.stored_chunks(spark, f"{key}/table")
