"""Markdown chat transcripts: files to lines, sessions, blocks and canonical rows.

Files come in as one row each, of at most 2 GiB, or as lines read by byte range,
whatever their size. Session and block of a line follow from counts of headers
and of role changes before it. In a file's row they are its places in an array,
so lines, sessions and blocks need no shuffle. Byte ranges, and files of several
rows, are counted within slices, and sums over the slices are carried across: no
task needs a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tracelake.operators import sequences

from tracelake.functions.text import LINE_END, LINE_ENDS, SPACE, col, group, is_blank, nonempty, rstrip, strip
from tracelake.functions.times import stamp_epoch
from tracelake.operators.columns import evaluate_once
from tracelake.session import Scratch
from tracelake.sources import landing
from tracelake.sources.chat_events import classify

PREFIX = "aider:"  # fixed value: id prefix of this source kind
KIND = "aider"
# How a transcript marks its lines.
HEADER_MARK = "# aider chat started at "
SESSION_HEADER = rf"(?d)^# aider chat started at (.+?){SPACE}*$"
USER_MARK = "#### "
TOOL_MARK = "> "
#: Lines of a slice, where a file is one row.
SLICE_LINES = 100_000


def read_transcripts(
    spark: SparkSession, folder: str, limit: int | None = None, manifest: DataFrame | None = None,
    pattern: str = "aider*.chat*.md",
) -> DataFrame:
    """Files below a landing folder: path, text, modified.

    File names must not start with a dot (Spark skips those); a manifest
    (landed, path) restores the original path.
    """
    found = landing.find(spark, folder)
    listed = landing.listing(spark, found, pattern) if found else None
    if listed is not None:
        files = landing.whole(found, listed).select(
            "path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"),
            F.floor(F.col("modified") / 1000).alias("modified"),
        )
    else:
        files = (
            spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
            .text(folder, wholetext=True)
            .select(
                F.col("_metadata.file_path").alias("path"), F.make_valid_utf8("value").alias("text"),
                F.unix_seconds(F.col("_metadata.file_modification_time")).alias("modified"),
            )
        )
    if manifest is not None:
        files = files.join(manifest.select(F.col("landed").alias("path"), F.col("path").alias("__path")), "path", "left")
        files = files.withColumn("path", F.coalesce("__path", "path")).drop("__path")
    if limit:
        files = files.orderBy("path").limit(limit)
    return files


def split_lines(text: Column | str) -> Column:
    """Lines with their line ends, as Python sees them after newline normalising."""
    plain = F.regexp_replace(col(text), r"\r\n?", "\n")
    return F.filter(F.split(plain, f"(?<={LINE_END})"), lambda x: x != "")


def _is_header(line: Column) -> Column:
    return F.startswith(line, F.lit(HEADER_MARK)) & F.regexp_like(line, F.lit(SESSION_HEADER))


def _role(line: Column) -> Column:
    return (
        F.when(_is_header(line), "system").when(F.startswith(line, F.lit(USER_MARK)), "user")
        .when(F.startswith(line, F.lit(TOOL_MARK)), "tool").otherwise("assistant")
    )


def lines(files: DataFrame, by_session: bool = False) -> DataFrame:
    """path, line_no (1-based), raw, role, prev_role, session_index, island; lines before the first header are dropped.

    All of them are found inside the row of the file, without a shuffle. Rows
    that share their path are one file, whose lines are counted across them.
    With by_session they come in rows of a session, for blocks(): path,
    session_index, runs. Where a file has several rows, its lines come one by
    one there, told apart by a column `whole`.
    """
    repeated = _repeated(files)
    if repeated is None:
        packed = _in_sessions(files)
    else:
        same = files["path"].eqNullSafe(repeated["path"])
        line = F.array(F.struct("line_no", "raw", "prev_role"))
        packed = _in_sessions(files.join(repeated, same, "left_anti")).withColumn("whole", F.lit(True)).unionByName(_across_rows(files.join(repeated, same, "left_semi")).select(
            "path", "session_index", F.array(F.struct("island", "role", line.alias("lines"))).alias("runs"), F.lit(False).alias("whole")))
    return packed if by_session else _line_by_line(packed)


def _repeated(files: DataFrame) -> DataFrame | None:
    """The paths that several rows have; None if there are none."""
    scratch = Scratch(files.sparkSession)
    found = scratch.write("repeated", files.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("path"))
    if not found.isEmpty():
        return found
    scratch.drop("repeated")
    return None


def _with_roles(files: DataFrame) -> DataFrame:
    """path, __lines, __roles: the lines of a file and their roles as arrays of its row."""
    listed = files.select("path", split_lines("text").alias("__lines"))
    return listed.select("path", "__lines", F.transform("__lines", _role).alias("__roles"))


def _places(items: str, holds) -> Column:
    """The positions (from 0) of the items of an array for which holds(item, position) is true."""
    return F.filter(F.transform(items, lambda x, i: F.when(holds(x, i), i)), lambda i: i.isNotNull())


def _in_sessions(files: DataFrame) -> DataFrame:
    """One row per session with its runs, each with its lines, taken by position: work in proportion to the lines."""
    roles = lambda i: F.get("__roles", i)
    run_starts = _places("__roles", lambda role, i: _starts({"role": role, "prev_role": F.when(i > 0, roles(i - 1))}))
    listed = _with_roles(files).withColumn("__starts", run_starts)
    listed = listed.withColumn("__heads", _places("__starts", lambda at, _: roles(at) == "system"))

    def until(places: str, k: Column, end: str) -> Column:
        """The last position that belongs to the k-th place."""
        return F.coalesce(F.get(places, k + 1), F.size(end)) - 1

    def line(i: Column) -> Column:
        return F.struct((i + 1).cast("long").alias("line_no"), F.get("__lines", i).alias("raw"), F.when(i > 0, roles(i - 1)).alias("prev_role"))

    def run(k: Column) -> Column:
        at = F.get("__starts", k)
        return F.struct((k + 1).cast("long").alias("island"), roles(at).alias("role"),
                        F.transform(F.sequence(at, until("__starts", k, "__lines")), line).alias("lines"))

    sessions = F.transform("__heads", lambda first, s: F.struct(
        s.cast("long").alias("session_index"), F.transform(F.sequence(first, until("__heads", s, "__starts")), run).alias("runs")))
    return listed.select("path", F.inline(sessions))


def _line_by_line(packed: DataFrame) -> DataFrame:
    runs = packed.select("path", "session_index", F.inline("runs"))
    flat = runs.select("path", "session_index", "island", "role", F.inline("lines"))
    return flat.select("path", "line_no", "raw", "role", "prev_role", "session_index", "island")


def _across_rows(files: DataFrame) -> DataFrame:
    """The lines of files that have several rows, cut into slices inside a row, with the headers and runs before each."""
    # The previous role sits in the same array, so finding it needs no window.
    rows = F.transform(
        "__lines",
        lambda x, i: F.struct(
            x.alias("raw"), F.get("__roles", i).alias("role"),
            F.when(i > 0, F.get("__roles", i - 1)).alias("prev_role"),
        ),
    )
    listed = evaluate_once(_with_roles(files), __rows=rows).select("path", "__rows")
    first = F.col("__slice") * SLICE_LINES
    before = F.slice("__rows", F.lit(1), first.cast("int"))
    cut = listed.select("path", "__rows", F.explode(F.sequence(F.lit(0), F.floor(F.size("__rows") / SLICE_LINES).cast("int"))).alias("__slice")).select(
        "path", "__slice", F.size(F.filter(before, _is_head)).cast("long").alias("__heads"), F.size(F.filter(before, _starts)).cast("long").alias("__runs"),
        F.slice("__rows", (first + 1).cast("int"), F.lit(SLICE_LINES)).alias("__rows"))
    flat = cut.select("path", "__slice", "__heads", "__runs", F.posexplode("__rows").alias("pos", "r")).select(
        "path", "__slice", (first + F.col("pos") + 1).cast("long").alias("line_no"), "r.raw", "r.role", "r.prev_role", "__heads", "__runs")
    so_far = Window.partitionBy("path", "__slice").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.struct("role", "prev_role")
    counted = flat.withColumn("session_index", F.sum(_is_head(row).cast("long")).over(so_far) + F.col("__heads")).withColumn(
        "island", F.sum(_starts(row).cast("long")).over(so_far) + F.col("__runs"))
    return _from_first_header(counted)


def _is_head(row: Column) -> Column:
    return row["role"] == "system"


def _starts(row: Column) -> Column:
    """Headers and tool lines are runs of their own."""
    return row["role"].isin("system", "tool") | ~row["role"].eqNullSafe(row["prev_role"])


def _from_first_header(counted: DataFrame) -> DataFrame:
    placed = counted.withColumn("session_index", F.col("session_index") - 1)
    return placed.select("path", "line_no", "raw", "role", "prev_role", "session_index", "island").filter(F.col("session_index") >= 0)


def read_lines(spark: SparkSession, folder: str, pattern: str = "aider*.chat*.md") -> DataFrame:
    """The lines of all files below a folder, as lines() gives them, read by byte range: a file may have any size.

    A range holds the lines that begin in it. Their numbers come from the sums of
    the ranges before; whether a file's last line is ended, from its size.
    """
    found = landing.find(spark, folder)
    listed = landing.listing(spark, found, pattern) if found else None
    if listed is not None:
        width = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        given = landing.lines(found, listed, width).withColumn("value", F.col("value").cast("string"))
    else:
        at = F.col("_metadata")
        given = (
            spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "\n").text(folder)
            .select(at["file_path"].alias("path"), at["file_block_start"].alias("range"), at["file_size"].alias("size"), "value",
                    F.monotonically_increasing_id().alias("at"))
        )
    # The order within a range is that of the numbers its task gave.
    ranges = sequences.in_slices(given, ["path"], F.col("range"))
    summed = sequences.running(ranges, ["at"], ended=("sum", F.octet_length("value").cast("long") + 1))
    text = F.concat(F.make_valid_utf8("value"), F.when(F.col("ended") <= F.col("size"), F.lit("\n")).otherwise(""))
    parts = summed.select(*summed.columns, F.posexplode(split_lines(text)).alias("part", "raw")).withColumn("role", _role(F.col("raw")))
    numbered = sequences.running(parts, ["at", "part"], line_no=("sum", F.lit(1).cast("long")))
    before = sequences.previous(numbered, ["line_no"], {"prev_role": "role"})
    row = F.struct("role", "prev_role")
    counted = sequences.running(
        before, ["line_no"], session_index=("sum", _is_head(row).cast("long")), island=("sum", _starts(row).cast("long")))
    return _from_first_header(counted)


def _piece(role: Column, raw: Column) -> Column:
    """One line without its line end (it holds exactly one) and its role mark."""
    bare = F.rtrim(raw, F.lit(LINE_ENDS))
    return F.when(role == "tool", F.substring(bare, 3, 1 << 30)).when(role == "user", F.substring(bare, 6, 1 << 30)).otherwise(bare)


def _content(role: Column, raw: Column, typed: Column) -> Column:
    return F.when(role == "system", group(raw, SESSION_HEADER)).when(role == "assistant", rstrip(raw)).otherwise(rstrip(typed))


def _joined(role: Column, run: Column) -> tuple[Column, Column]:
    """The lines of a run in one text, as they are and without their marks."""
    typed = F.when(role.isin("user", "tool"), F.array_join(F.transform(run, lambda x: _piece(role, x["raw"])), "\n"))
    return F.array_join(F.transform(run, lambda x: x["raw"]), ""), typed


def _kept(role: Column, content: Column) -> Column:
    return role.isin("system", "tool") | ~is_blank(content)


def blocks(file_lines: DataFrame) -> DataFrame:
    """Runs of one role as blocks, classified and numbered from 1 within their session.

    Lines that come by session are joined and numbered inside the session's row, others are grouped.
    """
    if "whole" in file_lines.columns:
        rest = _blocks_of_lines(_line_by_line(file_lines.filter(~F.col("whole"))))
        placed = _blocks_in_sessions(file_lines.filter(F.col("whole"))).unionByName(rest)
    elif "runs" in file_lines.columns:
        placed = _blocks_in_sessions(file_lines)
    else:
        placed = _blocks_of_lines(file_lines)
    return evaluate_once(placed, __e=classify("role", "content")).select(
        "path", "session_index", "block_no", "role", "content", "raw", "start_line", "end_line",
        F.col("__e.kind").alias("event_kind"), F.col("__e.event").alias("event"),
    )


BLOCK = ["path", "session_index", "block_no", "role", "content", "raw", "start_line", "end_line"]


def _blocks_in_sessions(packed: DataFrame) -> DataFrame:
    def joined(run: Column) -> Column:
        raw, typed = _joined(run["role"], run["lines"])
        first, last = F.element_at(run["lines"], 1), F.element_at(run["lines"], -1)
        return F.struct(run["role"].alias("role"), raw.alias("raw"), typed.alias("typed"),
                        first["line_no"].alias("start_line"), last["line_no"].alias("end_line"))

    def block(b: Column) -> Column:
        return F.struct(b["role"].alias("role"), _content(b["role"], b["raw"], b["typed"]).alias("content"), b["raw"].alias("raw"),
                        b["start_line"].alias("start_line"), b["end_line"].alias("end_line"))

    kept = F.filter(F.transform(F.transform("runs", joined), block), lambda b: _kept(b["role"], b["content"]))
    numbered = F.transform(kept, lambda b, i: F.struct((i + 1).cast("long").alias("block_no"), b.alias("b")))
    return packed.select("path", "session_index", F.inline(numbered)).select("path", "session_index", "block_no", "b.*").select(*BLOCK)


def _blocks_of_lines(file_lines: DataFrame) -> DataFrame:
    merged = file_lines.groupBy("path", "session_index", "island", "role").agg(
        F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"),
        F.array_sort(F.collect_list(F.struct("line_no", "raw"))).alias("__lines"),
    )
    raw, typed = _joined(F.col("role"), F.col("__lines"))
    kept = (
        evaluate_once(evaluate_once(merged, raw=raw), content=_content(F.col("role"), F.col("raw"), typed))
        .filter(_kept(F.col("role"), F.col("content")))
        .drop("__lines", "island")
    )
    sliced = sequences.in_slices(kept, ["path", "session_index"], F.floor(F.col("start_line") / SLICE_LINES))
    # Only rows that share a path have blocks with the same first line.
    return sequences.whole(sequences.running(sliced, ["start_line", "end_line"], block_no=("sum", F.lit(1).cast("long")))).select(*BLOCK)


def value(event: Column | str, name: str) -> Column:
    """Text of one event field; null when absent or null."""
    return F.get_json_object(F.concat(F.lit('{"v":'), F.try_element_at(col(event), F.lit(name)), F.lit("}")), "$.v")


def source_id(path: Column, index: Column, started_at: Column) -> Column:
    stable = F.concat_ws("\0", path, index.cast("string"), F.coalesce(started_at, F.lit("")))
    return F.concat(F.lit(PREFIX), F.substring(F.sha1(stable), 1, 24))


def extents(files: DataFrame) -> DataFrame:
    """path, session_index, start_line, end_line, found inside the row of the file, where it is one; else from its lines."""
    if "line_no" in files.columns:
        return files.groupBy("path", "session_index").agg(F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"))
    # The array is made inside the generator: Spark filters on a generator's column, which would split the text again for each filter.
    listed = files.select("path", split_lines("text").alias("__lines"))
    found = listed.select("path", F.size("__lines").alias("__n"), _places("__lines", lambda x, _: _is_header(x)).alias("__starts"))
    return found.select("path", F.inline(F.transform("__starts", lambda at, i: F.struct(
        i.cast("long").alias("session_index"), (at + 1).cast("long").alias("start_line"),
        F.coalesce(F.get("__starts", i + 1), F.col("__n")).cast("long").alias("end_line")))))


def sessions(files: DataFrame, block_rows: DataFrame) -> DataFrame:
    """One row per session with its line range, metadata, title and stable id. files: rows of files, or their lines."""
    extent = extents(files)

    def pick(kind: str, field: str, chooser) -> Column:
        v = nonempty(value("event", field))
        ok = (F.col("role") == "tool") & (F.col("event_kind") == kind) & v.isNotNull()
        return chooser(F.when(ok, v), F.when(ok, F.col("block_no")))

    said = (F.col("role") == "user") & ~is_blank("content")
    meta = block_rows.groupBy("path", "session_index").agg(
        F.max(F.when(F.col("role") == "system", F.col("content"))).alias("started_at"),
        pick("startup", "command", F.min_by).alias("command"),
        pick("startup", "version", F.min_by).alias("version"),
        pick("startup", "model", F.max_by).alias("model"),
        pick("startup", "git_repo", F.min_by).alias("git_repo"),
        pick("repo_map", "repo_map", F.min_by).alias("repo_map"),
        F.min_by(
            F.when(said, F.substring(strip("content"), 1, 250)), F.when(said, F.col("block_no"))
        ).alias("title"),
        F.count(F.lit(1)).alias("block_count"),
    )
    joined = extent.join(meta, ["path", "session_index"])
    return joined.withColumn("source_id", source_id(F.col("path"), F.col("session_index"), F.col("started_at")))


def source_rows(session_rows: DataFrame) -> DataFrame:
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return session_rows.select(
        "source_id", "title", F.concat(F.lit(PREFIX), "path").alias("source"), "model",
        folder.alias("primary_cwd"), F.col("started_at").alias("file_date"),
    )


# Event kind to (tool name, target file known, success).
TOOL_OPS = [
    ("edit_applied", "Edit", True, True),
    ("dry_run", "Edit", True, False),
    ("shell", "Bash", False, True),
    ("test", "Bash", False, True),
    ("lint", "Bash", False, True),
    ("git", "Bash", False, True),
    ("git_commit", "Bash", False, True),
    ("git_undo", "Bash", False, True),
    ("web", "WebFetch", False, True),
    ("repo_map", "Read", False, True),
    ("context_file", "Read", True, True),
    ("context_dump", "Read", False, True),
    ("history_save", "NotebookEdit", True, True),
    ("history_load_exec", "NotebookEdit", True, True),
    ("history_clear", "NotebookEdit", True, True),
    ("history_restore", "NotebookEdit", True, True),
    ("usage", "TokenUsage", False, True),
]
OTHER_TOOL = "AiderStatus"  # fixed value: tool name of every other classified block


def _lookup(pairs: list[tuple[str, object]], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), key)


def with_tool_op(block_rows: DataFrame) -> DataFrame:
    """Add tool_name, target_file and success for every block with an event kind."""
    kind = F.col("event_kind")
    has_path = kind.isin([k for k, _, known, _ in TOOL_OPS if known])
    return (
        block_rows
        .withColumn("tool_name", F.when(
            kind.isNotNull(), F.coalesce(_lookup([(k, t) for k, t, _, _ in TOOL_OPS], kind), F.lit(OTHER_TOOL))))
        .withColumn("target_file", F.when(has_path, value("event", "path")))
        .withColumn("success", F.when(kind.isNotNull(), _lookup([(k, s) for k, _, _, s in TOOL_OPS], kind)))
    )


def chunk_rows(session_rows: DataFrame, block_rows: DataFrame, fallback_epoch: Column | int) -> DataFrame:
    """Canonical message rows; blank chunks are left out but keep their number."""
    fallback = fallback_epoch if isinstance(fallback_epoch, Column) else F.lit(fallback_epoch).cast("long")
    heads = session_rows.select(  # the fallback may be a column of the session rows
        "path", "session_index", "source_id", F.coalesce(stamp_epoch("started_at"), fallback).alias("__start")
    )
    role = F.col("role")
    shown = (role == "tool") & (F.col("event_kind") != "raw_status")
    text = F.when(shown, F.concat("event_kind", F.lit(": "), "content")).otherwise(F.col("content"))
    kind = (
        F.when(role == "user", "user_prompt").when(role == "assistant", "assistant").when(role == "system", "system")
        .otherwise("tool_call")
    )
    out_role = F.when(role.isin("user", "system"), role).otherwise("assistant")
    rows = with_tool_op(block_rows).join(heads, ["path", "session_index"])
    return rows.select(
        F.concat("source_id", F.lit("_"), F.col("block_no").cast("string")).alias("chunk_id"), "source_id",
        F.col("block_no").alias("chunk_number"), kind.alias("type"), out_role.alias("role"),
        strip(text).alias("content"), (F.col("__start") + F.col("block_no") - 1).alias("timestamp"),
        "tool_name", "target_file", "success", F.col("role").alias("block_role"), "event_kind", "event",
        "start_line", "end_line", "raw",
    ).filter(F.col("content") != "")


def turns(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "chunk_id", "source_id", F.col("block_role").alias("role"), "event_kind", "start_line", "end_line",
        value("event", "command_name").alias("command_name"), value("event", "command_kind").alias("command_kind"),
    )


def event_json(c: DataFrame) -> Column:
    """All event fields plus position, as JSON with sorted keys."""
    own = F.create_map(
        F.lit("role"), F.concat(F.lit('"'), "block_role", F.lit('"')),
        F.lit("start_line"), F.col("start_line").cast("string"),
        F.lit("end_line"), F.col("end_line").cast("string"),
        F.lit("event_kind"), F.concat(F.lit('"'), "event_kind", F.lit('"')),
    )
    entries = F.array_sort(F.map_entries(F.map_concat("event", own)))
    fields = F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"]))
    return F.concat(F.lit("{"), F.array_join(fields, ", "), F.lit("}"))


def tool_events(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.col("event_kind").isNotNull()).select(
        "chunk_id", "event_kind", event_json(chunks).alias("event_json"),
        F.when(F.col("event_kind") == "raw_status", 1).otherwise(0).alias("raw_status"),
    )


def usage(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.col("event_kind") == "usage").select(
        "chunk_id", value("event", "sent").alias("sent"), value("event", "received").alias("received")
    )


def git_events(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.col("event_kind").isin("git_commit", "git_undo")).select(
        "chunk_id", "event_kind", value("event", "hash").alias("commit_hash"), value("event", "message").alias("message")
    )


def raw_bodies(chunks: DataFrame) -> DataFrame:
    """Tool lines as they stand in the file, for the content store."""
    return chunks.filter(F.col("block_role") == "tool").select(
        "chunk_id", F.col("raw").alias("content"), F.coalesce("event_kind", F.lit("aider_tool")).alias("tool_name")
    )


def coverage(block_rows: DataFrame) -> DataFrame:
    return (
        block_rows.filter(F.col("event_kind").isNotNull()).groupBy("event_kind").agg(F.count(F.lit(1)).alias("blocks"))
    )


def unclassified(block_rows: DataFrame) -> DataFrame:
    return block_rows.filter((F.col("role") == "tool") & (F.col("event_kind") == "raw_status")).select(
        F.col("path").alias("source_path"), "session_index", "start_line", "content"
    )
