"""Agent message store (session, message, part with JSON payloads) to canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracelake import schemas
from tracelake.functions.jsons import is_array, is_object, kind_at, object_variant, quoted, spaced, text_at
from tracelake.functions.text import SPACE, first_nonempty, is_blank, nonempty, strip
from tracelake.functions.times import millis_or_seconds
from tracelake.operators.columns import evaluate_once
from tracelake.operators.sequences import numbered

PREFIX = "opencode:"  # fixed value: id prefix of this source kind
# Tool names of the store and their canonical names.
TOOL_NAMES = {"bash": "Bash", "read": "Read", "apply_patch": "Edit"}
DEFAULT_BODY_TOOL = "opencode_tool"
# How the read tool wraps a file body.
READ_BODY = r"(?s)<content>\n?(.*?)\n?</content>"
READ_FOOTER = rf"\n?\(End of file - total \p{{Nd}}+ lines?\){SPACE}*\z"
READ_LINE_NUMBER = rf"(?dm)^{SPACE}*\p{{Nd}}+:{SPACE}?"


def read_store(spark: SparkSession, folder: str, limit: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three exported tables (JSON lines below session/, message/, part/)."""
    sessions = spark.read.schema(schemas.AGENT_SESSION).json(f"{folder}/session")
    if limit:
        sessions = sessions.orderBy("time_created", "id").limit(limit)
    messages = spark.read.schema(schemas.AGENT_MESSAGE).json(f"{folder}/message")
    return sessions, messages, spark.read.schema(schemas.AGENT_PART).json(f"{folder}/part")


def target_file(v: str = "d") -> Column:
    listed = F.when(
        is_object(v, "$.state.metadata.files[0]"),
        first_nonempty(
            text_at(v, "$.state.metadata.files[0].filePath"), text_at(v, "$.state.metadata.files[0].relativePath")
        ),
    )
    return F.coalesce(nonempty(text_at(v, "$.state.input.filePath")), nonempty(listed))


def tool_success(v: str = "d") -> Column:
    """True, false or null: an exit code decides when present, else the status."""
    status = text_at(v, "$.state.status")
    code = strip(text_at(v, "$.state.metadata.exit")).try_cast("long")
    return (
        F.when(kind_at(v, "$.state.metadata.exit").isNotNull(), code == 0)
        .when(status == "completed", F.lit(True))
        .when(status.isin("error", "failed"), F.lit(False))
    )


def canonical_tool(raw: Column) -> Column:
    named = F.create_map(*[F.lit(x) for pair in TOOL_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(named, raw), raw)


def tool_content(v: str = "d") -> Column:
    tool = F.coalesce(nonempty(text_at(v, "$.tool")), F.lit("tool"))
    output = text_at(v, "$.state.output")
    title = text_at(v, "$.state.title")
    printed = first_nonempty(output, text_at(v, "$.state.metadata.output"))
    command = first_nonempty(text_at(v, "$.state.input.command"))
    shown = first_nonempty(text_at(v, "$.state.metadata.preview"), output)
    patch = first_nonempty(text_at(v, "$.state.input.patchText"), text_at(v, "$.state.metadata.diff"), output)

    def titled(name: str, head: Column, body: Column) -> Column:
        return strip(F.concat(F.lit(f"{name}: "), head, F.lit("\n"), strip(body)))

    other = F.coalesce(nonempty(output), nonempty(title), spaced(F.to_json(v)))
    return (
        F.when(tool == "bash", titled("Bash", command, printed))
        .when(tool == "read", titled("Read", first_nonempty(text_at(v, "$.state.input.filePath"), title), shown))
        .when(tool == "apply_patch", titled("Edit", F.coalesce(target_file(v), F.lit("")), patch))
        .otherwise(strip(F.concat(tool, F.lit(": "), other)))
    )


def part_text(v: str = "d") -> Column:
    kind = text_at(v, "$.type")
    files = F.try_variant_get(F.col(v), "$.files", "array<string>")
    listed = F.when(is_array(v, "$.files"), F.concat(F.lit("Patch: "), F.array_join(files, ", "))).otherwise("Patch")
    return (
        F.when(kind.isin("text", "reasoning"), nonempty(text_at(v, "$.text")))
        .when(kind == "tool", tool_content(v))
        .when(kind == "patch", listed)
    )


def message_model(v: str = "md") -> Column:
    def joined(base: str) -> Column:
        provider, model = nonempty(text_at(v, f"{base}.providerID")), nonempty(text_at(v, f"{base}.modelID"))
        return F.when(model.isNotNull(), F.concat_ws("/", provider, model))

    return F.coalesce(joined("$"), joined("$.model"))


def read_body(output: Column) -> Column:
    """File text inside the read tool's output; null when there is none."""
    inner = F.when(F.regexp_like(output, F.lit(READ_BODY)), F.regexp_extract(output, READ_BODY, 1))
    body = F.regexp_replace(F.regexp_replace(inner, READ_FOOTER, ""), READ_LINE_NUMBER, "")
    return F.when(~is_blank(body), body)


def _whole(v: str, path: str) -> Column:
    """An integer at path; other JSON kinds count as missing."""
    return F.when(kind_at(v, path) == "BIGINT", F.try_variant_get(F.col(v), path, "long"))


def chunk_rows(sessions: DataFrame, messages: DataFrame, parts: DataFrame, fallback_epoch: int) -> DataFrame:
    """Canonical message rows. Parts without text are left out first and get no number."""
    s = sessions.select(
        F.col("id").alias("session_id"), "directory", F.col("time_created").alias("s_created")
    )
    m = evaluate_once(messages.select(
        F.col("id").alias("message_id"), "session_id", F.col("time_created").alias("m_created"), "data",
    ), md=object_variant("data")).select(
        "message_id", "session_id", "m_created", message_model().alias("model"),
        first_nonempty(text_at("md", "$.role")).alias("m_role"), nonempty(text_at("md", "$.path.cwd")).alias("m_cwd"),
    )
    p = evaluate_once(parts.select(
        F.col("id").alias("part_id"), "message_id", "session_id", F.col("time_created").alias("p_created"), "data",
    ), d=object_variant("data")).drop("data")
    # A part without text makes no row here, so it gets no number later.
    p = p.select("*", F.explode(F.filter(F.array(part_text()), lambda t: ~is_blank(t))).alias("text"))
    # The estimate of a side whose VARIANT is dropped again is a small part of its size; unhinted it would be broadcast.
    rows = p.join(m.hint("merge"), ["session_id", "message_id"]).join(s, "session_id")
    order = ["m_created", "message_id", "p_created", "part_id"]
    # How large the sessions are at most is known without reading any payload.
    sizes = parts.select("session_id", "message_id", F.col("time_created").alias("p_created"), F.col("id").alias("part_id")).join(
        messages.select(F.col("id").alias("message_id"), "session_id", F.col("time_created").alias("m_created")),
        ["session_id", "message_id"],
    )
    rows = numbered(rows, ["session_id"], order, "chunk_number", sizes=sizes)
    kind = text_at("d", "$.type")
    is_tool = kind == "tool"
    is_user = F.col("m_role") == "user"
    stamp = F.coalesce(
        _whole("d", "$.state.time.start"), _whole("d", "$.timestamp"), F.col("p_created"), F.col("m_created"), F.col("s_created")
    )
    seconds = F.coalesce(millis_or_seconds(F.nullif(stamp, F.lit(0).cast("long"))), F.lit(fallback_epoch).cast("long"))
    source = F.concat(F.lit(PREFIX), "session_id")
    return rows.select(
        F.concat(source, F.lit("_"), F.col("chunk_number").cast("string")).alias("chunk_id"), source.alias("source_id"),
        "chunk_number", F.when(kind.isin("tool", "patch"), "tool_call").when(is_user, "user_prompt").otherwise("assistant").alias("type"),
        F.when(is_user, "user").otherwise("assistant").alias("role"), strip("text").alias("content"),
        (seconds + F.col("chunk_number")).alias("timestamp"), F.coalesce("m_cwd", "directory").alias("cwd"), "model",
        F.when(is_tool, canonical_tool(text_at("d", "$.tool"))).alias("tool_name"),
        F.when(is_tool, target_file()).alias("target_file"), F.when(is_tool, tool_success()).alias("success"),
        "message_id", "part_id", "d",
    )


def source_rows(sessions: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per session; the first model seen in its messages counts."""
    m = evaluate_once(evaluate_once(messages, md=object_variant("data")), model=message_model())
    first = m.filter(F.col("model").isNotNull()).groupBy("session_id").agg(
        F.min_by("model", F.struct("time_created", "id")).alias("model")
    )
    # As in chunk_rows, the estimate of this side says nothing about its size.
    return sessions.withColumnRenamed("id", "session_id").join(first.hint("merge"), "session_id", "left").select(
        F.concat(F.lit(PREFIX), "session_id").alias("source_id"), "title",
        F.concat(F.lit(PREFIX), "session_id").alias("source"), F.col("directory").alias("primary_cwd"),
        F.when(F.coalesce("time_created", F.lit(0)) == 0, "").otherwise(F.col("time_created").cast("string")).alias("file_date"),
        "model",
    )


def session_sidecar(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        F.concat(F.lit(PREFIX), "id").alias("source_id"), F.col("id").alias("session_id"), "project_id", "parent_id",
        "slug", "directory", "title", "version", "summary_additions", "summary_deletions", "summary_files",
        "time_created", "time_updated",
    )


def part_sidecar(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "chunk_id", "message_id", "part_id", text_at("d", "$.type").alias("part_type"), text_at("d", "$.tool").alias("raw_tool"),
        text_at("d", "$.callID").alias("call_id"), text_at("d", "$.state.status").alias("status"),
        text_at("d", "$.snapshot").alias("snapshot"), text_at("d", "$.reason").alias("reason"),
    )


def patch_records(chunks: DataFrame) -> DataFrame:
    """Diff, its short hash and the touched files of patch parts and apply_patch calls."""
    is_patch = (text_at("d", "$.type") == "patch") | (
        (text_at("d", "$.type") == "tool") & (text_at("d", "$.tool") == "apply_patch")
    )
    diff = F.coalesce(
        nonempty(text_at("d", "$.state.metadata.diff")), nonempty(text_at("d", "$.patch")),
        nonempty(text_at("d", "$.state.input.patchText")), spaced(F.to_json("d")),
    )

    def files_at(path: str) -> Column:
        value = F.try_variant_get("d", path, "variant")
        return F.when(F.schema_of_variant(value) != "VOID", spaced(F.to_json(value)))

    own = files_at("$.files")
    own = F.when(~own.isin("[]", "{}", '""', "false", "0"), own)

    return chunks.filter(is_patch).select(
        "chunk_id", F.substring(F.sha2(diff, 256), 1, 16).alias("patch_hash"),
        F.coalesce(own, files_at("$.state.metadata.files")).alias("files_json"),
        F.concat(F.lit('{"diff": '), quoted(diff), F.lit("}")).alias("diff_json"),
    )


def bodies(chunks: DataFrame) -> DataFrame:
    """Bodies for the content store: tool output, patch input, and the clean text of files read."""
    tools = chunks.filter(text_at("d", "$.type") == "tool")
    raw_tool = F.coalesce(nonempty(text_at("d", "$.tool")), F.lit(DEFAULT_BODY_TOOL))
    output = nonempty(text_at("d", "$.state.output"))
    patch = F.when(raw_tool == "apply_patch", nonempty(text_at("d", "$.state.input.patchText")))
    clean = F.when((raw_tool == "read") & F.col("target_file").isNotNull(), read_body(output))
    listed = F.array(
        F.struct(F.coalesce(output, spaced(F.to_json("d"))).alias("content"), raw_tool.alias("tool_name")),
        F.struct(patch.alias("content"), F.lit("apply_patch_input").alias("tool_name")),
        F.struct(clean.alias("content"), F.lit("read_body").alias("tool_name")),
    )
    return tools.select("chunk_id", F.inline(listed)).filter(F.col("content").isNotNull())
