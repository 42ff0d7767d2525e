"""Side logs of the chat tool: input history, model log, analytics events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracelake.functions.text import LINE_ENDS, SPACE, group, is_blank, rstrip, strip
from tracelake.operators import sequences
from tracelake.sources.markdown_chat import SLICE_LINES, split_lines

# Marks of the input history and the model log.
ENTRY_MARK = "# "
CONTENT_MARK = "+"
MODEL_MARK = rf"(?d)^(TO LLM|LLM RESPONSE){SPACE}+(.+?){SPACE}*$"
BAD_RECORD = "_invalid_json"


def numbered_lines(files: DataFrame) -> DataFrame:
    """path, line_no (1-based) and the line without its end."""
    flat = files.select("path", F.posexplode(split_lines("text")).alias("pos", "raw"))
    return flat.select(
        "path", (F.col("pos") + 1).cast("long").alias("line_no"),
        F.rtrim("raw", F.lit(LINE_ENDS)).alias("line"),
    )


def _islands(rows: DataFrame, starts: Column) -> DataFrame:
    """Number the runs that begin at `starts`, counted in slices of a file."""
    sliced = sequences.in_slices(rows.withColumn("__starts", starts), ["path"], F.floor(F.col("line_no") / SLICE_LINES))
    return sequences.whole(sequences.running(sliced, ["line_no"], island=("sum", F.col("__starts").cast("long")))).drop("__starts")


def _joined(lines: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(lines)), lambda s: s["line"]), "\n")


def input_history(files: DataFrame) -> DataFrame:
    """Entries of typed input: a header line gives the time, plus lines are the content."""
    rows = numbered_lines(files)
    header = F.startswith("line", F.lit(ENTRY_MARK))
    rows = _islands(rows.withColumn("__head", header), F.col("__head"))
    typed = F.when(~F.col("__head") & F.startswith("line", F.lit(CONTENT_MARK)),
                   F.struct("line_no", F.expr("substring(line, 2)").alias("line")))
    return (
        rows.withColumn("__typed", typed).groupBy("path", "island")
        .agg(
            F.max(F.when(F.col("__head"), strip(F.expr("substring(line, 3)")))).alias("timestamp"),
            _joined("__typed").alias("content"), F.count("__typed").alias("__n"),
            F.max(F.when(F.col("__head"), F.col("line_no"))).alias("start_line"),
            F.max("line_no").alias("end_line"),
        )
        .filter(F.col("__n") > 0)
        .select("path", F.coalesce("timestamp", F.lit("")).alias("timestamp"), "content",
                F.coalesce("start_line", F.lit(0).cast("long")).alias("start_line"), "end_line")
    )


def model_log(files: DataFrame) -> DataFrame:
    """Requests and responses of the model log; text before the first marker is dropped."""
    rows = numbered_lines(files).withColumn("__mark", group("line", MODEL_MARK, 1))
    rows = _islands(rows.withColumn("__at", group("line", MODEL_MARK, 2)), F.col("__mark").isNotNull())
    body = F.when(F.col("__mark").isNull(), F.struct("line_no", "line"))
    return (
        rows.filter(F.col("island") > 0).withColumn("__body", body).groupBy("path", "island")
        .agg(
            F.max("__mark").alias("mark"), F.max("__at").alias("timestamp"), _joined("__body").alias("content"),
            F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"),
        )
        .select(
            "path", F.when(F.col("mark") == "TO LLM", "to_llm").otherwise("llm_response").alias("role"), "timestamp",
            rstrip("content").alias("content"), "start_line", "end_line",
        )
    )


def analytics(files: DataFrame) -> DataFrame:
    """JSON lines with their line number; blank lines skipped, broken ones kept with their text."""
    rows = numbered_lines(files).filter(~is_blank("line"))
    payload = F.try_parse_json("line")
    name = F.when(payload.isNull(), F.lit(BAD_RECORD)).otherwise(F.try_variant_get(payload, "$.event", "string"))
    return rows.select(
        "path", F.col("line_no").alias("_line"), name.alias("event"), payload.alias("payload"),
        F.when(payload.isNull(), F.col("line")).alias("raw"),
    )
