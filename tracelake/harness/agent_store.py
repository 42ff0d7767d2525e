"""An agent message store made by Spark from the events: a session per user, a message and a part per event."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracelake.functions.times import epoch_seconds
from tracelake.harness.events import events, stored
from tracelake.session import shared_folder
from tracelake.sources import agent_store as store

FALLBACK = 1700000000


def _base(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf).withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    # Even users write milliseconds, odd users seconds.
    at = F.when(F.col("user_id") % 2 == 0, epoch_seconds("ts") * 1000).otherwise(epoch_seconds("ts"))
    return e.select(
        "event_id", "event_type", "k", "user_id", at.alias("at"),
        F.concat(F.lit("ses_"), F.col("user_id").cast("string")).alias("session_id"),
        F.concat(F.lit("msg_"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("message_id"),
    )


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    b = _base(spark, sf)
    agg = b.groupBy("session_id", "user_id").agg(F.min("at").alias("time_created"), F.max("at").alias("time_updated"))
    user = F.col("user_id").cast("string")
    return agg.select(
        F.col("session_id").alias("id"), F.concat(F.lit("p"), (F.col("user_id") % 7).cast("string")).alias("project_id"),
        F.when(F.col("user_id") % 5 == 0, "ses_0").alias("parent_id"), F.concat(F.lit("slug-"), user).alias("slug"),
        F.concat(F.lit("/home/"), user).alias("directory"), F.concat(F.lit("Work of "), user).alias("title"),
        F.lit("1.0").alias("version"), (F.col("user_id") % 9).cast("int").alias("summary_additions"),
        F.lit(0).alias("summary_deletions"), F.lit(1).alias("summary_files"), F.lit(None).cast("string").alias("summary_diffs"),
        "time_created", "time_updated",
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    data = F.expr("""
      CASE WHEN k % 11 = 0 THEN '[1]'
      ELSE concat('{"role":"', if(event_type = 'signup', 'user', 'assistant'), '"',
        CASE WHEN k % 2 = 0 THEN concat(',"providerID":"prov","modelID":"m', k, '"')
             WHEN k % 4 = 1 THEN concat(',"model":{"modelID":"n', k, '"}') ELSE '' END,
        if(k % 3 = 0, concat(',"path":{"cwd":"/w/', k, '"}'), ''), '}') END""")
    return _base(spark, sf).select(
        F.col("message_id").alias("id"), "session_id", F.col("at").alias("time_created"), F.col("at").alias("time_updated"),
        data.alias("data"),
    )


def parts(spark: SparkSession, sf: str) -> DataFrame:
    data = F.expr(r"""
      CASE event_type
      WHEN 'view' THEN concat('{"type":"tool","tool":"read","callID":"c', event_id, '","state":{"status":"completed","input":{"filePath":"src/f', k,
        '.py"},"output":"<content>\\n00001: line ', k, '\\n00002: value\\n\\n(End of file - total 2 lines)\\n</content>","time":{"start":', at + 1, '}}}')
      WHEN 'click' THEN concat('{"type":"tool","tool":"bash","state":{"status":"completed","input":{"command":"run ', k, '"},"output":"',
        if(k % 5 = 0, '', concat('out ', k, '\\n')), '"', CASE k % 4 WHEN 0 THEN ',"metadata":{"exit":0}' WHEN 1 THEN ',"metadata":{"exit":1}'
        WHEN 2 THEN ',"metadata":{"exit":"x"}' ELSE '' END, '}}')
      WHEN 'purchase' THEN concat('{"type":"tool","tool":"apply_patch","state":{"status":"', if(k % 7 = 0, 'error', 'completed'), '","input":{',
        if(k % 2 = 0, concat('"patchText":"P', k, '"'), ''), '},"metadata":{"files":[{"relativePath":"src/r', k, '.py"}]',
        if(k % 3 = 0, concat(',"diff":"D', k, '"'), ''), '},"output":"done ', k, '"}}')
      WHEN 'error' THEN CASE k % 3 WHEN 0 THEN '{"type": broken'
        WHEN 1 THEN concat('{"type":"patch","files":["a', k, '","b"],"patch":"Q', k, '"}')
        ELSE concat('{"type":"tool","tool":"grep","state":{"status":"running","title":"t', k, '"}}') END
      ELSE concat('{"type":"text","text":"', if(k % 6 = 0, '  ', concat(' hello ', k, ' ')), '","timestamp":', at, '}') END""")
    owner = F.when(F.col("k") == 13, F.lit("msg_gone")).otherwise(F.col("message_id"))
    return _base(spark, sf).select(
        F.concat(F.lit("prt_"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("id"), owner.alias("message_id"),
        "session_id", F.col("at").alias("time_created"), F.col("at").alias("time_updated"), data.alias("data"),
    )


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return stored("agent_chunks", spark, sf, lambda: store.chunk_rows(
        sessions(spark, sf), messages(spark, sf), parts(spark, sf), FALLBACK))


def landed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables written as an export (JSON lines in the shared folder) and read back by the reader."""
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/export-{md5(sf.encode()).hexdigest()[:8]}"
    for name, rows in (("session", sessions), ("message", messages), ("part", parts)):
        rows(spark, sf).write.mode("overwrite").json(f"{folder}/{name}")
    return store.read_store(spark, folder)
