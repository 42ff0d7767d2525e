"""Time the ordered operators on rows of which one key holds a third, next to a plain window.

usage: python tools/skew.py [rows]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, Window, functions as F  # noqa: E402

from tracelake.operators.sequences import gap_sessions  # noqa: E402
from tracelake.plans import digest, topology  # noqa: E402
from tracelake.operators.ranking import pick_first  # noqa: E402
from tracelake.session import local_session  # noqa: E402


def rows(spark, n: int) -> DataFrame:
    """Events over a year; user 0 holds a third of them."""
    r = F.xxhash64("id")
    user = F.when(F.col("id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.pmod(r, F.lit(n // 50)) + 1)
    at = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64("id", F.lit(7)), F.lit(365 * 86400))).cast("timestamp_ntz")
    return spark.range(n).select(F.col("id"), user.alias("user"), at.alias("ts"))


def plain(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("user").orderBy("ts", "id")
    cut = F.coalesce(F.col("ts") - F.lag("ts").over(w) > F.expr("INTERVAL 1 HOUR"), F.lit(True))
    df = df.withColumn("cut", cut)
    df = df.withColumn("session_no", F.sum(F.col("cut").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.withColumn("position", F.row_number().over(Window.partitionBy("user", "session_no").orderBy("ts", "id"))).drop("cut")


def timed(label: str, df: DataFrame) -> None:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    print(f"{label}: {time.perf_counter() - t0:.1f}s", flush=True)


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    spark = local_session(8, "skew", shuffle_partitions=32)
    df = rows(spark, n)
    timed("warm-up", gap_sessions(df.limit(1000), ["user"], "ts", ["id"], "1 HOUR"))
    timed("plain window", plain(df))
    cut = gap_sessions(df, ["user"], "ts", ["id"], "1 HOUR")
    timed("segmented sessions", cut)
    same = cut.select("id", "session_no", "position").exceptAll(plain(df).select("id", "session_no", F.col("position").cast("long")))
    print("rows that differ:", same.count(), flush=True)
    timed("first row per key", pick_first(df, ["user"], ["ts", "id"]))
    sessions = df.select(
        F.col("id").cast("string").alias("session_id"), F.col("user").cast("int").alias("community_id"),
        F.lit("c").alias("community_label"), F.lit("p").alias("project"), F.lit(1).alias("message_count"),
        F.col("ts").alias("started_at"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("centrality"),
        F.lit(1).alias("is_hub"), F.lit(0).alias("is_bridge"), F.lit("t").alias("title"), F.lit(None).cast("string").alias("fingerprint_index"),
    )
    seed = topology.seed(sessions, "2024-12-31 00:00:00", days=365)
    timed("top hubs per community", topology.hubs(sessions, seed))
    touched = df.select(
        F.col("user").cast("string").alias("target_file"), F.pmod(F.xxhash64("id"), F.lit(100000)).cast("string").alias("session_id"))
    timed("file heat", digest.file_heat(touched))
    spark.stop()


if __name__ == "__main__":
    main()
