"""Idempotent merges of a batch into a table, and the content-addressed store.

The merges return DataFrames.  Append-only tables (keep-first, high-water) are
stored as one directory per batch, so a batch writes only its own rows and a
replayed batch replaces itself.  Tables whose rows change are stored in buckets
by a hash of the key; a batch reads and rewrites the buckets of its keys alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tracelake.operators.ranking import pick_first, pick_last


def fresh_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of the batch whose key is new; the first row of a key in the batch counts."""
    return pick_first(batch, keys, order).join(target.select(*keys), keys, "left_anti")


def keep_first(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First writer wins: rows already stored never change."""
    return target.unionByName(fresh_rows(target, batch, keys, order))


def replace(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last writer wins: a batch row replaces the stored row of its key."""
    newest = pick_last(batch, keys, order)
    return target.join(newest.select(*keys), keys, "left_anti").unionByName(newest)


def coalesce_update(
    target: DataFrame, updates: DataFrame, keys: list[str], old_wins: tuple[str, ...] = (),
    new_wins: tuple[str, ...] = (),
) -> DataFrame:
    """Fill columns from one update row per key: old_wins only when null, new_wins whenever the update has a value."""
    changed = [*old_wins, *new_wins]
    new = updates.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in changed])
    joined = target.join(new, keys, "left")

    def merged(c: str) -> Column:
        if c in old_wins:
            return F.coalesce(F.col(c), F.col(f"__new_{c}")).alias(c)
        if c in new_wins:
            return F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c)
        return F.col(c)

    return joined.select(*[merged(c) for c in target.columns])


BUCKET = "bucket"
BUCKETS = 256


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))


def write_buckets(df: DataFrame, base: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Write a keyed table anew. The number of buckets is the table's for good: about its size by a few GB."""
    _bucketed(df, keys, buckets).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(base)


def read_buckets(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(base).drop(BUCKET)


def _merge_buckets(batch: DataFrame, base: str, schema: T.StructType, keys: list[str], buckets: int, merge) -> None:
    """Rewrite the buckets that the batch's keys fall into; the files of the others stay as they are.

    Buckets are staged and moved into place one by one, so a batch that failed
    half way is run again: a merge gives the same rows over what it wrote.
    """
    spark = batch.sparkSession
    batch = _bucketed(batch, keys, buckets)
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
    if not touched:
        return
    whole = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(base)
    target = whole.where(F.col(BUCKET).isin(touched))
    merged = merge(target.drop(BUCKET), batch.drop(BUCKET))
    rows = _bucketed(merged, keys, buckets).repartition(BUCKET)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(base)


def upsert_replace(batch: DataFrame, base: str, schema: T.StructType, keys: list[str], order: list[str], buckets: int = BUCKETS) -> None:
    """replace() on a table written by write_buckets."""
    _merge_buckets(batch, base, schema, keys, buckets, lambda target, rows: replace(target, rows, keys, order))


def upsert_coalesce(
    updates: DataFrame, base: str, schema: T.StructType, keys: list[str], old_wins: tuple[str, ...] = (), new_wins: tuple[str, ...] = (),
    buckets: int = BUCKETS,
) -> None:
    """coalesce_update() on a table written by write_buckets."""
    _merge_buckets(updates, base, schema, keys, buckets, lambda target, rows: coalesce_update(target, rows, keys, old_wins, new_wins))


def flag_batch(
    target: DataFrame, batch: DataFrame, keys: list[str], order: list[str], valid: Column
) -> DataFrame:
    """Add outcome to every batch row: rejected, duplicate (key known or repeated) or inserted."""
    known = target.select(*keys).distinct().withColumn("__known", F.lit(True))
    row = F.struct(*order, *sorted(set(batch.columns) - set(order)))  # ties in order are broken by the rest of the row
    first = batch.filter(valid).groupBy(*keys).agg(F.min(row).alias("__first"))
    out = batch.join(known, keys, "left").join(first, keys, "left")
    fresh = F.col("__known").isNull() & row.eqNullSafe(F.col("__first"))
    outcome = F.when(~F.coalesce(valid, F.lit(False)), "rejected").when(fresh, "inserted").otherwise("duplicate")
    return out.withColumn("outcome", outcome).drop("__known", "__first")


def audit(flagged: DataFrame, kind: str, params: dict[str, str]) -> DataFrame:
    """One row per source kind: attempted, inserted, rejected, and the batch parameters as JSON."""
    given = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in sorted(params.items())])) if params else F.lit("{}")
    return (
        flagged.groupBy(kind)
        .agg(
            F.count(F.lit(1)).alias("attempted"),
            F.count_if(F.col("outcome") == "inserted").alias("inserted"),
            F.count_if(F.col("outcome") == "rejected").alias("rejected"),
        )
        .withColumn("params", given)
    )


def content_hash(c: str = "content") -> Column:
    return F.sha2(F.col(c), 256)


def content_store(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bodies (chunk_id, content, tool_name) to one row per distinct content and the chunk-to-hash edges."""
    hashed = bodies.withColumn("hash", content_hash())
    store = hashed.groupBy("hash").agg(
        F.min_by("tool_name", "chunk_id").alias("tool_name"), F.any_value("content").alias("content"),
        F.max(F.octet_length("content")).cast("long").alias("byte_length"),
    )
    edges = hashed.select("chunk_id", F.col("hash").alias("content_hash")).distinct()
    return store, edges


def _folder(spark: SparkSession, base: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    return jvm, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_batch(df: DataFrame, base: str, batch_id: int) -> None:
    """Write the rows of one batch into its own directory; the same batch again replaces it."""
    df.write.mode("overwrite").parquet(f"{base}/batch={batch_id}")


def read_batches(spark: SparkSession, base: str, schema: str, before: int | None = None) -> DataFrame:
    """All rows of an append-only table, or those of the batches before one; empty when there is none yet."""
    _, root, fs = _folder(spark, base)
    if not fs.exists(root):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(f"{schema}, batch long").parquet(base)
    return (df if before is None else df.filter(F.col("batch") < before)).drop("batch")
