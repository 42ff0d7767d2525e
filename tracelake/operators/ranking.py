"""Top-k and pick-one operators that combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rn") -> DataFrame:
    """First k rows per group. Spark limits each map task to k rows per group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def pick_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest by `order`; an aggregate, so hot keys combine before the shuffle."""
    return _pick(df, keys, order, F.min_by)


def pick_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(df, keys, order, F.max_by)


def _pick(df: DataFrame, keys: list[str], order: list[str], chooser) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(chooser(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def top_rows(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First k rows of all; each task keeps k."""
    return df.orderBy(*order).limit(k)
