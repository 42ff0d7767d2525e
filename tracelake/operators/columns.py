"""Column evaluation helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def evaluate_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add costly columns so that each is computed once per row.

    A later filter on a plain projected column is pushed below the projection
    and its expression copied; values made by a generator stay where they are.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
