"""Ordered computations per key that stay parallel when one key is very large.

A plain window puts every row of a key into one task. Here a key's rows are cut
into slices along their order, of `target` rows and never of more than twice as
many; a key of fewer is one slice. The window runs per (key, slice), and only
one summary row per (key, slice) is windowed per key to carry values across the
cuts. Input rows are shuffled once, by (key, slice).

The cuts come from counts. A cell, at first a key, that holds more than `target`
rows is divided into CELLS of equal width between its least and largest value
of the first order column in which its rows differ, and so on; a second into
which most rows fall is thus divided further, down to the tie columns. Running
sums over the cells of a key then place the cuts. Rows that are equal in all
order columns (strings: in their first 48 bytes) stay together. Where no key is
cut there is nothing to carry, and the plain window is what is left.

A null order value comes first; rows with a null key are one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tracelake.session import Scratch

_KEY, _SLICE = "__key", "__slice"
TARGET = 2_000_000
CELLS = 512
#: A string is ordered by so many numbers of so many bytes each.
STRING_DIGITS, DIGIT_BYTES = 8, 6


def _digits(df: DataFrame, order: list[str]) -> list[Column]:
    """The order columns as whole numbers, each exact as a double; their list never falls in the order of the rows."""
    out: list[Column] = []
    for name in order:
        kind, c = df.schema[name].dataType, F.col(name)
        if isinstance(kind, T.StringType):
            for k in range(STRING_DIGITS):
                part = F.rpad(F.hex(F.substring(F.encode(c, "utf-8"), 1 + DIGIT_BYTES * k, DIGIT_BYTES)), 2 * DIGIT_BYTES, "0")
                out.append(F.coalesce(F.conv(part, 16, 10).cast("long"), F.lit(-1).cast("long")))
            continue
        if isinstance(kind, T.TimestampNTZType):
            c = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
        elif isinstance(kind, T.TimestampType):
            c = F.unix_micros(c)
        elif not isinstance(kind, T.IntegralType):
            raise TypeError(f"rows can't be cut along {name}: {kind.simpleString()}")
        c = c.cast("long")
        out += [F.coalesce(F.shiftright(c, 32), F.lit(-(1 << 40))), F.coalesce(c.bitwiseAND((1 << 32) - 1), F.lit(0).cast("long"))]
    return out


def cut_points(df: DataFrame, keys: list[str], order: list[str], target: int) -> DataFrame | None:
    """__key and __cuts, the places at which the slices of a key begin but the first; None if no key is cut."""
    digits = _digits(df, order)
    scratch = Scratch(df.sparkSession)
    rows = df.select(F.struct(*keys).alias(_KEY), F.array(*digits).alias("at"))
    sizes = rows.groupBy(_KEY).agg(F.count("*").alias("n")).where(F.col("n") > target)
    many = scratch.write("keys", sizes.select(_KEY, F.lit("").alias("cell")))  # at most rows / target
    if many.isEmpty():
        return None
    rows = rows.join(many, _KEY)
    leaves, number = None, 0
    while True:
        lows, highs = (F.array(*[f(F.get("at", k)) for k in range(len(digits))]) for f in (F.min, F.max))
        counted = rows.groupBy(_KEY, "cell").agg(F.count("*").alias("n"), lows.alias("lows"), highs.alias("highs"))
        cells = scratch.write(f"cells-{number}", counted)
        differ = F.array_position(F.zip_with("lows", "highs", lambda a, b: a < b), F.lit(True)).cast("int")
        large = (F.col("n") > target) & (differ > 0)
        leaf = cells.where(~large).select(_KEY, "n", F.col("lows").alias("start"))
        leaves = leaf if leaves is None else leaves.union(leaf)
        low, high = F.element_at("lows", differ), F.element_at("highs", differ)
        split = cells.where(large).select(
            _KEY, "cell", (differ - 1).alias("digit"), low.alias("low"), F.greatest(F.lit(1.0), (high - low + 1) / F.lit(float(CELLS))).alias("width"))
        if split.isEmpty():
            break
        inner = F.floor((F.get("at", F.col("digit")) - F.col("low")) / F.col("width")).cast("string")
        rows = rows.join(split, [_KEY, "cell"]).select(_KEY, "at", F.concat_ws(".", "cell", inner).alias("cell"))
        number += 1
    # The least values of a cell, column by column, are not above its first row, and above all rows of the cells before it.
    before = Window.partitionBy(_KEY).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = leaves.withColumn(_SLICE, F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / target))
    begins = placed.groupBy(_KEY, _SLICE).agg(F.min("start").alias("start")).where(F.col(_SLICE) > 0)
    return scratch.write("cuts", begins.groupBy(_KEY).agg(F.sort_array(F.collect_list("start")).alias("__cuts")))


def sliced(df: DataFrame, keys: list[str], order: list[str], target: int = TARGET, sizes: DataFrame | None = None) -> DataFrame:
    """Add the key as one column and, if any key is cut, the number of the row's slice along the order.

    `sizes` may hold the same keys and order columns more cheaply than df, with
    at least as many rows.
    """
    cuts = cut_points(df if sizes is None else sizes, keys, order, target)
    rows = df.withColumn(_KEY, F.struct(*keys))
    if cuts is None:
        return rows
    begun = F.size(F.filter("__cuts", lambda c: c <= F.array(*_digits(df, order))))
    return rows.join(cuts, _KEY, "left").withColumn(_SLICE, F.when(F.col("__cuts").isNull(), 0).otherwise(begun).cast("long")).select(*rows.columns, _SLICE)


def in_slices(df: DataFrame, keys: list[str], number: Column) -> DataFrame:
    """Rows whose slice is known beforehand: a number that does not fall along the key's order."""
    return df.withColumn(_KEY, F.struct(*keys)).withColumn(_SLICE, number.cast("long"))


def whole(df: DataFrame) -> DataFrame:
    """The rows without what sliced() added."""
    return df.drop(_KEY, _SLICE)


def _by(df: DataFrame) -> list[str]:
    return [c for c in (_KEY, _SLICE) if c in df.columns]


def previous(df: DataFrame, order: list[str], values: dict[str, str]) -> DataFrame:
    """Add lag(1) of columns to sliced rows: values maps new name to source column."""
    by = _by(df)
    local = Window.partitionBy(*by).orderBy(*order)
    lagged = df.select("*", *[F.lag(src).over(local).alias(name) for name, src in values.items()])
    if _SLICE not in by:
        return lagged
    along = Window.partitionBy(_KEY).orderBy(_SLICE)
    ends = df.groupBy(*by).agg(
        F.max_by(F.struct(*[F.col(v).alias(n) for n, v in values.items()]), F.struct(*order)).alias("__end")
    )
    carried = ends.select(*by, F.lag("__end").over(along).alias("__carry"))
    out = lagged.withColumn("__first", F.row_number().over(local) == 1).join(carried, by, "left")
    for name in values:
        out = out.withColumn(name, F.when(F.col("__first"), F.col(f"__carry.{name}")).otherwise(F.col(name)))
    return out.drop("__first", "__carry")


def running(df: DataFrame, order: list[str], **aggs: tuple[str, Column]) -> DataFrame:
    """Add running aggregates to sliced rows: name=('sum'|'max', expression)."""
    fns = {"sum": F.sum, "max": F.max}
    by = _by(df)
    local = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if _SLICE not in by:
        return df.select("*", *[fns[fn](expr).over(local).alias(name) for name, (fn, expr) in aggs.items()])
    before = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    staged = df
    for name, (_, expr) in aggs.items():
        staged = staged.withColumn(f"__v_{name}", expr)
    totals = staged.groupBy(*by).agg(*[fns[fn](f"__v_{name}").alias(f"__t_{name}") for name, (fn, _) in aggs.items()])
    offsets = totals.select(*by, *[fns[fn](f"__t_{name}").over(before).alias(f"__o_{name}") for name, (fn, _) in aggs.items()])
    out = staged
    for name, (fn, _) in aggs.items():
        out = out.withColumn(name, fns[fn](f"__v_{name}").over(local))
    out = out.join(offsets, by, "left")
    for name, (fn, _) in aggs.items():
        carry = F.col(f"__o_{name}")
        if fn == "sum":
            value = F.coalesce(F.col(name), F.lit(0)) + F.coalesce(carry, F.lit(0))
        else:
            value = F.greatest(F.col(name), carry)
        out = out.withColumn(name, value).drop(f"__v_{name}", f"__o_{name}")
    return out


def numbered(
    df: DataFrame, keys: list[str], order: list[str], name: str, target: int = TARGET, sizes: DataFrame | None = None,
) -> DataFrame:
    """1-based row number per key, in order."""
    return whole(running(sliced(df, keys, order, target, sizes), order, **{name: ("sum", F.lit(1).cast("long"))}))


def gap_sessions(
    df: DataFrame, keys: list[str], ts: str, tie: list[str], gap: str, same_day: bool = False, target: int = TARGET,
) -> DataFrame:
    """Add session_no and position (both 1-based): a gap above `gap` starts a new session.

    With same_day a change of calendar day starts one as well.  One shuffle of
    the rows by (key, slice), one summary row per (key, slice), one join back.
    """
    placed = sliced(df, keys, [ts, *tie], target)
    by = _by(placed)
    local = Window.partitionBy(*by).orderBy(ts, *tie)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = Window.partitionBy(_KEY).orderBy(_SLICE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)

    def breaks(earlier: Column, later: Column) -> Column:
        cut = later - earlier > F.expr(f"INTERVAL {gap}")
        return cut | (F.to_date(later) != F.to_date(earlier)) if same_day else cut

    rows = (
        placed.withColumn("__prev", F.lag(ts).over(local))
        .withColumn("__n", F.row_number().over(local).cast("long"))
        .withColumn("__cut", F.coalesce(breaks(F.col("__prev"), F.col(ts)), F.lit(False)))
        .withColumn("__cuts", F.sum(F.col("__cut").cast("long")).over(upto))
        .withColumn("__cut_n", F.max(F.when(F.col("__cut"), F.col("__n"))).over(upto))
    )
    if _SLICE not in by:
        since = F.coalesce(F.col("__cut_n"), F.lit(1).cast("long"))
        return rows.select(*df.columns, (F.col("__cuts") + 1).alias("session_no"), (F.col("__n") - since + 1).alias("position"))
    parts = (
        rows.groupBy(*by)
        .agg(
            F.max("__n").alias("rows"), F.min(ts).alias("lo"), F.max(ts).alias("hi"),
            F.max("__cuts").alias("cuts"), F.max("__cut_n").alias("cut_n"),
        )
        .withColumn("opens", F.coalesce(breaks(F.lag("hi").over(along), F.col("lo")), F.lag("rows").over(along).isNull()))
        .withColumn("rows0", F.coalesce(F.sum("rows").over(before), F.lit(0).cast("long")))
        .withColumn(
            "last_cut", F.col("rows0") + F.coalesce(F.col("cut_n"), F.when(F.col("opens"), F.lit(1).cast("long")))
        )
        .select(
            *by, F.col("opens").alias("__opens"),
            # sessions opened in earlier slices, and rows already in the session that is open here
            F.coalesce(
                F.sum(F.col("cuts") + F.col("opens").cast("long")).over(before), F.lit(0).cast("long")
            ).alias("__cuts0"),
            (F.col("rows0") - F.max("last_cut").over(before) + 1).alias("__open_rows"),
        )
    )
    out = rows.join(parts, by)
    position = (
        F.when(F.col("__cut_n").isNotNull(), F.col("__n") - F.col("__cut_n") + 1)
        .when(F.col("__opens"), F.col("__n"))
        .otherwise(F.col("__open_rows") + F.col("__n"))
    )
    return out.select(
        *df.columns, (F.col("__cuts0") + F.col("__opens").cast("long") + F.col("__cuts")).alias("session_no"), position.alias("position")
    )
