"""Scalar helpers against Python's own functions."""

import datetime as dt
import html
import json
import re

from pyspark.sql import functions as F

from tracelake.functions import jsons, text, times
from tracelake.functions.html import strip_html


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", expr.alias("o")).orderBy("i").collect()]


def test_strip_and_blank(spark):
    values = [" a ", " x ", "\x1c y\x85", "", "\n\n", "a​b ", "in  side"]
    assert column(spark, values, text.strip("v")) == [v.strip() for v in values]
    assert column(spark, values, text.rstrip("v")) == [v.rstrip() for v in values]
    assert column(spark, values, text.is_blank("v")) == [not v.strip() for v in values]


def test_iso_times(spark):
    def python(v):
        try:
            d = dt.datetime.fromisoformat(v.replace("Z", "+00:00"))
            return int((d if d.tzinfo else d.replace(tzinfo=dt.timezone.utc)).timestamp())
        except ValueError:
            return 0

    values = [
        "2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02 03:04:05", "2024-01-02T03:04:05.750Z", "2024-01-02",
        "2024-01-02T03:04", "2024-01-02T03", "soon", "", "2024", "2024-13-01T00:00:00Z", "2024-02-30", "2024-01-02T03:04:05-05:30",
    ]
    assert column(spark, values, times.iso_epoch_or_zero("v")) == [python(v) for v in values]
    assert column(spark, [None], times.iso_epoch_or_zero("v")) == [0]


def test_html(spark):
    values = ["<p>a &amp; b</p>", "&lt;b&gt;gone&lt;/b&gt;", "x<br>y", "&copy &amp;lt;i&gt;", "", None, "no markup", "a < b"]
    want = [re.sub(r"<[^>]+>", "", html.unescape(v)).strip() if v else "" for v in values]
    assert column(spark, values, strip_html("v")) == want


def test_json_helpers(spark):
    values = ['a"b\\c\n é', "", None]
    assert column(spark, values, jsons.quoted("v")) == [json.dumps(v, ensure_ascii=False) for v in values]
    tags = ['["rust","db"]', "[]", None, "broken", '["RUST"]', '"rust"']
    assert column(spark, tags, jsons.has_tag("v", "rust")) == [True, False, False, False, False, False]
    objects = ['{"a":1}', "[1]", "{bad", None, "3"]
    assert column(spark, objects, jsons.object_variant("v").isNotNull()) == [True, False, False, False, False]


def test_dates(spark):
    df = spark.sql("""SELECT timestamp_ntz'2024-01-07 23:00:00' AS a, timestamp_ntz'2024-01-06 23:30:00' AS b""")
    r = df.select(
        times.week_start("a").alias("ws"), times.week_end("a").alias("we"),
        times.whole_days_between(F.col("a"), F.col("b")).alias("d"),
        times.calendar_since("b", "2024-01-07 12:00:00", 1).alias("cal"), times.rolling_since("b", "2024-01-07 23:45:00", 1).alias("roll"),
    ).first()
    assert (r["ws"], r["we"], r["d"], r["cal"], r["roll"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 7), 0, True, False)
    got = column(spark, ["0", "1704067200", None], times.yymmdd(F.col("v").cast("long")))
    assert got == ["", "240101", ""]
    assert column(spark, ["1704067200000", "1704067200", None], times.millis_or_seconds("v")) == [1704067200, 1704067200, None]
