"""Segmented windows against plain Python, with one key that holds most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tracelake.operators import sequences as S
from tracelake.operators.ranking import pick_first, pick_last, top_per_group

T0 = dt.datetime(2024, 1, 1)


def rows(seed, n=600):
    rng = random.Random(seed)
    out, at = [], {}
    for i in range(n):
        key = 0 if rng.random() < 0.6 else rng.randrange(1, 6)
        step = rng.choice([0, 60, 3600, 3601, 9000, 40000, 90000, 200000])
        at[key] = at.get(key, 0) + step
        out.append((key, T0 + dt.timedelta(seconds=at[key]), i, rng.randrange(100)))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "k int, ts timestamp_ntz, i int, v int")


def by_key(data):
    out = {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("seed,max_rows,same_day", [(1, 50, False), (2, 7, False), (3, 20, True), (4, 100000, True)])
def test_gap_sessions(spark, seed, max_rows, same_day):
    data = rows(seed)
    want = {}
    for key, seq in by_key(data).items():
        no = pos = 0
        prev = None
        for r in seq:
            cut = prev is None or (r[1] - prev) > dt.timedelta(hours=1) or (same_day and r[1].date() != prev.date())
            no, pos = (no + 1, 1) if cut else (no, pos + 1)
            prev = r[1]
            want[r[2]] = (no, pos)
    out = S.gap_sessions(frame(spark, data), ["k"], "ts", ["i"], "1 HOUR", same_day, max_rows)
    assert {r["i"]: (r["session_no"], r["position"]) for r in out.collect()} == want


@pytest.mark.parametrize("seed", [5, 6])
def test_running_and_previous(spark, seed):
    data = rows(seed)
    total, last, seen, n = {}, {}, {}, {}
    for seq in by_key(data).values():
        s, m, p = 0, -1, None
        for c, r in enumerate(seq, start=1):
            s, m = s + r[3], max(m, r[3])
            total[r[2]], last[r[2]], seen[r[2]], n[r[2]] = s, p, m, c
            p = r[3]
    df = S.sliced(frame(spark, data), ["k"], ["ts", "i"], 30)
    df = S.running(df, ["ts", "i"], total=("sum", F.col("v")), top=("max", F.col("v")))
    df = S.whole(S.previous(df, ["ts", "i"], {"p": "v"}))
    got = df.collect()
    assert {r["i"]: r["total"] for r in got} == total
    assert {r["i"]: r["top"] for r in got} == seen
    assert {r["i"]: r["p"] for r in got} == last
    num = S.numbered(frame(spark, data), ["k"], ["ts", "i"], "n", 11).collect()
    assert {r["i"]: r["n"] for r in num} == n


def test_only_large_keys_are_cut(spark):
    df = S.sliced(frame(spark, rows(8)), ["k"], ["ts", "i"], 100)
    slices = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.countDistinct("__slice").alias("n")).collect()}
    assert slices[0] >= 3 and all(n == 1 for k, n in slices.items() if k != 0)
    nulls = spark.createDataFrame([(None, 1, None), (None, 2, 5), (1, 3, None), (1, 4, 9)], "k int, i int, t long")
    got = S.numbered(nulls, ["k"], ["t", "i"], "n", 1).collect()
    assert {r["i"]: r["n"] for r in got} == {1: 1, 2: 2, 3: 1, 4: 2}
    at = [(None, T0, 1), (None, T0 + dt.timedelta(minutes=1), 2), (None, T0 + dt.timedelta(days=1), 3), (7, T0, 4)]
    cut = S.gap_sessions(spark.createDataFrame(at, "k int, ts timestamp_ntz, i int"), ["k"], "ts", ["i"], "1 HOUR", target=1)
    assert {r["i"]: (r["session_no"], r["position"]) for r in cut.collect()} == {1: (1, 1), 2: (1, 2), 3: (2, 1), 4: (1, 1)}
    assert S.numbered(nulls.where("false"), ["k"], ["t", "i"], "n", 1).count() == 0


@pytest.mark.parametrize("tie", ["long", "string"])
def test_no_slice_is_above_twice_the_target(spark, tie):
    """One key with nearly all rows, of these 99 % in one second; ties by numbers or by long strings that begin alike."""
    rng = random.Random(9)
    data = []
    for i in range(6000):
        key = (None if i % 2 else 0) if i % 50 else rng.randrange(1, 9)
        at = T0 + (dt.timedelta(seconds=5) if rng.random() < 0.99 else dt.timedelta(seconds=rng.randrange(10**7)))
        data.append((key, at, i * 10**9 - 7 * 10**11 if tie == "long" else f"message-of-one-session-{i:09d}-é"))
    df = spark.createDataFrame(data, f"k int, ts timestamp_ntz, i {tie}").repartition(3)
    target = 40
    sizes = S.sliced(df, ["k"], ["ts", "i"], target).groupBy("k", "__slice").count().collect()
    assert max(r["count"] for r in sizes) <= 2 * target
    assert len(sizes) < 3 * len(data) / target
    want, number = {}, {}
    for key, _, i in sorted(data, key=lambda r: (r[1], r[2])):
        want[key, i] = number[key] = number.get(key, 0) + 1
    got = S.numbered(df, ["k"], ["ts", "i"], "n", target).collect()
    assert {(r["k"], r["i"]): r["n"] for r in got} == want


def test_pick_and_top(spark):
    data = rows(7)
    first = {k: seq[0][2] for k, seq in by_key(data).items()}
    last = {k: seq[-1][2] for k, seq in by_key(data).items()}
    df = frame(spark, data)
    assert {r["k"]: r["i"] for r in pick_first(df, ["k"], ["ts", "i"]).collect()} == first
    assert {r["k"]: r["i"] for r in pick_last(df, ["k"], ["ts", "i"]).collect()} == last
    got = top_per_group(df, ["k"], [F.col("v").desc(), F.col("i").asc()], 3).collect()
    for k, seq in by_key(data).items():
        best = [r[2] for r in sorted(seq, key=lambda r: (-r[3], r[2]))[:3]]
        assert [r["i"] for r in sorted((r for r in got if r["k"] == k), key=lambda r: r["rn"])] == best
