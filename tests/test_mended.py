"""Small cases: JSON text form, malformed comment trees, blank queries, ties in a batch, windows of weeks, spread over all rows."""

import hashlib
import json

import numpy as np
from pyspark.sql import functions as F

from tracelake.functions.jsons import spaced
from tracelake.operators import sinks
from tracelake.plans import search, topology, vectors
from tracelake.sources import articles


def test_json_text_is_that_of_sorted_python_dumps(spark):
    values = [{"b": [1, 2.5, None, True], "a": {"x": "y, z: \"q\" \\ {", "é": "😀:,"}}, [], {}, [{"k": ""}], {"t": ":,\":"}]
    rows = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)], "i int, j string")
    got = {r.i: r.t for r in rows.select("i", spaced(F.to_json(F.parse_json("j"))).alias("t")).collect()}
    want = {i: json.dumps(v, ensure_ascii=False, sort_keys=True) for i, v in enumerate(values)}
    assert got == want
    assert hashlib.sha256(got[3].encode()).hexdigest() == hashlib.sha256(b'[{"k": ""}]').hexdigest()


def test_malformed_nodes(spark):
    tree = json.dumps(["text", 5, None, {"id_code": "a", "user": "bob", "children": {"x": 1}}, {"id_code": 7, "user": {"username": 3}, "children": ["t", {"id_code": "b", "body_html": []}]}])
    trees = spark.createDataFrame([("1", tree), ("2", "{"), ("3", None), ("4", "5")], "article_id string, tree string")
    got = articles.flatten_comments(trees).collect()
    assert sorted((r["head_id"], r["dfs_pos"]) for r in got) == [("1", 0), ("1", 1), ("1", 2)]


def test_blank_query_finds_nothing(spark):
    index = search.build_index(spark.createDataFrame([("1", "some words")], "id string, content string"))
    assert search.keyword(index, "  ").count() == 0 and search.keyword(index, "words").count() == 1


def test_ties_in_a_batch_insert_one(spark):
    target = spark.createDataFrame([], "key string")
    batch = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", 1, None)], "key string, at int, v string")
    out = sinks.flag_batch(target, batch, ["key"], ["at"], F.lit(True)).collect()
    assert sorted(r["outcome"] for r in out) == ["duplicate", "duplicate", "inserted"]


def test_weeks_cover_the_window():
    weeks = topology.weeks_of("2024-01-31 00:00:00", 60)
    assert (weeks[0], weeks[-1], len(weeks)) == ("2023-11-27", "2024-01-29", 10)
    assert topology.weeks_of("2024-01-29", 0) == ["2024-01-29"]


def test_spread_looks_beyond_the_best_300(spark):
    rng = np.random.default_rng(0)
    near = np.hstack([np.ones((980, 1)), rng.normal(0, 0.01, (980, 7))])  # almost one direction
    far = np.eye(8)[1:].repeat(3, axis=0)[:20] + 0.05
    m = np.vstack([near, far])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, embedding array<float>")
    got = vectors.diverse(vectors.score(df, [1.0] + [0.0] * 7), 20, share=0.3).collect()
    assert len({r["id"] for r in got}) == 20 and any(r["id"] >= 980 for r in got)
