"""What a task, a batch or a shuffle holds must not grow with the table."""

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tracelake.plans import search, vectors
from tracelake.sources import articles
from tracelake.streaming import arrivals


def test_postings_of_distinct_ids_need_no_shuffle(spark):
    chunks = spark.createDataFrame([("1", "b a b"), ("2", None), ("3", "A")], "id string, content string")
    postings, documents = search.build_index(chunks)
    assert "Exchange" not in postings._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["token"], r["id"], r["length"], r["positions"]) for r in postings.collect()) == [
        ("a", "1", 3, [1]), ("a", "3", 1, [0]), ("b", "1", 3, [0, 2])]
    assert sorted(map(tuple, documents.collect())) == [("1", 3), ("2", 0), ("3", 1)]


def test_postings_of_repeated_and_null_ids_are_one_row_a_token(spark):
    chunks = spark.createDataFrame([("1", "a b"), ("1", "x a b a"), (None, "a"), (None, "b a"), ("2", "a")], "id string, content string")
    rows = {(r["token"], r["id"]): (r["length"], r["positions"]) for r in search.build_index(chunks)[0].collect()}
    assert rows == {("a", "1"): (4, [0, 1, 3]), ("b", "1"): (4, [1, 2]), ("x", "1"): (4, [0]),
                    ("a", None): (2, [0, 1]), ("b", None): (2, [0]), ("a", "2"): (1, [0])}


def test_trees_are_decoded_in_pieces(monkeypatch):
    tree = json.dumps([{"id_code": "c", "body_html": "x" * 50, "children": []}])
    monkeypatch.setattr(articles, "TREE_BYTES", 2 * len(tree), raising=False)
    batch = pa.RecordBatch.from_pydict({"head_id": list("abcde"), "tree": [tree, tree, None, tree, tree]})
    out = list(articles._flatten(iter([batch])))
    assert [b.num_rows for b in out] == [3, 2]
    assert [len(x) for b in out for x in b.column("flat").to_pylist()] == [1, 1, 0, 1, 1]


def test_texts_are_embedded_in_pieces(monkeypatch):
    tokens = pa.array([["a", "b"], [], ["c"], ["a"], ["d", "d"]], pa.list_(pa.string()))
    whole, made, zeros = vectors._embed_tokens(tokens).to_pylist(), [], np.zeros
    monkeypatch.setattr(vectors, "EMBED_ROWS", 2, raising=False)
    monkeypatch.setattr(vectors.np, "zeros", lambda shape, *a, **k: made.append(shape) or zeros(shape, *a, **k))
    assert vectors._embed_tokens(tokens).to_pylist() == whole
    assert max(shape[0] for shape in made) == 2


def test_named_files_are_listed_in_few_tasks(spark, tmp_path):
    paths = []
    for n in range(250):
        (tmp_path / f"aider{n}.chat.md").write_text(f"text {n}")
        paths.append(f"file:{tmp_path}/aider{n}.chat.md")
    context, kept = spark.sparkContext, spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    context.setJobGroup("listing", "")
    try:
        found = arrivals.read_files(spark, paths)
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        assert max(tracker.getStageInfo(s).numTasks for s in stages) <= 3
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == kept
    assert found.agg(F.count("*"), F.min("text")).first() == (250, "text 0")
