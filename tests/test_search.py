"""Keyword search, vector modifiers and the source graph against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.plans import graph, search, vectors

TEXTS = {
    "a": "The vector database stores a vector. Database of vectors!",
    "b": "database vector vector database vector database",
    "c": "nothing here", "d": "", "e": "Vector, DATABASE; été vector",
}


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(list(TEXTS.items()), "id string, content string")


def tokens(text):
    import re

    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def brute(units, texts):
    docs = {k: tokens(v) for k, v in texts.items()}
    avg = sum(map(len, docs.values())) / len(docs)

    def tf(unit, t):
        return sum(t[i:i + len(unit)] == unit for i in range(len(t)))

    out = {}
    for k, t in docs.items():
        if all(tf(u, t) for u in units):
            rank = 0.0
            for u in units:
                df, f = sum(1 for x in docs.values() if tf(u, x)), tf(u, t)
                rank += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(t) / avg))
            out[k] = round(rank, 9)
    return out


@pytest.mark.parametrize("query", ["vector", "vector database", '"vector database"', '"database vector" été', "absent", '"vector database stores"'])
def test_bm25(chunks, query):
    got = search.keyword(search.build_index(chunks), query)
    assert {r["id"]: round(r["rank"], 9) for r in got.collect()} == brute(search.parse_query(query), TEXTS)


def test_parse():
    assert search.parse_query('"Vector database" fast, x') == [["vector", "database"], ["fast"], ["x"]]


def test_snippets(spark, chunks):
    hits = spark.createDataFrame([("a",), ("b",)], "id string")
    told = lambda query: {r["id"]: r["snippet"] for r in search.with_snippet(hits, chunks, query, before=4, width=12).collect()}
    assert told("stores absent") == {"a": "ase stores a", "b": "database vec"}
    assert told('"vector vector" stores')["b"] == "ase vector v"
    assert told(" - ") == told("") == {"a": "The vector d", "b": "database vec"}


def test_index_round_trip_and_update(spark, chunks, tmp_path):
    search.write_index(*search.build_index(chunks), str(tmp_path / "i"))
    index = search.read_index(spark, str(tmp_path / "i"))
    changed = spark.createDataFrame([("c", "vector now"), ("z", "new database vector")], "id string, content string")
    gone = spark.createDataFrame([("b",)], "id string")
    texts = {k: v for k, v in TEXTS.items() if k != "b"} | {"c": "vector now", "z": "new database vector"}
    got = search.keyword(search.update_index(index, changed, gone), "vector")
    assert {r["id"]: round(r["rank"], 9) for r in got.collect()} == brute([["vector"]], texts)
    only = search.keyword(index, "vector", candidates=chunks.filter("id = 'a'"))
    full = brute([["vector"]], TEXTS)
    assert {r["id"]: round(r["rank"], 9) for r in only.collect()} == {"a": full["a"]}  # statistics stay those of all chunks
    assert search.with_snippet(only, chunks, "database").first()["snippet"].startswith("The vector")


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(60, 8))
    m[:20] = m[0] + 0.01 * rng.normal(size=(20, 8))  # a third are near copies
    m = (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(99, None)]
    return m.astype(np.float64), spark.createDataFrame(rows, "id long, embedding array<float>")


def test_score_and_candidates(spark, cloud):
    m, df = cloud
    got = {r["id"]: r["score"] for r in vectors.score(df, list(m[3])).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    assert 99 not in got and np.allclose([got[i] for i in range(60)], unit @ unit[3], atol=1e-6)
    few = spark.createDataFrame([(i,) for i in range(30, 40)], "id long")
    top = vectors.top(vectors.score(df, list(m[3]), candidates=few), 5)
    assert [r["id"] for r in top.collect()] == sorted(range(30, 40), key=lambda i: -got[i])[:5]


def test_suppress_and_decay(cloud):
    m, df = cloud
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    plain, near = unit @ unit[0], unit @ unit[30]
    got = {r["id"]: r["score"] for r in vectors.score(df, list(m[0]), suppress=list(m[30]), share=0.7).collect()}
    assert np.allclose([got[i] for i in range(60)], plain - 0.7 * np.maximum(0, near), atol=1e-6)
    dated = df.withColumn("created_at", F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.least("id", F.lit(90)).cast("int")))
    got = {r["id"]: r["score"] for r in vectors.score(dated, list(m[0]), decay_days=10, as_of="2024-03-01 00:00:00").collect()}
    assert np.allclose([got[i] for i in range(60)], plain * 0.5 ** ((60 - np.arange(60)) / 10), atol=1e-6)


def test_diverse_is_greedy_mmr(cloud):
    m, df = cloud
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    scored = vectors.score(df, list(m[0]))
    by_id = {r["id"]: r["score"] for r in scored.collect()}
    pool = sorted(by_id, key=lambda i: (-by_id[i], i))[:40]
    taken = [pool[0]]
    while len(taken) < 8:
        gain = {i: 0.7 * by_id[i] - 0.3 * max(unit[i] @ unit[j] for j in taken) for i in pool if i not in taken}
        taken.append(max(gain, key=lambda i: gain[i]))
    got = vectors.diverse(scored, 8, pool=40).orderBy("pick").collect()
    assert [r["id"] for r in got] == taken
    spread = vectors.diverse(scored, 8, pool=40, share=0.4)
    assert spread.filter("id < 20").count() < 8  # no longer all from the copies
    assert vectors.diverse(scored.limit(0), 8).count() == 0


def test_diverse_scans_few_times(spark, monkeypatch):
    """The picks of the rule itself, step by step over all rows, with few rows looked ahead, ties and copies; at most three scans."""
    rng = np.random.default_rng(4)
    m = np.round(rng.normal(size=(900, 8)), 1)
    m[300:450] = m[7]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(m.tolist())], "id long, embedding array<double>").repartition(4)
    scored = vectors.score(df, m[0].tolist())
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    score = np.round(unit @ unit[0], vectors.DIGITS)
    taken = [min(range(900), key=lambda i: (-score[i], i))]
    while len(taken) < 20:
        gain = np.round(0.7 * score - 0.3 * (unit @ unit[taken].T).max(axis=1), vectors.DIGITS)
        taken.append(min((i for i in range(900) if i not in taken), key=lambda i: (-gain[i], -score[i], i)))
    calls, scan = [], vectors._head
    monkeypatch.setattr(vectors, "_head", lambda *a: calls.append(1) or scan(*a))
    for ahead, most in ((vectors.AHEAD, 2), (300, 3), (5, 20)):
        calls.clear()
        got = vectors.diverse(scored, 20, ahead=ahead).orderBy("pick").collect()
        assert [r["id"] for r in got] == taken and len(calls) <= most


def test_peaks(cloud):
    m, df = cloud
    got = {r["id"]: r for r in vectors.peaks(vectors.score(df, list(m[0])), pool=60).collect()}
    assert len(got) == 60 and len({got[i]["_cluster_id"] for i in range(20)}) == 1  # the copies are one cluster
    summits = [r["_cluster_id"] for r in got.values() if r["_is_attractor"] == 1]
    assert sorted(summits) == sorted({r["_cluster_id"] for r in got.values()}) == list(range(1, len(summits) + 1))
    one = vectors.peaks(vectors.score(df.filter("id = 5"), list(m[0]))).first()
    assert (one["_cluster_id"], one["_is_attractor"]) == (1, 1)


def test_embedding(spark, chunks):
    got = {r["id"]: np.array(r["e"]) for r in chunks.select("id", vectors.embed("content").alias("e")).collect()}
    for k, v in TEXTS.items():
        assert np.allclose(got[k], vectors.embed_text(v), atol=1e-6)
    assert np.allclose(np.linalg.norm(got["a"]), 1, atol=1e-5) and not got["d"].any()
    part = chunks.withColumn("embedding", F.when(F.col("id") == "a", F.array_repeat(F.lit(1.0).cast("float"), 64)))
    filled = {r["id"]: r["embedding"] for r in vectors.embed_new(part).collect()}
    assert filled["a"] == [1.0] * 64 and np.allclose(filled["b"], got["b"])


def brute_graph(ids, m, nearest=graph.NEAREST):
    """Neighbours, walk, labels and crossings by explicit loops; rows of zeros are unlinked."""
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    unit = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    sim, n = np.round(unit @ unit.T, graph.DIGITS), len(ids)
    edges = {}
    for i in range(n):
        best = sorted((-sim[i, j], ids[j], j) for j in range(n) if j != i and sim[i, j] > 0)[:nearest]
        edges[i] = [(j, -w) for w, _, j in best] or [(i, 1.0)]
    rank = np.full(n, 1 / n)
    for _ in range(graph.STEPS):
        after = np.full(n, (1 - graph.DAMPING) / n)
        for i, out in edges.items():
            for j, w in out:
                after[j] += graph.DAMPING * rank[i] * w / sum(w for _, w in out)
        rank = after
    label = list(ids)
    turn = [int(hashlib.md5(str(i).encode()).hexdigest()[0], 16) % 2 for i in ids]
    for number in range(1, graph.ROUNDS + 1):
        before = list(label)
        for i, out in edges.items():
            if turn[i] == number % 2:
                votes = Counter()
                for j, w in out:
                    votes[before[j]] += w
                label[i] = min(votes, key=lambda c: (-round(votes[c], graph.DIGITS), c))
    weight, across, reached = np.zeros(n), np.zeros(n), [set() for _ in ids]
    for i, out in edges.items():
        for j, w in out:
            for a, b in ((i, j), (j, i)):
                weight[a] += w
                if label[a] != label[b]:
                    across[a] += w
                    reached[a].add(label[b])
    return edges, rank, label, across / weight, [len(r) for r in reached]


def test_graph_equals_the_explicit_one(spark, cloud):
    m, df = cloud
    extra = [(1000, [0.0] * m.shape[1]), (1001, None), (1002, (-m[40]).tolist())]
    sources = df.filter("embedding is not null").select(F.col("id").alias("source_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sources = sources.union(spark.createDataFrame(extra, "source_id long, embedding array<double>"))
    rows = sorted((r["source_id"], r["embedding"] or [0.0] * m.shape[1]) for r in sources.collect())
    ids = [i for i, _ in rows]
    edges, rank, label, share, reached = brute_graph(ids, np.array([v for _, v in rows]))
    got = {r["source_id"]: r for r in graph.source_graph(sources).collect()}
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        r = got[i]
        assert np.allclose([r["centrality"], r["bridge_share"]], [rank[k], share[k]], atol=1e-8)
        assert (r["community_id"], r["reached"]) == (label[k], reached[k])
        assert r["is_bridge"] == (share[k] >= graph.BRIDGE_SHARE)
    for c in set(label):
        inside = [got[i] for i, x in zip(ids, label) if x == c]
        best = min(inside, key=lambda r: (-round(r["centrality"], 12), r["source_id"]))
        assert [r["source_id"] for r in inside if r["is_hub"]] == ([best["source_id"]] if len(inside) > 1 else [])
    for i in (1000, 1001):
        assert (got[i]["community_id"], got[i]["is_hub"], got[i]["is_bridge"]) == (i, 0, 0)
        assert math.isclose(got[i]["centrality"], 1 / len(ids))
    assert graph.source_graph(sources.where("false")).count() == 0
    alone = graph.source_graph(sources.where("source_id = 5")).first()
    assert (alone["community_id"], alone["centrality"], alone["is_hub"], alone["is_bridge"]) == (5, 1.0, 0, 0)


def test_neighbours_beyond_one_cell(spark):
    """Recall against brute force with many runs, a third of all sources alike, and ids of another type; communities are not few."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(160, 32))
    m = np.vstack([centres[rng.integers(0, 160, 4000)] + 0.35 * rng.normal(size=(4000, 32)), np.tile(centres[0], (2000, 1))])
    ids = [f"s{k:05d}" for k in range(len(m))]
    sources = spark.createDataFrame(list(zip(ids, m.tolist())), "source_id string, embedding array<double>").repartition(5)
    found = {}
    for r in graph.neighbour_edges(sources, cell=64).collect():
        found.setdefault(r["source_id"], []).append((r["neighbour"], r["weight"]))
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    hits = total = 0
    for k in range(0, len(m), 7):
        sim = np.round(unit @ unit[k], graph.DIGITS)
        sim[k] = -2
        least = np.sort(sim)[-graph.NEAREST]
        got = found[ids[k]]
        assert len(got) == len({j for j, _ in got}) == graph.NEAREST and ids[k] not in {j for j, _ in got}
        assert all(math.isclose(sim[int(j[1:])], w, abs_tol=2e-9) for j, w in got)
        hits += sum(w >= least - 2e-9 for _, w in got)
        total += graph.NEAREST
    assert hits / total >= 0.9
    communities = {r["community_id"] for r in graph.source_graph(sources, cell=64).collect()}
    assert 60 < len(communities) < 2000


def test_mean_vectors(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"s{i % 5}", [rng.random() for _ in range(4)]) for i in range(50)] + [("hot", None)]
    got = {r["source_id"]: r["embedding"] for r in graph.source_vectors(spark.createDataFrame(rows, "source_id string, embedding array<double>")).collect()}
    for key in {r[0] for r in rows}:
        assert np.allclose(got[key], np.mean([v for k, v in rows if k == key and v], axis=0))
