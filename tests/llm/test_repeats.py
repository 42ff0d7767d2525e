"""Operator 8 against brute force."""

import hashlib
import random

import numpy as np

from tracelake.llm import registry, repeats
from tracelake.llm.shared import work_folder


def brute(docs):
    first = {}
    for doc_id, text in docs:
        data, own = (text or "").encode(), doc_id if doc_id is not None else 1 << 63
        for p in range(len(data) - 49):
            s = data[p:p + 50]
            first[s] = min(first.get(s, own), own)
    out = []
    for doc_id, text in docs:
        data, own = (text or "").encode(), doc_id if doc_id is not None else 1 << 63
        gone = [False] * len(data)
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < own:
                gone[p:p + 50] = [True] * 50
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in registry.queries()["op8_repeats"](spark, sf).collect()), key=str) == brute(docs)


def test_small_bins(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BIN_BYTES", 4000)
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdefg hij") for _ in range(rng.randint(30, 200))) for _ in range(12)]
    docs = [(rng.choice([None, *range(40)]), "".join(rng.choice(base)[rng.randint(0, 20):rng.randint(40, 200)] for _ in range(rng.randint(0, 6)))) for _ in range(120)]
    docs += [(50, None), (51, ""), (52, "x" * 49), (53, "x" * 500), (54, "x" * 50), (55, "ab" * 300), (56, "é" * 100), (57, "\x00" * 120), (58, "\x00" * 60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeats.without_repeats(df, work_folder(spark, "r")).collect()), key=str) == brute(docs)


def test_chunks_do_not_matter(monkeypatch):
    rng = random.Random(8)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 900))).encode() for _ in range(9)]
    ends = np.cumsum([len(p) for p in parts])
    whole = repeats.Stretches(b"".join(parts), ends)
    monkeypatch.setattr(repeats, "CHUNK", 100)
    cut = repeats.Stretches(b"".join(parts), ends)
    for name in ("anchor", "low", "high", "hash", "bytes", "doc"):
        assert np.array_equal(getattr(whole, name), getattr(cut, name))


def test_column_insertion():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 2, (80, repeats.WIDTH)).astype(np.uint8)
    for i in range(40, 80):  # pieces of others
        a, b = sorted(rng.integers(0, repeats.WIDTH + 1, 2))
        text[i, a:b] = text[i - 40, a:b]
    docs, low = rng.integers(0, 60, 80), rng.integers(0, 20, 80)
    high = low + rng.integers(0, 15, 80)
    got = repeats.column_insertion(iter(text.T.copy()), docs, low, high)
    for i in range(80):
        want = 0
        for s in range(low[i], high[i] + 1):
            if any(docs[j] < docs[i] and low[j] <= s <= high[j] and (text[j, s:s + 50] == text[i, s:s + 50]).all() for j in range(80)):
                want |= 1 << s
        assert got[i] == want
