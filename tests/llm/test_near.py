"""Operators 6, 7 and 10 and the components against brute force."""

import itertools
import random

import numpy as np
import xxhash

from tracelake.llm import components, decontam, fuzzy_lines, registry, simhash
from tracelake.llm.shared import work_folder


def merged(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(50)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    want = merged({x for p in pairs for x in p}, pairs)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long"), work_folder(spark, "c")).collect()}
    assert {n: got.get(n, n) for n in want} == want
    assert components.components(spark.createDataFrame([], "a long, b long"), work_folder(spark, "c")).count() == 0


def test_masks_cover():
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(4)]
    rng = random.Random(2)
    assert all(any(not d & m for m in masks) for d in (sum(1 << i for i in rng.sample(range(64), rng.randint(1, 4))) for _ in range(3000)))


def test_simhash(spark, sf):
    def fingerprint(text):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {r.doc_id: fingerprint(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = merged(prints, [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4])
    for r in registry.queries()["op7_simhash"](spark, sf).collect():
        assert (int(r.fingerprint, 16), r.component_id) == (prints[r.doc_id], want[r.doc_id])


def test_masked_fingerprints_are_not_broadcast(spark, tmp_path):
    """The estimate leaves out the 31 rows of a fingerprint, so a table somewhat below the threshold would fill the driver."""
    spark.range(1000).withColumnRenamed("id", "fingerprint").write.parquet(str(tmp_path / "t"))
    plan = simhash.links(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_large_bucket_in_blocks(spark):
    rng = np.random.default_rng(0)
    prints = set()
    for base in rng.integers(0, 2**63, 6, dtype=np.int64).tolist():
        x = base
        for _ in range(80):
            x ^= 1 << int(rng.integers(0, 62))
            prints.add(x)
            x = base if rng.random() < 0.3 else x
    want = merged(prints, [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 4])
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    for block in (2048, 16):
        assert merged(prints, [tuple(r) for r in simhash.links(df, block=block).collect()]) == want


def test_tiling_finds_reordered_passages():
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "nothing of this stands in any of the texts here")]
    items = decontam.Items(rows, 5, 0.5)
    whole = "Zeta, eta THETA iota kappa lambda mu! And then: alpha beta gamma delta epsilon."
    part = "alpha beta gamma delta epsilon zeta and no more"
    little = "alpha beta gamma delta epsilon and no more"
    out = items.matches([whole, part, little, "", "lambda mu alpha"])
    assert out == [[{"item_id": 1, "covered": 12, "item_words": 12, "tiles": 2}], [{"item_id": 1, "covered": 6, "item_words": 12, "tiles": 1}], [], [], []]


def test_tiling_is_greedy_and_disjoint():
    rng = np.random.default_rng(3)
    for _ in range(200):
        item, text = rng.integers(0, 4, 25), rng.integers(-1, 4, 40)
        tiles = decontam.tiling(item, text, 3)
        assert [t[2] for t in tiles] == sorted((t[2] for t in tiles), reverse=True)
        used_a, used_b = [i + k for i, _, n in tiles for k in range(n)], [j + k for _, j, n in tiles for k in range(n)]
        assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
        assert all(item[i + k] == text[j + k] for i, j, n in tiles for k in range(n))
        left_a, left_b = set(range(25)) - set(used_a), set(range(40)) - set(used_b)
        assert not any(all(i + k in left_a and j + k in left_b and item[i + k] == text[j + k] for k in range(3)) for i in range(23) for j in range(38))


def test_benchmark_passages(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = {r.doc_id for r in registry.queries()["op6_decontam"](spark, sf).collect()}
    assert found == {i for i, t in docs.items() if any(x in t for x in items)}


def test_fuzzy_lines(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, i, line.strip(" \t\n\x0b\x0c\r").lower()) for r in docs.collect() for i, line in enumerate(r.text.split("\n")))
    rows = [r for r in rows if r[2]]
    sets = {t: {t[i:i + 5] for i in range(len(t) - 4)} or {t} for *_, t in rows}
    close = []
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
            close.append((a, b))
    root, first = merged(sets, close), {}
    for doc_id, i, line in rows:
        first.setdefault(root[line], (doc_id, i))
    want = {(d, i): first[root[line]] for d, i, line in rows}
    got = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in registry.queries()["op10_fuzzy_lines"](spark, sf).collect()}
    assert len(close) > 20 and set(got) == set(want)
    assert sum(got[k] != want[k] for k in want) <= 1  # banding may miss a pair


def test_fuzzy_lines_in_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_lines, "SMALL_BUCKET", 3)
    rng = random.Random(5)
    base = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
    lines = [base[:p] + c + base[p + 1:] for p, c in ((rng.randrange(len(base)), rng.choice("xyz")) for _ in range(60))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    assert {r.first_doc_id for r in fuzzy_lines.line_groups(docs, work_folder(spark, "f")).collect()} == {0}


def test_lines_of_unlike_length_and_spacing_share_bands(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    pairs = []
    for _ in range(40):
        head = " ".join(word(6) for _ in range(8)) + " " + word(4)
        pairs.append((f"{head} page 9"[:64], f"{head} page 9"[:64] + " 104"))  # 64 and 68 characters
        parts = [word(24) for _ in range(4)]
        pairs.append((" ".join(parts) + " " + word(30), None))
    pairs = [(a, b or a[:-12] + " " + a[-11:]) for a, b in pairs]  # the second sort: one space more in 130 characters
    sets = [tuple({t[i:i + 5] for i in range(len(t) - 4)} for t in p) for p in pairs]
    assert all(len(x & y) >= 0.8 * len(x | y) for x, y in sets)
    docs = spark.createDataFrame([(i, "\n".join(p)) for i, p in enumerate(pairs)], "doc_id long, text string")
    gone = [r.doc_id for r in fuzzy_lines.line_groups(docs, work_folder(spark, "f")).collect() if not r.kept]
    assert len(gone) >= 0.97 * len(pairs)


def near_copies(rng, copies, changed):
    """Lines of 90 words from one line, each with some words changed for others of a small vocabulary."""
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    base = [rng.choice(words) for _ in range(90)]
    return [" ".join(rng.choice(words) if i in gone else w for i, w in enumerate(base)) for gone in (set(rng.sample(range(90), changed)) for _ in range(copies))]


def test_lines_nearly_alike_are_no_candidates(spark, monkeypatch):
    lines = near_copies(random.Random(11), 150, 11)
    sets = [{t[i:i + 5] for i in range(len(t) - 4)} for t in lines]
    close = [(a, b) for a, b in itertools.combinations(range(len(lines)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    named, write = {}, fuzzy_lines.written
    monkeypatch.setattr(fuzzy_lines, "written", lambda df, folder, name: named.setdefault(name, write(df, folder, name)))
    monkeypatch.setattr(fuzzy_lines, "drop_folder", lambda *a: None)
    monkeypatch.setattr(fuzzy_lines, "PER_TASK", 16)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: r.first_doc_id for r in fuzzy_lines.line_groups(docs, work_folder(spark, "f")).collect()}
    assert sum(got[i] != r for i, r in merged(range(len(lines)), close).items()) <= 2  # banding may miss a pair
    made = [named[n].count() for n in ("pairs-0", "pairs-1", "pairs-2")]
    assert len(close) < 600 and made[0] < 15 * len(lines) and made[1] + made[2] < 1000  # of 11,175 pairs


def test_maps_lose_no_link(spark):
    rng = random.Random(12)
    lines = [t for n in (2, 4, 6, 8) for t in near_copies(rng, 12, n)] + ["ab", "abcd", "abcde", "abcdef", "x" * 40, "x" * 41, "äöü ß" * 30, "äöü ß" * 29 + "äöü"]
    sets = [{t[i:i + 5] for i in range(len(t) - 4)} or {t} for t in lines]
    texts = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    sized = fuzzy_lines.maps(texts)
    assert {r.id: r.size for r in sized.collect()} == {i: len(s) for i, s in enumerate(sets)}
    mixed = sized.selectExpr("*", "0L AS key", "0L AS sketch", "id AS root", f"{len(lines)}L AS n")
    got = {tuple(r) for r in fuzzy_lines._pairs(mixed).collect()}
    close = {(a, b) for a, b in itertools.combinations(range(len(lines)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(close) > 50 and close <= got


def test_line_is_coded_once(spark):
    plan = spark.range(1).selectExpr("repeat('abc', 9) AS line").select(fuzzy_lines.shingles(fuzzy_lines._wide(fuzzy_lines.F.col("line"))).alias("h"))
    assert plan._jdf.queryExecution().analyzed().toString().lower().count("encode(") == 1  # in a lambda it would be made for every shingle
