"""Operators 11 to 13 against brute-force versions, the libraries and round trips."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracelake.llm import fill_middle, packing, registry, spelling
from tracelake.llm.shared import work_folder

LONG = "word and more words, again and again. " * 9000
TEXTS = ["one two three", "one two three", None, "", " \n\t\n ", LONG, "x" * 70_000, "é😀\u0000字" * 40, "a<P>b", "a<S", "S>b<", "12345 6 7", "<|endoftext|> a <|startoftext|>",
         "ab'sÀΣ", "line\n\nnext\r\nlast", "l'été, Ünder 3x²½́ " * 50]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 4 else None, t, 7, "own", "own") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], 7, "own", "own")]
    return spark.createDataFrame(rows, "doc_id long, text string, n long, ids string, output string").repartition(3)


@pytest.fixture(scope="module")
def rows(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_fim(doc_id, text):
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}" if form == "spm" else f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    return doc_id, n, form, a, b - a, sha(out), sha(text)


def test_fill_middle(spark, sf, rows):
    got = [tuple(r) for r in registry.queries()["op11_fill_middle"](spark, sf).collect()]
    assert sorted(got) == sorted(brute_fim(*r) for r in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
        assert sorted(db.execute(fill_middle.OP11_SQL).fetchall()) == sorted(got)


@pytest.mark.parametrize("limit", [1 << 21, 5, 1000])
def test_fill_middle_edges(docs, limit):
    made = fill_middle.fill_middle(docs, limit=limit)
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256), F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256))
    want = [brute_fim(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert fill_middle.fill_middle(docs.where("false")).count() == 0


@pytest.mark.parametrize("units, pattern", [("words", r"\s*\S+\s*|\s+"), ("lines", r"[^\n]*\n|[^\n]+")])
def test_fill_middle_units(docs, units, pattern):
    ascii_docs = docs.where("text IS NOT NULL AND NOT text RLIKE '[^\\\\x00-\\\\x7F]'")
    for r in fill_middle.fill_middle(ascii_docs, units, limit=50).join(ascii_docs.select("doc_id", "text"), "doc_id").collect():
        cut = re.findall(pattern, r.text)
        assert r.n == len(cut)
        if r.form != "plain":
            ends = {0}
            for c in cut:
                ends.add(max(ends) + len(c))
            assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= ends


def apart(v, w):
    """Whether one inserted, deleted or replaced letter turns v into w."""
    if v == w or abs(len(v) - len(w)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(v, w)) if x != y), min(len(v), len(w)))
    return v[i + 1:] == w[i + 1:] if len(v) == len(w) else (v[i:] == w[i + 1:] if len(v) < len(w) else v[i + 1:] == w[i:])


def brute_spelling(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [] for w in words}
    holes = defaultdict(set)  # words that are equal without one letter, or with one more
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:]].add(w)
    for w in words:
        found = set().union(*(holes[w[:i] + w[i + 1:]] for i in range(len(w))), holes.get(w, ()), (w[:i] + w[i + 1:] for i in range(len(w))))
        near[w] = [v for v in found if v in words and apart(v, w)]
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def test_spelling(spark, sf, rows):
    got = sorted(tuple(r) for r in registry.queries()["op12_spelling"](spark, sf).collect())
    assert got == brute_spelling(rows)
    assert any(r[1] for r in got)


def crowded(seed, n=4000):
    """Words over few letters, so that many are near; some long."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abÀé") for _ in range(rng.randint(4, 8))) for _ in range(n)}
    words |= {"x" * 60 + "".join(rng.choice("ab") for _ in range(rng.randint(3, 6))) + "y" * rng.randint(0, 2) for _ in range(100)}
    words |= {"z" * k for k in range(4, 40)}
    return [(k % 7, " ".join([w] * rng.randint(1, 9))) for k, w in enumerate(sorted(words))]


@pytest.mark.parametrize("group", [spelling.GROUP, 30, 3])
def test_spelling_crowded(spark, group):
    """Groups above the limit are cut again; the pairs stay the same."""
    rows = crowded(1) + [(None, "ABCDE abcde abcdÉ abcdé abcde"), (3, None), (3, "")]
    docs = spark.createDataFrame([(*r, "own", 7) for r in rows], "doc_id long, text string, word string, n long").repartition(3)
    got = spelling.spelling_groups(docs, work_folder(spark, "edge"), group=group).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute_spelling(rows)


def test_spelling_edges(spark, docs, monkeypatch):
    assert spelling.spelling_groups(docs.where("false"), work_folder(spark, "edge")).count() == 0
    got = spelling.spelling_groups(docs, work_folder(spark, "edge")).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute_spelling([(r.doc_id, r.text) for r in docs.collect()])
    assert "".join(spelling.chunks(LONG, 7)) == LONG


def check_packing(pieces, rows, ids_of, size=2048):
    """Every id in one piece, sequences gapless, at most `size`, and not padded."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.doc_tokens, p.start].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    want = Counter()
    for doc_id, text in rows:
        want[doc_id, len(ids_of(text))] += 1
    got = Counter()
    for (doc_id, n, start), same in by_doc.items():
        if start == 0:
            got[doc_id, n] += len(same)
    assert got == want
    assert sum(p.length for p in pieces) == sum(n * c for (_, n), c in want.items())
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end == size or end & (end - 1) == 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@pytest.fixture(scope="module")
def ids_of():
    library = Tokenizer.from_file(packing.VOCABULARY)
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_packing(spark, sf, rows, ids_of):
    pieces = registry.queries()["op13_packing"](spark, sf).collect()
    check_packing(pieces, rows, ids_of)
    texts = dict(rows)
    for p in pieces:
        part = ids_of(texts[p.doc_id])[p.start:p.start + p.length]
        assert len(part) == p.length and zlib.crc32(struct.pack(f"<{p.length}I", *part)) == p.ids_crc32


@pytest.mark.parametrize("most_open", [0, 2, packing.MOST_OPEN])
def test_packing_edges(spark, docs, ids_of, most_open):
    packed = packing.pack(docs, work_folder(spark, "edge"), size=64, most_open=most_open).collect()
    check_packing(packed, [(r.doc_id, r.text) for r in docs.collect()], ids_of, 64)
    long = sorted((p.start, p.ids) for p in packed if p.doc_id == 5)
    assert np.frombuffer(b"".join(ids for _, ids in long), "<u4").tolist() == ids_of(LONG)
    assert packing.pack(docs.where("false"), work_folder(spark, "edge")).count() == 0


def test_level_is_the_best_of_all():
    """The chosen level gives the least sum of squares over all levels and a new window."""
    rng = random.Random(2)
    packer = packing.Packer(32)
    for _ in range(600):
        n = rng.randint(1, 31)
        sums = {}
        for h in [0, *range(1, 33 - n)]:
            if h and not packer.counts[h]:
                continue
            after = packer.counts.copy()
            after[h] -= h > 0
            if h + n < 32:
                after[h + n] += 1
            sums[h] = int((after ** 2).sum())
        level = packer.level_for(n)
        assert sums[level] == min(sums.values())
        packer.place(("d", n), 0, b"\0" * 4 * n)
    assert packer.open == packer.counts.sum()


def test_few_documents_are_cut():
    rng = random.Random(3)
    packer, closed, n = packing.Packer(), [], 4000
    for doc in range(n):
        closed += packer.place((doc, 0), 0, bytes(4 * min(2047, int(rng.lognormvariate(5.5, 1)) + 1)))
    whole = len(closed)
    closed += packer.close_rest()
    assert sum(start > 0 for w in closed for _, start, _ in w) < 0.05 * n
    assert all(sum(len(ids) for _, _, ids in w) == 4 * 2048 for w in closed[:whole])


def test_cached_words_equal_the_library(ids_of, monkeypatch):
    rng = random.Random(4)
    parts = [" ", "\n", "\t", "  ", "'s", "'", "é", "é", "́", "Σ", "1", "42", "<|endoftext|>", "<|", "word", "Ab", "字", "😀", "!!", " ", " ", "\x1c", "²"]
    words = packing.word_ids(packing.VOCABULARY)
    for size in (1, 4, packing.PART):
        monkeypatch.setattr(packing, "PART", size)
        for _ in range(700):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
            assert np.frombuffer(b"".join(words.encode(text)), "<u4").tolist() == ids_of(text)[:-1], repr(text)
    monkeypatch.setattr(packing, "CACHE_BYTES", 1000)
    assert np.frombuffer(b"".join(words.encode(LONG)), "<u4").tolist() == ids_of(LONG)[:-1]
