"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and columns with clashing names."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tracelake.llm import byte_bpe, decontam, fuzzy_lines, main_text, pii, quality, repeats, simhash, token_counts, token_files
from tracelake.llm.shared import work_folder

CLASHING = ("start", "n_tokens", "row", "place", "line", "id", "key", "fingerprint", "kept", "text_hash", "h", "node", "root", "gone", "n", "match", "bin", "block")
LONG = "word and more words, again and again. " * 9000
ROWS = [(1, "one two three four five six"), (1, "one two three four five six"), (1, "another text for the same id"), (None, "one two three four five six"),
        (None, None), (2, None), (3, ""), (4, " \n\t\n "), (5, LONG), (6, LONG), (7, "x" * 70_000), (8, "é😀\u0000字" * 40), (9, "a\nb\n\na")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(*r, "en", "src", 5) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.select("*", *[F.lit("own").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "one two three four five six", "x"), (1, "one two three four five six", "x"), (None, "another text for the same id", "x"), (3, None, "x"), (4, "", "x"), (5, "b", "x")]
    return spark.createDataFrame(rows, "item_id long, text string, covered string")


def per_document(spark):
    folder = lambda: work_folder(spark, "edge")
    files = lambda d, f: token_files.read_back(token_files.write_tokens(d, f), f)
    return {
        "op1": lambda d: files(d, folder()), "op2": lambda d: pii.span_table(d, folder()), "op3": token_counts.token_counts, "op4": byte_bpe.encode,
        "op5": lambda d: quality.judged(d, folder()), "op7": lambda d: simhash.simhash_groups(d, folder()), "op8": lambda d: repeats.without_repeats(d, folder())}


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op7", "op8"])
def test_a_row_for_every_document(spark, docs, name):
    rows = per_document(spark)[name](docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in ROWS)


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op7", "op8"])
def test_no_rows_from_an_empty_table(spark, docs, name):
    assert per_document(spark)[name](docs.where("false")).collect() == []


def test_defined_results(spark, docs):
    run = per_document(spark)
    none = hashlib.sha256(b"").hexdigest()
    for r in run["op4"](docs).where("doc_id IN (2, 3)").collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) == (0, none, none, [])
    assert {r.n_tokens for r in run["op1"](docs).where("doc_id IN (2, 3)").collect()} == {1}
    assert [r.n_tokens for r in run["op3"](docs).where("doc_id IN (2, 3)").collect()] == [0, 0]
    assert not any(r.kept for r in run["op5"](docs).where("doc_id IN (2, 3, 4)").collect())
    prints = {r.doc_id: (r.fingerprint, r.component_id) for r in run["op7"](docs).where("doc_id IN (2, 3, 4, 5, 6)").collect()}
    assert prints[2] == prints[3] == prints[4] == ("0" * 16, 2) and prints[5] == prints[6] and prints[6][1] == 5
    gone = {r.doc_id: r.n_removed for r in run["op8"](docs).where("doc_id IN (2, 5, 6)").collect()}
    assert gone == {2: 0, 5: 0, 6: len(LONG)}


def test_matches(docs, benchmark):
    found = [(r.doc_id, r.item_id, r.covered, r.item_words) for r in decontam.matches(docs, benchmark).collect()]
    assert sorted(found, key=str) == sorted([(i, 1, 6, 6) for i in (1, 1, None) for _ in range(2)] + [(1, None, 6, 6), (9, 5, 1, 1)], key=str)
    assert decontam.matches(docs.where("false"), benchmark).count() == decontam.matches(docs, benchmark.where("false")).count() == 0
    assert decontam.matches(docs, benchmark, block_bytes=20).count() == len(found)


def test_lines(spark, docs):
    rows = {(r.doc_id, r.line_no): r.kept for r in fuzzy_lines.line_groups(docs.where("doc_id IN (4, 9)"), work_folder(spark, "edge")).collect()}
    assert rows == {(9, 0): True, (9, 1): True, (9, 3): False}
    assert fuzzy_lines.line_groups(docs.where("false"), work_folder(spark, "edge")).count() == 0


def test_pages(spark):
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "<p>", "x"), (2, "u", "<article><p>a &amp; b<p>c  d</article>", "x"), (3, "u", "<script>1</", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = main_text.main_text(pages).collect()
    assert sorted((r.text, r.n_chars) for r in out) == [("", 0)] * 4 + [("a & b\nc d", 9)]
    assert main_text.main_text(pages.where("false")).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, sf, docs, name, stage):
    out = stage(spark, docs, sf)
    if name != "byte_bpe":
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    rows = out.collect()
    n = {"quality": None, "fuzzy_lines": len(ROWS), "simhash": 7, "decontam": len(ROWS), "byte_bpe": len(ROWS)}[name]
    assert n is None or len(rows) == n
    assert stage(spark, docs.where("false"), sf).count() == 0
