"""The pipeline: each stage against its operator's own report."""

import corpus_pipeline
from tracelake.llm import decontam, fuzzy_lines, quality, simhash
from tracelake.llm.shared import work_folder, written


def test_stages(spark, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "fuzzy_lines", "simhash", "decontam", "byte_bpe"]
    stages = dict(corpus_pipeline.STAGES)
    folder = work_folder(spark, "p")
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    good = written(stages["quality"](spark, docs, sf), folder, "a")
    want = {r.doc_id for r in quality.judged(docs, work_folder(spark, "q")).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == want and good.count() == len(want) and good.columns == docs.columns

    lines = written(stages["fuzzy_lines"](spark, good, sf), folder, "b")
    gone = {(r.doc_id, r.line_no) for r in fuzzy_lines.line_groups(good, work_folder(spark, "l")).where("not kept").collect()}
    texts = {r.doc_id: r.text for r in good.collect()}
    got = {r.doc_id: r for r in lines.collect()}
    assert set(got) == set(texts) and gone
    for i, text in texts.items():
        assert got[i].text == "\n".join(t for n, t in enumerate(text.split("\n")) if (i, n) not in gone) and got[i].n_chars == len(got[i].text)

    one = written(stages["simhash"](spark, lines, sf), folder, "c")
    firsts = {r.component_id for r in simhash.simhash_groups(lines, work_folder(spark, "s")).collect()}
    assert sorted(r.doc_id for r in one.collect()) == sorted(firsts)

    clean = written(stages["decontam"](spark, one, sf), folder, "d")
    held = {r.doc_id for r in decontam.matches(one, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == firsts - held

    last = {r.doc_id: r for r in stages["byte_bpe"](spark, clean, sf).collect()}
    run = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert last == run and set(last) == firsts - held
