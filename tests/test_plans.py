"""What the plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tracelake.operators import sinks
from tracelake.plans import presets, search, topology, vectors


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cross_join_and_no_row_udf(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


def test_group_limit_before_the_shuffle(spark, sf):
    text = plan(entry.queries()["topology_hubs"](spark, sf))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_top_k_without_a_full_sort(spark, sf):
    for name in ("topology_bridges", "recent_articles", "vector_top"):
        text = plan(entry.queries()[name](spark, sf))
        assert "TakeOrderedAndProject" in text and "Exchange rangepartitioning" not in text


def test_dedupe_combines_before_the_shuffle(spark, sf):
    text = plan(entry.queries()["ingest_keep_first"](spark, sf))
    assert "partial_min_by" in text


def test_filters_and_columns_reach_a_stored_table(spark, tmp_path):
    schema = "id string, type string, created_at timestamp_ntz, title string, author string, score int, content string, timestamp long, other string"
    rows = spark.range(100).selectExpr(
        "cast(id as string) id", "'a' type", "timestamp_ntz'2024-01-01' created_at", "'t' title", "'u' author", "1 score", "'c' content",
        "id timestamp", "'x' other", "'tu' thread_url", "'su' story_url")
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.schema(schema + ", thread_url string, story_url string").parquet(str(tmp_path / "t"))
    text = plan(presets.story_recent(table, "2024-01-05"))
    assert "GreaterThanOrEqual(created_at" in text
    assert "other" not in text[text.index("ReadSchema"):]


def test_reports_choose_rows_before_texts_and_joins(spark, sf, monkeypatch):
    """The first scan has no text and no join, and skips by time; the second is filtered by the chosen keys."""
    from tracelake.harness import feeds as H
    from tracelake.plans import late

    chosen, top_rows = [], late.top_rows
    monkeypatch.setattr(late, "top_rows", lambda *a: chosen.append(top_rows(*a)) or chosen[-1])
    cell = H.story_cell(spark, sf)
    second = plan(late.story_recent(cell, H.AS_OF, days=60))
    first = plan(chosen[0].select("id", "source_id"))
    assert "Join" not in first and "content" not in first and "GreaterThanOrEqual(timestamp" in first and "TakeOrderedAndProject" in first
    assert "In(id" in second or "EqualTo(id" in second
    counts = plan(late.tag_counts(H.article_cell(spark, sf)))
    assert counts.count("FileScan") == 1 and "Join" not in counts and counts.count("Exchange") == 1


def test_index_reads_only_the_query_words(spark, tmp_path):
    chunks = spark.createDataFrame([("a", "one two"), ("b", "three")], "id string, content string")
    search.write_index(*search.build_index(chunks), str(tmp_path))
    text = plan(search.keyword(search.read_index(spark, str(tmp_path)), "one two"))
    assert "In(token, [one,two])" in text


def test_candidates_limit_below_the_top_k(spark):
    v = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(9)], "id long, embedding array<float>")
    text = optimized(vectors.top(vectors.score(v, [1.0, 0.0], candidates=v.filter("id > 3")), 2))
    assert text.index("Limit") < text.index("LeftSemi")


def test_seed_is_a_semi_join(spark, sf):
    from tracelake.harness import events as E

    s = E.sessions(spark, sf)
    assert "LeftSemi" in optimized(topology.communities(s, topology.seed(s, E.AS_OF)))


def test_running_twice_gives_the_same_rows(spark, sf):
    for name in ("random_sample", "source_graph", "vector_peaks"):
        a, b = (sorted(map(str, entry.queries()[name](spark, sf).collect())) for _ in range(2))
        assert a == b


def test_spark_keeps_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.unix_timestamp(F.lit("1970-01-01 00:00:00"))).first()[0] == 0
