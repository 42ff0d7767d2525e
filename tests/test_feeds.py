"""Landed feed files: normalising, trees, chunk numbering, second batches."""

import json

from pyspark.sql import functions as F

from tracelake.operators import sinks
from tracelake.plans import late, presets, views
from tracelake.sources import articles, feeds, stories
from tracelake.streaming import incremental


def land(folder, name, records):
    path = folder / name
    path.write_text("\n".join(json.dumps(r) for r in records))
    return str(path)


ARTICLES = [
    {"id": 1, "title": "One", "description": "d1", "url": "u1", "published_at": "2024-01-02T00:00:00Z", "positive_reactions_count": 5,
     "comments_count": 3, "reading_time_minutes": 2, "tag_list": ["ai", "SQLite"], "user": {"username": "ann"},
     "feed_kind": "tag", "feed": "ai", "feed_pos": 0},
    {"id": 1, "title": "One again", "published_at": "2024-01-02T00:00:00Z", "tag_list": "x", "user": {"username": "ann"},
     "feed_kind": "author", "feed": "ann", "feed_pos": 0},
    {"id": 2, "title": "Two", "published_at": "2023-01-01T00:00:00+00:00", "tag_list": "ai, , db ", "feed_kind": "tag", "feed": "ai", "feed_pos": 1},
    {"id": 3, "title": None, "published_at": "bad", "tag_list": [], "feed_kind": "tag", "feed": "ai", "feed_pos": 2},
    {"id": None, "title": "no id", "feed_kind": "tag", "feed": "ai", "feed_pos": 3},
]


def test_articles(spark, tmp_path):
    raw = articles.read_articles(spark, land(tmp_path, "a.jsonl", ARTICLES))
    details = articles.read_details(spark, land(tmp_path, "d.jsonl", [{"id": 1, "body_markdown": "full"}, {"id": 2, "body_markdown": ""}, {"body_markdown": "x"}]))
    heads = articles.normalise(articles.with_details(raw, details))
    got = {(r["id"], r["feed_kind"]): r for r in heads.collect()}
    assert set(got) == {("1", "tag"), ("1", "author"), ("2", "tag"), ("3", "tag")}
    one = got[("1", "tag")]
    assert (one["content"], one["tags"], one["created_utc"], one["author"]) == ("One\n\nfull", '["ai", "SQLite"]', 1704153600, "ann")
    assert got[("2", "tag")]["tags"] == '["ai", "db"]' and got[("2", "tag")]["content"] == "Two"
    assert got[("3", "tag")]["tags"] == "[]" and got[("3", "tag")]["created_utc"] == 0 and got[("3", "tag")]["content"] == ""
    feeds_in_order = [("tag", "ai"), ("author", "ann")]
    recent = feeds.recent_per_feed(heads, 1700000000, 1)
    unique = feeds.dedupe_across_feeds(feeds.with_feed_rank(recent, feeds_in_order))
    assert [(r["id"], r["title"]) for r in unique.collect()] == [("1", "One")]
    limited = feeds.dedupe_with_limit(feeds.with_feed_rank(heads, feeds_in_order), 2)
    assert sorted(r["id"] for r in limited.collect()) == ["1", "2"]
    dates = {r["source_id"]: r["file_date"] for r in feeds.sources(unique, articles.PREFIX).collect()}
    assert dates == {"devto_1": "240102"}


def tree(depth, width, name="c"):
    return [
        {"id_code": f"{name}{i}", "body_html": f"<p>{name}{i} &amp; more</p>", "created_at": f"2024-01-0{9 - depth}T00:0{i}:00Z",
         "user": {"username": "u"}, "children": tree(depth - 1, width, f"{name}{i}") if depth else []}
        for i in range(width)
    ]


def walk(nodes, parent=""):
    for n in nodes:
        yield n["id_code"], parent
        yield from walk(n["children"], n["id_code"])


def test_comment_tree_is_depth_first(spark, tmp_path):
    nodes = tree(4, 2)
    nodes[1]["children"][0]["body_html"] = "[deleted]"
    nodes[0]["children"][1].pop("children")
    want = list(walk(json.loads(json.dumps(nodes), object_hook=lambda d: {"children": [], **d})))
    path = land(tmp_path, "c.jsonl", [{"article_id": 7, "tree": nodes}, {"article_id": 8, "tree": []}])
    flat = articles.flatten_comments(articles.read_comment_trees(spark, path))
    got = [(r["comment_id"], r["parent_id"]) for r in flat.orderBy("dfs_pos").collect()]
    assert got == want
    by_time = sorted(flat.collect(), key=lambda r: (r["created_utc"], r["dfs_pos"]))
    assert [r["position"] for r in by_time] == list(range(1, len(want) + 1))
    assert articles.flatten_comments(articles.read_comment_trees(spark, path), limit=3).count() == 3
    assert flat.filter("comment_id = 'c0'").first()["content"] == "c0 & more"


def test_deep_tree(spark):
    node = {"id_code": "leaf", "children": []}
    for i in range(300):
        node = {"id_code": f"n{i}", "children": [node]}
    df = spark.createDataFrame([(1, json.dumps([node]))], "article_id long, tree string")
    assert articles.flatten_comments(df).count() == 301


STORIES = [
    {"short_id": "s1", "title": "T", "description_plain": "", "description": "D", "url": "x", "created_at": "2024-01-01T00:00:00.000-06:00",
     "score": 3, "comment_count": 2, "tags": ["rust"], "submitter_user": {"username": "ann"}},
    {"short_id": "s2", "title": "T2", "comments_url": "cu", "created_at": "2024-01-02T00:00:00Z", "tags": "rust", "submitter_user": "bob"},
]
COMMENTS = [
    {"story_id": "s1", "pos": 0, "short_id": "c0", "comment_plain": "first", "depth": 0, "created_at": "2024-01-03T00:00:00Z", "commenting_user": "bob"},
    {"story_id": "s1", "pos": 1, "short_id": "c1", "comment_plain": "", "comment": "", "depth": 1, "parent_comment": "c0", "created_at": "2024-01-02T00:00:00Z"},
    {"story_id": "s1", "pos": 2, "short_id": "c2", "comment": "[removed]", "created_at": "2024-01-02T00:00:00Z"},
    {"story_id": "s1", "pos": 3, "short_id": "c3", "comment": "late", "score": 9, "created_at": "2024-01-02T00:00:00Z", "commenting_user": {"username": "cy"}},
]


def story_rows(spark, folder, stories_, comments_):
    heads = stories.normalise(stories.read_stories(spark, land(folder, "s.jsonl", stories_)))
    comments = stories.normalise_comments(stories.read_comments(spark, land(folder, "c.jsonl", comments_)))
    return heads, feeds.chunk_rows(heads, comments, stories.PREFIX, stories.KIND, "story")


def test_stories_and_gaps(spark, tmp_path):
    heads, rows = story_rows(spark, tmp_path, STORIES, COMMENTS)
    h = {r["id"]: r for r in heads.collect()}
    assert h["s1"]["content"] == "T\n\nD" and h["s1"]["url"] == "https://lobste.rs/s/s1" and h["s1"]["author"] == "ann"
    assert h["s2"]["tags"] == "[]" and h["s2"]["author"] == "bob" and h["s2"]["url"] == "cu" and h["s1"]["created_utc"] == 1704088800
    assert sorted(r["id"] for r in rows.collect()) == ["lob_s1:0", "lob_s1:1", "lob_s1:4", "lob_s2:0"]
    assert feeds.estimate(heads, stories.normalise_comments(stories.read_comments(spark, str(tmp_path / "c.jsonl")))).first()["chunks"] == 6
    listed = spark.createDataFrame([("s1", json.dumps(COMMENTS))], "short_id string, comments string")
    assert [r["comment_id"] for r in stories.normalise_comments(stories.listed_comments(listed)).orderBy("dfs_pos").collect()] == ["c0", "c1", "c2", "c3"]


def test_second_batch_keeps_first(spark, tmp_path):
    (tmp_path / "one").mkdir(), (tmp_path / "two").mkdir()
    _, first = story_rows(spark, tmp_path / "one", STORIES, COMMENTS)
    changed = [{**STORIES[0], "score": 99, "title": "Changed"}, STORIES[1], {"short_id": "s3", "title": "New", "created_at": "2020-01-01T00:00:00Z"}]
    earlier = [{**COMMENTS[0], "pos": 0, "short_id": "cx", "comment_plain": "came in before"}] + [{**c, "pos": c["pos"] + 1} for c in COMMENTS]
    _, second = story_rows(spark, tmp_path / "two", changed, earlier)
    base = str(tmp_path / "table")
    schema = "id string, content string, timestamp long"
    sinks.write_batch(first.select("id", "content", "timestamp"), base, 0)
    for number in (1, 2):  # the same batch twice adds nothing the second time
        stored = sinks.read_batches(spark, base, schema, before=number)
        sinks.write_batch(sinks.fresh_rows(stored, second.select("id", "content", "timestamp"), ["id"], ["timestamp"]), base, number)
    got = {r["id"]: r["content"] for r in sinks.read_batches(spark, base, schema).collect()}
    assert got["lob_s1:0"] == "T\n\nD" and got["lob_s1:1"] == "first"  # ids are positional: the shifted text stays hidden
    assert got["lob_s1:2"] == "first" and got["lob_s1:5"] == "late" and got["lob_s3:0"] == "New"
    assert len(got) == 7
    # The cursor covers heads and comments, so the old new head is not seen by the default refresh.
    meta = incremental.next_cursor(first)
    fresh = incremental.refresh(first, second, meta, ["id"], ["timestamp"])
    assert [r["id"] for r in fresh.collect()] == ["lob_s1:2"]
    assert incremental.refresh(first, second, meta, ["id"], ["timestamp"], lateness=10 ** 9).count() == 3


def test_presets_quirks(spark, tmp_path):
    heads, rows = story_rows(spark, tmp_path, STORIES, COMMENTS)
    cell = feeds.tables(rows)
    cell["sources"] = feeds.sources(heads, stories.PREFIX)
    cell["graph"] = spark.createDataFrame([("lob_s1", 0.5, 1, 0, 2)], "source_id string, centrality double, is_hub int, is_bridge int, community_id int")
    view = views.story_chunks(cell)
    assert {r["id"]: r["community_id"] for r in view.collect()} == {"lob_s1:0": 2, "lob_s1:1": 2, "lob_s1:4": 2, "lob_s2:0": None}
    assert presets.tagged(view, "rust", "2024-01-10", days=30).count() == 3
    assert presets.tagged(view, "rus", "2024-01-10", days=30).count() == 0
    top = presets.top(view, "2024-01-10").collect()
    assert [r["id"] for r in top] == ["lob_s1:4", "lob_s1:0", "lob_s1:1", "lob_s2:0"]
    got = {r["source_id"]: r["chunk_count"] for r in views.threads(cell).collect()}
    assert got == {"lob_s1": 3, "lob_s2": 1}
    art = spark.createDataFrame([("a", "article", "[]"), ("b", "article", '["x"]'), ("c", "article", ""), ("d", "comment", '["x"]')], "id string, type string, tags string")
    assert {r["tag"]: r["articles"] for r in presets.tag_counts(art).collect()} == {"[]": 1, "x": 1}
    assert presets.random_sample(view, longer_than=0).count() == 3
    assert view.filter(presets.tags_like("thread_tags", "RUS_")).filter(F.col("type") == "story").count() == 1
    # The reports over the cell give what those over the view give, whether its chunks are one table or three.
    for stored in (cell, {**cell, "rows": rows}):
        for whole, few in (
            (presets.top(view, "2024-01-10"), late.top(stored, "2024-01-10")),
            (presets.top(view, "2024-01-10", limit=2), late.top(stored, "2024-01-10", limit=2)),
            (presets.story_recent(view, "2024-01-10", limit=3), late.story_recent(stored, "2024-01-10", limit=3)),
            (presets.story_recent(view, "2024-01-02 00:00:00.5", days=1), late.story_recent(stored, "2024-01-02 00:00:00.5", days=1)),
            (presets.tagged(view, "rust", "2024-01-10"), late.tagged(stored, "rust", "2024-01-10")),
            (presets.tagged(view, "none", "2024-01-10"), late.tagged(stored, "none", "2024-01-10")),
            (presets.top_threads(views.threads(cell), 1), late.top_threads(stored, 1)),
            (presets.comment_thread(view, "lob_s1"), late.comment_thread(stored, views.story_chunks, "lob_s1")),
        ):
            assert whole.columns == few.columns and list(map(tuple, whole.collect())) == list(map(tuple, few.collect()))
    tagged = art.select("id", F.col("type").alias("item_type"), "tags")
    assert {r["tag"]: r["articles"] for r in late.tag_counts({"rows": tagged}).collect()} == {"[]": 1, "x": 1}
    assert {r["tag"]: r["articles"] for r in late.tag_counts_inner({"rows": tagged}).collect()} == {"x": 1}
