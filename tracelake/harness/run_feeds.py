"""Registered queries over the feed-made cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions.html import strip_html
from tracelake.harness import feeds as H
from tracelake.harness.events import table
from tracelake.plans import late, presets, views
from tracelake.sources import feeds, stories

CURSOR = 1705000000


def _article_chunks(spark, sf):
    return views.article_chunks(H.article_cell(spark, sf))


def _story_chunks(spark, sf):
    return views.story_chunks(H.story_cell(spark, sf))


def _unique(spark, sf):
    ranked = feeds.with_feed_rank(feeds.recent_per_feed(H.feed_rows(spark, sf), CURSOR, 10), H.FEEDS)
    return feeds.dedupe_across_feeds(ranked)


def _global_limit(spark, sf):
    rows = H.feed_rows(spark, sf).filter(F.col("created_utc") >= CURSOR)
    return feeds.dedupe_with_limit(feeds.with_feed_rank(rows, H.FEEDS), 40)


def _thread_rows(spark, sf):
    return feeds.threads(H.article_heads(spark, sf), H.article_comments(spark, sf))


def _article(report):
    return lambda spark, sf: report(H.article_cell(spark, sf))


def _story(report):
    return lambda spark, sf: report(H.story_cell(spark, sf))


def queries() -> dict:
    return {
        "article_heads": H.article_heads,
        "comment_tree_flat": lambda spark, sf: H.article_comments(spark, sf).drop("tags", "reading_time", "depth", "url", "score"),
        "story_heads": H.story_heads,
        "story_listed_comments": lambda spark, sf: stories.normalise_comments(
            stories.listed_comments(H.stories_with_comments(spark, sf))).drop("tags", "reading_time"),
        "story_comments": lambda spark, sf: H.story_comments(spark, sf).drop("tags", "reading_time"),
        "feed_recent_limit": lambda spark, sf: feeds.recent_per_feed(H.feed_rows(spark, sf), CURSOR, 10).select(
            "feed_kind", "feed", "feed_pos", "id"),
        "feed_dedupe": lambda spark, sf: _unique(spark, sf).select("id", "feed_kind", "feed", "feed_rank", "title"),
        "feed_global_limit": lambda spark, sf: _global_limit(spark, sf).select("id", "feed_rank", "feed_pos"),
        "thread_rows": _thread_rows,
        "article_chunk_rows": lambda spark, sf: H.article_cell(spark, sf)["chunks"],
        "article_edges": lambda spark, sf: H.article_cell(spark, sf)["edges"],
        "story_types": lambda spark, sf: H.story_cell(spark, sf)["types"],
        "article_sources": lambda spark, sf: H.article_cell(spark, sf)["sources"],
        "pull_estimate": lambda spark, sf: feeds.estimate(_unique(spark, sf), H.article_comments(spark, sf)),
        "pull_feed_counts": lambda spark, sf: feeds.per_feed_counts(feeds.recent_per_feed(H.feed_rows(spark, sf), CURSOR)),
        "view_article_chunks": _article_chunks,
        "view_story_chunks": _story_chunks,
        "view_threads": lambda spark, sf: views.threads(H.story_cell(spark, sf)),
        "recent_stories": _story(lambda c: late.story_recent(c, H.AS_OF, days=7)),
        "recent_articles": _article(late.article_recent),
        "top_stories": _story(lambda c: late.top(c, H.AS_OF)),
        "tagged_stories": _story(lambda c: late.tagged(c, "rust", H.AS_OF)),
        "articles_by_tag": _article(lambda c: late.by_tag(c, "SRC1")),
        "article_tag_counts": _article(late.tag_counts),
        "article_tag_counts_inner": _article(late.tag_counts_inner),
        "articles_by_me": lambda spark, sf: late.mine(H.article_cell(spark, sf), H.meta(spark), H.AS_OF, days=20),
        "cell_shape": lambda spark, sf: presets.shape(H.article_cell(spark, sf)),
        "random_sample": _article(late.random_sample),
        "latest_sample": _article(late.latest_sample),
        "top_articles_for_tag": _article(lambda c: late.top_articles_for_tag(c, "src2")),
        "top_threads": _story(late.top_threads),
        "top_threads_for_tag": _story(lambda c: late.top_threads(c, tag="db")),
        "comment_thread": _article(lambda c: late.comment_thread(c, views.article_chunks, "devto_3")),
        "story_comment_thread": _story(lambda c: late.comment_thread(c, views.story_chunks, "lob_c3")),
        "page_text": lambda spark, sf: table(spark, sf, "pages").select("page_id", strip_html("html").alias("text")),
    }
