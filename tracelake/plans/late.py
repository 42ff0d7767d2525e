"""The named reports over a stored cell, materialised late.

A report is defined over the flat view (presets). Here its rows are first chosen
from the few stored columns that its filter and order need, without the texts
and without the joins; then the view is made of the chosen keys alone. At most
`limit` keys come to the driver, and reach the second scan as filters. Tag
counts need one scan of two columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracelake.functions.jsons import has_tag, string_array
from tracelake.functions.times import EPOCH, instant
from tracelake.operators.ranking import top_rows
from tracelake.plans import presets, views

Cell = dict[str, DataFrame]


def since(as_of, days: int) -> Column:
    """presets' filter on created_at as one on the stored seconds, which Parquet can skip by."""
    micros = F.timestamp_diff("MICROSECOND", instant(EPOCH), instant(as_of))
    return F.col("timestamp") >= F.ceil(micros / F.lit(1_000_000)).cast("long") - F.lit(int(days) * 86400).cast("long")


def _newest() -> list[Column]:
    return [F.col("timestamp").desc(), F.col("id").asc()]


def _picked(cell: Cell, rows: DataFrame, order: list[Column], limit: int) -> Cell:
    """The cell with the first rows in this order alone."""
    keys = top_rows(rows, order, limit).select("id", "source_id").collect()
    return views.only(cell, sorted({k["source_id"] for k in keys} - {None}), [k["id"] for k in keys])


def story_recent(cell: Cell, as_of, days: int = 7, limit: int = 50) -> DataFrame:
    few = _picked(cell, views.chunk_table(cell).filter(since(as_of, days)), _newest(), limit)
    return presets.story_recent(views.story_chunks(few), as_of, days, limit)


def article_recent(cell: Cell, limit: int = 50) -> DataFrame:
    return presets.article_recent(views.article_chunks(_picked(cell, views.chunk_table(cell), _newest(), limit)), limit)


def latest_sample(cell: Cell, limit: int = 3) -> DataFrame:
    return presets.latest_sample(views.article_chunks(_picked(cell, views.chunk_table(cell), _newest(), limit)), limit)


def top(cell: Cell, as_of, days: int = 30, limit: int = 50) -> DataFrame:
    order = [F.coalesce("score", F.lit(0)).desc(), *_newest()]
    few = _picked(cell, views.chunk_table(cell).filter(since(as_of, days)), order, limit)
    return presets.top(views.story_chunks(few), as_of, days, limit)


def tagged(cell: Cell, tag: str, as_of, days: int = 30, limit: int = 50) -> DataFrame:
    """The tag is the thread's: its sources are found first."""
    threads = cell["sources"].filter(has_tag("tags", tag)).select("source_id")
    rows = views.chunk_table(cell).filter(since(as_of, days)).join(threads, "source_id", "left_semi")
    return presets.tagged(views.story_chunks(_picked(cell, rows, _newest(), limit)), tag, as_of, days, limit)


def by_tag(cell: Cell, tag: str, limit: int = 50) -> DataFrame:
    rows = views.chunk_table(cell).filter(presets.tags_like("tags", tag))
    return presets.by_tag(views.article_chunks(_picked(cell, rows, _newest(), limit)), tag, limit)


def mine(cell: Cell, meta: DataFrame, as_of, days: int = 30, limit: int = 200) -> DataFrame:
    authors = meta.filter(F.col("key") == "authors").select(F.explode(string_array("value")).alias("author")).distinct()
    rows = views.chunk_table(cell).filter(since(as_of, days)).join(authors, "author", "left_semi")
    return presets.mine(views.article_chunks(_picked(cell, rows, _newest(), limit)), meta, as_of, days, limit)


def random_sample(cell: Cell, seed: int = 7, limit: int = 3, longer_than: int = 40) -> DataFrame:
    rows = views.chunk_table(cell).filter(F.char_length("content") > longer_than)
    few = _picked(cell, rows, [F.md5(F.concat(F.lit(str(seed)), "id")), F.col("id").asc()], limit)
    return presets.random_sample(views.article_chunks(few), seed, limit, longer_than)


def top_articles_for_tag(cell: Cell, tag: str, limit: int = 20) -> DataFrame:
    rows = views.chunk_table(cell).filter((F.col("item_type") == "article") & presets.tags_like("tags", tag)).select("id", "source_id")
    scored = rows.join(cell["sources"].select("source_id", F.col("score").alias("article_score")), "source_id", "left")
    few = _picked(cell, scored, [F.col("article_score").desc(), F.col("id").asc()], limit)
    return presets.top_articles_for_tag(views.article_chunks(few), tag, limit)


def top_threads(cell: Cell, limit: int = 20, tag: str | None = None) -> DataFrame:
    threads = cell["sources"] if tag is None else cell["sources"].filter(has_tag("tags", tag))
    keys = top_rows(threads, [F.col("score").desc(), F.col("source_id").asc()], limit).select("source_id").collect()
    return presets.top_threads(views.threads(views.only(cell, [k["source_id"] for k in keys])), limit, tag)


def _tags(cell: Cell, tags: Column) -> DataFrame:
    articles = views.chunk_table(cell).filter(F.col("item_type") == "article")
    return articles.select(F.explode(F.array_distinct(tags)).alias("tag"))  # a chunk id is stored once


def _counted(tags: DataFrame, limit: int) -> DataFrame:
    return tags.groupBy("tag").agg(F.count("*").alias("articles")).orderBy(F.col("articles").desc(), F.col("tag").asc()).limit(limit)


def tag_counts(cell: Cell, limit: int = 100) -> DataFrame:
    """Articles per tag; an empty tag array counts under its own text, as a left join on the array gives it."""
    listed = string_array("tags")
    own = F.when(F.coalesce(F.size(listed), F.lit(0)) > 0, F.transform(listed, lambda t: F.coalesce(t, F.col("tags")))).otherwise(F.array("tags"))
    return _counted(_tags(cell, own).filter(F.col("tag") != ""), limit)


def tag_counts_inner(cell: Cell, limit: int = 30) -> DataFrame:
    return _counted(_tags(cell, string_array("tags")), limit)


def comment_thread(cell: Cell, view, source_id: str) -> DataFrame:
    """Comments of one source in position order; view is the cell's flat view."""
    return presets.comment_thread(view(views.only(cell, [source_id])), source_id)
