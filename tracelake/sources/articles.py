"""Articles and their nested comment trees, from landed JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tracelake import schemas
from tracelake.functions.html import strip_html
from tracelake.functions.jsons import list_text
from tracelake.functions.text import first_nonempty, nonempty, strip
from tracelake.functions.times import iso_epoch_or_zero
from tracelake.operators.ranking import pick_first

PREFIX = "devto_"  # fixed value: id prefix of this source kind
KIND = "devto"
#: Trees that a Python task decodes at a time; decoded they take several times as much.
TREE_BYTES = 4 << 20

_TEXTS = ["id", "parent_id", "author", "body_html", "created_at"]
_COMMENTS = T.ArrayType(T.StructType(
    [T.StructField("dfs_pos", T.LongType()), *[T.StructField(n, T.StringType()) for n in _TEXTS]]
))
_FLAT = T.StructType([T.StructField("head_id", T.StringType()), T.StructField("flat", _COMMENTS)])


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ARTICLE).json(path)


def read_details(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ARTICLE_DETAIL).json(path)


def read_comment_trees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ARTICLE_COMMENTS).json(path)


def with_details(listed: DataFrame, details: DataFrame) -> DataFrame:
    """Full bodies from the detail records; an empty or missing detail keeps the listed body."""
    full = details.filter(F.col("id").isNotNull() & nonempty("body_markdown").isNotNull())
    full = pick_first(full.select("id", F.col("body_markdown").alias("__full")), ["id"], ["__full"])
    return (
        listed.join(full, "id", "left")
        .withColumn("body_markdown", F.coalesce("__full", "body_markdown"))
        .drop("__full")
    )


def _tags():
    listed = F.from_json("tag_list", "array<string>")
    typed = F.filter(F.transform(F.split("tag_list", ","), strip), lambda t: t != "")
    tags = F.when(F.startswith("tag_list", F.lit("[")), listed).otherwise(typed)
    return F.coalesce(tags, F.array().cast("array<string>"))


def normalise(raw: DataFrame) -> DataFrame:
    """Article heads; records without an id are left out. Feed columns pass through."""
    title = F.coalesce("title", F.lit(""))
    body = first_nonempty("body_markdown", "description")
    return raw.filter(F.coalesce("id", F.lit(0)) != 0).select(
        F.col("id").cast("string").alias("id"),
        F.lit("article").alias("type"),
        F.coalesce("user.username", F.lit("")).alias("author"),
        title.alias("title"),
        body.alias("body"),
        strip(F.concat(title, F.lit("\n\n"), body)).alias("content"),
        F.coalesce("positive_reactions_count", F.lit(0)).alias("score"),
        F.coalesce("comments_count", F.lit(0)).alias("num_comments"),
        F.coalesce("url", F.lit("")).alias("url"),
        iso_epoch_or_zero("published_at").alias("created_utc"),
        list_text(_tags()).alias("tags"),
        F.coalesce("reading_time_minutes", F.lit(0)).alias("reading_time"),
        F.lit("").alias("story_url"),
        "feed_kind", "feed", "feed_pos",
    )


def _load_tree(text: str | None) -> list:
    try:
        tree = json.loads(text) if text else []
    except ValueError:
        return []
    return tree if isinstance(tree, list) else []


def _walk(tree: list, into: dict[str, list]) -> int:
    """Append one comment tree in depth-first pre-order; no recursion, so depth is not limited by the stack.

    What is no object is no comment; a field of another kind than expected is empty.
    """
    def text(value) -> str:
        return value if isinstance(value, str) else ""

    count, todo = 0, [(node, "") for node in reversed(tree)]
    while todo:
        node, parent = todo.pop()
        if not isinstance(node, dict):
            continue
        own, user, children = text(node.get("id_code")), node.get("user"), node.get("children")
        into["dfs_pos"].append(count)
        into["id"].append(own)
        into["parent_id"].append(parent)
        into["author"].append(text(user.get("username")) if isinstance(user, dict) else "")
        into["body_html"].append(text(node.get("body_html")))
        into["created_at"].append(text(node.get("created_at")))
        count += 1
        todo.extend((child, own) for child in reversed(children if isinstance(children, list) else []))
    return count


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most TREE_BYTES of trees, or of one tree."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("tree")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + TREE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees to arrays of comments, built column by column."""
    for batch in (piece for whole in batches for piece in _pieces(whole)):
        columns: dict[str, list] = {"dfs_pos": [], **{name: [] for name in _TEXTS}}
        ends = [0]
        for text in batch.column("tree").to_pylist():
            ends.append(ends[-1] + _walk(_load_tree(text), columns))
        kinds = [pa.int64(), *[pa.string()] * len(_TEXTS)]
        rows = pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(columns.values(), kinds)], list(columns))
        flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
        yield pa.RecordBatch.from_arrays([batch.column("head_id"), flat], ["head_id", "flat"])


def flatten_comments(trees: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per comment: dfs_pos in depth-first order, position from 1 in time order.

    Order and position are found inside the record of the tree, so nothing is
    shuffled; limit keeps the first comments of each article in depth-first order.
    """
    given = trees.select(F.col("article_id").cast("string").alias("head_id"), "tree")
    flat = given.mapInArrow(_flatten, _FLAT)
    if limit is not None:
        flat = flat.withColumn("flat", F.slice("flat", 1, limit))
    timed = F.transform("flat", lambda c: F.struct(
        iso_epoch_or_zero(c["created_at"]).alias("created_utc"), c["dfs_pos"].alias("dfs_pos"), c["id"].alias("comment_id"),
        c["parent_id"].alias("parent_id"), c["author"].alias("author"), c["body_html"].alias("body_html"),
    ))
    rows = flat.select("head_id", F.posexplode(F.array_sort(timed)).alias("place", "c"))
    return rows.select(
        "head_id", "c.dfs_pos", (F.col("place") + 1).cast("long").alias("position"), "c.comment_id",
        F.lit("comment").alias("type"), "c.author", strip_html("c.body_html").alias("content"),
        F.lit(0).alias("score"), F.lit("").alias("url"), "c.created_utc", "c.parent_id",
        F.lit("[]").alias("tags"), F.lit(0).alias("reading_time"), F.lit(None).cast("int").alias("depth"),
    )
