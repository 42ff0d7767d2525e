"""Landed feed records made by Spark from documents, conversations and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracelake import schemas
from tracelake.functions.jsons import quoted
from tracelake.harness.events import stored, table
from tracelake.sources import articles, feeds, stories

T0 = 1704067200  # 2024-01-01
AS_OF = "2024-02-01 00:00:00"


def _json(fields: dict[str, Column]) -> Column:
    parts: list[Column] = []
    for i, (name, value) in enumerate(fields.items()):
        parts += [F.lit(f'{"," if i else ""}"{name}":'), value]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def _iso(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _number(c: Column) -> Column:
    return c.cast("string")


def _head_epoch() -> Column:
    return F.lit(T0) + (F.col("doc_id") * 7919) % 2592000


def landed_articles(spark: SparkSession, sf: str) -> DataFrame:
    """One article record per document, parsed from its JSON line; tags as a list or as text, some dates broken."""
    d = table(spark, sf, "documents")
    doc = F.col("doc_id")
    tags = (
        F.when(doc % 10 == 9, F.lit("[]"))
        .when(doc % 2 == 0, F.concat(F.lit("["), quoted("lang"), F.lit(","), quoted("source"), F.lit("]")))
        .otherwise(quoted(F.concat("lang", F.lit(", "), "source")))
    )
    line = _json({
        "id": _number(doc + 1),
        "title": quoted(F.split("text", "\n")[0]),
        "description": quoted("text"),
        "url": quoted(F.concat(F.lit("https://example.org/a/"), doc.cast("string"))),
        "published_at": quoted(F.when(doc % 97 == 0, "soon").otherwise(_iso(_head_epoch()))),
        "positive_reactions_count": _number(F.col("n_chars") % 500),
        "comments_count": _number(F.size(F.split("text", "\n"))),
        "reading_time_minutes": _number(F.floor(F.col("n_chars") / 1000)),
        "tag_list": tags,
        "user": F.concat(F.lit('{"username":'), quoted(F.concat(F.lit("user"), (doc % 50).cast("string"))), F.lit("}")),
        "feed_kind": F.lit('"tag"'),
        "feed": quoted("lang"),
        "feed_pos": _number(doc),
    })
    return d.select(F.from_json(line, schemas.ARTICLE).alias("r")).select("r.*")


def article_details(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    body = F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("text"))
    return d.select((F.col("doc_id") + 1).alias("id"), body.alias("body_markdown"))


def article_heads(spark: SparkSession, sf: str) -> DataFrame:
    return articles.normalise(articles.with_details(landed_articles(spark, sf), article_details(spark, sf)))


def comment_trees(spark: SparkSession, sf: str) -> DataFrame:
    """A comment per line of the document, its sentences as replies."""
    d = table(spark, sf, "documents")

    def node(code: Column, who: Column, text: Column, at: Column, children: Column) -> Column:
        escaped = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        body = F.when(F.char_length(text) % 17 == 0, F.lit("[deleted]")).otherwise(F.concat(F.lit("<p>"), escaped, F.lit("</p>")))
        return _json({
            "id_code": quoted(code), "body_html": quoted(body), "created_at": quoted(_iso(at)),
            "user": F.concat(F.lit('{"username":"u'), who.cast("string"), F.lit('"}')), "children": children,
        })

    doc = F.col("doc_id")

    def reply(i: Column):
        def build(s: Column, j: Column) -> Column:
            code = F.concat(doc.cast("string"), F.lit("-"), i.cast("string"), F.lit("-"), j.cast("string"))
            return node(code, (doc + j) % 30, s, _head_epoch() + (doc * 31 + i * 37 + j * 101 + 500) % 5000, F.lit("[]"))

        return build

    def line(text: Column, i: Column) -> Column:
        code = F.concat(doc.cast("string"), F.lit("-"), i.cast("string"))
        replies = F.transform(F.split(text, r"\. "), reply(i))
        children = F.concat(F.lit("["), F.array_join(replies, ","), F.lit("]"))
        return node(code, (doc + i) % 40, text, _head_epoch() + (doc * 31 + i * 37) % 5000, children)

    tree = F.concat(F.lit("["), F.array_join(F.transform(F.split("text", "\n"), line), ","), F.lit("]"))
    return d.select((doc + 1).alias("article_id"), tree.alias("tree"))


def article_comments(spark: SparkSession, sf: str) -> DataFrame:
    return articles.flatten_comments(comment_trees(spark, sf))


def landed_stories(spark: SparkSession, sf: str) -> DataFrame:
    """The first turn of every conversation as a story record."""
    c = table(spark, sf, "conversations").filter(F.col("turn") == 0)
    conv = F.col("conv_id")
    code = F.concat(F.lit("c"), conv.cast("string"))
    who = F.concat(F.lit("s"), (conv % 25).cast("string"))
    line = _json({
        "short_id": quoted(code),
        "title": quoted(F.split("text", "\n")[0]),
        "description_plain": F.when(conv % 3 == 0, F.lit('""')).otherwise(quoted("text")),
        "description": F.when(conv % 6 == 0, F.lit("null")).otherwise(quoted("text")),
        "url": quoted(F.concat(F.lit("https://example.org/s/"), code)),
        "comments_url": F.when(conv % 5 == 0, F.lit("null")).otherwise(quoted(F.concat(F.lit("https://example.org/t/"), code))),
        "created_at": quoted(_iso(F.lit(T0) + (conv * 86413) % 2592000)),
        "score": _number(F.char_length("text") % 100),
        "comment_count": _number(conv % 10),
        "tags": F.when(conv % 4 == 0, F.lit('["rust"]')).when(conv % 4 == 1, F.lit('["rust","db"]'))
        .when(conv % 4 == 2, F.lit('"rust"')).otherwise(F.lit("[]")),
        "submitter_user": F.when(conv % 2 == 0, F.concat(F.lit('{"username":'), quoted(who), F.lit("}"))).otherwise(quoted(who)),
        "feed_kind": F.lit('"newest"'), "feed": F.lit('"1"'), "feed_pos": _number(conv),
    })
    return c.select(F.from_json(line, schemas.STORY).alias("r")).select("r.*")


def landed_story_comments(spark: SparkSession, sf: str) -> DataFrame:
    """All later turns as flat comment records in turn order."""
    c = table(spark, sf, "conversations").filter(F.col("turn") > 0)
    conv, turn = F.col("conv_id"), F.col("turn")
    n = F.char_length("text")
    code = F.concat(F.lit("c"), conv.cast("string"))
    own = F.concat(code, F.lit("_"), turn.cast("string"))
    parent = F.concat(code, F.lit("_"), (turn - 1).cast("string"))
    body = F.when(n % 11 == 0, F.lit('"[removed]"')).when(n % 13 == 0, F.lit('""')).otherwise(quoted("text"))
    line = _json({
        "story_id": quoted(code), "pos": _number(turn - 1), "short_id": quoted(own),
        "comment_plain": F.when(turn % 4 == 3, F.lit('""')).otherwise(body), "comment": body,
        "score": _number(n % 30), "depth": _number((turn - 1) % 5),
        "parent_comment": F.when(turn == 1, F.lit("null")).otherwise(quoted(parent)),
        "url": quoted(F.concat(F.lit("https://example.org/c/"), own)),
        "created_at": quoted(_iso(F.lit(T0) + (conv * 86413) % 2592000 + turn * 60)),
        "commenting_user": quoted(F.col("role")),
    })
    return c.select(F.from_json(line, schemas.STORY_COMMENT).alias("r")).select("r.*")


def stories_with_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Stories that carry their comments as one JSON array, as a detail request lists them."""
    c = landed_story_comments(spark, sf)
    item = F.struct(*[x for x in c.columns if x not in ("story_id", "pos")])
    rows = F.array_sort(F.collect_list(F.struct("pos", item.alias("c"))))
    return c.groupBy(F.col("story_id").alias("short_id")).agg(F.to_json(F.transform(rows, lambda r: r["c"])).alias("comments"))


def story_heads(spark: SparkSession, sf: str) -> DataFrame:
    return stories.normalise(landed_stories(spark, sf))


def story_comments(spark: SparkSession, sf: str) -> DataFrame:
    return stories.normalise_comments(landed_story_comments(spark, sf))


def _graph(sources: DataFrame, number: Column) -> DataFrame:
    n = number.cast("long")
    return sources.select(
        "source_id", ((n * 37) % 1000 / 1000).alias("centrality"), F.when(n % 20 == 0, 1).otherwise(0).alias("is_hub"),
        F.when(n % 15 == 0, 1).otherwise(0).alias("is_bridge"), (n % 8).cast("int").alias("community_id"),
    ).filter(n % 9 != 4)


def article_cell(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    heads = article_heads(spark, sf)
    rows = stored("articles", spark, sf, lambda: feeds.chunk_rows(
        heads, article_comments(spark, sf), articles.PREFIX, articles.KIND, "article"))
    cell = {"rows": rows, **feeds.tables(rows)}
    cell["sources"] = feeds.sources(heads, articles.PREFIX)
    cell["graph"] = _graph(cell["sources"], F.regexp_extract("source_id", "([0-9]+)$", 1))
    return cell


def story_cell(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    heads = story_heads(spark, sf)
    rows = stored("stories", spark, sf, lambda: feeds.chunk_rows(
        heads, story_comments(spark, sf), stories.PREFIX, stories.KIND, "story"))
    cell = {"rows": rows, **feeds.tables(rows)}
    cell["sources"] = feeds.sources(heads, stories.PREFIX)
    cell["graph"] = _graph(cell["sources"], F.regexp_extract("source_id", "([0-9]+)$", 1))
    return cell


def feed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every article in its language feed, its source feed and its author feed."""
    heads = article_heads(spark, sf).drop("feed_kind", "feed")
    docs = table(spark, sf, "documents").select((F.col("doc_id") + 1).cast("string").alias("id"), "lang", F.col("source").alias("src"))
    both = heads.join(docs, "id")
    listed = F.array(
        F.struct(F.lit("tag").alias("feed_kind"), F.col("lang").alias("feed")),
        F.struct(F.lit("tag").alias("feed_kind"), F.col("src").alias("feed")),
        F.struct(F.lit("author").alias("feed_kind"), F.col("author").alias("feed")),
    )
    return both.select(*[c for c in heads.columns], F.inline(listed))


# The feeds one pull is configured with: languages, two sources, two authors.
FEEDS = [("tag", "en"), ("tag", "src3"), ("tag", "fr"), ("tag", "src1"), ("author", "user7"), ("author", "user20")]


def meta(spark: SparkSession) -> DataFrame:
    rows = [("authors", '["user7", "u3", "user20"]'), ("tags", '["en", "src3"]'), ("scope", "{}"),
            ("last_pull_ts", "1705000000"), ("description", "test cell")]
    return spark.createDataFrame(rows, schemas.META)
