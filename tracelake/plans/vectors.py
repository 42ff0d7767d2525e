"""Embedding of text, and vector search with its modifiers.

Our own definitions, all deterministic: score is the cosine with the query;
suppress subtracts a share of the cosine with a second vector; decay halves the
score every N days; pool keeps the best N before diverse (maximal marginal
relevance) or peaks (hill climbing to the densest neighbour) look at them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tracelake.functions.text import words
from tracelake.functions.times import calendar_since, instant
from tracelake.plans.graph import neighbour_edges
from tracelake.session import Scratch, scratch_table

DIMENSIONS = 64
SUPPRESS_SHARE = 0.5
POOL = 300
DIVERSE_SHARE = 0.7
NEIGHBOURS = 5
#: Rows from which the greedy choice goes on without a scan.
AHEAD = 2000
#: Token lists embedded at a time: their codes and places are arrays of eight bytes a token.
EMBED_ROWS = 500
DIGITS = 9  # a product differs in its last bits with the batch it is made in; rounded, equal texts tie and the id decides


def _slot(token: str) -> tuple[int, float]:
    """Dimension and sign of a token, from its hash."""
    h = int(hashlib.md5(token.encode()).hexdigest()[:8], 16)
    return h % DIMENSIONS, 1.0 if (h >> 16) % 2 == 0 else -1.0


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _embed_tokens(tokens: pa.Array) -> pa.Array:
    """Signed feature hashing of token lists, EMBED_ROWS at a time; every distinct token of the batch is hashed once."""
    n = len(tokens)
    coded = pc.dictionary_encode(tokens.flatten())
    slots = [_slot(t) for t in coded.dictionary.to_pylist()]
    dims, signs = np.array([s[0] for s in slots], np.int64), np.array([s[1] for s in slots])
    codes = coded.indices.to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    ends = np.append(0, np.cumsum(lengths, dtype=np.int64))
    flat = np.empty(n * DIMENSIONS, np.float32)
    for at in range(0, n, EMBED_ROWS):
        stop = min(n, at + EMBED_ROWS)
        out, part = np.zeros((stop - at, DIMENSIONS)), codes[ends[at]:ends[stop]]
        np.add.at(out, (np.repeat(np.arange(stop - at), lengths[at:stop]), dims[part]), signs[part])
        flat[at * DIMENSIONS:stop * DIMENSIONS] = _unit_rows(out).astype(np.float32).ravel()
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * DIMENSIONS, DIMENSIONS, dtype=np.int32), pa.array(flat))


def embed(c: Column | str) -> Column:
    """Unit vector of a text; the zero vector for a text without words."""
    udf = F.arrow_udf(_embed_tokens, T.ArrayType(T.FloatType()))
    return udf(words(F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(""))))


def embed_text(text: str) -> list[float]:
    """The same vector for one query text."""
    import re

    tokens = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return _embed_tokens(pa.array([tokens], pa.list_(pa.string())))[0].as_py()


def embed_new(chunks: DataFrame) -> DataFrame:
    """Fill the embedding of rows that have none; other rows are left alone."""
    fresh = chunks.filter(F.col("embedding").isNull()).withColumn("embedding", embed("content"))
    return chunks.filter(F.col("embedding").isNotNull()).unionByName(fresh)


def cosine(c: str, query: Sequence[float]) -> Column:
    """Cosine of a vector column with one query vector, a batch at a time; null for a null vector."""
    q = np.asarray(query, dtype=np.float64)
    q = q / (np.linalg.norm(q) or 1.0)

    def score(vectors: pa.Array) -> pa.Array:
        present = vectors.is_valid().to_numpy(zero_copy_only=False)
        m = vectors.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(q))
        out = np.full(len(vectors), np.nan)
        out[present] = np.round(_unit_rows(m) @ q, DIGITS)
        return pa.array(out, mask=~present)

    return F.arrow_udf(score, T.DoubleType())(F.col(c))


def score(
    vectors: DataFrame, query: Sequence[float], candidates: DataFrame | None = None,
    suppress: Sequence[float] | None = None, share: float = SUPPRESS_SHARE,
    decay_days: float | None = None, as_of=None, created: str = "created_at",
) -> DataFrame:
    """Add score to vectors (id, embedding, ...). Candidates limit before anything is scored or cut."""
    if candidates is not None:
        vectors = vectors.join(candidates.select("id"), "id", "left_semi")
    out = vectors.filter(F.col("embedding").isNotNull()).withColumn("score", cosine("embedding", query))
    if suppress is not None:
        out = out.withColumn("__near", cosine("embedding", suppress))
        out = out.withColumn("score", F.col("score") - share * F.greatest(F.lit(0.0), F.col("__near"))).drop("__near")
    if decay_days is not None:
        age = F.timestamp_diff("SECOND", F.col(created), instant(as_of)) / F.lit(86400.0)
        out = out.withColumn("score", F.col("score") * F.pow(F.lit(0.5), age / F.lit(float(decay_days))))
    return out.withColumn("score", F.round("score", DIGITS))


def top(scored: DataFrame, limit: int) -> DataFrame:
    return scored.orderBy(F.col("score").desc(), F.col("id").asc()).limit(limit)


def _nearest(c: str, picked: np.ndarray) -> Column:
    """Largest cosine of a vector column with the vectors picked so far, a batch at a time."""
    unit = _unit_rows(picked)

    def near(vectors: pa.Array) -> pa.Array:
        m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, unit.shape[1])
        return pa.array((_unit_rows(m) @ unit.T).max(axis=1))

    return F.arrow_udf(near, T.DoubleType())(F.col(c))


def _vectors(rows: list) -> np.ndarray:
    return _unit_rows(np.array([r["embedding"] for r in rows], dtype=np.float64))


def _head(rows: DataFrame, picks: list, share: float, limit: int) -> list:
    """The rows of the largest gain after these picks, in order, from one scan."""
    gain = F.col("score")
    if picks:
        rows = rows.filter(~F.col("id").isin([p["id"] for p in picks]))
        near = _nearest("embedding", np.array([p["embedding"] for p in picks], dtype=np.float64))
        gain = F.round(share * F.col("score") - (1 - share) * near, DIGITS)
    return rows.withColumn("gain", gain).orderBy(F.col("gain").desc(), F.col("score").desc(), F.col("id").asc()).limit(limit).collect()


def diverse(scored: DataFrame, limit: int, pool: int | None = None, share: float = DIVERSE_SHARE, ahead: int = AHEAD) -> DataFrame:
    """Spread results: greedy maximal marginal relevance over all scored rows, or over the best `pool` where the caller names one.

    A pick can only lower the gain of other rows. So one scan finds the first
    pick, a second one the `ahead` rows of the largest gain after it, and from
    these the greedy choice goes on, with their nearest cosine carried along,
    for as long as its pick is not below the last of them; every row left out
    is. Then, if picks are missing, another scan takes all picks into account.
    The picks are those of one scan per pick; at most `ahead` rows come to the
    driver at a time.
    """
    rows = scored.select("id", "score", "embedding").filter(F.col("embedding").isNotNull())
    if pool is not None:
        rows = scratch_table(top(rows, pool))
    picks: list = _head(rows, [], share, 1) if limit > 0 else []
    while picks and len(picks) < limit:
        head = _head(rows, picks, share, ahead)
        if not head:
            break
        unit = _vectors(head)
        near = (unit @ _vectors(picks).T).max(axis=1)
        score, left = np.array([r["score"] for r in head]), list(range(len(head)))
        last = len(head) - 1
        floor = (head[last]["gain"], score[last]) if len(head) == ahead else (-np.inf, -np.inf)
        while left and len(picks) < limit:
            gain = np.round(share * score - (1 - share) * near, DIGITS)
            most = max((gain[i], score[i]) for i in left)
            best = min((i for i in left if (gain[i], score[i]) == most), key=lambda i: head[i]["id"])
            at = (gain[best], score[best])
            if at < floor or at == floor and head[best]["id"] > head[last]["id"]:
                break
            picks.append(head[best])
            left.remove(best)
            near = np.maximum(near, unit @ unit[best])
    schema = T.StructType([rows.schema["id"], T.StructField("pick", T.IntegerType()), T.StructField("score", T.DoubleType())])
    return rows.sparkSession.createDataFrame([(p["id"], i, p["score"]) for i, p in enumerate(picks, start=1)], schema)


def peaks(scored: DataFrame, pool: int = POOL, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Cluster the best `pool` rows: each climbs to its densest neighbour; the summits are attractors.

    Neighbours are found in blocks, as for the source graph. A row's density is
    the mean cosine with its neighbours; rows are ranked by it, then by score
    and id. Pointer doubling takes every row to its summit.
    """
    scratch = Scratch(scored.sparkSession)
    best = scratch.write("pool", top(scored, pool).select("id", "score", "embedding"))
    edges = scratch.write("edges", neighbour_edges(best.select(F.col("id").alias("source_id"), "embedding"), neighbours, scratch=scratch, positive=False))
    density = edges.groupBy(F.col("source_id").alias("id")).agg(F.round(F.avg("weight"), DIGITS).alias("density"))
    # A large rank is the denser row; of equals the one of the better score, then the smaller id.
    order = Window.orderBy(F.col("density").desc_nulls_last(), F.col("score").desc(), F.col("id").asc())
    ranked = scratch.write("ranked", best.select("id", "score").join(density, "id", "left").withColumn("rank", F.row_number().over(order).cast("long")))
    there = ranked.select(F.col("id").alias("neighbour"), F.col("rank").alias("near"))
    upward = edges.join(there, "neighbour").groupBy(F.col("source_id").alias("id")).agg(F.min("near").alias("near"))
    at = ranked.join(upward, "id", "left").select("id", "score", "rank", F.least("rank", F.coalesce("near", "rank")).alias("top"))
    number = 0
    while True:
        at = scratch.write(f"climb-{number}", at)
        onward = at.select(F.col("rank").alias("top"), F.col("top").alias("next"))
        if at.join(onward, "top").where("next <> top").isEmpty():
            break
        at, number = at.join(onward, "top").select("id", "score", "rank", F.col("next").alias("top")), number + 1
    summits = at.where("rank = top").select("top", F.row_number().over(Window.orderBy("top")).alias("_cluster_id"))
    return at.join(summits, "top").select("id", "_cluster_id", F.when(F.col("rank") == F.col("top"), 1).otherwise(0).alias("_is_attractor"), "score")


def hybrid(keyword_hits: DataFrame, vectors: DataFrame, query: Sequence[float], limit: int = 10, **modifiers) -> DataFrame:
    """The keyword pool, scored and ordered by vector."""
    scored = score(vectors, query, candidates=keyword_hits, **modifiers).select("id", "score")
    return top(scored.join(keyword_hits, "id"), limit)


def hub_hits(scored: DataFrame, graph: DataFrame, limit: int = 10) -> DataFrame:
    """Scored rows whose source is a hub, the most central first."""
    hubs = graph.filter(F.col("is_hub") == 1).select("source_id", "centrality", "community_id")
    return (
        scored.join(hubs, "source_id").orderBy(F.col("centrality").desc(), F.col("id").asc()).limit(limit)
    )


# Texts of the digest's semantic reports and their modifiers.
VOICE = "decisions architecture goals accomplishments next steps"
VOICE_TIGHT = "decisions goals accomplishments what we built what is next"
SECONDARY = "work tasks progress"
SECONDARY_SUPPRESS = "skill digest query pipeline"
CLUSTERS = "what are we working on, what decisions, what was built"


def _asked(messages: DataFrame, as_of, days: int) -> DataFrame:
    """The prompts of the window: what the semantic reports look at."""
    return messages.filter((F.col("type") == "user_prompt") & calendar_since("created_at", as_of, days))


def _told(hits: DataFrame, messages: DataFrame) -> DataFrame:
    return hits.join(messages.select("id", "content", "session_id", "created_at"), "id")


def user_voice(messages: DataFrame, as_of, text: str = VOICE, limit: int = 20, days: int = 1) -> DataFrame:
    """Prompts of the last day near the theme, spread out, fresher ones first. messages: id, type, content, embedding, session_id, created_at."""
    prompts = _asked(messages, as_of, days)
    return _told(diverse(score(prompts, embed_text(text), decay_days=1, as_of=as_of), limit), prompts)


def secondary_work(messages: DataFrame, as_of, limit: int = 15, suppress: str = SECONDARY_SUPPRESS, days: int = 1) -> DataFrame:
    prompts = _asked(messages, as_of, days)
    return _told(diverse(score(prompts, embed_text(SECONDARY), suppress=embed_text(suppress)), limit), prompts)


def workstream_clusters(messages: DataFrame, as_of, pool: int = POOL, days: int = 1) -> DataFrame:
    """Clusters of the best `pool` prompts of the last day. Spreading a pool that is clustered whole changes its order alone."""
    prompts = _asked(messages, as_of, days)
    return _told(peaks(score(prompts, embed_text(CLUSTERS)), pool), prompts)
