"""Keyword search: a positional index kept per batch, and BM25 over it.

The postings are one row per (token, id) with the token's positions.  A query
reads only the postings of its own words; the index is written sorted by token,
so Parquet statistics skip the rest.  A common word's postings spread over many
partitions because the sort key is (token, id).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tracelake.functions.text import words
from tracelake.session import scratch_table

K1 = 1.2
B = 0.75
POSTINGS = "token string, id string, length int, positions array<int>"
DOCUMENTS = "id string, length int"
#: Token lists grouped at a time: what is sorted takes some fifty bytes a token.
PIECE = 1000
_FOUND = T.ArrayType(T.StructType([T.StructField("token", T.StringType()), T.StructField("positions", T.ArrayType(T.IntegerType()))]))


def _occurrences(tokens: pa.Array) -> pa.Array:
    """The distinct tokens of every list, each with its positions in order; PIECE lists at a time."""
    return pa.concat_arrays([_piece(tokens.slice(at, PIECE)) for at in range(0, max(1, len(tokens)), PIECE)])


def _piece(tokens: pa.Array) -> pa.Array:
    lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
    coded = tokens.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    at = (np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
    key = rows * (len(coded.dictionary) + 1) + codes
    order = np.argsort(key, kind="stable")
    firsts = np.flatnonzero(np.diff(key[order], prepend=-1))
    positions = pa.ListArray.from_arrays(pa.array(np.append(firsts, len(order)), pa.int32()), pa.array(at[order]))
    found = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(codes[order][firsts])), positions], ["token", "positions"])
    ends = np.cumsum(np.bincount(rows[order][firsts], minlength=len(lengths)))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), found)


def build_index(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings (token, id, length, positions) and documents (id, length) of chunks (id, content).

    A posting carries the length of its chunk, so ranking needs no join to the documents.
    A chunk's tokens are grouped inside its row. Only chunks that share their id
    with others are grouped across rows; which those are is looked up first.
    """
    documents = _tokens(chunks).select("id", F.size("tokens").alias("length"))
    ids = chunks.select(F.struct("id").alias("__id"))  # a null id is an id like any other
    repeated = scratch_table(ids.groupBy("__id").agg(F.count("*").alias("n")).where("n > 1").select("__id"))
    if repeated.isEmpty():
        return _postings(chunks), documents
    keyed = chunks.withColumn("__id", F.struct("id"))
    several = _postings(keyed.join(repeated, "__id", "left_semi")).groupBy("token", "id").agg(
        F.max("length").alias("length"), F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"))
    return _postings(keyed.join(repeated, "__id", "left_anti")).unionByName(several), documents


def _tokens(chunks: DataFrame) -> DataFrame:
    return chunks.select("id", words(F.coalesce("content", F.lit(""))).alias("tokens"))


def _postings(chunks: DataFrame) -> DataFrame:
    """Postings of chunks, row by row."""
    found = F.arrow_udf(_occurrences, _FOUND)(F.col("tokens"))
    rows = _tokens(chunks).select("id", F.size("tokens").alias("length"), F.inline(found))
    return rows.select("token", "id", "length", "positions")


def sorted_postings(postings: DataFrame) -> DataFrame:
    """Ranges of (token, id): Parquet statistics then skip other words, and a common word spreads over many files."""
    return postings.repartitionByRange("token", "id").sortWithinPartitions("token", "id")


def write_index(postings: DataFrame, documents: DataFrame, folder: str) -> None:
    sorted_postings(postings).write.mode("overwrite").parquet(f"{folder}/postings")
    documents.write.mode("overwrite").parquet(f"{folder}/documents")


def read_index(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.read.schema(POSTINGS).parquet(f"{folder}/postings"), spark.read.schema(DOCUMENTS).parquet(f"{folder}/documents")
    )


def update_index(
    index: tuple[DataFrame, DataFrame], changed: DataFrame, deleted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Index after a batch: rows of changed or deleted ids go, the changed chunks are added."""
    gone = changed.select("id") if deleted is None else changed.select("id").unionByName(deleted.select("id"))
    gone = gone.distinct()
    postings, documents = build_index(changed)
    return (
        index[0].join(gone, "id", "left_anti").unionByName(postings),
        index[1].join(gone, "id", "left_anti").unionByName(documents),
    )


def parse_query(query: str) -> list[list[str]]:
    """Units of a query: a quoted phrase is one unit of several words, any other word is its own."""
    units = []
    for phrase, word in re.findall(r'"([^"]*)"|(\S+)', query):
        found = [w for w in re.split(r"[\W_]+", (phrase or word).lower()) if w]
        units += [found] if phrase else [[w] for w in found]
    return [u for u in units if u]


def _hits(unit: list[str]) -> Column:
    """How often the unit occurs: start positions whose following words are in place."""
    def at(word: str) -> Column:
        return F.try_element_at("by_token", F.lit(word))

    def shifted(word: str, step: int) -> Column:
        return F.transform(at(word), lambda p: p - step)

    found = at(unit[0])
    for step, word in enumerate(unit[1:], start=1):
        found = F.array_intersect(found, shifted(word, step))
    return F.coalesce(F.size(found), F.lit(0))


def keyword(
    index: tuple[DataFrame, DataFrame], query: str, candidates: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """id, rank of the chunks that hold every unit of the query, best first. Candidates limit before ranking."""
    postings, documents = index
    units = parse_query(query)
    wanted = sorted({w for u in units for w in u})
    if not units:
        return documents.select("id", F.lit(0.0).alias("rank")).where("false")
    read = postings.filter(F.col("token").isin(wanted))
    # One entry per query word and chunk, so the map stays as small as the query.
    per_id = (
        read.groupBy("id")
        .agg(F.max("length").alias("length"), F.map_from_entries(F.collect_list(F.struct("token", "positions"))).alias("by_token"))
    )
    counted = per_id.select("id", "length", *[_hits(u).alias(f"tf{i}") for i, u in enumerate(units)])
    totals = documents.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("avg")).select(F.struct("n", "avg"))
    if all(len(u) == 1 for u in units):  # a word is in as many chunks as it has postings: no grouping by chunk
        found = read.agg(F.array(*[F.count_if(F.col("token") == u[0]) for u in units]))
    else:
        found = counted.agg(F.array(*[F.count_if(F.col(f"tf{i}") > 0) for i in range(len(units))]))
    matched = counted.filter(" AND ".join(f"tf{i} > 0" for i in range(len(units))))
    if candidates is not None:
        matched = matched.join(candidates.select("id"), "id", "left_semi")
    scored = matched.withColumn("__t", totals.scalar()).withColumn("__df", found.scalar())
    rank = F.lit(0.0)
    for i in range(len(units)):
        df, tf = F.get("__df", i), F.col(f"tf{i}")
        idf = F.log(1 + (F.col("__t.n") - df + 0.5) / (df + 0.5))
        rank = rank + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("__t.avg")))
    ranked = scored.select("id", rank.alias("rank"))
    if limit is not None:
        ranked = ranked.orderBy(F.col("rank").desc(), F.col("id").asc()).limit(limit)
    return ranked


def with_snippet(hits: DataFrame, chunks: DataFrame, query: str, before: int = 30, width: int = 120) -> DataFrame:
    """Add the text round the first place where a unit of the query stands as words; a query without words shows the beginning."""
    units = [r"[^\p{L}\p{N}]+".join(rf"\Q{w}\E" for w in u) for u in parse_query(query)]
    at = F.regexp_instr(F.lower("content"), F.lit(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(units)})(?![\p{{L}}\p{{N}}])")) if units else F.lit(1)
    start = F.greatest(F.lit(1), at - before)
    body = chunks.select("id", F.col("content").substr(start, F.lit(width)).alias("snippet"))
    return hits.join(body, "id")
