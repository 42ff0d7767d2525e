"""Similarity graph of sources: neighbours, centrality, hubs, bridges and communities.

Every source has at most `nearest` edges, to the sources of largest cosine. To
find them, sources are put in order by signed random projections, and compared
with those that stand near them in that order, in `tables` orders of their own.
Up to 2 * `cell` sources all are compared and the edges are exact; beyond,
the work grows in proportion to the sources, whatever group of them is alike,
and the share of true neighbours found is measured by a test.

The walk and the communities are rounds of joins and sums over the written
edges. A source without a vector, or without a neighbour of positive cosine, is
linked to itself alone: it has the average centrality, is its own community,
and is neither hub nor bridge. No source at all gives no rows. source_id is
unique and not null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as T

from tracelake.operators.ranking import top_per_group
from tracelake.session import Scratch

NEAREST = 8
#: Sources that are compared at a time with as many before and after them, and orders that are tried.
CELL, TABLES = 1024, 8
DAMPING = 0.85
STEPS = 10
ROUNDS = 8
#: Rounds of one plan; then the state is written.
WRITTEN = 5
BRIDGE_SHARE = 0.4
DIGITS = 9


def source_vectors(chunks: DataFrame) -> DataFrame:
    """Mean vector per source; the mean combines on the map side."""
    present = chunks.filter(F.col("embedding").isNotNull())
    pooled = present.groupBy("source_id").agg(Summarizer.mean(array_to_vector("embedding")).alias("m"))
    return pooled.select("source_id", vector_to_array("m").alias("embedding"))


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.float64)


def unit_vectors(sources: DataFrame) -> DataFrame:
    """source_id and the vector at length one; sources without a vector or with the zero vector are left out."""
    present = sources.select("source_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("embedding").isNotNull())
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    return present.withColumn("length", length).filter("length > 0").select(
        "source_id", F.transform("embedding", lambda x: x / F.col("length")).alias("embedding"))


def _order(dimensions: int, middle: list[float], bits: int, table: int):
    """The place of vectors in one order: signs of `bits` projections from the middle, then a further projection."""
    planes = np.random.default_rng(table).normal(size=(dimensions, bits + 1))
    weights = 1 << np.arange(bits, dtype=np.int64)

    def place(vectors: pa.Array) -> pa.Array:
        along = (_matrix(vectors) - np.asarray(middle)) @ planes if len(vectors) else np.zeros((0, bits + 1))
        cell = (along[:, :bits] > 0) @ weights
        return pa.StructArray.from_arrays([pa.array(cell.astype(np.int64)), pa.array(along[:, bits])], ["cell", "along"])

    return F.arrow_udf(place, "struct<cell: long, along: double>")


def _nearest(nearest: int, cell: int, positive: bool):
    """Rows in order, in runs of `cell`: each run is compared with itself and the runs before and after it."""

    def best(run: pa.Table, around: list[pa.Table]) -> pa.RecordBatch:
        seen = pa.concat_tables(around)
        seen = seen.take(pc.sort_indices(seen.column("source_id")))
        near = np.round(_matrix(run.column("embedding").combine_chunks()) @ _matrix(seen.column("embedding").combine_chunks()).T, DIGITS)
        # one number that orders by cosine, then by id: no ties are left to the partition below
        ranked = np.round(near * 10**DIGITS).astype(np.int64) * len(seen) - np.arange(len(seen))
        own = pc.index_in(run.column("source_id"), seen.column("source_id")).to_numpy()
        ranked[np.arange(len(run)), own] = np.iinfo(np.int64).min
        k = min(nearest, len(seen))
        top = np.argpartition(-(ranked + 1), k - 1, axis=1)[:, :k]
        row, weight = np.repeat(np.arange(len(run)), k), np.take_along_axis(near, top, axis=1).ravel()
        keep = (top.ravel() != np.repeat(own, k)) & ((weight > 0) | (not positive))
        return pa.RecordBatch.from_arrays([
            run.column("source_id").take(pa.array(row[keep])).combine_chunks(),
            seen.column("source_id").take(pa.array(top.ravel()[keep])).combine_chunks(), pa.array(weight[keep])], ["source_id", "neighbour", "weight"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[pa.Table] = []
        held: list[pa.RecordBatch] = []
        size = 0

        def close() -> None:
            runs.append(pa.Table.from_batches(held).combine_chunks())
            held.clear()

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, cell - size)
                held.append(part)
                size += part.num_rows
                batch = batch.slice(part.num_rows)
                if size == cell:
                    close()
                    size = 0
                    if len(runs) > 1:
                        yield best(runs[-2], runs[-3:])
                        del runs[:-2]
        if size:
            close()
            if len(runs) > 1:
                yield best(runs[-2], runs[-3:])
        if runs:
            yield best(runs[-1], runs[-2:])

    return run


def neighbour_edges(
    sources: DataFrame, nearest: int = NEAREST, cell: int = CELL, tables: int = TABLES, scratch: Scratch | None = None, positive: bool = True,
) -> DataFrame:
    """source_id, neighbour, weight: up to `nearest` sources of the largest positive cosine, or of any."""
    scratch = scratch or Scratch(sources.sparkSession)
    units = scratch.write("units", unit_vectors(sources))
    n = units.count()
    kind = sources.schema["source_id"].dataType
    schema = T.StructType([T.StructField("source_id", kind), T.StructField("neighbour", kind), T.StructField("weight", T.DoubleType())])
    if not n:
        return sources.sparkSession.createDataFrame([], schema)
    middle = list(units.agg(Summarizer.mean(array_to_vector("embedding")).alias("m")).first()["m"])
    bits = max(0, math.ceil(math.log2(n / (2 * cell))))
    found = None
    for table in range(tables if bits else 1):  # without a bit, all orders compare all
        placed = units.withColumn("at", _order(len(middle), middle, bits, table)("embedding"))
        placed = placed.repartitionByRange(max(1, n // (8 * cell)), "at.cell", "at.along", "source_id").sortWithinPartitions("at.cell", "at.along", "source_id")
        pairs = placed.select("source_id", "embedding").mapInArrow(_nearest(nearest, cell, positive), schema)
        found = pairs if found is None else found.union(pairs)
    if not bits:
        return found
    best = F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("w"), "neighbour")))  # at most nearest * tables
    once = found.groupBy("source_id", "neighbour").agg(F.max("weight").alias("weight"))
    top = once.groupBy("source_id").agg(F.slice(best, 1, nearest).alias("e")).select("source_id", F.explode("e").alias("e"))
    return top.select("source_id", "e.neighbour", (-F.col("e.w")).alias("weight"))


def linked_sources(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """source_id and its edges, as an array of at most `nearest`; an unlinked source has an edge to itself."""
    lists = edges.groupBy("source_id").agg(F.collect_list(F.struct("neighbour", "weight")).alias("edges"))
    itself = F.array(F.struct(F.col("source_id").alias("neighbour"), F.lit(1.0).alias("weight")))
    return sources.select("source_id").join(lists, "source_id", "left").withColumn("edges", F.coalesce("edges", itself))


def centrality(nodes: DataFrame, scratch: Scratch, steps: int = STEPS) -> DataFrame:
    """source_id, centrality: visits of a damped walk along the edges by weight, from all sources alike.

    A round sums the shares that arrive at a source, first within each task; the
    edges are dealt by source once for all rounds of a plan.
    """
    n = nodes.count()
    degree = F.aggregate("edges", F.lit(0.0), lambda s, e: s + e["weight"])
    shares = F.transform("edges", lambda e: F.struct(e["neighbour"].alias("neighbour"), (e["weight"] / degree).alias("share")))
    nodes = scratch.write("shares", nodes.select("source_id", shares.alias("edges")))
    dealt = nodes.repartition("source_id")
    ranks = nodes.select("source_id", F.lit(1.0 / n if n else 0.0).alias("centrality"))
    for step in range(1, steps + 1):
        passed = dealt.join(ranks, "source_id").select(F.explode("edges").alias("e"), "centrality")
        sums = passed.groupBy(F.col("e.neighbour").alias("source_id")).agg(F.sum(F.col("centrality") * F.col("e.share")).alias("visits"))
        ranks = dealt.select("source_id").join(sums, "source_id", "left").select(
            "source_id", ((1 - DAMPING) / max(n, 1) + DAMPING * F.coalesce("visits", F.lit(0.0))).alias("centrality"))
        if step % WRITTEN == 0 or step == steps:
            ranks = scratch.write(f"ranks-{step}", ranks)
            scratch.drop(f"ranks-{step - WRITTEN}")
    return ranks


def communities(nodes: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """source_id, community_id: labels that spread along the edges.

    A source takes the label of the largest weight among its neighbours, the
    smallest of equals. Sources take turns, by a hash of their id, so that two
    do not swap labels for ever. A label is the id of the source it began at.
    """
    turn = F.conv(F.substring(F.md5(F.col("source_id").cast("string")), 1, 1), 16, 10).cast("int") % 2
    labels = nodes.select("source_id", F.col("source_id").alias("community_id"))
    for number in range(1, rounds + 1):
        asking = nodes.where(turn == number % 2).select("source_id", F.explode("edges").alias("e")).select("source_id", "e.neighbour", "e.weight")
        told = asking.join(labels.select(F.col("source_id").alias("neighbour"), "community_id"), "neighbour")
        votes = told.groupBy("source_id", "community_id").agg(F.round(F.sum("weight"), DIGITS).alias("votes"))
        chosen = votes.groupBy("source_id").agg(F.min_by("community_id", F.struct(-F.col("votes"), "community_id")).alias("chosen"))
        labels = labels.join(chosen, "source_id", "left").select("source_id", F.coalesce("chosen", "community_id").alias("community_id"))
        labels = scratch.write(f"labels-{number}", labels)
        scratch.drop(f"labels-{number - 1}")
    return labels


def crossings(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """source_id, share, reached: the share of the weight of its edges, from it and to it, that crosses communities, and how many others it reaches.

    Both ends of an edge are given their community, then weights are summed by
    source and community, first within each task.
    """
    ends = nodes.join(labels, "source_id").select("source_id", "community_id", F.explode("edges").alias("e"))
    other = labels.select(F.col("source_id").alias("neighbour"), F.col("community_id").alias("other_id"))
    edges = ends.select("source_id", "community_id", "e.neighbour", "e.weight").join(other, "neighbour")
    there = F.struct("source_id", F.col("community_id").alias("own"), F.col("other_id").alias("far"), "weight")
    back = F.struct(F.col("neighbour").alias("source_id"), F.col("other_id").alias("own"), F.col("community_id").alias("far"), "weight")
    both = edges.select(F.explode(F.array(there, back)).alias("x")).select("x.*")
    summed = both.groupBy("source_id", "own", "far").agg(F.sum("weight").alias("weight"))
    crosses = F.col("far") != F.col("own")
    return summed.groupBy("source_id").agg(
        F.round(F.sum(F.when(crosses, F.col("weight")).otherwise(0.0)) / F.sum("weight"), DIGITS).alias("share"), F.count_if(crosses).alias("reached"))


def source_graph(
    sources: DataFrame, nearest: int = NEAREST, cell: int = CELL, tables: int = TABLES, hubs: int = 1, bridge_share: float = BRIDGE_SHARE,
) -> DataFrame:
    """source_id, centrality, is_hub, is_bridge, community_id, bridge_share, reached for vectors (source_id, embedding).

    Hubs are the `hubs` most central sources of a community of two or more;
    bridges have at least `bridge_share` of their weight across communities.
    """
    scratch = Scratch(sources.sparkSession)
    nodes = scratch.write("nodes", linked_sources(sources, neighbour_edges(sources, nearest, cell, tables, scratch)))
    ranks, labels = centrality(nodes, scratch), communities(nodes, scratch)
    ranked = labels.join(ranks, "source_id").join(crossings(nodes, labels), "source_id")
    best = top_per_group(
        ranked.select("community_id", "centrality", "source_id"), ["community_id"],
        [F.round("centrality", 12).desc(), F.col("source_id").asc()], hubs,
    ).select("source_id", F.lit(True).alias("best"))
    several = ranked.groupBy("community_id").agg((F.count("*") > 1).alias("several"))
    out = ranked.join(best, "source_id", "left").join(several, "community_id")
    flagged = out.select(
        "source_id", "centrality", F.when(F.col("best") & F.col("several"), 1).otherwise(0).alias("is_hub"),
        F.when((F.col("share") >= bridge_share) & (F.col("reached") > 0), 1).otherwise(0).alias("is_bridge"), "community_id",
        F.col("share").alias("bridge_share"), "reached")
    graph = scratch.write("graph", flagged)
    for name in ("units", "nodes", "shares", f"ranks-{STEPS}", f"labels-{ROUNDS}"):
        scratch.drop(name)
    return graph


def bridge_listing(graph: DataFrame, limit: int = 20) -> DataFrame:
    return (
        graph.filter(F.col("is_bridge") == 1).orderBy(F.round("centrality", 12).desc(), F.col("source_id").asc()).limit(limit)
    )
