"""SimHash near-duplicates by covering locality-sensitive hashing (operator 7).

Each of the 64 bits gets one of the 31 nonzero vectors of five bits; each
nonzero vector v makes a mask of the bits whose own vector has an odd product
with v. Any four bits leave a v that is orthogonal to all of theirs, so two
fingerprints that differ in at most four bits are equal under some mask: no
pair within the radius is missed. Buckets of equal masked values are compared
inside, in blocks of bounded size if they are large, and give the edges of a
spanning forest, not all pairs. Components are found among distinct
fingerprints, so copies cost one row each.

Null text: empty; a text without words has fingerprint zero and links like any
other. Null doc_ids are documents too, but never a component's id unless all
its ids are null. Repeated rows each get a row. Extra columns are left. An
empty table gives no rows. Texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracelake.llm.components import components
from tracelake.llm.shared import slices, text_rows, work_folder, written

WORDS = 4
RADIUS = 4
SEED = 42
#: Fingerprints of a bucket that are compared as one block.
BLOCK = 2048


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of every shingle, in text order; a shorter text is one shingle, one without words has none."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return []
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return [digest(joined, SEED)]
    ends = np.cumsum([len(p) + 1 for p in parts])
    begins = np.append(0, ends[:-words]).tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(begins, (ends[words - 1:] - 1).tolist())]


def fingerprints(texts: list[str], words: int = WORDS) -> np.ndarray:
    """The SimHash of each text: a bit is set if more than half of the shingle hashes have it."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = np.array(shingle_hashes(text, words), "<u8")
        if len(hashes):
            votes = np.zeros(64, np.int64)
            for first in range(0, len(hashes), 1 << 16):
                raw = hashes[first:first + (1 << 16)].view(np.uint8).reshape(-1, 8)
                votes += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprint_column(words: int = WORDS):
    """A column function text -> fingerprint (long)."""

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        rows = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [fingerprints([t or "" for t in p.column(0).to_pylist()], words).view(np.int64) for p in slices(rows)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return fingerprint


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks of 64 bits, as signed longs."""
    n = (1 << radius + 1) - 1
    vectors = [i % n + 1 for i in range(64)]
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, n + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spanning_links(prints: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """Edges of a spanning forest of the close pairs inside each group; rows of a group are next to each other."""
    n = len(prints)
    root, rows = np.arange(n), np.arange(n)
    found = []
    shift = 1
    rows = rows[:-1][group[1:] == group[:-1]] if n else rows
    while len(rows):
        near = rows[np.bitwise_count(prints[rows] ^ prints[rows + shift]) <= radius]
        near = near[root[near] != root[near + shift]]
        for a in near.tolist():
            x, y = a, a + shift
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                found.append((a, a + shift))
        if len(near):
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
        shift += 1
        rows = rows[rows + shift < n]
        rows = rows[group[rows] == group[rows + shift]]
    return np.array(found, np.int64).reshape(-1, 2)


def _linker(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        keys = ("mask", "key", "left", "right")
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not table.num_rows:
                continue
            columns = [table.column(k).to_numpy() for k in keys]
            new = np.zeros(table.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            last = int(np.flatnonzero(new)[-1]) if new.any() else 0
            held = table.slice(last).to_batches()[0]  # the last group may go on in the next batch
            yield from _links(table.slice(0, last), np.cumsum(new)[:last], radius)
        if held is not None:
            yield from _links(pa.Table.from_batches([held]), np.zeros(held.num_rows, np.int64), radius)

    return run


def _links(table: pa.Table, group: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    if table.num_rows:
        prints = table.column("fingerprint").to_numpy()
        links = prints[spanning_links(prints.view(np.uint64), group, radius)]
        yield pa.RecordBatch.from_pydict({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})


def links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """a, b: edges that connect all distinct fingerprints within the radius. distinct: fingerprint, unique."""
    masks = [F.struct(F.lit(i).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(covering_masks(radius))]
    keyed = distinct.select("fingerprint", F.explode(F.array(*masks)).alias("k")).select("k.mask", "k.key", "fingerprint")
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    # A row makes as many as there are masks, which Spark's estimate of either side leaves out: neither is broadcast.
    rows = keyed.join(sizes.hint("merge"), ["mask", "key"]).withColumn("parts", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("mask", "key", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "fingerprint")
    place = ["mask", "key", "left", "right"]
    return rows.repartition(*place).sortWithinPartitions(*place).mapInArrow(_linker(radius), "a long, b long")


def grouped(prints: DataFrame, folder: str, radius: int = RADIUS) -> DataFrame:
    """fingerprint, root, component_id for every distinct fingerprint. prints: doc_id, fingerprint."""
    distinct = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), folder, "distinct")
    roots = components(links(distinct.select("fingerprint"), radius), folder)
    rooted = distinct.join(roots, distinct.fingerprint == roots.node, "left").select("fingerprint", "doc_id", F.coalesce("root", "fingerprint").alias("root"))
    rooted = written(rooted, folder, "rooted")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.select("fingerprint", "root").join(least, "root").select("fingerprint", "root", "component_id")


def simhash_groups(docs: DataFrame, folder: str, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per document."""
    prints = text_rows(docs).select("doc_id", fingerprint_column(words)("text").alias("fingerprint"))
    prints = written(prints, folder, "prints")
    rows = prints.join(written(grouped(prints, folder, radius), folder, "groups"), "fingerprint")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, folder: str, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One document of each group, with the columns it came with: that of the smallest doc_id (null ids last), of several the first stored."""
    names = docs.columns
    wide = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), F.monotonically_increasing_id().alias("place"))
    wide = wide.withColumn("fingerprint", fingerprint_column(words)(F.coalesce("row.text", F.lit(""))))
    wide = written(wide, folder, "rows")
    prints = wide.select(F.col("row.doc_id").cast("long").alias("doc_id"), "fingerprint", "place")
    named = prints.join(grouped(prints, folder, radius), "fingerprint")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("place"))).getField("place").alias("place")
    stay = named.groupBy("root").agg(first).select("place")
    return wide.join(stay, "place", "left_semi").select("row.*")


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_groups(spark.read.parquet(f"{sf}/documents.parquet"), work_folder(spark, "op7"))
