"""Benchmark decontamination by greedy string tiling (operator 6).

Words are compared in lower case without marks. Seeds are runs of five words
of a benchmark item; a document that shares seeds with an item is tiled
against it: the longest common run of words not yet marked is found by
rolling hashes, checked word by word and marked in both, until no run of five
is left. A document holds an item if the tiles cover at least half of its
words, wherever in the document and in whatever order they stand.

The benchmark is a stated query set: its size is summed first and it goes to
the tasks in blocks of bounded size; documents are read once per block and
never shuffled. A seed that many items or documents share costs candidates
only: a pair whose shared seeds cannot reach the threshold is not tiled.

Null text, in either table: empty, holds nothing and is held by nothing. An
item of fewer than five words counts as one seed. Null and repeated ids are
kept as they are, a repeated item is reported for each of its rows. Extra
columns are left. With an empty table there are no matches.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracelake.llm.shared import slices, text_rows

SEED_WORDS = 5
COVERAGE = 0.5
#: Bytes of benchmark text that are sent to the tasks at a time.
BLOCK_BYTES = 8 << 20
WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
MATCHES = "array<struct<item_id:long,covered:int,item_words:int,tiles:int>>"
_KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("covered", pa.int32()), ("item_words", pa.int32()), ("tiles", pa.int32())]))


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` ids, modulo 2^64."""
    if len(ids) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(ids) - size + 1, np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = out * _FACTOR + mixed[i:i + len(out)]
    return out


def _common_runs(item: np.ndarray, text: np.ndarray, free_item: np.ndarray, free_text: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Places of equal unmarked runs of `size` words, by place in the item."""
    open_item = np.flatnonzero(np.convolve(free_item, np.ones(size, np.int64), "valid") == size) if len(item) >= size else []
    open_text = np.flatnonzero(np.convolve(free_text, np.ones(size, np.int64), "valid") == size) if len(text) >= size else []
    if not len(open_item) or not len(open_text):
        return []
    a, b = rolling(item, size)[open_item], rolling(text, size)[open_text]
    order = np.argsort(b, kind="stable")
    low, high = np.searchsorted(b[order], a, "left"), np.searchsorted(b[order], a, "right")
    found = []
    for i, x, y in zip(open_item.tolist(), low.tolist(), high.tolist()):
        found += [(i, j) for j in open_text[order[x:y]].tolist() if np.array_equal(item[i:i + size], text[j:j + size])]
    return found


def tiling(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in text, words), longest first; negative ids match nothing."""
    free_item, free_text = np.ones(len(item), np.int64), (text >= 0).astype(np.int64)
    tiles, longest = [], min(len(item), len(text))
    while longest >= least:
        low, high, runs = least, longest, []
        while low <= high:  # a common run of some length holds common runs of all smaller ones
            size = (low + high) // 2
            here = _common_runs(item, text, free_item, free_text, size)
            if here:
                low, runs, longest = size + 1, here, size
            else:
                high = size - 1
        if not runs:
            break
        for i, j in runs:
            if free_item[i:i + longest].all() and free_text[j:j + longest].all():
                free_item[i:i + longest] = free_text[j:j + longest] = 0
                tiles.append((i, j, longest))
    return tiles


class Items:
    """A block of benchmark items, indexed by seed."""

    def __init__(self, rows: list[tuple[int, str]], seed_words: int, coverage: float):
        self.seed_words, self.coverage = seed_words, coverage
        self.words: dict[str, int] = {}
        self.ids, self.items = [], []
        for item_id, text in rows:
            words = WORD.findall((text or "").lower())
            if words:
                self.ids.append(item_id)
                self.items.append(np.array([self.words.setdefault(w, len(self.words)) for w in words], np.int64))
        self.sizes = sorted({min(seed_words, len(i)) for i in self.items})
        self.places: dict[int, dict[int, list[tuple[int, int]]]] = {s: {} for s in self.sizes}
        for n, item in enumerate(self.items):
            size = min(seed_words, len(item))
            for at, seed in enumerate(rolling(item, size).tolist()):
                self.places[size].setdefault(seed, []).append((n, at))
        self.seeds = {s: np.array(sorted(p), np.uint64) for s, p in self.places.items()}

    def matches(self, texts: list[str]) -> list[list[dict]]:
        get, spans, ids = self.words.get, [], []
        for text in texts:
            first = len(ids)
            ids += [get(w, -1) for w in WORD.findall(text.lower())]
            spans.append((first, len(ids)))
            ids.append(-1)
        ids = np.array(ids, np.int64)
        shared: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        ends = np.array([b for _, b in spans])
        unknown = np.append(0, np.cumsum(ids < 0))
        for size in self.sizes:
            hashes = rolling(ids, size)
            whole = np.flatnonzero(unknown[size:] == unknown[:-size])
            seeds = self.seeds[size]
            at = np.searchsorted(seeds, hashes[whole])
            hits = whole[(at < len(seeds)) & (seeds[np.minimum(at, len(seeds) - 1)] == hashes[whole])]
            for place, seed in zip(hits.tolist(), hashes[hits].tolist()):
                doc = int(np.searchsorted(ends, place, "right"))
                for n, item_place in self.places[size][seed]:
                    shared.setdefault(doc, {}).setdefault(n, []).append((item_place, place, size))
        out: list[list[dict]] = [[] for _ in texts]
        for doc, by_item in shared.items():
            for n in sorted(by_item):
                found = self._tiled(n, by_item[n], ids)
                if found:
                    out[doc].append(found)
        return out

    def _tiled(self, n: int, seeds: list[tuple[int, int, int]], ids: np.ndarray) -> dict | None:
        item = self.items[n]
        reachable = np.zeros(len(item), bool)
        for at, _, size in seeds:
            reachable[at:at + size] = True
        if reachable.sum() < self.coverage * len(item):
            return None
        parts, end = [], -1
        for place in sorted({p for _, p, _ in seeds}):  # only where seeds lie can tiles lie
            stop = place + min(self.seed_words, len(item))
            if place > end:
                parts.append(np.array([-1]))
                end = place
            parts.append(ids[max(place, end):stop])
            end = stop
        tiles = tiling(item, np.concatenate(parts), min(self.seed_words, len(item)))
        covered = sum(size for _, _, size in tiles)
        if covered < self.coverage * len(item):
            return None
        return {"item_id": self.ids[n], "covered": covered, "item_words": len(item), "tiles": len(tiles)}


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[list[tuple[int, str]]]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    return [sorted((tuple(r) for r in rows.where(part == i).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])) for i in range(n)]


def _matcher(rows: list[tuple[int, str]], seed_words: int, coverage: float):
    held: list[Items] = []

    @F.arrow_udf(MATCHES)
    def matched(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Items(rows, seed_words, coverage))
        out = []
        for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"])):
            out += held[0].matches([t or "" for t in part.column(0).to_pylist()])
        return pa.array(out, _KIND)

    return matched


def matches(docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, covered, item_words, tiles: every document with every item it holds."""
    rows = text_rows(docs)
    out = rows.where("false").selectExpr("doc_id", "doc_id AS item_id", "0 AS covered", "0 AS item_words", "0 AS tiles")
    for block in _blocks(benchmark, block_bytes):
        found = rows.select("doc_id", F.explode(_matcher(block, seed_words, coverage)("text")).alias("m"))
        out = out.union(found.select("doc_id", "m.item_id", "m.covered", "m.item_words", "m.tiles"))
    return out


def without_matches(docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that hold no item, as they came."""
    for block in _blocks(benchmark, block_bytes):
        docs = docs.where(F.size(_matcher(block, seed_words, coverage)(F.coalesce(docs["text"], F.lit("")))) == 0)
    return docs


def op6_decontam(spark: SparkSession, sf: str) -> DataFrame:
    return matches(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
