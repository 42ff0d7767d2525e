"""Byte-level BPE encoding and decoding (operator 4).

Pre-tokens come from the class scan of `pretokens`; each is looked up in a
cache of packed ids, and a miss is merged pair by pair: always the leftmost
pair of lowest rank. Ids and the byte offsets of the tokens allow decoding of
any stretch. The cache is bounded; it changes no result.

Null text: empty. Empty text: no ids; both hashes are those of no bytes. Rows
that repeat are encoded one by one, extra columns are left, an empty table
gives no rows. Very long texts are cut where no pre-token can cross.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tracelake.llm.pretokens import boundaries
from tracelake.llm.shared import SLICE_BYTES, cut_places, per_slice, text_rows

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CACHE_ENTRIES = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: while any two neighbours make a token, join the leftmost pair of lowest rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 200:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    costs = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while costs:
        least = min(costs)
        if least == none:
            break
        i = costs.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del costs[i]
        if i < len(costs):
            costs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            costs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs over linked parts, for very long pre-tokens."""
    n = len(piece)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, end[j], after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(piece[i:end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if before[i] >= 0 and (r := ranks.get(piece[before[i]:end[i]])) is not None:
            heapq.heappush(heap, (r, before[i], end[i]))
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class ByteBpe:
    """Encoder and decoder over one rank file; the cache holds the packed ids of pre-tokens."""

    def __init__(self, path: str = RANKS):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.sizes = np.zeros(max(self.tokens) + 1, np.int64)
        self.sizes[list(self.tokens)] = [len(t) for t in self.tokens.values()]
        self.cache: dict[bytes, bytes] = {}

    def packed(self, piece: bytes) -> bytes:
        ids = self.cache.get(piece)
        if ids is None:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            ids = self.cache[piece] = np.array(merge_pairs(piece, self.ranks), "<u4").tobytes()
        return ids

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        pieces = [t.encode("utf-8", "surrogatepass") for t in texts]
        ends = np.cumsum([len(p) for p in pieces])
        data = b"".join(pieces)
        firsts = np.unique(np.append(0, ends[:-1])) if pieces else np.zeros(0, np.int64)
        begins = boundaries(data, firsts[firsts < len(data)])
        stops = np.append(begins[1:], len(data)).tolist()
        get, packed = self.cache.get, self.packed
        ids = [get(w := data[a:b]) or packed(w) for a, b in zip(begins.tolist(), stops)]
        to = np.searchsorted(begins, ends).tolist()
        return [b"".join(ids[a:b]) for a, b in zip([0, *to[:-1]], to)]

    def encode(self, text: str) -> np.ndarray:
        """Long texts are cut first, so that memory stays bounded by the pieces."""
        places = [0, *cut_places(text, SLICE_BYTES), len(text)]
        return np.frombuffer(b"".join(self.encode_all([text[a:b]])[0] for a, b in zip(places, places[1:])), "<u4")

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each token begins, and the end of the last."""
        return np.append(0, np.cumsum(self.sizes[ids]))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_CODECS: dict[str, ByteBpe] = {}


def codec(path: str = RANKS) -> ByteBpe:
    if path not in _CODECS:
        _CODECS[path] = ByteBpe(path)
    return _CODECS[path]


def _encoded(path: str, with_ids: bool):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = codec(path)
        texts = batch.column("text").to_pylist()
        if len(texts) == 1:
            packed = [bpe.encode(texts[0]).tobytes()]
        else:
            packed = bpe.encode_all(texts)
        counts, digests, decoded, lists = [], [], [], []
        for raw in packed:
            ids = np.frombuffer(raw, "<u4")
            counts.append(len(ids))
            digests.append(hashlib.sha256(raw).hexdigest())
            decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            if with_ids:
                lists.append(ids.astype(np.int32))
        columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                   "ids_sha256": pa.array(digests, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
        if with_ids:
            columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return work


def encode(docs: DataFrame, path: str = RANKS, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids. One pass, no shuffle."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return text_rows(docs).mapInArrow(per_slice(_encoded(path, with_ids)), schema)


def decode(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id and text of rows with ids."""

    def run(batches):
        bpe = codec(path)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf}/documents.parquet"), with_ids=False)
