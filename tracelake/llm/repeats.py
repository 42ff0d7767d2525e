"""Exact repeats across documents, column by column (operator 8).

A byte goes if a 50-byte string that covers it also starts in a document with
a smaller doc_id. Sorting all suffixes of the corpus one symbol a round would
take as many rounds as the longest text has bytes, each over all that was
inserted before; so the collection that is built column by column holds only
the places where it can matter, and those are found first:

1. Every 50-byte string has one anchor, its 16-byte string of least hash (the
   first of equal ones). Strings in a row that share an anchor form a stretch
   of 50 to 84 bytes; one byte in about 18 is an anchor.
2. Stretches are exchanged by anchor as hashes, each once per block of
   documents. One whose bytes also stand in a smaller document goes whole.
   One whose anchor occurs nowhere else, or only in equal bytes, stays whole.
3. What is left are stretches with a shared anchor and different bytes: the
   edges of repeats. Their bytes form collections of strings aligned at the
   anchor. Each round inserts one symbol of every string, the next column, and
   updates the order of the strings by what was read so far (a positional
   Burrows-Wheeler transform) and the common lengths of neighbours. The columns
   are written to a file and read from it one after the other. Where the common
   length reaches 50, neighbours share that string, and the smallest doc_id of
   each run decides.
4. Every block cuts the strings found out of its texts.

Blocks are compressed files in the work folder, so texts are never shuffled;
equal stretches of a block cost one entry however many documents hold them.
Hashes have 64 bits; two stretches count as equal if anchor hash and stretch
hash both agree.

Null text: empty. A null doc_id counts as larger than any other. Documents of
equal doc_id take nothing from each other. Matches never cross documents.
Extra columns are left. An empty table gives no rows. Texts of any length are
worked through whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracelake.llm.shared import slices, text_rows, work_folder, written

LENGTH = 50
ANCHOR = 16
SPAN = LENGTH - ANCHOR  # places before an anchor at which a string may start
WIDTH = LENGTH + SPAN
BLOCK_BYTES = 4 << 20
#: Bytes of text per bin of the exchanges, and per task that works on blocks.
BIN_BYTES = 16 << 20
CHUNK = 1 << 20
NO_ID = (1 << 63) - 1
MIX = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) | 1) for i in range(16)]
SCHEMA = "bin int, block string, payload binary"
ENTRY = np.dtype([("anchor", "<u8"), ("bytes", "<u8"), ("doc", "<i8")])
EDGE = np.dtype([("doc", "<i8"), ("low", "u1"), ("high", "u1"), ("text", "u1", (WIDTH,))])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * MIX[3]
    x ^= x >> np.uint64(29)
    x = x * MIX[5]
    return x ^ (x >> np.uint64(32))


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as an integer; zeros follow the end."""
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    out = np.empty(len(raw) + 8, np.uint64)
    for k in range(8):
        part = padded[k:k + (len(out) - k + 7) // 8 * 8].view("<u8") if (len(padded) - k) % 8 == 0 else padded[k:k + (len(padded) - k) // 8 * 8].view("<u8")
        out[k::8] = part[:len(out[k::8])]
    return out


class Stretches:
    """The stretches of a block: anchor, first and last start, document, and hashes of anchor and bytes."""

    def __init__(self, data: bytes, ends: np.ndarray):
        raw = np.frombuffer(data, np.uint8)
        begins = np.append(0, ends[:-1]) if len(ends) else ends
        step = np.zeros(len(raw) + 1, np.int32)  # places from which no string of full length starts in its document
        np.add.at(step, np.maximum(begins, ends - LENGTH + 1), 1)
        np.add.at(step, ends, -1)
        whole = np.cumsum(step[:-1]) == 0
        found: list[tuple] = []
        for first in range(0, len(raw), CHUNK):
            found.append(self._chunk(raw[first:first + CHUNK + WIDTH], whole[first:first + CHUNK], first))
        parts = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in zip(*found)] or [np.zeros(0, np.int64)] * 4
        self.anchor, self.low, self.high, self.hash = parts[0], parts[1], parts[2], parts[3].astype(np.uint64)
        if len(self.anchor):  # a stretch that goes over the end of a chunk was found in two parts
            joins = (self.anchor[1:] == self.anchor[:-1]) & (self.low[1:] == self.high[:-1] + 1)
            start = np.flatnonzero(np.append(True, ~joins))
            self.high = self.high[np.append(start[1:], len(joins) + 1) - 1]
            self.anchor, self.low, self.hash = self.anchor[start], self.low[start], self.hash[start]
        self.doc = np.searchsorted(ends, self.low, "right")
        self.bytes = self._digest(raw)

    @staticmethod
    def _chunk(raw: np.ndarray, whole: np.ndarray, base: int) -> tuple:
        n = len(whole)
        places = len(raw) - ANCHOR + 1
        none = np.zeros(0, np.int64)
        if places < 1 or not whole.any():
            return none, none, none, none.astype(np.uint64)
        words = _words(raw)
        hashes = _mixed(words[:places] * MIX[0] + _mixed(words[8:8 + places] ^ MIX[1]))
        del words
        key = (hashes & ~np.uint64((1 << 22) - 1)) | np.arange(places, dtype=np.uint64)
        reach = 1
        while 2 * reach <= SPAN + 1:  # the least of ever more places from each on
            key = np.minimum(key[:-reach], key[reach:]) if len(key) > reach else key[:0]
            reach *= 2
        rest = SPAN + 1 - reach
        key = np.minimum(key[:-rest], key[rest:]) if len(key) > rest else key[:0]
        key = key[:n]
        starts = np.flatnonzero(whole[:len(key)])
        at = (key[starts] & np.uint64((1 << 22) - 1)).astype(np.int64)
        if not len(starts):
            return none, none, none, none.astype(np.uint64)
        new = np.append(True, (np.diff(at) != 0) | (np.diff(starts) != 1))
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(starts)) - 1
        return at[firsts] + base, starts[firsts] + base, starts[lasts] + base, hashes[at[firsts]]

    def _digest(self, raw: np.ndarray) -> np.ndarray:
        """A hash of each stretch's bytes and the anchor's place in it: eight bytes from the front at a time, then from the back."""
        out = ((self.high - self.low) * 64 + (self.anchor - self.low)).astype(np.uint64) * MIX[2]
        stop = self.high + LENGTH
        for i in range(6):
            out = _mixed(out ^ (_at(raw, self.low + 8 * i) * MIX[4 + i]))
        for i in range(5):
            out = _mixed(out ^ (_at(raw, stop - 8 - 8 * i) * MIX[10 + i]))
        return out

    def entries(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair of hashes once, with the smallest doc_id, sorted; and which entry belongs to each stretch."""
        own = ids[self.doc] if len(self.doc) else np.zeros(0, np.int64)
        order = np.lexsort((own, self.bytes, self.hash))
        a, b = self.hash[order], self.bytes[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(order) else np.zeros(0, bool)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        firsts = order[new]
        out = np.empty(len(firsts), ENTRY)
        out["anchor"], out["bytes"], out["doc"] = self.hash[firsts], self.bytes[firsts], own[firsts]
        self.example = firsts
        return out, which


def _at(raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as an integer."""
    out = np.zeros(len(places), np.uint64)
    for k in range(8):
        out |= raw[places + k].astype(np.uint64) << np.uint64(8 * k)
    return out


class Block:
    """Documents in a file of the work folder."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, texts: list[bytes]):
        self.ids, self.missing, self.data = ids, missing, b"".join(texts)
        self.ends = np.cumsum([len(t) for t in texts]).astype(np.int64)

    def save(self, folder: str, name: str) -> None:
        body = len(self.ids).to_bytes(8, "little") + self.ids.astype("<i8").tobytes() + self.missing.astype("u1").tobytes() + self.ends.astype("<i8").tobytes() + self.data
        fs, place = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(place, recursive=True)
        hidden = f"{place}/.{name}-{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(hidden) as f:
            f.write(zstandard.ZstdCompressor(level=1).compress(body))
        fs.move(hidden, f"{place}/{name}")  # a retried task writes the same again

    @classmethod
    def load(cls, folder: str, name: str) -> Block:
        fs, place = pyarrow.fs.FileSystem.from_uri(folder)
        with fs.open_input_file(f"{place}/{name}") as f:
            body = zstandard.ZstdDecompressor().decompress(f.read())
        n = int.from_bytes(body[:8], "little")
        out = cls.__new__(cls)
        out.ids = np.frombuffer(body, "<i8", n, 8)
        out.missing = np.frombuffer(body, "u1", n, 8 + 8 * n).astype(bool)
        out.ends = np.frombuffer(body, "<i8", n, 8 + 9 * n)
        out.data = body[8 + 17 * n:]
        return out


def _rows(rows: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
    bins, names, payloads = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), pa.array(names, pa.string()), pa.array(payloads, pa.binary())], names=["bin", "block", "payload"])


def _by_bin(entries: np.ndarray, bins: int) -> list[np.ndarray]:
    """Positions of the entries of each bin."""
    own = (entries["anchor"] % np.uint64(bins)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    return np.split(order, np.searchsorted(own[order], np.arange(1, bins)))


def _blocks(folder: str, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for part in slices(batch, limit=BLOCK_BYTES):
                ids = part.column("doc_id")
                texts = [t.encode("utf-8", "surrogatepass") for t in part.column("text").to_pylist()]
                block = Block(np.asarray(ids.fill_null(NO_ID), np.int64), np.asarray(ids.is_null()), texts)
                name = f"{TaskContext.get().partitionId():06d}-{number:06d}-{hashlib.md5(block.data).hexdigest()}"
                number += 1
                block.save(folder, name)
                entries, _ = Stretches(block.data, block.ends).entries(block.ids)
                rows = [(b, name, entries[at].tobytes()) for b, at in enumerate(_by_bin(entries, bins)) if len(at)]
                yield _rows(rows or [(0, name, b"")])

    return run


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """The rows of one key at a time; they stand next to each other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != held[0][key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per entry of a bin: 1 if a smaller document has the same bytes, 2 if the anchor occurs with other bytes."""
    for rows in _grouped(batches, "bin"):
        entries = np.frombuffer(b"".join(r["payload"] for r in rows), ENTRY)
        order = np.lexsort((entries["doc"], entries["bytes"], entries["anchor"]))
        a, b, doc = (entries[f][order] for f in ("anchor", "bytes", "doc"))
        flags = np.zeros(len(order), np.uint8)
        if len(order):
            new_a = np.append(True, a[1:] != a[:-1])
            new_b = new_a | np.append(True, b[1:] != b[:-1])
            first = np.flatnonzero(new_b)
            least = doc[first][np.cumsum(new_b) - 1]
            kinds = np.add.reduceat(new_b.astype(np.int64), np.flatnonzero(new_a))[np.cumsum(new_a) - 1]
            flags[order] = (least < doc).astype(np.uint8) | ((kinds > 1).astype(np.uint8) << 1)
        sizes = [len(r["payload"]) // ENTRY.itemsize for r in rows]
        yield _rows([(r["bin"], r["block"], part.tobytes()) for r, part in zip(rows, np.split(flags, np.cumsum(sizes)[:-1]))])


def _flagged(block: Block, rows: list[dict], bins: int) -> tuple[Stretches, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    stretches = Stretches(block.data, block.ends)
    entries, which = stretches.entries(block.ids)
    flags = np.zeros(len(entries), np.uint8)
    own = _by_bin(entries, bins)
    for row in rows:
        if row["kind"] == 0 and row["payload"]:
            flags[own[row["bin"]]] = np.frombuffer(row["payload"], np.uint8)
    return stretches, entries, which, flags, own


def _edges(folder: str, bins: int):
    """The bytes of the entries that only a comparison can decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "block"):
            block = Block.load(folder, rows[0]["block"])
            stretches, entries, _, flags, own = _flagged(block, rows, bins)
            raw = np.concatenate([np.zeros(SPAN, np.uint8), np.frombuffer(block.data, np.uint8), np.zeros(WIDTH, np.uint8)])
            out = []
            for number, members in enumerate(own):
                members = members[flags[members] == 2]
                if not len(members):
                    continue
                at = stretches.example[members]
                edges = np.zeros(len(at), EDGE)
                edges["doc"] = entries["doc"][members]
                edges["low"] = stretches.low[at] - stretches.anchor[at] + SPAN
                edges["high"] = stretches.high[at] - stretches.anchor[at] + SPAN
                columns = np.arange(WIDTH)
                text = raw[stretches.anchor[at][:, None] + columns]
                inside = (columns >= edges["low"][:, None]) & (columns < edges["high"][:, None] + LENGTH)
                edges["text"] = np.where(inside, text, 0)
                out.append((number, rows[0]["block"], zstandard.ZstdCompressor(level=1).compress(edges.tobytes())))
            if out:
                yield _rows(out)

    return run


def column_insertion(columns: Iterator[np.ndarray], docs: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per string the starts, as bits, whose 50 bytes a string of a smaller document shares.

    columns: WIDTH arrays with one symbol of every string. `order` sorts the
    strings by what was read, last symbol first; `since` is the column from
    which on a string agrees with the one before it in that order.
    """
    n = len(docs)
    order, since = np.arange(n), np.zeros(n, np.int64)
    out = np.zeros(n, np.uint64)
    for j, column in enumerate(columns):
        symbols = column[order]
        moved = np.argsort(symbols, kind="stable")
        fresh = np.full(n, j + 1, np.int64)
        sorted_symbols = symbols[moved]
        begins = np.flatnonzero(np.append(True, sorted_symbols[1:] != sorted_symbols[:-1]))
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), n]):
            if b - a > 1:  # neighbours of one symbol agree since the latest break between them
                places = moved[a:b]
                fresh[a + 1:b] = np.maximum.reduceat(since[:places[-1] + 1], places[:-1] + 1)
        order, since = order[moved], fresh
        start = j - LENGTH + 1
        if start >= 0:
            valid = (low[order] <= start) & (start <= high[order])
            run = np.append(True, since[1:] > start)
            firsts = np.flatnonzero(run)
            least = np.minimum.reduceat(np.where(valid, docs[order], NO_ID), firsts)[np.cumsum(run) - 1]
            hit = order[valid & (least < docs[order])]
            out[hit] |= np.uint64(1 << start)
    return out


def _compare(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(place, recursive=True)
        for rows in _grouped(batches, "bin"):
            parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(r["payload"]), EDGE) for r in rows]
            edges = np.concatenate(parts)
            file = f"{place}/{rows[0]['bin']:06d}-{TaskContext.get().taskAttemptId()}.columns"
            with fs.open_output_stream(file) as f:
                for j in range(WIDTH):
                    f.write(np.ascontiguousarray(edges["text"][:, j]).tobytes())
            docs, low, high, n = edges["doc"].copy(), edges["low"].astype(np.int64), edges["high"].astype(np.int64), len(edges)
            sizes = [len(p) for p in parts]
            del parts, edges
            with fs.open_input_stream(file) as f:
                found = column_insertion((np.frombuffer(f.read(n), np.uint8) for _ in range(WIDTH)), docs, low, high)
            fs.delete_file(file)
            yield _rows([(r["bin"], r["block"], part.tobytes()) for r, part in zip(rows, np.split(found, np.cumsum(sizes)[:-1]))])

    return run


def _cut(folder: str, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "block"):
            block = Block.load(folder, rows[0]["block"])
            stretches, entries, which, flags, own = _flagged(block, rows, bins)
            shared = np.zeros(len(entries), np.uint64)
            for row in rows:
                if row["kind"] == 1:
                    members = own[row["bin"]]
                    shared[members[flags[members] == 2]] = np.frombuffer(row["payload"], "<u8")
            gone = np.zeros(len(block.data) + 1, np.int64)
            if len(which):
                whole = (block.ids[stretches.doc] > entries["doc"][which]) | (flags[which] & 1 == 1)
                np.add.at(gone, stretches.low[whole], 1)
                np.add.at(gone, stretches.high[whole] + LENGTH, -1)
                some = ~whole & (shared[which] != 0)
                starts, bits = stretches.anchor[some] - SPAN, shared[which[some]]
                for s in range(SPAN + 1):
                    hit = starts[(bits >> np.uint64(s)) & np.uint64(1) == 1] + s
                    np.add.at(gone, hit, 1)
                    np.add.at(gone, hit + LENGTH, -1)
            yield _result(block, np.cumsum(gone[:-1]) > 0)

    return run


def _result(block: Block, gone: np.ndarray) -> pa.RecordBatch:
    raw = np.frombuffer(block.data, np.uint8)
    begins = np.append(0, block.ends[:-1])
    removed, spans, digests = [], [], []
    for a, b in zip(begins.tolist(), block.ends.tolist()):
        own = gone[a:b]
        n = int(own.sum())
        removed.append(n)
        spans.append(int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if n else 0)
        digests.append(hashlib.sha256(raw[a:b][~own].tobytes() if n else block.data[a:b]).hexdigest())
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(block.ids, pa.int64(), mask=block.missing), "n_bytes": pa.array(block.ends - begins, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
        "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def without_repeats(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document."""
    rows = text_rows(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = max(1, -(-size // BIN_BYTES))
    files, columns = f"{folder}/blocks", f"{folder}/columns"

    def gathered(df: DataFrame, *keys: str) -> DataFrame:
        return df.repartition(bins, keys[0]).sortWithinPartitions(*keys)

    flags = gathered(rows.mapInArrow(_blocks(files, bins), SCHEMA), "bin", "block").mapInArrow(_judge, SCHEMA)
    flags = written(flags.withColumn("kind", F.lit(0)), folder, "flags")
    edges = gathered(flags, "block", "bin").mapInArrow(_edges(files, bins), SCHEMA)
    shared = written(gathered(edges, "bin", "block").mapInArrow(_compare(columns), SCHEMA).withColumn("kind", F.lit(1)), folder, "shared")
    known = gathered(flags.union(shared), "block", "kind", "bin")
    return known.mapInArrow(_cut(files, bins), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op8_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf}/documents.parquet"), work_folder(spark, "op8"))
