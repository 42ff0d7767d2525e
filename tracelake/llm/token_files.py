"""Token ids in flat binary files (operator 1).

A shard is three files: `.bin`, unsigned integers of 16 or 32 bits, one
document after the other, each closed by the end id; `.idx`, 64-bit offsets of
the documents in it and of its end; `.doc`, the 64-bit document ids. A table
names the shards in document order; its running sums of tokens are the bases
that turn a shard's offsets into places in the whole corpus, so writers need
not wait for each other. Readers map the files into memory.

Rows are sorted by doc_id, then by hash and text, so repeated rows and ties
have a place of their own; null ids come first and stay null. A null text is
empty and holds the end id alone. Extra columns are left. An empty table gives
no shards and no rows. A task's files have a name of their own and count only
if its row arrives in the table, so retried and doubled tasks do no harm.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tracelake.llm.shared import SLICE_BYTES, cut_places, slices, text_rows, work_folder, written
from tracelake.llm.token_counts import byte_letters

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
#: Bytes of pieces and ids that a worker keeps, with what Python adds to them.
CACHE_BYTES = 128 << 20
ENTRY_BYTES, LONGEST_KEPT = 170, 64
SHARD_SCHEMA = "shard int, file string, width int, n_docs long, n_null long, n_tokens long"
#: White space but spaces and line ends.
RARE_WHITE = re.compile(r"[^\S \n]")
#: Pre-tokens of plain lines: Latin letters, digits, marks but the apostrophe, single line ends. Other lines are cut at spaces.
PLAIN = r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]++| ?[0-9]++| ?[!-&(-/:-@\[-`{-~]++|\n"
PLAIN_PART, PLAIN_LINE = re.compile(PLAIN), re.compile(f"(?:{PLAIN})++")


class PieceEncoder(dict):
    """The library's ids, as bytes, of whole texts; holds what it gave for pieces that no pre-token crosses.

    Plain lines are split into their pre-tokens, which repeat more often than words with their marks. What is kept is
    bounded by bytes: a full table becomes the old one, from which what is used again comes back.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.type = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.code = "H" if self.type.itemsize == 2 else "I"
        self.end = np.array([end_id], self.type).tobytes()
        self.old: dict[str, bytes] = {}
        self.held = 0
        self.spelling = {byte: letter for letter, byte in byte_letters().items()}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.found(piece)
        if len(piece) <= LONGEST_KEPT:
            if self.held > CACHE_BYTES // 2:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self.held += ENTRY_BYTES + 4 * len(piece) + len(ids)
            self[piece] = ids
        return ids

    def found(self, piece: str) -> bytes:
        """The library's model on one pre-token, spelled in its byte letters; the whole library on other pieces."""
        if PLAIN_PART.fullmatch(piece):
            spelled = piece.encode().decode("latin-1").translate(self.spelling)
            return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return array(self.code, self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def pieces(self, line: str) -> list[str]:
        if PLAIN_LINE.fullmatch(line) and not any(s in line for s in self.special):
            return PLAIN_PART.findall(line)
        first, *words = line.split(" ")
        return [first, *[" " + w for w in words]]

    def encode(self, text: str) -> bytes:
        """A cut before a space, or on both sides of a line end, changes no token if it stands between two other characters."""
        if not text:
            return self.end
        get = self.__getitem__
        if "  " in text or "\n " in text or " \n" in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n" or RARE_WHITE.search(text):
            places = [0, *cut_places(text, 1), len(text)]
            return b"".join([get(text[a:b]) for a, b in zip(places, places[1:])]) + self.end
        line_end = get("\n")
        return line_end.join([b"".join(map(get, self.pieces(line))) for line in text.split("\n")]) + self.end


_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def encoder(path: str, end_id: int) -> PieceEncoder:
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = PieceEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def _writer(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, end_id)
        shard = TaskContext.get().partitionId()
        docs = nulls = tokens = 0
        fs, place = pyarrow.fs.FileSystem.from_uri(folder)
        stem = f"{place}/part-{shard:06d}-{uuid.uuid4().hex}"
        streams = None
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                if streams is None:
                    fs.create_dir(place, recursive=True)
                    streams = [fs.open_output_stream(f"{stem}.{kind}") for kind in ("bin", "idx", "doc")]
                ids = part.column("doc_id")
                offsets = np.empty(part.num_rows, "<i8")
                for i, text in enumerate(part.column("text").to_pylist()):
                    raw = own.encode(text)
                    offsets[i] = tokens
                    tokens += len(raw) // own.type.itemsize
                    streams[0].write(raw)
                streams[1].write(offsets.tobytes())
                streams[2].write(np.asarray(ids.fill_null(0), "<i8").tobytes())
                docs += part.num_rows
                nulls += ids.null_count
        if streams is None:
            return
        streams[1].write(np.array([tokens], "<i8").tobytes())
        for stream in streams:
            stream.close()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "file": [stem.removeprefix(place + "/")], "width": pa.array([own.type.itemsize], pa.int32()),
            "n_docs": [docs], "n_null": [nulls], "n_tokens": [tokens]})

    return run


def write_tokens(docs: DataFrame, folder: str, path: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write the shards into the folder and return their table, in document order."""
    by_place = [F.col("doc_id").asc_nulls_first(), F.col("text_hash"), F.col("text")]
    rows = text_rows(docs).withColumn("text_hash", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "text_hash").sortWithinPartitions(*by_place)
    return written(rows.select("doc_id", "text").mapInArrow(_writer(f"{folder}/tokens", path, end_id), SHARD_SCHEMA), folder, "shards")


def with_bases(shards: DataFrame) -> DataFrame:
    """Documents and tokens before each shard: running sums over the shard table, which has one row per task."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("token_base"))


def mapped(fs: pyarrow.fs.FileSystem, file: str, kind: str) -> np.ndarray:
    """A file as an array: mapped into memory where the folder is mounted, else read whole."""
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        return np.memmap(file, kind, "r") if os.path.getsize(file) else np.zeros(0, kind)
    with fs.open_input_file(file) as f:
        return np.frombuffer(f.read(), kind)


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard in batch.to_pylist():
                stem = f"{place}/{shard['file']}"
                tokens = mapped(fs, f"{stem}.bin", f"<u{shard['width']}")
                offsets, ids = mapped(fs, f"{stem}.idx", "<i8"), mapped(fs, f"{stem}.doc", "<i8")
                for first in range(0, shard["n_docs"], 10_000):
                    last = min(first + 10_000, shard["n_docs"])
                    cuts = offsets[first:last + 1].tolist()
                    sums = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
                    missing = np.arange(first, last) < shard["n_null"]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(ids[first:last], pa.int64(), mask=missing),
                        "start": pa.array(offsets[first:last] + shard["token_base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(offsets[first:last + 1]), pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64())})

    return run


def read_back(shards: DataFrame, folder: str) -> DataFrame:
    """Per document from the files: doc_id, its place in the corpus, its tokens, and their checksum."""
    rows = with_bases(shards).repartition(max(1, shards.count()), "shard")
    return rows.mapInArrow(_reader(f"{folder}/tokens"), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "op1")
    return read_back(write_tokens(spark.read.parquet(f"{sf}/documents.parquet"), folder), folder)
