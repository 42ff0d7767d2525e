"""Packing documents into fixed windows, sum-of-squares online (operator 13).

A document's ids (the library's, and an end id) go into windows of 2048. Whole
windows of a long document are closed at once; its rest, or a short document,
goes to the fill level that makes the sum of squared counts of partially filled
windows smallest, a new window included. The counts stand in a level array, the
windows of a level in a stack. Every task packs its own part of the input, in
the order it is read; nothing is shuffled.

Documents may be cut, so no id need be padded: when more than `most_open`
windows are open (a bound on memory, met where many documents of one length
leave no partner), those of the commonest level are joined and cut into full
ones; at the end of a task the open windows are joined and cut likewise, and
what is left, less than a window, goes into windows whose sizes are powers of
two. At most eleven of these stand at the end of each task.

The pieces are written as a table with their ids. Windows are numbered within
the task; running sums over the tasks make the numbers those of the corpus. A
lost task is packed anew as a whole before its rows count.

A null text is empty and holds the end id alone. Null ids stay null; repeated
rows are packed each; extra columns are left; an empty table gives no rows. A
very long text is encoded in parts; its text and ids are held, no list of its
words.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tracelake.llm.shared import slices, text_rows, work_folder, written
from tracelake.llm.token_counts import byte_letters

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
WINDOW = 2048
MOST_OPEN = 4096
#: Bytes of words and ids that a worker keeps, with what Python adds to them.
CACHE_BYTES = 128 << 20
ENTRY_BYTES, LONGEST_KEPT = 170, 64
#: Characters encoded at a time.
PART = 1 << 18
#: No pre-token of the vocabulary crosses white space or goes on at a digit, and nothing is composed with either.
APART = re.compile(r"[ \n0-9]")
#: Pre-tokens of plain lines: Latin letters, one digit, marks but the apostrophe and what opens a special token.
PLAIN = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]++|[0-9]|[!-&(-/:;=-@\[-`{-~]++"
PLAIN_PART, PLAIN_LINE = re.compile(PLAIN), re.compile(f"(?: |{PLAIN})++")
ROWS = 4096
SCHEMA = "part int, window long, offset long, doc_id long, start long, length long, doc_tokens long, ids binary"


class WordIds(dict):
    """The library's ids of pre-tokens, or of words between spaces, as bytes.

    Plain lines are split into pre-tokens here, and only the library's model works on these. What is kept is bounded
    by bytes: a full table becomes the old one, from which what is used again comes back.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spelling = {byte: letter for letter, byte in byte_letters().items()}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.found(word)
        if len(word) <= LONGEST_KEPT:
            if self.held > CACHE_BYTES // 2:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self.held += ENTRY_BYTES + 4 * len(word) + len(ids)
            self[word] = ids
        return ids

    def found(self, word: str) -> bytes:
        if PLAIN_PART.fullmatch(word):
            lowered = word.lower()
            spelled = lowered if word.isascii() else lowered.encode().decode("latin-1").translate(self.spelling)
            return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text, in parts."""
        first = 0
        while first < len(text):
            cut = APART.search(text, first + PART) if first + PART < len(text) else None
            last = cut.start() if cut else len(text)
            for line in text[first:last].split("\n"):
                plain = PLAIN_LINE.fullmatch(line)
                yield b"".join(map(self.__getitem__, PLAIN_PART.findall(line.lower()) if plain else line.split(" ")))
            first = last


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


class Packer:
    """Open windows by fill level. A piece is (doc, start, ids); a window is a list of pieces.

    place() and close_rest() return the windows they closed, in order.
    """

    def __init__(self, size: int = WINDOW, most_open: int = MOST_OPEN):
        self.size, self.most_open = size, most_open
        self.counts = np.zeros(size, np.int64)
        self.levels: list[list[list[tuple]]] = [[] for _ in range(size)]
        self.open = 0

    def level_for(self, n: int) -> int:
        """The level whose window takes n more ids with the least sum of squares; 0 is a new window, the fuller of equals wins.

        Half the change of the sum: moving a window from h to h + n, 1 + N(h + n) - N(h);
        closing it, 1/2 - N(h); opening one, 1/2 + N(n).
        """
        room = self.size - n
        change = np.where(self.counts[1:room + 1] > 0, -2 * self.counts[1:room + 1], np.iinfo(np.int32).max)
        change[:room - 1] += 2 + 2 * self.counts[n + 1:]
        if room:
            change[room - 1] += 1
        best = room - 1 - int(change[::-1].argmin()) if room else 0
        return best + 1 if room and change[best] <= 1 + 2 * self.counts[n] else 0

    def _push(self, pieces: list[tuple], level: int) -> None:
        self.levels[level].append(pieces)
        self.counts[level] += 1
        self.open += 1

    def _pop(self, level: int) -> list[tuple]:
        self.counts[level] -= 1
        self.open -= 1
        return self.levels[level].pop()

    def place(self, doc, start: int, ids: bytes) -> list[list[tuple]]:
        n = len(ids) // 4
        if n == self.size:
            return [[(doc, start, ids)]]
        level = self.level_for(n)
        pieces = self._pop(level) if level else []
        pieces.append((doc, start, ids))
        if level + n == self.size:
            return [pieces]
        self._push(pieces, level + n)
        if self.open <= self.most_open:
            return []
        commonest = int(self.counts.argmax())
        closed, rest = self.joined([self._pop(commonest) for _ in range(self.counts[commonest])])
        if rest:
            self._push(rest, sum(len(p[2]) for p in rest) // 4)
        return closed

    def joined(self, windows: list[list[tuple]]) -> tuple[list[list[tuple]], list[tuple]]:
        """The windows' pieces in full windows, cut where one ends, and a last one that is not full."""
        closed, pieces, room = [], [], 4 * self.size
        for doc, start, ids in (p for w in windows for p in w):
            while len(ids) >= room:
                pieces.append((doc, start, ids[:room]))
                closed.append(pieces)
                start, ids, pieces, room = start + room // 4, ids[room:], [], 4 * self.size
            if ids:
                pieces.append((doc, start, ids))
                room -= len(ids)
        return closed, pieces

    def close_rest(self) -> list[list[tuple]]:
        """All open windows joined; the last one cut into windows of 2^k ids, the largest first."""
        closed, rest = self.joined([self._pop(h) for h in range(self.size - 1, 0, -1) for _ in range(self.counts[h])])
        left = sum(len(p[2]) for p in rest) // 4
        while left:
            size = 1 << left.bit_length() - 1
            full, rest = Packer(size).joined([rest])
            closed += full
            left -= size
        return closed


def _pack(path: str, end_id: int, size: int, most_open: int):
    end = np.array([end_id], "<u4").tobytes()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Closed windows; a document is its id and its number of tokens."""
        words, packer = word_ids(path), Packer(size, most_open)
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    ids = b"".join([*words.encode(text.as_py()), end])
                    doc = (doc_id, len(ids) // 4)
                    rest = (len(ids) - 1) // (4 * size) * size
                    for start in range(0, rest, size):
                        yield [(doc, start, ids[4 * start:4 * (start + size)])]
                    yield from packer.place(doc, rest, ids[4 * rest:])
        yield from packer.close_rest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows: list[tuple] = []
        for number, pieces in enumerate(windows(batches)):
            offset = 0
            for doc, start, ids in pieces:
                rows.append((part, number, offset, doc[0], start, len(ids) // 4, doc[1], ids))
                offset += len(ids) // 4
            if len(rows) >= ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.int64()] * 6, pa.binary()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def pack(docs: DataFrame, folder: str, path: str = VOCABULARY, end_id: int = END_ID, size: int = WINDOW, most_open: int = MOST_OPEN) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian unsigned 32-bit integers)."""
    pieces = written(text_rows(docs).mapInArrow(_pack(path, end_id, size, most_open), SCHEMA), folder, "pieces")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tasks = pieces.groupBy("part").agg((F.max("window") + 1).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return pieces.join(F.broadcast(tasks), "part").select(  # one row of two numbers a task
        "doc_id", "start", "length", "doc_tokens", (F.col("base") + F.col("window")).alias("sequence_id"), "offset", "ids")


def op13_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = pack(spark.read.parquet(f"{sf}/documents.parquet"), work_folder(spark, "op13"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
