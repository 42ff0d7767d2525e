"""Token counts by a compiled transducer (operator 3).

The vocabulary's merges are compiled, state by state as texts need them, into
a deterministic transducer over bytes. A state holds the ways in which a token
may still be growing: for each, the place in the token trie, the last token
before it, and how many tokens fewer that is. In byte-pair encoding a sequence
of tokens is the encoding of its bytes exactly if every two neighbours are, so
the last token of every prefix is determined and the transition carries how
many tokens the prefix has gained or lost. The sum of a pre-token's
transitions is its count. Pre-tokens come from the chunked class transducer,
whose state maps compose by a prefix scan (`pretokens`).

Null text: empty, zero tokens. Special strings inside a text count as one
token each, the library's default. Repeated rows count one by one, extra
columns are left, an empty table gives no rows. Very long texts are cut where
no pre-token can cross.
"""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from tracelake.llm.pretokens import boundaries
from tracelake.llm.shared import SLICE_BYTES, cut_places, per_slice, text_rows

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512
#: Entries after which compiled parts are dropped and compiled again; they change no count.
MOST_STATES, MOST_WORDS = 300_000, 400_000


def byte_letters() -> dict[str, int]:
    """The printable letters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class CountTransducer:
    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        spell = lambda token: bytes(letter[c] for c in token)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.order = {(spell(a), spell(b)): i for i, (a, b) in enumerate(merges)}
        tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in self.order}
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[bytes | None] = [None]
        for token in tokens:
            node = 0
            for b in token:
                if b not in self.trie[node]:
                    self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.token_at.append(None)
                node = self.trie[node][b]
            self.token_at[node] = token
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.words: dict[bytes, int] = {}
        self._restart()

    def _restart(self) -> None:
        self.states: list[tuple] = [((0, b"", 0),)]
        self.numbers: dict[tuple, int] = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def encode(self, data: bytes) -> list[bytes]:
        """The plain definition, used for the few bytes of a pair: join the leftmost pair of lowest rank until none is left."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.order.get(p, len(self.order)) for p in zip(parts, parts[1:])]
            least = min(ranks)
            if least == len(self.order):
                break
            i = ranks.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def neighbours(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens may follow each other; an empty left one stands for the beginning."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.encode(left + right) == ([left, right] if left else [right])
            self.pairs[left, right] = known
        return known

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        growing, last, count = [], None, 0
        for node, before, behind in self.states[state]:
            node = self.trie[node].get(byte, -1)
            if node < 0:
                continue
            token = self.token_at[node]
            if token is not None and last is None and self.neighbours(before, token):
                last, count = token, behind + 1
            if self.trie[node]:
                growing.append((node, before, behind))
        after = (*((node, before, behind - count) for node, before, behind in growing), (0, last, 0))
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
        self.moves[state << 8 | byte] = move = (number, count)
        return move

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token: the sum of what its transitions emit."""
        known = self.words.get(word)
        if known is not None:
            return known
        if len(self.states) > MOST_STATES:
            self._restart()
            self.pairs.clear()
        if len(self.words) >= MOST_WORDS:
            self.words.clear()
        state = total = 0
        moves = self.moves
        for byte in word:
            move = moves.get(state << 8 | byte) or self._compile(state, byte)
            state, total = move[0], total + move[1]
        self.words[word] = total
        return total

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The text between special strings, cut to bounded pieces, and how many special strings there are."""
        between = self.special.split(text) if self.special else [text]
        out = []
        for part in between:
            places = [0, *cut_places(part, SLICE_BYTES), len(part)]
            out += [part[a:b] for a, b in zip(places, places[1:])] if len(places) > 2 else [part]
        return out, len(between) - 1

    def count_all(self, texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), np.int64)
        owners, parts = [], []
        for i, text in enumerate(texts):
            own, totals[i] = self.pieces(text)
            parts += [p.encode("utf-8", "surrogatepass") for p in own]
            owners += [i] * len(own)
        first = 0
        while first < len(parts):  # a text above the bound is worked on piece by piece
            stop, held = first, 0
            while stop < len(parts) and (stop == first or held + len(parts[stop]) <= 2 * SLICE_BYTES):
                held += len(parts[stop])
                stop += 1
            sizes = np.array([len(p) for p in parts[first:stop]])
            ends = np.cumsum(sizes)
            data = b"".join(parts[first:stop])
            begins = boundaries(data, np.unique((ends - sizes)[sizes > 0]))
            get, count = self.words.get, self.count
            stops = np.append(begins[1:], len(data)).tolist()
            counts = np.fromiter((get(w := data[a:b]) or count(w) for a, b in zip(begins.tolist(), stops)), np.int64, len(begins))
            running = np.append(0, np.cumsum(counts))
            at = np.searchsorted(begins, np.append(0, ends))
            np.add.at(totals, owners[first:stop], running[at[1:]] - running[at[:-1]])
            first = stop
        return totals


_TRANSDUCERS: dict[str, CountTransducer] = {}


def transducer(path: str = VOCABULARY) -> CountTransducer:
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = CountTransducer(path)
    return _TRANSDUCERS[path]


def _counted(path: str, limit: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = transducer(path).count_all(batch.column("text").to_pylist())
        sizes = pc.binary_length(batch.column("text")).cast(pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), sizes, pa.array(counts), pa.array(counts > limit)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return work


def token_counts(docs: DataFrame, path: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. One pass, no shuffle."""
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return text_rows(docs).mapInArrow(per_slice(_counted(path, limit)), schema)


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf}/documents.parquet"))
