"""Operators 1, 3 and 4 against the libraries."""

import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tracelake.llm import byte_bpe, pretokens, registry, token_counts, token_files
from tracelake.llm.shared import cut_places

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PARTS = [" ", "  ", "\n", "\n\n", "\t", " ", "the", "ing", "'s", "'re", "'ll", "'r", "'", "x", "é", "ª", "²", "字", "😀", "12", "!!", ",", "_", "<|endoftext|>", "<|end", "\x00", "-----"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_counts.VOCABULARY)


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.RANKS), special_tokens={})


def test_encoding_equals_the_library(encoding):
    bpe = byte_bpe.codec()
    for first in range(0, 3000, 7):
        own = texts(7, first)
        got = [np.frombuffer(x, "<u4") for x in bpe.encode_all(own)]
        assert [g.tolist() for g in got] == [encoding.encode_ordinary(t) for t in own]
        assert [bpe.decode(g) for g in got] == [t.encode() for t in own]
    ids = bpe.encode("ab" * 3000 + "x" * 5000 + " " * 300)
    assert ids.tolist() == encoding.encode_ordinary("ab" * 3000 + "x" * 5000 + " " * 300)
    at = bpe.offsets(ids)
    assert bpe.decode(ids[10:20]) == ("ab" * 3000 + "x" * 5000 + " " * 300).encode()[at[10]:at[20]]


def test_counts_equal_the_library(library):
    machine = token_counts.CountTransducer()
    for first in range(0, 2000, 5):
        own = texts(5, first)
        assert machine.count_all(own).tolist() == [len(e.ids) for e in library.encode_batch(own, add_special_tokens=False)]
    machine.states += [machine.states[0]] * token_counts.MOST_STATES  # too many: compiled anew
    machine.words.clear()
    assert machine.count_all(["the rest of it"]).tolist() == [4]


def test_pieces_equal_the_library(library):
    own = token_files.encoder(token_files.VOCABULARY, 2)
    for text in texts(3000, 1):
        assert np.frombuffer(own.encode(text), own.type).tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_chunks_do_not_matter(monkeypatch):
    data = "".join(texts(200, 3)).encode()
    firsts = np.array([0])
    whole = pretokens.boundaries(data, firsts)
    for size in (1, 2, 3, 17):
        monkeypatch.setattr(pretokens, "CHUNK", size)
        assert np.array_equal(pretokens.boundaries(data, firsts), whole)


def test_cut_places(encoding):
    text = "".join(texts(400, 5))
    places = [0, *cut_places(text, 20), len(text)]
    assert len(places) > 20
    assert [i for a, b in zip(places, places[1:]) for i in encoding.encode_ordinary(text[a:b])] == encoding.encode_ordinary(text)


def test_files(spark, sf, library):
    rows = sorted(registry.queries()["op1_token_files"](spark, sf).collect())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    start = 0
    for (doc_id, text), row in zip(docs, rows, strict=True):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
