"""Spelling variant grouping (operator 12).

Words are counted over all texts; two words are near if one inserted, deleted or
replaced letter turns one into the other. Near words are found with a
bit-sliced index: for every position and letter, a bit per word that has it
there. Recurrences over these bit sets, one machine word for 64 words at a
time, follow a query letter by letter and hold four sets at once: words that
agree so far (no error), and words with one error, by their shift against the
query: replaced (none), one letter less, one more.

The vocabulary is divided, so that no task sees all of it. Words of t and of
t - 1 letters make class t, whose longer words are cut into at most eight
windows; the one letter in which a near pair differs lies in one of these, so
both words agree in all that is left of them without it, and meet under the
hash of that rest. Groups of more than GROUP words have their window cut
again by eight, down to one letter, where a group holds at most the alphabet.
A pair is counted in the window of the first letter in which it differs, and
there alone. The exact check is the recurrence itself; hashes only gather.

A word's form is its commonest near word if that is at least twice as common.
Counts rise along forms, so the chains end; pointer doubling finds their last.

A null text has no words. A null doc_id is hashed as an empty one. Repeated
rows count each; extra columns are left; an empty table gives no rows. Long
texts are read in chunks cut outside words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracelake.llm.shared import text_rows, work_folder, written

#: Letters of a run, after A-Z are lower-cased. All are one byte in Latin-1.
LETTERS = "a-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, TIMES = 5, 3, 2
#: A run loses one letter where its hash is divisible by this.
DROP = 97
CHUNK = 1 << 20
#: Different words that a task holds before it passes their counts on.
HELD = 200_000
WINDOWS, LEAST_WINDOW = 8, 2
GROUP = 4096
#: Rows, and letters, that are compared at a time.
BIN_ROWS, BIN_LETTERS = 4096, 4 << 20


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.encode().lower().decode()


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """The text in parts that cut no run."""
    outside, first = re.compile(f"[^{LETTERS}]"), 0
    while first < len(text):
        cut = outside.search(text, first + size) if first + size < len(text) else None
        last = cut.start() if cut else len(text)
        yield text[first:last]
        first = last


def word_of(run: str, prefix_crc: int) -> str:
    """The run as it is counted: without one letter where the hash of document and run says so."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % DROP:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs, held = re.compile(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for chunk in chunks(_lower(text.as_py())):
                for run, n in Counter(runs.findall(chunk)).items():
                    word = word_of(run, prefix)
                    if len(word) >= LEAST_LETTERS:
                        held[word] += n
                if len(held) > HELD:
                    yield rows()
                    held.clear()
    if held:
        yield rows()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: words of at least five letters that occur at least three times."""
    counts = text_rows(docs).mapInArrow(_count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _cut(windows: DataFrame, parts: str) -> DataFrame:
    """Rows (word, n, m, t, a, b) with the window [a, b) cut into `parts`, and the hash of the word without it."""
    cut = windows.select("word", "n", "m", "t", F.expr(f"inline(transform(sequence(0, {parts} - 1), i -> named_struct("
                         f"'a', a + int(i * (b - a) / {parts}), 'b', a + int((i + 1) * (b - a) / {parts}))))"))
    rest = "xxhash64(t, a, b, substring(word, 1, a), substring(word, b + 1 - if(m = t, 0, 1)))"
    return cut.withColumn("key", F.expr(rest))


def grouped(words: DataFrame, folder: str, group: int = GROUP) -> DataFrame:
    """Words with their windows: word, n, m (letters), t, a, b, key. Near words share a key, and no key has more than `group` words or it has one letter left."""
    whole = words.select("word", "n", F.length("word").alias("m")).select("*", F.expr("explode(array(m, m + 1))").alias("t"))
    rows = _cut(whole.selectExpr("*", "0 AS a", "t AS b"), f"least({WINDOWS}, int((t + {LEAST_WINDOW - 1}) / {LEAST_WINDOW}))")
    done, number = None, 0
    while True:
        sizes = rows.groupBy("t", "a", "b", "key").agg(F.count("*").alias("size")).where((F.col("size") > group) & (F.col("b") - F.col("a") > 1))
        large = written(sizes.drop("size"), folder, f"large-{number}")
        if large.isEmpty():
            return rows if done is None else done.union(rows)
        small = rows.join(large, ["t", "a", "b", "key"], "left_anti").select(rows.columns)
        done = small if done is None else done.union(small)
        again = rows.join(large, ["t", "a", "b", "key"], "left_semi").drop("key")
        number += 1
        rows = written(_cut(again, f"least({WINDOWS}, b - a)"), folder, f"cut-{number}")


def near_pairs(words: list[bytes], group: np.ndarray, a: np.ndarray, b: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, near word) of the pairs in the same group that are one letter apart and first differ in the group's window.

    The words have t or t - 1 letters; pairs of two shorter ones belong to another class.
    """
    rows = len(words)
    lengths = np.fromiter(map(len, words), np.int64, rows)
    codes = np.frombuffer(b"".join(w.ljust(t, b"\0") for w in words), np.uint8).reshape(rows, t)
    letters = np.zeros(256, np.int64)
    used = np.unique(codes[codes > 0])
    letters[used] = np.arange(1, len(used) + 1)
    codes = letters[codes]
    width = -(-rows // 64)

    def bits(flags: np.ndarray) -> np.ndarray:
        return np.packbits(flags, axis=-1, bitorder="little").view("<u8")

    def index(place: int) -> np.ndarray:
        """For every letter, the words that have it at the place; none have letter 0, which stands behind the end."""
        flags = np.zeros((len(used) + 1, 64 * width), bool)
        if 0 <= place < t:
            flags[codes[:, place], np.arange(rows)] = True
            flags[0] = False
        return bits(flags)

    of_length = {}
    for n in (t - 1, t):
        flags = np.zeros(64 * width, bool)
        flags[:rows] = lengths == n
        of_length[n] = bits(flags)
    short = np.flatnonzero(lengths == t - 1)
    exact = np.full((rows, width), ~np.uint64(0))
    replaced, less, more = np.zeros_like(exact), np.zeros_like(exact), np.zeros_like(exact)
    hits = np.zeros_like(exact)
    before, here, after = index(-1), index(0), index(1)
    for place in range(t):
        if place == t - 1:
            hits[short] = (more[short] | exact[short]) & of_length[t]
        letter = codes[:, place]
        more = (more | exact) & after[letter]
        less = (less & before[letter]) | exact
        replaced = (replaced & here[letter]) | exact
        exact &= here[letter]
        before, here, after = here, after, index(place + 2)
    full = lengths == t
    hits[full] = ((replaced & ~exact & of_length[t]) | (less & of_length[t - 1]))[full]
    query, word = np.nonzero(hits)
    found = np.unpackbits(hits[query, word].reshape(-1, 1).view(np.uint8), axis=1, bitorder="little")
    at, bit = np.nonzero(found)
    query, near = query[at], 64 * word[at] + bit
    same = group[query] == group[near]
    query, near = query[same], near[same]
    first = (codes[query] != codes[near]).argmax(axis=1) if len(query) else query
    own = (a[query] <= first) & (first < b[query])
    return query[own], near[own]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by t, a, b, key, word: per word of a group its number of near words there and the commonest of them."""

    def work(held: list[list[tuple]]) -> pa.RecordBatch:
        rows = [r for g in held for r in g]
        t = rows[0][2]
        group = np.repeat(np.arange(len(held)), [len(g) for g in held])
        n, a, b = (np.array([r[k] for r in rows], np.int64) for k in (1, 3, 4))
        query, near = near_pairs([r[0].encode("latin-1") for r in rows], group, a, b, t)
        order = np.lexsort((near, -n[near], query))  # a group's words are sorted, so of equals the smaller comes first
        query, near = query[order], near[order]
        firsts = np.flatnonzero(np.diff(query, prepend=-1))
        return pa.RecordBatch.from_pydict({
            "word": pa.array([rows[i][0] for i in query[firsts]], pa.string()), "n_near": pa.array(np.diff(firsts, append=len(query)), pa.int64()),
            "near": pa.array([rows[i][0] for i in near[firsts]], pa.string()), "near_n": pa.array(n[near[firsts]], pa.int64())})

    held: list[list[tuple]] = []
    group: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and group[0][2:] != row[2:]:
                if len(group) > 1:
                    held.append(group)
                    size += len(group)
                    if size >= BIN_ROWS or size * row[2] >= BIN_LETTERS:
                        yield work(held)
                        held, size = [], 0
                if held and held[0][0][2] != row[2]:
                    yield work(held)
                    held, size = [], 0
                group = []
            group.append(row)
    if len(group) > 1:
        held.append(group)
    if held:
        yield work(held)


def nearest(words: DataFrame, folder: str, group: int = GROUP) -> DataFrame:
    """word, n_near, near, near_n: for every word with near ones their number and the commonest; of equals the smallest."""
    columns = ["t", "a", "b", "key"]
    rows = grouped(words, folder, group).select("word", "n", *columns).repartition(*columns).sortWithinPartitions(*columns, "word")
    found = rows.mapInArrow(_near, "word string, n_near long, near string, near_n long")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min_by("near", F.struct(-F.col("near_n"), F.col("near"))).alias("near"), F.max("near_n").alias("near_n"))


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """word, root: the last word that follows from (word, form), by pointer doubling; each round is a table."""
    at = written(forms.select("word", F.col("form").alias("root")), folder, "roots-0")
    number = 0
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        number += 1
        moved = written(moved, folder, f"roots-{number}")
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at


def spelling_groups(docs: DataFrame, folder: str, times: int = TIMES, group: int = GROUP) -> DataFrame:
    """word, n, form, form_n, n_near, root of every word of the vocabulary."""
    words = written(vocabulary(docs), folder, "words")
    best = nearest(words, folder, group)
    twice = F.col("near_n") >= times * F.col("n")
    forms = words.join(best, "word", "left").select(
        "word", "n", F.when(twice, F.col("near")).alias("form"), F.when(twice, F.col("near_n")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
    forms = written(forms, folder, "forms")
    last = roots(forms.where("form IS NOT NULL"), folder)
    return forms.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    groups = spelling_groups(spark.read.parquet(f"{sf}/documents.parquet"), work_folder(spark, "op12"))
    return groups.select("word", "form", "root", "n", "n_near", "form_n")
