"""Quality rules by distribution divergence (operator 5).

Base rules look at one document. The method then compares two histograms of
it, its character classes and its use of the language's most common words,
with those of the language, by Jensen-Shannon distance (base 2). The
references come from all documents with enough words and few symbols; where a
language has little text, characters are compared with those of all documents
of the same script and words are not. Where the script has little text too, the
histograms say nothing and the base rules decide. Short documents are not judged by a histogram: each has a
least length.

Null text: no words, rejected. Null or odd languages are compared by the
characters of the script. Every row is judged by itself, so repeated rows get equal rows. Extra columns
are left by `judged` and kept by `accepted`. An empty table gives no rows; if
no document may serve as reference, only the base rules hold. Whole texts are
read, whatever their length.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tracelake.llm.shared import slices, text_rows, work_folder, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
COMMON_WORDS = 50
#: A language or a script has a reference of its own from so many words on; a document may serve with at most so many symbols per 100 words.
REFERENCE_WORDS, REFERENCE_SYMBOLS = 20_000, 10
#: Least code points and words for a histogram to be judged, and the largest distances of an accepted document.
MIN_CHARS, MIN_COMMON = 200, 50
CHAR_DISTANCE, WORD_DISTANCE, JOINT_DISTANCE = 0.22, 0.42, 0.57
MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
            "char_distance double, word_distance double, kept boolean")
_FOLDED = bytes.maketrans(bytes(range(65, 91)) + b'.,;:!?"()', bytes(range(97, 123)) + b" " * 9)
_HIGH = bytes(range(128, 256))
_CLASSES: list[np.ndarray] = []
N_CLASSES = 10


def char_classes() -> np.ndarray:
    """By code point: space, other white space, small and capital ASCII letters, digits, marks, symbols, other ASCII, other letters, the rest."""
    if not _CLASSES:
        table = np.array([8 if chr(i).isalpha() else 9 for i in range(0x110000)], np.uint8)
        table[:128] = 7
        for kind, chars in enumerate((" ", "\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:!?'\"()-", SYMBOLS.decode())):
            table[[ord(c) for c in chars]] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def char_histogram(text: str, data: bytes) -> np.ndarray:
    if text.isascii():
        return _ascii_histogram(data)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _ascii_histogram(data.translate(None, _HIGH)) + np.bincount(char_classes()[points[points > 127]], minlength=N_CLASSES)


def _ascii_histogram(data: bytes) -> np.ndarray:
    return np.bincount(char_classes()[:128], np.bincount(np.frombuffer(data, np.uint8), minlength=128), N_CLASSES).astype(np.int64)


def script(text: str, histogram: np.ndarray) -> str:
    """The script of most letters, by their Unicode names, after a star; the first of equals. Without letters it is Latin."""
    if histogram[2] + histogram[3] >= histogram[8]:
        return "*LATIN"
    letters: Counter = Counter()
    for letter, n in Counter(text).items():
        if letter.isalpha():
            letters[unicodedata.name(letter, "").split(" ")[0]] += n
    return "*" + min(letters, key=lambda s: (-letters[s], s))


def folded_words(data: bytes) -> Counter:
    """Words in lower case without marks; letters outside ASCII stay as they are."""
    return Counter(data.translate(_FOLDED).split())


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text holds twice or more."""
    n = len(words)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array(list(map(number.__getitem__, words)), np.int64)
    if len(number) < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows)
    same = np.diff(windows[order]) == 0
    if not same.any():
        return 0
    marked = np.zeros(n, bool)
    for at in (order[1:][same], order[:-1][same]):
        for i in range(3):
            marked[at + i] = True
    return int(marked.sum())


def base_measures(text: str, data: bytes) -> dict:
    words = data.split()
    n = len(words)
    repeated = repeat_words(words) if n > 3 else 0
    lines = [line for line in data.split(b"\n") if line.strip()]
    return {
        "n_words": n, "word_chars": len(text) - len(data) + len(data.translate(None, WHITE)),
        "n_symbols": len(data) - len(data.translate(None, SYMBOLS)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeated,
        "base_failed": n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n}


def distance(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, 0 to 1."""
    a, b = a / a.sum(), b / b.sum()
    middle = (a + b) / 2
    parts = [np.sum(x[x > 0] * np.log2(x[x > 0] / middle[x > 0])) for x in (a, b)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


def language_key(docs: DataFrame) -> Column:
    """Two or three letters, of which there are few; anything else is the empty key."""
    return F.coalesce(F.regexp_extract(F.lower(docs["lang"].cast("string")), r"^([a-z]{2,3})(?:[-_].*)?$", 1), F.lit(""))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of character classes and words of the documents that may serve as reference."""
    for batch in batches:
        for part in slices(batch):
            chars: dict[str, np.ndarray] = {}
            texts: dict[str, list[bytes]] = {}
            totals: dict[str, int] = {}
            for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                symbols = len(data) - len(data.translate(None, SYMBOLS))
                n = len(data.split())
                if n >= MIN_WORDS and 100 * symbols <= REFERENCE_SYMBOLS * n:
                    histogram = char_histogram(text, data)
                    own = script(text, histogram)
                    chars[lang] = chars.get(lang, 0) + histogram
                    chars[own] = chars.get(own, 0) + histogram
                    totals[own] = totals.get(own, 0) + n
                    texts.setdefault(lang, []).append(data)
            words = {lang: folded_words(b" ".join(own)) for lang, own in texts.items()}
            rows = [(lang, "c", str(i), int(n)) for lang, h in chars.items() for i, n in enumerate(h) if n]
            rows += [(lang, "w", w.decode("utf-8", "replace"), n) for lang, c in words.items() for w, n in c.items()]
            rows += [(own, "t", "", n) for own, n in totals.items()]
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:3]), pa.array(columns[3], pa.int64())], names=["lang", "kind", "item", "n"])


def references(docs: DataFrame, folder: str) -> dict[str, tuple]:
    """By language key: class counts, common words, their counts and that of the rest. By script (after a star): class counts, no words.

    Counted over all documents; what comes to the driver is bounded by the
    keys (18,279 and the scripts of Unicode at most) times the classes and common words.
    """
    counts = text_rows(docs, language_key(docs).alias("lang")).select("lang", "text").mapInArrow(_counts, "lang string, kind string, item string, n long")
    own = written(counts.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")), folder, "counts")
    words = own.where("kind = 'w'")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))
    top = words.withColumn("rank", rank).where(F.col("rank") <= COMMON_WORDS).select("lang", "kind", "item", "n")
    total = words.groupBy("lang").agg(F.sum("n").alias("n")).select("lang", F.lit("t").alias("kind"), F.lit("").alias("item"), "n")
    out: dict[str, tuple] = {}
    for lang, kind, item, n in sorted(tuple(r) for r in top.union(total).union(own.where("kind <> 'w'")).collect()):
        classes, words, totals = out.setdefault(lang, (np.zeros(N_CLASSES), {}, []))
        if kind == "c":
            classes[int(item)] = n
        elif kind == "w":
            words[item.encode()] = n
        else:
            totals.append(n)
    return {lang: (classes, list(words), np.array([*words.values(), totals[0] - sum(words.values())], float))
            for lang, (classes, words, totals) in out.items() if lang and totals[0] >= REFERENCE_WORDS}


def judge(text: str, lang: str, known: dict[str, tuple]) -> dict:
    data = text.encode("utf-8", "surrogatepass")
    out = base_measures(text, data) | {"char_distance": None, "word_distance": None}
    own = known.get(lang)
    if known and len(text) >= MIN_CHARS:
        histogram = char_histogram(text, data)
        reference = own or known.get(script(text, histogram))
        if reference:
            out["char_distance"] = distance(histogram, reference[0])
    if own:
        words = folded_words(data)
        n = sum(words.values())
        if n >= MIN_COMMON:
            used = [words.get(w, 0) for w in own[1]]
            out["word_distance"] = distance(np.array([*used, n - sum(used)], float), own[2])
    chars, common = out["char_distance"] or 0, out["word_distance"] or 0
    far = chars > CHAR_DISTANCE or common > WORD_DISTANCE or chars + common > JOINT_DISTANCE
    return out | {"kept": not out["base_failed"] and not far}


def _verdicts(known: dict[str, tuple]):
    kind = pa.struct([(n, {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[t]) for n, t in (m.split(" ") for m in MEASURES.split(", "))])

    @F.arrow_udf(f"struct<{MEASURES.replace(' ', ':').replace(',:', ',')}>")
    def verdict(texts: pa.Array, langs: pa.Array) -> pa.Array:
        out = []
        for part in slices(pa.RecordBatch.from_arrays([texts, langs], names=["text", "lang"])):
            out += [judge(t or "", g or "", known) for t, g in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
        return pa.array(out, kind)

    return verdict


def judged(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id and the measures of every document."""
    verdict = _verdicts(references(docs, folder))
    rows = text_rows(docs, language_key(docs).alias("lang"))
    return rows.select("doc_id", verdict("text", "lang").alias("v")).select("doc_id", "v.*")


def accepted(docs: DataFrame, folder: str) -> DataFrame:
    """The documents that pass, as they came."""
    verdict = _verdicts(references(docs, folder))
    return docs.where(verdict(F.coalesce(docs["text"], F.lit("")), language_key(docs)).getField("kept"))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf}/documents.parquet"), work_folder(spark, "op5"))
