"""Operator 5 against a plain version, and its verdicts against labels it does not read."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tracelake.llm import quality, registry
from tracelake.llm.shared import work_folder


@pytest.fixture(scope="module")
def rows(spark, sf):
    return registry.queries()["op5_quality"](spark, sf).collect()


def test_base_measures(spark, sf, rows):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        windows = list(zip(words, words[1:], words[2:]))
        times, marked = Counter(windows), set()
        for i, w in enumerate(windows):
            if times[w] > 1:
                marked |= {i, i + 1, i + 2}
        seen, again = set(), 0
        for line in texts[r.doc_id].split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", texts[r.doc_id])), again, len(marked))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(words) < 50 or 100 * len(marked) > 50 * len(words))
        assert not (r.kept and r.base_failed)


def test_verdicts_follow_labels(spark, sf, rows):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(r.kept, labels[r.doc_id]) for r in rows if r.doc_id in labels and not r.base_failed]
    good = [kept for kept, label in judged if label == 1]
    assert sum(good) >= 0.97 * len(good)
    bad = [kept for kept, label in judged if label == 0]
    assert sum(bad) <= 0.2 * len(bad)


def test_distance():
    assert quality.distance(np.array([1.0, 0]), np.array([0, 3.0])) == pytest.approx(1)
    assert quality.distance(np.array([2.0, 6]), np.array([1, 3.0])) == 0


def test_many_distinct_words(monkeypatch):
    words = [b"a", b"b", b"c", b"x", b"a", b"b", b"c"]
    assert quality.repeat_words(words) == 6


def test_rare_scripts_are_not_judged_by_latin_texts(spark, monkeypatch):
    rng = random.Random(6)

    def text(letters):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(90)]
        return ". ".join(" ".join(words[i:i + 9]).capitalize() for i in range(0, 90, 9)) + "."

    sorts = {"en": "abcdefghijklmnopqrstuvwxyz", "ru": "абвгдежзийклмнопрстуфхцчшыьэюя", "el": "αβγδεζηθικλμνξοπρστυφχψω", "ko": "가나다라마바사아자차카타파하"}
    rows = [(i, text(sorts["en"]), "en") for i in range(300)]
    rows += [(1000 + i, text(sorts[g]), h) for i, (g, h) in enumerate((g, h) for g in ("ru", "el", "ko") for h in (g, None, "?!"))]
    rows += [(2000, "7# $4 %% 19 |> " * 4 + " ".join(f"{i}$$#%&|{i * i}" for i in range(80)), "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    own = {r.doc_id: r for r in quality.judged(docs, work_folder(spark, "q")).collect()}
    assert [own[1000 + i].kept for i in range(9)] == [True] * 9 and all(own[1000 + i].char_distance is None for i in range(9))
    assert own[0].kept and not own[2000].kept  # Latin texts, and those without letters, are still compared
    monkeypatch.setattr(quality, "REFERENCE_WORDS", 200)
    same = {r.doc_id: r for r in quality.judged(docs, work_folder(spark, "q")).collect()}
    assert all(same[1000 + i].kept and same[1000 + i].char_distance < 0.1 for i in range(9))
