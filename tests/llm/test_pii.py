"""Operator 2 against Python's regular expressions, and its trees on forms the base patterns miss."""

import hashlib
import random
import re

from tracelake.llm import pii
from tracelake.llm.shared import work_folder

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes_luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255) or (kind == "phone" and not 8 <= len(digits) <= 15) or (
                    kind == "card" and not (16 <= len(digits) <= 19 and passes_luhn(digits))):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans(spark):
    rng = random.Random(4)
    parts = ["a@b.c", "@", ".", "_d", "1.2.3.4", "300.1.1.1", "5", "+1 (5", "55) 123-4567", "4111 1111 1111 1111", "4111111111111111", "-", " ", "\n", "é", "😀", "x", "+", "0"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(600)]
    rows += [(1000, "1" * 30000), (1001, "1 " * 20000), (1002, "a" * 50000 + "@b"), (1003, "1." * 20000), (1004, "+1" + " " * 20000)]
    texts = dict(rows)
    for r in pii.span_table(spark.createDataFrame(rows, "doc_id long, text string"), work_folder(spark, "pii")).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in pii.KINDS]
        assert set(want) <= set(filter(None, r.spans.split(",")))


def test_trees_add_what_looks_like_a_phone(spark):
    rng = random.Random(9)
    number = lambda: f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = [(i, f"some text, call +1 {number()} for more") for i in range(300)]
    rows += [(1000 + i, f"total of {rng.randint(10, 99)} {rng.randint(10, 99)} units") for i in range(300)]
    rows += [(2000, "please call (988) 555-2485 for more")]
    got = {r.doc_id: r for r in pii.span_table(spark.createDataFrame(rows, "doc_id long, text string"), work_folder(spark, "pii")).collect()}
    assert got[2000].spans == "phone:12:26" and got[2000].n_added == 1
    assert all(got[i].n_phone == 1 for i in range(300)) and not any(got[1000 + i].spans for i in range(300))


def test_main_path_is_native(spark, sf):
    plan = pii.op2_pii(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_phones_whose_digits_are_all_apart(spark):
    rows = [(1, "call +1 2 3 4 5 6 7 8 now"), (2, "+4.9-1 7-2 3 4 5"), (3, "+1 2 3")]
    got = {r.doc_id: r for r in pii.span_table(spark.createDataFrame(rows, "doc_id long, text string"), work_folder(spark, "pii")).collect()}
    assert [got[i].spans for i in (1, 2, 3)] == [",".join(base_spans(t)) for _, t in rows] == ["phone:5:21", "phone:0:16", ""]


def test_other_forms_can_be_added(spark):
    rng = random.Random(3)
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    quad = lambda: ".".join(str(rng.randint(10, 250)) for _ in range(4))
    def card(right):
        while passes_luhn(c := "4" + digits(15)) != right:
            pass
        return c
    rows = [(i, f"please mail john{digits(2)}@example.com for more") for i in range(200)] + [(200 + i, f"they met at {digits(2)}.{digits(2)} today") for i in range(200)]
    rows += [(400 + i, f"paid with card {card(True)} then") for i in range(200)] + [(600 + i, f"parcel no {card(False)} came") for i in range(200)]
    rows += [(800 + i, f"login from host {quad()} again") for i in range(200)] + [(1000 + i, f"it was {digits(2)}:{digits(2)}:{digits(2)} then") for i in range(200)]
    wanted = {2000: ("please mail ", "john (at) example (dot) com", "email"), 2001: ("login from host ", "2001:db8:85a3:1:2:8a2e:370:7334", "ip"), 2002: ("paid with card ", "378282246310005", "card")}
    rows += [(i, f"{a}{m} then") for i, (a, m, _) in wanted.items()] + [(2010, "they met at 10.30 then"), (2011, "paid with card 378282246310006 then")]
    got = {r.doc_id: r.spans for r in pii.span_table(spark.createDataFrame(rows, "doc_id long, text string"), work_folder(spark, "pii")).collect()}
    assert {i: f"{k}:{len(a)}:{len(a) + len(m)}" in got[i].split(",") for i, (a, m, k) in wanted.items()} == dict.fromkeys(wanted, True)
    assert "email" not in got[2010] and "card" not in got[2011]


def test_rare_kind_keeps_its_threshold(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE", 400)
    rng = random.Random(7)
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))

    def card(right):
        while passes_luhn(c := "4" + digits(15)) != right:
            pass
        return c

    rows = [(i, f"total of {digits(2)} {digits(2)} units") for i in range(4000)] + [(4000 + i, f"call +1 555-{digits(3)}-{digits(4)} now") for i in range(2000)]
    rows += [(7000 + i, f"paid with card {card(True)} then") for i in range(200)] + [(8000 + i, f"parcel no {card(False)} came") for i in range(200)]
    rows += [(9000, "paid with card 4111.1111.1111.1111 then")]
    got = {r.doc_id: r.spans for r in pii.span_table(spark.createDataFrame(rows, "doc_id long, text string"), work_folder(spark, "pii")).collect()}
    assert "card:15:34" in got[9000].split(",")
