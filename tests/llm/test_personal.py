"""Personal data against whole-text patterns, and the spans that anchors add."""

import hashlib
import random
import re
import time

import pytest

from slicewise.llm import personal, queries

D = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def by_patterns(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if holds(k, m[0])]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    parts = ["a", "é", "@", "@", ".", ".", "-", "+", "+1", " ", " ", "12", "7", "255", "256", "0", "(555)", "b.c", "x@y.z", "1.2.3.4", "4111111111111111", "4111 1111 1111 1111", "%", "_", ")", "\n", "token", "漢"]
    for _ in range(30_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert personal.spans(text)[0] == by_patterns(text), text
    number = "0" * 5000 + ".0.0.255"
    assert personal.spans(number)[0] == [("ip", 0, len(number))]


def test_query_is_the_patterns_over_whole_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    rows = queries.op12_personal_data(spark, D).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = by_patterns(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in base) for kind in PATTERNS]
        shown = [":".join(map(str, s)) for s in base]
        assert r.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert every[: len(shown)] == shown
        for kind, start, end in (s.split(":") for s in every[len(shown) :]):
            assert kind == "account" and re.fullmatch(r"[0-9a-f]{40}", texts[r.doc_id][int(start) : int(end)])


ADDED = [
    ('x token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72" y', ["cb1a9fee807a05366fcb8b6c95c7c565ede51a72"]),
    ('{"api_key": "sk-12ab_34", "n": 1}', ["sk-12ab_34"]),
    ("IBAN: DE89 3704 0044 0532 0130 00 and more", ["DE89 3704 0044 0532 0130 00"]),
    ("Account no. 12345678.", ["12345678"]),
    ("SSN 078-05-1120, Passport number: X1234567", ["078-05-1120", "X1234567"]),
    ("Kontonummer: 1234567 und Konto 99", ["1234567"]),
    ("password is hunter2000!", []),
    ("password: hunter2000!", ["hunter2000"]),
    ("the token of tokens, an account of 1999 and passports", []),
    ("see https://bob:pw@example.com/a?b=c, or http://example.com/users/bob. Not https://example.com/news?page=2", ["https://bob:pw@example.com/a?b=c", "http://example.com/users/bob"]),
    ("mailto:a.b@c.org tel:+1 301 555 0346, mailto:none", ["mailto:a.b@c.org", "tel:+1 301 555 0346"]),
    ("josé@exämple.com and für.5@mail.example.com", ["josé@exämple.com", "für.5@mail.example.com"]),
    ("bob.lee [at] example [dot] com or eve(at)x.org", ["bob.lee [at] example [dot] com", "eve(at)x.org"]),
    ("@media a@b @ x@ 1@2", []),
]


@pytest.mark.parametrize("text, expected", ADDED)
def test_added_spans(text, expected):
    base, every = personal.spans(text)
    assert set(base) <= set(every)
    assert sorted(text[s:e] for k, s, e in every if k not in personal.BASE) == sorted(expected)


def test_rows_nulls_long_texts_and_clashing_columns(spark):
    long = "a.b@c.de, " * 40_000
    rows = [(1, None, "s"), (2, "", "s"), (2, "", "s"), (None, "mail x@y.zz now", "s"), (4, long, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string").withColumnRenamed("base", "spans")
    got = sorted(personal.found(docs, redact=True).collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert personal.found(docs).columns == ["doc_id", "base", "spans"]
    assert [len(r.base) for r in got] == [1, 0, 0, 0, 40_000]
    assert got[0].redacted == "mail <EMAIL> now" and got[1].redacted == "" and got[4].redacted == "<EMAIL>, " * 40_000
    assert personal.found(spark.createDataFrame([], docs.schema)).count() == 0


@pytest.mark.parametrize("part", ["a", "@", "a@", "1", "1.", "+1 ", "token", "token=", "token ", "http://", "a[at]", "iban AA00", "é@", "password.", "a.", "mailto:"])
def test_time_is_linear(part):
    took = []
    for n in (100_000, 400_000):
        text = part * (n // len(part))
        start = time.process_time()
        personal.spans(text)
        took.append(time.process_time() - start)
    assert took[1] < 8 * took[0] + 0.5
