"""Substring and suffix-array dedup against brute force, and their defined edge cases."""

import hashlib
import random
import re

import pytest

from slicewise.llm import suffix_dedup
from slicewise.llm.substring_dedup import substring_dedup

SCHEMA = "doc_id long, text string, n_words string, batch string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def marks(rows, n):
    first = {}
    for id, text in rows:
        own = words(text)
        for s in range(len(own) - n + 1):
            gram = tuple(own[s : s + n])
            first[gram] = min(first.get(gram, 1 << 62), 1 << 62 if id is None else id)
    out = []
    for id, text in rows:
        own = words(text)
        gone = [None] * len(own)
        for s in range(len(own) - n + 1):
            least = first[tuple(own[s : s + n])]
            if least < (1 << 62 if id is None else id):
                for k in range(s, s + n):
                    gone[k] = least if gone[k] is None else min(gone[k], least)
        out.append((id, own, gone))
    return out


def corpus(seed, n_docs=60, n=13):
    rng = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(n * 3)] for k in range(5)]
    rows = []
    for id in range(n_docs):
        text = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randrange(len(p))
                text += p[a : a + rng.randint(1, len(p))]
            else:
                text += [f"u{rng.randrange(4)}" for _ in range(rng.randint(0, 2 * n))]
        rows.append((id, rng.choice([" ", "\n", "\t \r"]).join(text)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (201, rows[4][1]), (None, rows[5][1]), (300, None), (301, ""), (302, " \n"), (303, "é x " * 40)]
    rows.append((304, " ".join(f"long{i % 3000}" for i in range(6000))))
    return rows


@pytest.mark.parametrize("window,block", [(13, 7), (5, 3), (50, 25)])
def test_substring_dedup_removes_what_brute_force_removes(spark, window, block):
    rows = corpus(window)
    docs = spark.createDataFrame([(i, t, "mine", "b") for i, t in rows], SCHEMA)
    got = substring_dedup(docs, window=window, block=block, batch_bytes=4000)
    assert got.columns == ["doc_id", "text", "batch", "n_words", "n_removed", "kept_text", "removed"]
    expected = sorted(
        (str(i), len(w), sum(x is not None for x in g), " ".join(a for a, x in zip(w, g) if x is None)) for i, w, g in marks(rows, window))
    found = got.collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in found) == expected
    assert all(sum(s.length for s in r.removed) == r.n_removed for r in found)
    assert all(r.batch == "b" for r in found)


def test_substring_dedup_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substring_dedup(docs).count() == 0
    with pytest.raises(ValueError):
        substring_dedup(docs, window=12, block=7)


def test_removal_looks_at_the_input_not_at_what_is_left(spark):
    a = " ".join(f"a{i}" for i in range(13))
    docs = spark.createDataFrame([(1, a), (2, a), (3, a + " end")], "doc_id long, text string")
    assert {r.doc_id: r.kept_text for r in substring_dedup(docs).collect()} == {1: a, 2: "", 3: "end"}


@pytest.mark.parametrize("window,gram,hot", [(50, 12, 4096), (10, 4, 4096), (6, 6, 4096), (50, 12, 0), (10, 4, 3)])
def test_suffix_dedup_finds_every_repeated_passage(spark, window, gram, hot):
    """However few suffixes of a gram one task may compare: the others are split by their windows."""
    rows = corpus(window + 1, n=max(4, window // 3))
    expected = []
    for id, own, gone in marks(rows, window):
        s = 0
        while s < len(own):
            e = s
            while e < len(own) and gone[e] is not None:
                e += 1
            if e > s:
                expected.append((str(id), s, e - s))
            s = max(e, s + 1)
    docs = spark.createDataFrame([(i, t, "mine", "b") for i, t in rows], SCHEMA)
    got = suffix_dedup.repeated_passages(docs, window=window, gram=gram, batch_bytes=4000, hot_suffixes=hot).collect()
    assert sorted((str(r.doc_id), r.start, r.n_words) for r in got) == sorted(expected)
    assert all(r.doc_id is None or r.first_id < r.doc_id for r in got)
    assert suffix_dedup.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_queries_agree_with_brute_force_on_the_small_tables(spark):
    from slicewise.llm import queries

    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op1_substring_dedup(spark, d).collect()}
    assert got == {
        i: (len(w), sum(x is not None for x in g), hashlib.sha256(" ".join(a for a, x in zip(w, g) if x is None).encode()).hexdigest())
        for i, w, g in marks(rows, 13)}
    spans = {(r.doc_id, k) for r in queries.op3_suffix_array_dedup(spark, d).collect() for k in range(r.start, r.start + r.n_words)}
    assert spans == {(i, k) for i, _, g in marks(rows, 50) for k, x in enumerate(g) if x is not None}
