"""The pipeline as a whole against a brute-force version of its stages."""

import collections
import random
from itertools import combinations

import numpy as np
import public_tokenizers as public
from test_near import labels
from test_passages import marks, words
from test_quality_html_chat import base, kneser_ney
from tokenizers import Tokenizer

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    rng = random.Random(31)
    lexicon = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(900)]
    weights = [1 / (k + 3) for k in range(len(lexicon))]
    prose = lambda n: rng.choices(lexicon, weights, k=n)
    docs = [(i, prose(rng.randint(150, 900))) for i in range(220)]
    shared = prose(70)
    docs += [(300 + i, prose(400) + shared + prose(300)) for i in range(3)]
    docs += [(400 + i, [w for k, w in enumerate(docs[i][1]) if k != 70] if i % 2 else docs[i][1]) for i in range(12)]  # near and exact copies
    docs += [(500 + i, ["".join(rng.choice("0123456789#") for _ in range(9)) for _ in range(200)]) for i in range(6)]  # too odd
    docs += [(600 + i, rng.choices([f"stock{k}" for k in range(9)], k=300)) for i in range(6)]  # too plain
    docs += [(700, prose(30)), (701, ["again", "and"] * 90), (702, prose(3000))]
    rows = [(i, " ".join(w), "xx", "s", 9) for i, w in docs]
    return [*rows, (800, None, "xx", "s", 9), (801, "", "xx", "s", 9), (None, rows[5][1] + " end", "xx", "s", 9), (7, " ".join(prose(200)), "xx", "s", 9)]


def good(rows, digest):
    grams = lambda t: {tuple(words(t)[k : k + 8]) for k in range(len(words(t)) - 7)}
    seen = collections.Counter(g for _, t, *_ in rows for g in grams(t))
    models = [kneser_ney([words(t) for _, t, *_ in rows if digest[t] & 1 != f]) for f in (0, 1)]
    rated = []
    for row in rows:
        own, n, repeated = words(row[1]), *(base(row[1])[k] for k in (0, 4))
        if n < 50 or 2 * repeated > n:
            continue
        copied = sum(seen[g] > 1 for g in grams(row[1])) / len(grams(row[1]))
        rated.append((row, -sum(models[digest[row[1]] & 1](a, b) for a, b in zip(["<s>", *own], own)) / n, copied))
    fair = list({row[1]: p for row, p, copied in rated if copied <= 0.25}.values())
    one, three = np.quantile(fair, [0.25, 0.75])
    reach = 3 * max(0.3, three - one)
    return [row for row, p, copied in rated if p <= three + reach and (p >= one - reach or copied > 0.25)]


def unlike(rows):
    last = 1 << 62
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for w in (words(r[1].lower()) for r in rows)]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group = labels(range(len(rows)), links)
    first = {}
    for k, r in enumerate(rows):
        first.setdefault(group[k], []).append((last if r[0] is None else r[0], k))
    return [rows[k] for k in sorted(min(g)[1] for g in first.values())]


def test_the_run_is_that_of_brute_force(spark, tmp_path):
    rows = fixture()
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    digest = {r.text: r.d for r in docs.selectExpr("text", "xxhash64(text) d").collect()}
    kept = good(rows, digest)
    lost = {r[0] for r in rows} - {r[0] for r in kept}
    assert lost == {500, 501, 502, 503, 504, 505, 600, 601, 602, 603, 604, 605, 700, 701, 800, 801}
    once = unlike(kept)
    assert {r[0] for r in kept} - {r[0] for r in once} == {None, *range(400, 412)}
    cut = [(i, [w for w, g in zip(own, gone) if g is None] if any(g is not None for g in gone) else None) for i, own, gone in marks([(r[0], r[1]) for r in once], 50)]
    texts = [(r[0], r[1] if left is None else " ".join(left)) for r, (_, left) in zip(once, cut) if left != []]
    assert sum(left is not None for _, left in cut) == 2
    tokenizer = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    expected = collections.Counter()
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for piece, s in enumerate(range(0, len(ids), 2048)):
            expected[i, piece, s, ids[s : s + 2048].tobytes()] += 1
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in found) == expected
    bins = collections.defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    fitting = []
    for n in sorted((r.length for r in found), reverse=True):
        home = next((k for k, room in enumerate(fitting) if room >= n), None)
        if home is None:
            home = len(fitting)
            fitting.append(2048)
        fitting[home] -= n
    assert len(bins) <= len(fitting)  # first-fit decreasing
