"""Vector codes and whitening against plain computations."""

import hashlib
import math

import numpy as np
import pytest

from slicewise.llm import queries, vector_codes, whitening

D = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code int, id string"


def plain_lloyd(x, parts, k, rounds):
    """Codes, errors and codebooks by comparing every part with every entry, in Python integers."""
    edges = np.cumsum([0, *(len(c) for c in np.array_split(np.arange(x.shape[1]), parts))])
    cut = [x[:, a:b].astype(object) for a, b in zip(edges, edges[1:])]
    books = [c[:k].copy() for c in cut]

    def assign():
        d = [((c[:, None, :] - b[None]) ** 2).sum(axis=2) if c.shape[1] else np.zeros((len(c), len(b)), object) for c, b in zip(cut, books)]
        best = [[min(range(len(row)), key=lambda j: (row[j], j)) for row in m] for m in d]
        return best, [sum(m[i][b[i]] for m, b in zip(d, best)) for i in range(len(x))]

    for _ in range(rounds):
        best, _ = assign()
        for c, b, at in zip(cut, books, best):
            for j in set(at):
                own = c[[i for i, a in enumerate(at) if a == j]]
                b[j] = [sum(v) // len(own) for v in own.T]
    best, error = assign()
    numbers = ",".join(str(v) for b in books for entry in b for v in entry)
    return ["".join(f"{b[i]:02x}" for b in best) for i in range(len(x))], error, hashlib.sha256(numbers.encode()).hexdigest()


def random_rows(n, dim, seed, step=64.0):
    rng = np.random.default_rng(seed)
    return np.floor(rng.normal(0, 1, (n, dim)) * step) / step  # coarse values, so that distances tie


@pytest.mark.parametrize("dim, n, step", [(64, 400, 4.0), (64, 400, 256.0), (40, 30, 8.0), (5, 90, 2.0)])
def test_codes_are_those_of_plain_lloyd(spark, dim, n, step):
    v = random_rows(n, dim, dim + n, step)
    v[7] = v[3]
    rows = [(i, x.tolist(), i % 3 if i % 5 else None, 9, "z") for i, x in enumerate(v)]
    bad = [(n, None, 1, 9, "z"), (n + 1, [], 1, 9, "z"), (n + 2, [1.0] * (dim - 1) + [math.nan], 1, 9, "z"), (n + 3, [None] * dim, 1, 9, "z"), (n + 4, [math.inf] * dim, 1, 9, "z"), (n + 5, [1.0] * (dim + 1), 1, 9, "z")]
    df = spark.createDataFrame(bad[:3] + rows[::-1] + bad[3:] + rows[:2], SCHEMA).repartition(5)
    got = vector_codes.compressed(df).collect()
    assert len(got) == n + 2 and got[0].__fields__ == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    whole = np.floor(v * 256).astype(np.int64)
    at = [0, 0, 1, 1, *range(2, n)]
    codes, errors, digest = plain_lloyd(whole[at], 16, 64, 2)
    by_label = {}
    for i, e in zip(at, errors):
        by_label[rows[i][2]] = by_label.get(rows[i][2], 0) + e
    assert {r.codebooks_sha256 for r in got} == {digest}
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted((i, c, e, by_label[rows[i][2]]) for i, c, e in zip(at, codes, errors))


def test_groups_are_skipped_and_bounds_hold():
    rng = np.random.default_rng(2)
    centres = rng.integers(-900, 900, (64, 64))
    x = centres[rng.integers(0, 64, 4000)] + rng.integers(-20, 20, (4000, 64))
    books = vector_codes.Codebooks(x[:64].astype(np.int64), 16)
    code, low, _, full = books.nearest(x)
    assert full == 4000 * 16 * 64
    for _ in range(2):
        entries = books.entries.copy()
        for p in range(16):
            for j in np.unique(code[:, p]):
                books.part(entries, p)[j] = books.part(x, p)[code[:, p] == j].sum(axis=0) // (code[:, p] == j).sum()
        later = books.replaced(entries)
        drift = books.drifts(later)
        books = later
        code, low, error, scanned = books.nearest(x, code, low, drift)
        plain = books.nearest(x)
        assert (code == plain[0]).all() and (error == plain[2]).all()
        assert scanned < 0.8 * full
        for p in range(16):
            d = np.sqrt(vector_codes.squared(books.part(x, p), books.part(books.entries, p)).astype(float))
            d[np.arange(len(x)), code[:, p]] = np.inf
            for g in range(books.n_groups):
                assert (low[:, p, g] <= d[:, books.groups[p] == g].min(axis=1, initial=np.inf)).all()


def test_codes_of_large_numbers_are_exact(spark):
    v = [[130_000.0 * (-1) ** (i * j % 3) + i for j in range(32)] for i in range(80)]
    df = spark.createDataFrame([(i, x, 0, 0, "") for i, x in enumerate(v)] + [(99, [131_072.0] * 32, 0, 0, "")], SCHEMA)
    got = sorted((r.vec_id, r.code, r.error) for r in vector_codes.compressed(df).collect())
    codes, errors, _ = plain_lloyd(np.floor(np.array(v) * 256).astype(np.int64), 16, 64, 2)
    assert got == [(i, c, e) for i, (c, e) in enumerate(zip(codes, errors))]
    assert vector_codes.compressed(df.limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.compressed(df.limit(0)).count() == 0


def expected(x, components):
    """By an eigendecomposition of the covariance, in one piece."""
    n = len(x)
    mean = x.mean(axis=0)
    e, v = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return (x - mean) @ v / np.sqrt(e), e


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_whitening_is_that_of_the_covariance(spark, parts):
    rng = np.random.default_rng(parts)
    v = (rng.standard_normal((300, 24)) * np.linspace(3, 0.3, 24)) @ np.linalg.qr(rng.standard_normal((24, 24)))[0]
    v = v.astype(np.float32)
    bad = [(900, None), (901, []), (902, [math.nan] * 24), (903, [None] * 24), (904, [1.0] * 23), (905, [math.inf] * 24)]
    rows = [(i, x.tolist(), 1, 1, "") for i, x in enumerate(v)] + [(i, x, 1, 1, "") for i, x in bad] + [(0, v[0].tolist(), 2, 2, ""), (None, v[1].tolist(), 2, 2, "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("code", "n").repartition(parts)
    got = whitening.whitened(df).collect()
    x = np.floor(np.r_[v, v[:1], v[1:2]].astype(float) * 1024).astype(np.int64) + 100_000
    ids = [*range(300), 0, None]
    n, total = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    white, e = expected(x.astype(float), 8)
    trace = np.trace(np.cov(x.T, bias=True))
    assert len(got) == 8 * n
    for c in range(8):
        own = sorted(((r.vec_id is None, r.vec_id or 0, r.whitened, r.deviation) for r in got if r.component == c + 1))
        want = sorted(((i is None, i or 0, w, d) for i, w, d in zip(ids, white[:, c], deviation)))
        assert [r[3] for r in own] == [r[3] for r in want]
        a, b = np.array([r[2] for r in own]), np.array([r[2] for r in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    assert all(r.n == n and abs(r.explained - e[r.component - 1] / trace) < 1e-9 and r.identity_error < 1e-9 for r in got)


def test_merging_keeps_every_dimension():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (200, 6)) * np.array([1, 1, 1, 1, 1, 1]) + 10**12
    x[:, 5] = x[:, 4] + rng.integers(0, 2, 200)
    whole = None
    for part in np.split(x.astype(np.int64), [1, 2, 5, 50, 51, 130]):
        one = whitening.Summary.of(part)
        whole = whole.merged(one) if whole else one
    small = (x - 10**12).astype(float)
    assert whole.n == 200 and whole.total.tolist() == [int(v) for v in x.astype(object).sum(axis=0)]
    assert np.allclose(whole.covariance(), np.cov(small.T, bias=True), rtol=1e-10, atol=1e-8)
    assert (whole.values > 0).all()


def test_whitening_of_few_flat_and_no_vectors(spark):
    rows = [(1, [1.0, 2.0, 3.0], 0, 0, ""), (2, [1.0, 2.0, 3.0], 0, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert whitening.whitened(df).count() == 0 and whitening.whitened(df.limit(0)).count() == 0
    got = whitening.whitened(df.union(spark.createDataFrame([(3, [5.0, 2.0, 1.0], 0, 0, "")], SCHEMA))).collect()
    assert {r.component for r in got} == {1} and len(got) == 3 and abs(got[0].explained - 1) < 1e-12
    far = spark.createDataFrame([(i, [1e11 * i, float(i)], 0, 0, "") for i in range(9)], SCHEMA.replace("float", "double"))
    assert {(r.vec_id == 4, r.deviation) for r in whitening.whitened(far).collect()} == {(True, 0), (False, None)}


def test_queries_cover_the_table(spark):
    n = spark.read.parquet(f"{D}/embeddings.parquet").count()
    got = queries.op13_embedding_whitening(spark, D).collect()
    assert len(got) == 8 * n and got[0].identity_error < 1e-9
    assert queries.op11_vector_codes(spark, D).count() == n
