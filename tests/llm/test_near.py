"""Near-duplicates of documents and vectors, and components, against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from slicewise.llm import embedding_dedup, simhash
from slicewise.llm.components import connected_components


def labels(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def brute_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 400)] + [(900, x) for x in range(901, 1400)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    links += [(5, 5), (None, 3), (7, 6)]
    rng.shuffle(links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    clean = [(a, b) for a, b in links if a is not None and a != b]
    assert got == labels({n for pair in clean for n in pair}, clean)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("tile", [4096, 8])
def test_simhash_links_all_close_fingerprints(spark, tile):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 80))) for _ in range(40)]
    rows = []
    for i, text in enumerate(base * 3):
        words = text.split()
        if words and i >= 40:
            words[rng.randrange(len(words))] = "Changed"
        rows.append((i, " ".join(words)))
    rows += [(500, None), (501, ""), (502, "one"), (503, "ONE"), (502, "one"), (None, rows[0][1]), (504, "x " * 30000)]
    docs = spark.createDataFrame([(i, t, 9, 8) for i, t in rows], "doc_id long, text string, fingerprint int, rep int")
    got = simhash.near_duplicates(docs, tile=tile).collect()
    assert len(got) == len(rows)
    fp = {i: brute_fingerprint(t, 4) for i, t in rows}
    assert all(r.fingerprint[0] & (1 << 64) - 1 == fp[r.doc_id] for r in got)
    links = [(a, b) for a, b in combinations([i for i in fp if i is not None], 2) if (fp[a] ^ fp[b]).bit_count() <= 4]
    expected = labels([i for i in fp if i is not None], links)
    assert all(r.component_id == expected[r.doc_id if r.doc_id is not None else 0] for r in got)
    kept = simhash.keep_first(docs, tile=tile)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == set(expected.values())
    assert simhash.near_duplicates(spark.createDataFrame([], docs.schema)).count() == 0


def test_wide_fingerprints_catch_near_copies_and_leave_others(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows.append((i, " ".join(words)))
        for at in (50, 120):
            words[at] = "edited"
        rows.append((100 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.keep_first(docs, shingle=5, lanes=8, max_bits=77, blocks=36, share=1)
    assert {r.doc_id for r in kept.collect()} == set(range(60))


@pytest.mark.parametrize("tile", [4096, 8])
def test_proposed_links_are_verified_by_their_shingles(spark, tile):
    rng = random.Random(8)
    rows, seen = [], {}
    for i in range(24):
        words = [f"w{rng.randrange(5000)}" for _ in range(150)]
        for k in range(6):  # from nearly all to half of the shingles in common with the first
            changed = list(words)
            for at in range(0, 150, [150, 75, 50, 38, 30, 21][k])[1:] if k else []:
                changed[at] = "Other"
            rows.append((len(rows), " ".join(changed)))
    rows += [(900, rows[0][1]), (901, rows[0][1].upper()), (902, None), (903, ""), (904, "word " * 20000), (None, rows[6][1]), (0, rows[0][1])]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, tile int, key string")

    def shingles(text):
        words = (text or "").lower().split()
        return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))

    for i, t in rows:
        if i is not None:
            seen.setdefault(i, shingles(t))
    links = [(a, b) for a, b in combinations(seen, 2) if len(seen[a] & seen[b]) / len(seen[a] | seen[b]) >= 0.8]
    expected = labels(list(seen), links)
    how = {"shingle": 5, "lanes": 8, "max_bits": 110, "blocks": 52, "share": 1, "similarity": 0.8, "tile": tile}
    got = simhash.near_duplicates(docs, **how).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == expected
    assert 1 < sum(a != b for a, b in expected.items()) < len(expected) - 24
    kept = simhash.keep_first(docs, **how)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == set(expected.values())
    assert simhash.near_duplicates(spark.createDataFrame([], docs.schema), **how).count() == 0


def test_pipeline_links_copies_that_repeat_a_line_and_all_pairs_at_the_threshold(spark):
    """At the pipeline's parameters: repeats of a line don't part copies, and no pair at 0.8 is left out."""
    import corpus_pipeline

    rng = random.Random(5)
    rows, kept = [], set()
    for i in range(20):
        words = " ".join(f"u{rng.randrange(10**9)}" for _ in range(500))
        line = " ".join(f"l{rng.randrange(10**9)}" for _ in range(20))
        kept.add(len(rows))
        rows += [(len(rows) + k, f"{words} {' '.join([line] * n)}") for k, n in enumerate((1, 6, 24))]
    for i in range(300):  # ten words changed, far from each other: 400 of 500 shingles in common
        words = [f"v{rng.randrange(10**9)}" for _ in range(454)]
        other = list(words)
        for at in range(20, 440, 42):
            other[at] = f"x{rng.randrange(10**9)}"
        kept.add(len(rows))
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == kept


@pytest.mark.parametrize("tile", [1024, 12])
def test_vectors_link_as_in_brute_force(spark, tile):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((60, 24))
    rows = [(i, (c + rng.standard_normal(24) * s).tolist()) for i, (c, s) in enumerate((centers[k % 60], 0.2) for k in range(300))]
    rows += [(i, (centers[0] * 3 + rng.standard_normal(24) * 0.05).tolist()) for i in range(300, 360)]
    rows += [(400 + i, rows[i % 3][1]) for i in range(9)]
    bad = [(500, None), (501, [0.0] * 24), (502, [float("nan")] * 24), (503, [1.0, None] * 12), (504, [float("inf")] * 24), (505, [])]
    other = [(600, [1.0, 2.0]), (601, [2.0, 4.0]), (None, rows[0][1])]
    data = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + bad + other], "vec_id long, embedding array<float>, copies int, n int")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(data, tile=tile).collect()}
    assert len(got) == data.count()
    v = np.array([x for _, x in rows], np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.95
    ids = [i for i, _ in rows]
    true = near.sum(axis=1) - 1
    found = np.array([got[i].n_links for i in ids])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum()
    if found.sum() == true.sum():
        links = [(ids[a], ids[b]) for a, b in np.argwhere(np.triu(near, 1))]
        expected = labels(ids, links)
        assert all(got[i].component_id == expected[i] and got[i].kept == (i == expected[i]) for i in ids)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in bad)
    assert got[600].n_links == got[601].n_links == 1 and got[601].component_id == 600
    assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept
    assert embedding_dedup.near_vectors(spark.createDataFrame([], data.schema)).count() == 0


def test_recall_of_the_embedding_query(spark):
    from slicewise.llm import queries

    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").orderBy("vec_id").collect()
    v = np.array([r.embedding for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    true = (v @ v.T >= 0.95).sum(axis=1) - 1
    got = queries.op8_embedding_near_dedup(spark, d).orderBy("vec_id").collect()
    found = np.array([r.n_links for r in got])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum()


@pytest.mark.parametrize("dim", [1, 2, 4, 8])
def test_all_links_of_short_vectors_are_found(spark, dim):
    rng = np.random.default_rng(dim)
    v = rng.standard_normal((1500, dim)).astype(np.float32)
    data = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(9000, [1.0] * 30), (9001, [1.0] * 29 + [1.1])], "vec_id long, embedding array<float>")
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(data, tile=256).collect()}
    assert [got[i].n_links for i in range(1500)] == (near.sum(axis=1) - 1).tolist() and got[9000].n_links == got[9001].n_links == 1
    expected = labels(range(1500), [tuple(x) for x in np.argwhere(np.triu(near, 1)).tolist()])
    assert [got[i].component_id for i in range(1500)] == [expected[i] for i in range(1500)]


def test_filters_fall_back_to_a_grid_where_caps_do_not_reach_the_recall(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MOST", 8)
    embedding_dedup.cap_filters.cache_clear()
    filters = embedding_dedup.cap_filters(64, 500, 0.95, 0.97, 6)
    embedding_dedup.cap_filters.cache_clear()
    assert isinstance(filters, embedding_dedup.GridFilters)
    rng = np.random.default_rng(4)
    a, b = embedding_dedup.CapFilters.pairs(type("", (), {"dim": 64}), rng, 300, 0.95)
    assert all(np.intersect1d(x, y).size for x, y in zip(filters.decoded(a, 6), filters.decoded(b, 6)))


def test_a_calibrated_code_is_the_same_code():
    whole = embedding_dedup.CapFilters(24, 60, 0.95, 0.97, 6)
    again = embedding_dedup.CapFilters(24, 60, 0.95, 0.97, 6, (whole.threshold, whole.met))
    unit = whole.pairs(np.random.default_rng(1), 50, 0.9)[0]
    assert all(np.array_equal(x, y) for x, y in zip(whole.decoded(unit, 6), again.decoded(unit, 6)))


@pytest.mark.parametrize("blocks, share", [(6, 2), (7, 3), (8, 4)])
def test_simhash_links_are_the_same_for_any_blocks(spark, blocks, share):
    rng = random.Random(21)
    words = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randint(1, 40))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(words * 2)), "doc_id long, text string")
    shown = lambda df: sorted((r.doc_id, r.component_id) for r in df.collect())
    assert shown(simhash.near_duplicates(docs, blocks=blocks, share=share)) == shown(simhash.near_duplicates(docs))


def test_blocks_follow_the_number_of_fingerprints():
    assert [simhash.blocks_for(n, 64, 4) for n in (0, 10**6, 10**8, 10**9, 10**10, 10**12)] == [(6, 2), (6, 2), (7, 3), (7, 3), (8, 4), (9, 5)]


@pytest.mark.parametrize("code", [50, 500, 5000, 15_811])
def test_pairs_at_the_threshold_meet_in_a_filter_at_every_size(code):
    filters = embedding_dedup.CapFilters(64, code, 0.95, 0.97, 6)
    rng = np.random.default_rng(code)
    assert filters.met >= 0.97 and filters.meeting([filters.pairs(rng, 50, 0.95) for _ in range(8)], 6) >= 0.9


def test_unlike_texts_are_seldom_proposed_at_the_pipelines_width(monkeypatch):
    """Else the groups of proposed links grow together in a large table, and their verification with the square of its size."""
    import corpus_pipeline

    how = {}
    monkeypatch.setattr(simhash, "keep_first", lambda docs, **given: how.update(given))
    corpus_pipeline.near_dedup(None, None, "")
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 64, 600 * 150, np.uint64)
    bits = simhash.majorities(h, np.arange(601) * 150, how["lanes"]).view(np.uint64)
    a, b = np.triu_indices(600, 1)
    assert (np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) <= how["max_bits"]).sum() <= 2  # of 179,700
    half = h.reshape(600, 150).copy()
    half[:, :17] = rng.integers(0, 1 << 64, (600, 17), np.uint64)  # 133 of 167 in common: 0.796
    other = simhash.majorities(half.reshape(-1), np.arange(601) * 150, how["lanes"]).view(np.uint64)
    assert (np.bitwise_count(bits ^ other).sum(axis=1, dtype=np.int64) <= how["max_bits"]).all()


def test_shingle_sets_of_a_batch_are_those_of_each_text():
    rng = random.Random(6)
    texts = [None, "", " \n", "one", "ONE", " one two\t", "a b c d", "a b c d e", "a b c d e f a b c d e", "x " * 3000, "é É ü"]
    texts += [" ".join(f"W{rng.randrange(30)}" for _ in range(rng.randrange(900))) for _ in range(80)] + [None, "x"]
    h, first = simhash.shingle_sets(texts, 5)
    bits, named = simhash.majorities(h, first, 3), {}
    for i, text in enumerate(texts):
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
        shingles = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        own = h[first[i] : first[i + 1]]
        assert len(own) == len(shingles) and (own[1:] > own[:-1]).all() and bits[i].tolist() == simhash.fingerprint(own, 3)
        assert named.setdefault(frozenset(shingles), own.tobytes()) == own.tobytes()
    assert len(set(named.values())) == len(named)
    assert [len(x) for x in simhash.shingle_sets([], 5)] == [0, 1]


def test_prefixes_of_sets_at_the_threshold_meet():
    rng = np.random.default_rng(9)
    rank = rng.integers(0, 50, 1 << simhash.CELL_BITS).astype(np.uint16)
    for n in [1, 2, 4, 5, 9, 10, 33, 400]:
        common = int(np.ceil(0.8 * n - 1e-9))
        h = rng.integers(0, 1 << 64, n, np.uint64)
        other = h[:common] if n % 2 else np.append(h[:common], rng.integers(0, 1 << 64, max(0, int(common / 0.8) - n), np.uint64))
        sets = [np.sort(h), np.sort(other)]
        keys, begin = simhash.prefixes(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), rank, 0.8)
        assert np.intersect1d(keys[: begin[1]], keys[begin[1] :]).size


@pytest.mark.parametrize("size", [1, 2, 3, 1000])
def test_keys_of_one_row_go_wherever_batches_end(size):
    import pyarrow as pa

    rng = random.Random(size)
    key = sorted(rng.randrange(120) for _ in range(100)) + [200, 201, 201]
    table = pa.table({"node": range(len(key)), "key": key})
    found = [x for b in simhash.shared_keys(table.to_batches(max_chunksize=size)) for x in b["node"].to_pylist()]
    assert found == [i for i, k in enumerate(key) if key.count(k) > 1]
    assert list(simhash.shared_keys([])) == []


def test_edges_of_alike_sets_span_the_components_of_brute_force():
    rng = np.random.default_rng(12)
    for m in (1, 2, 3, 30, 150):
        base = rng.choice(5000, 80, replace=False)
        sets = [np.unique(np.r_[base[rng.random(80) < rng.choice([0.7, 0.9, 1])], rng.integers(0, 5000, rng.integers(0, 30))]).astype(np.uint32) for _ in range(m)]
        a, b = simhash.alike_edges(sets, 0.8)
        alike = lambda x, y: len(np.intersect1d(sets[x], sets[y])) >= 0.8 * len(np.union1d(sets[x], sets[y]))
        assert labels(range(m), zip(a.tolist(), b.tolist())) == labels(range(m), [p for p in combinations(range(m), 2) if alike(*p)])
        assert len(a) == m - len(set(labels(range(m), zip(a.tolist(), b.tolist())).values()))


def test_words_are_hashed_alike_wherever_a_chunk_ends():
    from slicewise.llm import passages

    for spaces in range(passages.CHUNK - 24, passages.CHUNK + 3):
        words = passages.Words([b"alpha beta " + b" " * spaces + b"gamma  ", b"\t gamma"])
        assert len(words.hash) == 4 and words.hash[2] == words.hash[3] and words.doc.tolist() == [0, 0, 0, 1]
    assert len(passages.Words([b"word" + b" " * (2 * passages.CHUNK)]).hash) == 1
