"""Token counts, BPE round trips and packing against the libraries."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tokenizers import Tokenizer

from slicewise.llm import bpe, packing, token_counts

TEXTS = [
    "", None, " ", "  a   b \n\n c", "aaaaaaaaab", "<|endoftext|>x<|endoftext|> ", "é漢字 \U0001f600 ΑΣ ΑΣ. İstanbul é", "a" * 5000,
    "don't WE'LL they've 123 ½ ² Ⅷ", "a\x1cb\x1d c\x85d e f　g", "\t\tx\r\ny   ", "<|startoftext|> hi<|endoftext|>", "word " * 3000,
    "The thing that onting erstth, of the and nding.", "x\n \n  \ny", "####$$$ &&& ***", "\u0000�",
    "say <|ENDOFTEXT|> now", "a<|EndOfText|>b<|endoftext|>C<|STARTOFTEXT|><|startoftext|>", "<|<|endoftext|>|>", "<|endoftext|", "<|ENDOFTEXT|>",
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, "keep", 7) for i, t in enumerate(TEXTS)] + [(None, "a b", "keep", 7), (3, TEXTS[3], "keep", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens int")


def test_counts_are_the_librarys(spark, texts):
    path = public.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = token_counts.token_counts(texts, path, public.PATTERN, limit=10)
    assert got.columns == ["doc_id", "source", "n_bytes", "n_tokens", "over_limit"]
    for row, (_, text, *_) in zip(got.collect(), texts.collect()):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (n, len((text or "").encode()), n > 10), text
    assert token_counts.token_counts(spark.createDataFrame([], texts.schema), path, public.PATTERN).count() == 0


def test_whole_strings_are_proven_to_be_one_token():
    w = token_counts.whole_tokens(public.path("byte_bpe_50k.json"), public.PATTERN)
    assert len(w.whole) > 40_000
    assert all(len(e.ids) == 1 for e in w.tokenizer.encode_batch(sorted(w.whole)[::97], add_special_tokens=False))


def test_bpe_round_trip(spark, texts):
    path = public.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    exact = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.encoded(texts, path, public.PATTERN, chunk=2000)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids", "decoded"]
    for row, (_, text, *_) in zip(got.collect(), texts.collect()):
        ids = exact.encode_ordinary(text or "")
        assert list(struct.unpack(f"<{row.n_tokens}I", row.ids)) == ids, text
        assert bytes(row.decoded) == (text or "").encode()
    assert bpe.encoded(spark.createDataFrame([], texts.schema), path, public.PATTERN).count() == 0


def test_replay_follows_low_ranks_that_a_merge_creates(tmp_path):
    """abc ranks below bc: merging bc makes a pair of a lower rank, where the order matters."""
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 400, b"abc": 300, b"bc": 350, b"bcb": 310, b"aa": 260, b"aaaa": 270}
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    exact = tiktoken.Encoding("odd", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for word in ["abcbc", "xabc", "aaaaaaa", "bcbcb", "abcabcbcb", "aaabc"]:
        ids, sizes = bpe.merges(str(path)).replay([word.encode()])
        assert ids.tolist() == exact.encode_ordinary(word), word


def test_packing_places_every_piece_once(spark, texts):
    path = public.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.packed(texts, path, capacity=64, with_ids=True, cell=8)
    rows = got.collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
    for id, text, *_ in texts.collect():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[id], key=lambda r: (r.piece, r.sequence_id))
        if id == 3:  # repeated row
            own = own[:1]
        assert [(r.piece, r.start) for r in own] == [(k, s) for k, s in enumerate(range(0, len(ids), 64))]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == ids, text
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    least = -(-sum(r.length for r in rows) // 64)
    assert len(by_sequence) <= least + 2
    assert packing.packed(spark.createDataFrame([], texts.schema), path).count() == 0


def test_ids_of_special_strings_in_any_case_are_the_librarys():
    path = public.path("word_bpe_49k.json")
    tokenizer, own, rng = Tokenizer.from_file(path), packing.WordIds(path), random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|", "|>", "endoftext", " ", "\n", "a", "Word", "É", "İ", "Σ", "ΑΣ ", "12", "'s", "!"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(4000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_islands_never_lose_items_and_beat_first_fit():
    rng = np.random.default_rng(0)
    lengths = rng.integers(300, 1100, 400)
    island = packing.Island(lengths, 2048, 1)
    island.settle(4)
    start = island.packings[0][0]
    best = island.evolve(4, 12)
    assert island.fill(best).max() <= 2048 and len(best) == 400
    assert island.packings[0][0] <= start


def bin_sets(bins):
    return {frozenset(np.flatnonzero(bins == b).tolist()) for b in np.unique(bins)}


def test_crossover_injects_whole_bins_and_improves_on_its_parents():
    rng = np.random.default_rng(3)
    lengths = rng.integers(40, 900, 2000)
    island = packing.Island(lengths, 2048, 5)
    island.settle(5)
    seeds = [p[0][0] for p in island.packings]
    donor, receiver = island.packings[0][1], island.packings[1][1]
    child = np.unique(island.child(receiver, donor), return_inverse=True)[1]
    assert island.fill(child).max() <= 2048
    whole = [s for s in bin_sets(donor) if len(set(child[list(s)].tolist())) == 1]
    assert len(whole) >= 0.1 * 0.7 * len(bin_sets(donor)) - 1
    assert len(bin_sets(child) & bin_sets(donor)) > 10 and len(bin_sets(child) & bin_sets(receiver)) > 10
    island.evolve(5, 24)
    assert island.packings[0][0][0] < min(seeds)  # by crossover, not by a seed
    falling = np.empty(len(lengths), np.int64)
    none = np.zeros(0, np.int64)
    packing.best_fit(lengths, np.argsort(-lengths, kind="stable"), none, none, 0, 2048, falling)
    assert island.packings[0][0][0] <= falling.max() + 1


def test_elites_migrate_between_islands(spark):
    """After an epoch each island's best is in the next island too: its last packing is no worse than either."""
    rng = np.random.default_rng(7)
    rows = [(0, k, int(n), -1) for k, n in enumerate(rng.integers(300, 1100, 300))]
    items = spark.createDataFrame(rows, "cell long, item long, length long, bin long")
    seen = {}
    for epochs in (1, 2):
        found = packing._rounds(items, 2048, islands=3, epochs=epochs, size=4, generations=1).toPandas().sort_values("item")
        assert len(found) == 300 and found.groupby("bin")["length"].sum().max() <= 2048
        seen[epochs] = found
    lonely = packing.Island(np.array([n for _, _, n, _ in rows]), 2048, 1)
    lonely.admit(seen[1]["bin"].to_numpy())
    kept = lonely.packings[0][0]
    lonely.admit(seen[2]["bin"].to_numpy())
    assert lonely.packings[0][0] <= kept and bin_sets(seen[2]["bin"].to_numpy()) != bin_sets(seen[1]["bin"].to_numpy())
    assert bin_sets(seen[2]["bin"].to_numpy()) & bin_sets(seen[1]["bin"].to_numpy())


def test_columns_named_like_inner_ones_are_kept(spark):
    from slicewise.llm import html_text
    from slicewise.llm.substring_dedup import substring_dedup

    names = ["_text", "_html", "_row", "row", "c0", "none", "batch", "id", "rest"]
    docs = spark.createDataFrame([(1, "a b c", *range(9)), (2, None, *range(9))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    path = public.path("byte_bpe_50k.tiktoken")
    for found in (bpe.encoded(docs, path, public.PATTERN), token_counts.token_counts(docs, public.path("byte_bpe_50k.json"), public.PATTERN), html_text.extracted(docs, "text"), substring_dedup(docs)):
        rows = found.collect()
        assert len(rows) == 2 and all([r[n] for n in names] == list(range(9)) for r in rows)


def test_queries_on_the_small_tables(spark):
    from slicewise.llm import queries

    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    for r in queries.op5_token_counts(spark, d).collect():
        assert r.n_tokens == len(tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids)
    m = bpe.merges(public.path("byte_bpe_50k.tiktoken"))
    exact = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=m.ranks, special_tokens={})
    for r in queries.op10_bpe_round_trip(spark, d).collect():
        ids = exact.encode_ordinary(docs[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    rows = queries.op4_best_fit_packing(spark, d).collect()
    assert {r.doc_id for r in rows} == set(docs)
