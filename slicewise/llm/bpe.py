"""Byte-level BPE encoding and decoding by replaying the merges over a corpus of distinct words."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewise.llm.passages import expanded, squeezed

#: Characters and rows of a batch of texts, and bytes of text whose words meet in one hash bucket.
CHUNK, ROWS, BUCKET = 4_000_000, 20_000, 32 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """Ranks as arrays: for each pair of tokens whose bytes together are a token, that token."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.base = len(self.bytes)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.base + b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.into = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.sizes = np.array([len(t) for t in self.bytes], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair merges into, -1 where it doesn't."""
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.into[at], -1)

    def exactly(self, word: bytes) -> list[int]:
        """One word, merging its pair of lowest rank, leftmost first, until none is left; by a heap of pairs."""
        token, n = [self.ranks[word[i : i + 1]] for i in range(len(word))], len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = lambda i: self.ranks.get(self.bytes[token[i]] + self.bytes[token[after[i]]], -1) if after[i] < n else -1
        heap = [(r, i) for i in range(n) if (r := rank(i)) >= 0]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if token[i] < 0 or rank(i) != r:  # merged away, or another pair by now
                continue
            right = after[i]
            token[i], token[right], after[i] = r, -1, after[right]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (new := rank(k)) >= 0:
                    heapq.heappush(heap, (new, k))
        return [t for t in token if t >= 0]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the distinct words, one word after another, and how many each word has.

        All words lie in one array of tokens, each with its neighbours' positions. ``index`` maps a rank
        to the positions of the left halves of its pairs. Ranks are taken in rising order from a heap;
        each merges all its positions at once, and only the pairs beside a merge get new entries. Where
        a merge makes a pair of no higher rank than its own, the order inside that word could matter:
        the word is encoded again by ``exactly``. A word that is itself a token is left out of it all.
        """
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        todo = np.flatnonzero(whole < 0).tolist()
        count = np.ones(len(words), np.int64)
        if not todo:
            return whole.astype(np.uint32), count
        sizes = np.array([len(words[i]) for i in todo], np.int64)
        raw = np.frombuffer(b"".join(words[i] for i in todo), np.uint8)
        n = len(raw)
        token = np.append(self.byte[raw], -1)  # the last cell stands for no neighbour
        word = np.repeat(np.arange(len(todo)), sizes)
        ends = np.cumsum(sizes)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], after[n] = n, n
        before[ends - sizes] = n
        redo = np.zeros(len(todo), bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]).tolist()
            for s, e in zip(cuts, [*cuts[1:], len(at)]):
                r = int(ranks[s])
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(at[s:e])

        every = np.arange(n)
        first = self.rank(token[:n], token[after[:n]])
        enter(every[first >= 0], first[first >= 0])
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            at = at[(token[at] >= 0)]
            at = at[self.rank(token[at], token[after[at]]) == r] if len(at) else at
            if len(at):
                right = after[at]
                clash = np.r_[False, right[:-1] == at[1:]]  # overlaps: the left one of a run goes first
                if clash.any():
                    runs = np.maximum.accumulate(np.where(~clash, np.arange(len(at)), 0))
                    now = at[(np.arange(len(at)) - runs) % 2 == 0]
                else:
                    now = at
                right = after[now]
                beyond, prior = after[right], before[now]
                token[now], token[right] = r, -1
                after[now] = beyond
                before[beyond] = now
                before[n] = n
                for left in (prior[prior < n], now[beyond < n]):
                    ranks = self.rank(token[left], token[after[left]])
                    hit = ranks >= 0
                    if hit.any():
                        redo[word[left[hit & (ranks <= r)]]] = True
                        enter(left[hit], ranks[hit])
        alive = np.flatnonzero(token[:n] >= 0)
        ids, n_ids = token[alive], np.bincount(word[alive], minlength=len(todo))
        if redo.any():
            parts = np.split(ids, np.cumsum(n_ids)[:-1])
            for k in np.flatnonzero(redo).tolist():
                parts[k] = np.array(self.exactly(words[todo[k]]), np.int64)
            ids, n_ids = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        count[todo] = n_ids
        flat = np.empty(int(count.sum()), np.uint32)
        merged = np.repeat(whole < 0, count)
        flat[merged], flat[~merged] = ids, whole[whole >= 0]
        return flat, count


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that ``rows`` names, one after another."""
    n = sizes[rows]
    shift = np.repeat(starts[rows] - (np.cumsum(n) - n), n)
    return flat[shift + np.arange(len(shift))]


def decode(ids: np.ndarray, path: str) -> bytes:
    m = merges(path)
    return gathered(m.flat, m.starts, m.sizes, ids.astype(np.int64)).tobytes()


def slices(batches, size: int):
    """(record batch, its texts) of about ``size`` characters or ROWS rows, from batches whose last column is the text."""
    for b in batches:
        texts, start, held = b.column(b.num_columns - 1).to_pylist(), 0, 0
        for i, n in enumerate(map(len, texts)):
            if held and held + n > size or i - start >= ROWS:
                yield b.slice(start, i - start), texts[start:i]
                start, held = i, 0
            held += n
        if start < len(texts):
            yield b.slice(start), texts[start:]


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, ``ids`` and ``decoded``.

    ``ids`` are little-endian unsigned 32-bit integers as binary, ``decoded`` the bytes of the decoded ids.

    Texts are matched against ``pattern`` in batches of about ``chunk`` characters. A batch keeps for each
    text the numbers of its words, and sends its distinct words to hash buckets. A bucket makes the words of
    all batches distinct, so every word of the corpus is merged once, replays the merges over them and
    answers each batch with the ids of its words. The batch gathers the ids of its texts. Texts themselves
    aren't shuffled, and what is sent are a few packed rows for each batch.

    A null text is empty: no ids. Texts are whole, however long. Rows, repeats and other columns stay, but
    for columns of the three names, which are replaced.
    """
    new = {"n_tokens": T.LongType(), "ids": T.BinaryType(), "decoded": T.BinaryType()}
    kept = [c for c in docs.columns if c not in (text, *new)]
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))

    def pack(batches):
        find, part, n = regex.compile(pattern).findall, TaskContext.get().partitionId(), 0
        for b, texts in slices(batches, chunk):
            number: dict[str, int] = {}
            flat, sizes = [], []
            for t in texts:
                words = find(t)
                for w in words:
                    if w not in number:
                        number[w] = len(number)
                flat.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                sizes.append(len(words))
            words = [w.encode() for w in number]
            bucket = np.fromiter((xxhash.xxh64_intdigest(w) % buckets for w in words), np.int64, len(words))
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(order), np.uint32)  # words are numbered as the buckets will answer
            place[order] = np.arange(len(order))
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            sent = []
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                own = [words[i] for i in order[cuts[k] : cuts[k + 1]].tolist()]
                lengths = np.fromiter(map(len, own), np.uint32, len(own))
                sent.append({"bucket": k, "blob": [squeezed(lengths), zstandard.ZstdCompressor(level=3).compress(b"".join(own))]})
            at = pa.array([0, len(texts)], pa.int32())
            own_rows = pa.StructArray.from_arrays([b.column(i) for i in range(len(kept))] + [pa.array(range(len(texts)), pa.int32())], names=[*fields, "row"])
            yield pa.RecordBatch.from_arrays([
                pa.array([part << 32 | n], pa.int64()), pa.ListArray.from_arrays(at, own_rows), pa.array([squeezed(np.array(sizes, np.uint32))], pa.binary()),
                pa.array([squeezed(place[np.concatenate(flat)] if len(flat) else np.zeros(0, np.uint32))], pa.binary()), pa.array([sent], parcels)], names=["batch", "rows", "sizes", "words", "sent"])
            n += 1

    parcels = pa.list_(pa.struct([("bucket", pa.int32()), ("blob", pa.list_(pa.binary()))]))
    fields = [f"c{i}" for i in range(len(kept))]
    row = T.StructType([*(T.StructField(f, docs.schema[c].dataType) for f, c in zip(fields, kept)), T.StructField("row", T.IntegerType())])
    schema = T.StructType([
        T.StructField("batch", T.LongType()), T.StructField("rows", T.ArrayType(row)), T.StructField("sizes", T.BinaryType()), T.StructField("words", T.BinaryType()),
        T.StructField("sent", T.ArrayType(T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("blob", T.ArrayType(T.BinaryType()))])))])

    def merge(t):
        own = []
        for lengths, letters in t["blob"].to_pylist():
            ends = np.cumsum(expanded(lengths, np.uint32)).tolist()
            letters = zstandard.ZstdDecompressor().decompress(letters)
            own.append([letters[s:e] for s, e in zip([0, *ends[:-1]], ends)])
        number: dict[bytes, int] = {}
        for words in own:
            for w in words:
                if w not in number:
                    number[w] = len(number)
        flat, sizes = merges(path).replay(list(number))
        starts = np.cumsum(sizes) - sizes
        at = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in own]
        blobs = [[squeezed(sizes[x].astype(np.uint32)), squeezed(gathered(flat, starts, sizes, x))] for x in at]
        return pa.table([t["batch"], t["bucket"], pa.array(blobs, pa.list_(pa.binary()))], schema=answer_type)

    answer_type = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("blob", pa.list_(pa.binary()))])

    def gather(t, back):
        back = back.sort_by("bucket")
        blobs = back["blob"].to_pylist()
        flat = np.concatenate([np.zeros(0, np.uint32), *(expanded(b[1], np.uint32) for b in blobs)])
        sizes = np.concatenate([np.zeros(0, np.int64), *(expanded(b[0], np.uint32).astype(np.int64) for b in blobs)])
        words = expanded(t["words"][0].as_py(), np.uint32).astype(np.int64)
        ids = gathered(flat, np.cumsum(sizes) - sizes, sizes, words)
        ends = np.cumsum(sizes[words])
        upto = np.cumsum(expanded(t["sizes"][0].as_py(), np.uint32).astype(np.int64))
        ends = np.where(upto > 0, ends[upto - 1], 0) if len(ends) else np.zeros(len(upto), np.int64)
        texts = np.split(ids.astype("<u4"), ends[:-1])
        own = t["rows"].combine_chunks().flatten()
        made = [pa.array([len(x) for x in texts], pa.int64()), pa.array([x.tobytes() for x in texts], pa.binary()), pa.array([decode(x, path) for x in texts], pa.binary())]
        return pa.table([own.field(i) for i in range(len(kept))] + made, names=[*kept, *new])

    def send(t):
        own = t["sent"][0].as_py()
        return pa.table({"bucket": pa.array([x["bucket"] for x in own], pa.int32()), "batch": pa.array([t["batch"][0].as_py()] * len(own), pa.int64()), "blob": pa.array([x["blob"] for x in own], pa.list_(pa.binary()))})

    packed = docs.select(*(F.col(c).alias(n) for c, n in zip(kept, fields)), F.coalesce(text, F.lit("")).alias("text")).mapInArrow(pack, schema)
    # both uses of the batches take all their columns and so share one exchange
    answers = packed.groupBy("batch").applyInArrow(send, "bucket int, batch long, blob array<binary>").groupBy("bucket").applyInArrow(
        merge, "batch long, bucket int, blob array<binary>")
    done = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(c, t) for c, t in new.items())])
    return packed.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(gather, done)
