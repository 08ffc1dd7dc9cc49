"""Words, rolling hashes and packed hash columns, for operators that look for repeated passages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Stands for a null id: no document's id is smaller than another's by it.
NO_ID = np.iinfo(np.int64).max
#: Letters that are hashed at a time.
CHUNK = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, salt: int) -> np.ndarray:
    """n fixed odd 64-bit factors."""
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


LETTER = odd_numbers(256, 1)
WORD_LETTER = np.where(SPACE, np.uint64(0), LETTER)
_place = odd_numbers(64, 2)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts: a 64-bit hash of each and whose they are.

    ``hash``, ``doc`` (position of the text in the batch) and ``place`` (position of the word in its
    text) are parallel; ``first`` has where each text's words begin, and an end.
    """

    def __init__(self, texts: list[bytes]):
        global _place
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        space = (data == 32) | (data - np.uint8(9) < 5)
        edge = np.diff(space.view(np.int8), prepend=np.int8(1))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sizes = ends - starts
        n = len(starts)
        del space, edge, ends
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.first = np.append(np.searchsorted(starts, np.cumsum(lengths) - lengths), n)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.place = np.arange(n) - self.first[self.doc]
        if not n:
            self.hash = np.zeros(0, np.uint64)
            return
        reach = np.diff(starts, append=len(data))  # a word with the spaces behind it, which add nothing
        if reach.max() > len(_place):
            _place = odd_numbers(int(reach.max()), 2)
        cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), CHUNK)), n))
        self.hash = np.empty(n, np.uint64)
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):  # some words at a time bound the memory
            lo, hi = int(starts[s]), int(starts[e - 1] + reach[e - 1])
            at = starts[s:e] - lo
            step = np.ones(hi - lo, np.int32)
            step[0] = 0
            step[at[1:]] = 1 - reach[s : e - 1]
            letters = WORD_LETTER[data[lo:hi]]
            letters *= _place[np.cumsum(step, dtype=np.int32)]
            self.hash[s:e] = np.add.reduceat(letters, at)
        self.hash = mixed(self.hash + sizes.astype(np.uint64))

    def rolling(self, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each position, and whether they lie in one text; n - 1 shorter."""
        count = max(0, len(self.hash) - n + 1)
        total = np.zeros(count, np.uint64)
        for k, factor in enumerate(odd_numbers(n, salt)):
            total += self.hash[k : k + count] * factor
        return mixed(total), self.doc[:count] == self.doc[n - 1 :][:count]


def dealing(total: int, batch_bytes: int | None) -> tuple[int, int]:
    """How many batches, and hash buckets (a power of two), for ``total`` bytes of text.

    Batches grow with the root of the total, from 2 to 8 MB, so that what a batch sends to a bucket stays
    worth a row; a bucket gets about as much as four batches hold.
    """
    size = batch_bytes or int(min(8 << 20, max(2 << 20, 100 * total**0.5)))
    batches = max(1, -(-total // size))
    return batches, 1 << max(0, (batches // 4).bit_length())


def batch_number(id: str, text: str, batches: int) -> Column:
    """Column ``batch`` of a row, by its content; rows that repeat another are spread over 64 batches.

    The row number that spreads them is that of the scan, the same when a lost executor's work is done again;
    a table that isn't read from files should be written first (the pipeline's stages are).
    """
    salt = F.monotonically_increasing_id().bitwiseAND(F.lit(63))
    return F.pmod(F.xxhash64(id, text, salt), F.lit(batches)).cast("int").alias("batch")


def group_ids(table: pa.Table) -> np.ndarray:
    return table["id"].combine_chunks().fill_null(NO_ID).to_numpy()


def group_words(table: pa.Table) -> tuple[list[bytes], Words]:
    texts = [t or b"" for t in table["text"].cast(pa.binary()).to_pylist()]
    return texts, Words(texts)


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: 8 bytes of a count, then planes of like significance."""
    v = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(v.view(np.uint8).reshape(len(v), v.itemsize).T)
    return len(v).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expanded(blob: bytes, kind) -> np.ndarray:
    n, kind = int.from_bytes(blob[:8], "little"), np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:], max_output_size=n * kind.itemsize or 1), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).reshape(-1).view(kind)


def squeezed_sorted(values: np.ndarray) -> bytes:
    """Rising unsigned numbers, by their differences."""
    return squeezed(np.diff(values, prepend=values.dtype.type(0)))


def expanded_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(expanded(blob, np.uint64), dtype=np.uint64)


def cut_at_buckets(sorted_hashes: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where each of ``buckets`` (a power of two) ranges of the highest of ``bits`` bits begins, and the end."""
    low = np.arange(buckets, dtype=np.uint64) << np.uint64(bits - (buckets.bit_length() - 1))
    return np.append(np.searchsorted(sorted_hashes, low), len(sorted_hashes))


def joined_bits(table: pa.Table, cuts: np.ndarray) -> np.ndarray:
    """The bits that the buckets sent back to a batch, in the order of its entries."""
    out = np.zeros(int(cuts[-1]), bool)
    for bucket, bits in zip(table["bucket"].to_pylist(), table["bits"].to_pylist()):
        s, e = int(cuts[bucket]), int(cuts[bucket + 1])
        out[s:e] = np.unpackbits(np.frombuffer(bits, np.uint8), count=e - s)
    return out


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort order by the keys (the first counts most), where each run of equal ones begins in it, and
    for each input position the number of its run."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), inverse


def covered(marks: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n words that starts at a marked position."""
    at = np.flatnonzero(marks)
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, np.minimum(at + n, size), -1)
    return np.cumsum(step[:-1]) > 0


def spans(cover: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of each maximal run of covered words; runs end with their text."""
    before = np.r_[False, cover[:-1]] & (words.place > 0) if len(cover) else cover
    after = np.r_[cover[1:], False] & (np.r_[words.place[1:], 0] > 0) if len(cover) else cover
    start, end = np.flatnonzero(cover & ~before), np.flatnonzero(cover & ~after)
    return start, end - start + 1
