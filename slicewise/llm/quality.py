"""Quality rules for documents: base statistics, and bands of n-gram perplexity for each language."""

from __future__ import annotations

from dataclasses import InitVar, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from slicewise.llm import passages as P
from slicewise.llm.common import checkpointed, kept
from slicewise.sources.shared import freeing_shuffles
from slicewise.sources.store import Store

#: Frequent words have 20-bit ids, with their totals on the driver. Every other word is rare: a word of the
#: model like them, known by its hash, with its totals in hash buckets. Scores don't depend on which are.
VOCABULARY, ID_BITS = 1 << 18, 20
RARE, END, BEGIN = (1 << ID_BITS) - 3, (1 << ID_BITS) - 2, (1 << ID_BITS) - 1
#: Totals of so many ids are added up in one task; a bucket gets so many ranges of the keys.
RANGE, RANGES = 1 << 15, 16
#: Bits of a hash that tell words apart, and anchors.
WORD_BITS = 48
#: First bits of a hash by which the frequent words are looked up.
SLOT_BITS = 18
#: A bigram with this share of all tokens is scored where it is read; so at most 2 ** 19 are.
HOT = 1 << 19
#: Log probabilities are added up as multiples of 1 / SCALE, so that sums don't depend on their order.
SCALE = 1 << 16
#: Words of an anchor, and one in how many passages of that length is one.
ANCHOR, EVERY = 8, 16
#: Rows of a slice at most.
ROWS = 1 << 15
SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
INNER = (np.arange(256) & 0xC0) == 0x80  # bytes that continue a character
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each run values[first[i]:first[i + 1]]."""
    total = np.cumsum(values, dtype=np.int32)  # of flags of one batch
    upto = np.where(first > 0, total[first - 1], 0) if len(total) else np.zeros(len(first), np.int32)
    return np.diff(upto.astype(np.int64))


def base_statistics(texts: list[bytes], words: P.Words) -> np.ndarray:
    """A row for each text: words, code points in words, symbols, repeated lines, words in repeated trigrams."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    byte_first = np.append(0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))))
    chars = sums(~P.SPACE[data] & ~INNER[data], byte_first)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    h, inside = words.rolling(3, 6)
    at = np.flatnonzero(inside)
    key = P.mixed(h[at] + P.mixed(words.doc[at].astype(np.uint64) + np.uint64(1)))
    twice = np.sort(key)
    twice = np.unique(twice[1:][twice[1:] == twice[:-1]])
    marks = np.zeros(len(words.hash) + 1, bool)
    if len(twice):
        marks[at] = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
    repeated = P.covered(marks, 3, len(words.hash))
    return np.stack([
        np.diff(words.first), chars, sums(SYMBOL[data], byte_first), np.array([len(x) - len(set(x)) for x in lines], np.int64).reshape(len(texts)),
        sums(repeated, words.first)], axis=1)


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and over, from how many have counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3) <= 0:
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    return np.array([0, *np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [0.95, 1.95, 2.95])])


@dataclass
class Occurrences:
    """Each rare word of a batch: its hash, the codes and (where they are rare too) hashes of its neighbours."""

    word: np.ndarray
    before: np.ndarray  # an id, RARE or BEGIN
    after: np.ndarray  # an id, RARE or END
    before_word: np.ndarray  # zero unless before is RARE
    after_word: np.ndarray
    doc: np.ndarray
    fold: np.ndarray = None


class Fold:
    """The bigram model of one half of the texts: context and continuation mass by word id, and hot bigrams' counts.

    Arrays have a place for each frequent word and one for the beginning."""

    def __init__(self, found: dict, words: int, hot_count: np.ndarray):
        """``found`` has by kind (ids, columns): 0 contexts, 1 continuations, 2 counts of counts, 4 counts of counts of
        rare words' continuations, 5 their sum and number."""
        none = np.zeros(0, np.int64)
        of = lambda kind, n: found.get(kind, (none, [none] * n))
        total = lambda kind, n: np.array([x.sum() for x in of(kind, n)[1]])
        ids, columns = of(0, 4)
        count = np.zeros((words + 1, 4))
        count[np.minimum(ids, words)] = np.stack(columns, axis=1)
        self.discount = discounts(total(2, 4))
        self.context = count[:, 0]
        self.backoff = (count[:, 1:] * self.discount[1:]).sum(axis=1) / np.maximum(1, self.context)
        ids, columns = of(1, 1)
        follows = np.zeros(words + 1, np.int64)
        follows[ids] = columns[0]
        counts = np.bincount(np.minimum(follows[follows > 0], 5), minlength=6)[1:5] + total(4, 4)
        e = self.follow_discount = discounts(counts)
        rare, types = total(5, 2)
        self.total, size = float(follows.sum() + rare), int((follows > 0).sum() + types)
        one, two = int(counts[0]), int(counts[1])
        left = (one * e[1] + two * e[2] + (size - one - two) * e[3]) / self.total if self.total else 1.0
        self.spread = left / (size + 1)  # dealt to all words alike, the unknown one included
        self.lower = self.continuation(follows)
        self.hot_count = hot_count

    def at(self, code: np.ndarray) -> np.ndarray:
        """Places of words, or the beginning, by their codes."""
        return np.minimum(code.astype(np.int64), len(self.context) - 1)

    def continuation(self, follows: np.ndarray) -> np.ndarray:
        """Lower-order probability of words with so many distinct words before them; unknown ones have none."""
        return np.maximum(follows - self.follow_discount[np.minimum(follows, 3)], 0) / max(1.0, self.total) + self.spread

    def costs(self, count: np.ndarray, context: np.ndarray, backoff: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Negative log probability of bigrams with so many counts, as multiples of 1 / SCALE."""
        known = np.maximum(count - self.discount[np.minimum(count, 3)], 0) / np.maximum(context, 1)
        return np.rint(-SCALE * np.log(np.where(context > 0, known + backoff * lower, lower))).astype(np.int64)

    def pair_costs(self, key: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Of bigrams of frequent words."""
        first, second = self.at(key >> np.uint64(ID_BITS)), self.at(key & np.uint64((1 << ID_BITS) - 1))
        return self.costs(count, self.context[first], self.backoff[first], self.lower[second])


@dataclass
class Model:
    """Frequent words and hot bigrams as sorted arrays, and a model of each half of the texts."""

    vocabulary: np.ndarray  # sorted hashes
    ids: np.ndarray
    tokens: InitVar[np.ndarray]  # by id, falling
    hot: np.ndarray = None  # sorted bigram keys
    folds: tuple[Fold, Fold] = None

    def __post_init__(self, tokens: np.ndarray):
        self.share = np.cumsum(np.concatenate([[0], tokens, tokens[:1]]), dtype=float)  # beginnings count like the most frequent word
        self.share /= max(1, self.share[-1])
        self.slots = np.searchsorted(self.vocabulary, np.arange((1 << SLOT_BITS) + 1, dtype=np.uint64) << np.uint64(WORD_BITS - SLOT_BITS)).astype(np.int32)

    def number(self, h: np.ndarray) -> np.ndarray:
        """Ids of words by their hashes, RARE for rare ones; a slot of first bits says where a hash can be."""
        found = np.full(len(h), RARE)
        for i in range(0, len(h), ROWS):  # some at a time bound the memory
            own, out = h[i : i + ROWS], found[i : i + ROWS]
            slot = (own >> np.uint64(WORD_BITS - SLOT_BITS)).astype(np.int64)
            at, end = self.slots[slot], self.slots[1:][slot]
            left = np.flatnonzero(at < end)
            while len(left):
                place = at[left]
                same = self.vocabulary[place] == own[left]
                out[left[same]] = self.ids[place[same]]
                at[left] += 1
                left = left[~same & (at[left] < end[left])]
        return found

    def places(self, key: np.ndarray) -> np.ndarray:
        """Rising 48-bit places of bigrams of frequent words, among which tokens are spread evenly."""
        found = np.empty(len(key), np.uint64)
        for i in range(0, len(key), ROWS):
            own = key[i : i + ROWS]
            first = np.minimum((own >> np.uint64(ID_BITS)).astype(np.int64), len(self.vocabulary))
            second = (own & np.uint64((1 << ID_BITS) - 1)).astype(np.int64)
            low = self.share[first]
            found[i : i + ROWS] = (low + (self.share[first + 1] - low) * self.share[second]) * (1 << WORD_BITS)
        return found

    def bigrams(self, words: P.Words) -> tuple[np.ndarray, np.ndarray, Occurrences]:
        """A 40-bit key for each frequent word after a frequent one or a beginning, their texts, and the rare words."""
        h = words.hash >> np.uint64(64 - WORD_BITS)
        ids = self.number(h)
        before, after = np.roll(ids, 1), np.roll(ids, -1)
        before[words.place == 0] = BEGIN
        after[words.first[1:][np.diff(words.first) > 0] - 1] = END
        rare = ids == RARE
        known = ~rare & (before != RARE)
        key = (before[known].astype(np.uint64) << np.uint64(ID_BITS)) | ids[known].astype(np.uint64)
        none = np.uint64(0)
        found = Occurrences(
            h[rare], before[rare].astype(np.uint32), after[rare].astype(np.uint32), np.where(before == RARE, np.roll(h, 1), none)[rare],
            np.where(after == RARE, np.roll(h, -1), none)[rare], words.doc[rare])
        return key, words.doc[known], found

    def settle(self, rows: list) -> Model:
        """Take in the totals, (kind, fold, blob) rows; kind 3 are hot bigrams with their counts in both halves."""
        found: dict = {}
        for kind, fold, blob in rows:
            found.setdefault((fold, kind), []).append([P.expanded(x, np.int64) for x in blob])
        found = {k: [np.concatenate(c) for c in zip(*parts)] for k, parts in found.items()}
        hot = found.get((0, 3), [np.zeros(0, np.int64)] * 3)
        order = np.argsort(hot[0])
        self.hot = hot[0][order].astype(np.uint64)
        self.folds = tuple(Fold({k: (c[0], c[1:]) for (fold, k), c in found.items() if fold == f}, len(self.vocabulary), hot[1 + f][order]) for f in (0, 1))
        return self

    def rare_costs(self, o: Occurrences, side: list, docs: int) -> np.ndarray:
        """Sums for each document of the costs of frequent words' bigrams with the rare words of this bucket, and of
        all bigrams that these begin; each by the model of the other half. ``side`` has what ``fitted`` found of pairs of rare words."""
        total = np.zeros(docs, np.int64)
        # a frequent word or a beginning, then a rare word
        at = np.flatnonzero(o.before != RARE)
        word, before, doc, fold = o.word[at], o.before[at].astype(np.int64), o.doc[at], o.fold[at]
        _, first, run = P.runs(word, before)
        if len(at):
            count = by_fold(run, fold, np.ones(len(at), np.int64), len(first))
            pick = np.empty(len(first), np.int64)
            pick[run] = np.arange(len(at))
            word, before = word[pick], before[pick]
            _, begin, of = P.runs(word)
            after_rare = [x for kind, x in side if kind == 8]
            h, *more = (np.concatenate(x) for x in zip(*after_rare)) if after_rare else [np.zeros(0, np.uint64)] * 3
            for f in (0, 1):
                model, other = self.folds[1 - f], count[1 - f]
                follows = np.add.reduceat(other > 0, begin, dtype=np.int64)
                if len(h):
                    order = np.argsort(h)
                    seen = np.minimum(np.searchsorted(h[order], word[begin]), len(h) - 1)
                    follows = follows + np.where(h[order][seen] == word[begin], more[1 - f][order][seen].astype(np.int64), 0)
                cost = model.costs(other, model.context[model.at(before)], model.backoff[model.at(before)], model.continuation(follows)[of])
                own = fold == f
                total += np.bincount(doc[own], cost[run[own]], docs).astype(np.int64)

        # a rare word, then any
        at = np.flatnonzero(o.after != END)
        word, after, hash_, doc, fold = o.word[at], o.after[at].astype(np.int64), o.after_word[at], o.doc[at], o.fold[at]
        _, first, run = P.runs(word, after, hash_)
        if len(at):
            count = by_fold(run, fold, np.ones(len(at), np.int64), len(first))
            pick = np.empty(len(first), np.int64)
            pick[run] = np.arange(len(at))
            word, after, hash_ = word[pick], after[pick], hash_[pick]
            _, begin, of = P.runs(word)
            pair = after == RARE
            if pair.any():
                pairs = [x for kind, x in side if kind == 9]
                key = joined(np.concatenate([x[0] for x in pairs]), np.concatenate([x[1] for x in pairs]))
                order = np.argsort(key)
                seen = order[np.searchsorted(key[order], joined(word[pair], hash_[pair]))]
            for f in (0, 1):
                model, other = self.folds[1 - f], count[1 - f]
                context = np.add.reduceat(other, begin)
                backoff = np.add.reduceat(model.discount[np.minimum(other, 3)], begin) / np.maximum(context, 1)
                lower = model.lower[model.at(after)]
                if pair.any():
                    lower[pair] = model.continuation(np.concatenate([x[3 - f] for x in pairs]).astype(np.int64)[seen])
                cost = model.costs(other, context[of], backoff[of], lower)
                own = fold == f
                total += np.bincount(doc[own], cost[run[own]], docs).astype(np.int64)
        return total


def by_fold(run: np.ndarray, fold: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``n`` for each run, in the first and in the second half."""
    return tuple(np.bincount(run[fold == f], n[fold == f], size).astype(np.int64) for f in (0, 1))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash for two."""
    return P.mixed(P.mixed(a + np.uint64(1)) + b)


def anchors(words: P.Words) -> tuple[np.ndarray, np.ndarray]:
    """Content-selected passages of ANCHOR words: the distinct (hash, text) of each, sorted."""
    h, inside = words.rolling(ANCHOR, 11)
    at = np.flatnonzero(inside & (h % np.uint64(EVERY) == 0))
    key, doc = h[at] >> np.uint64(64 - WORD_BITS), words.doc[at]
    order, starts, _ = P.runs(key, doc)
    return key[order[starts]], doc[order[starts]]


def _slices(batches, size: int = 3 << 20):
    """(fold, record batch, whole texts as bytes) of about ``size`` bytes or ROWS rows; a null text is empty.

    A text's fold, 0 or 1, is by its digest: copies are in one."""
    pa.default_memory_pool().release_unused()  # of earlier tasks of this worker
    for whole in batches:
        side = whole["digest"].to_numpy() & 1
        for fold in (0, 1):
            b = whole.filter(pa.array(side == fold))
            text = b["text"].cast(pa.binary())
            lengths = pc.fill_null(pc.binary_length(text), 0).to_pylist()
            start = held = 0
            for i, n in enumerate([*lengths, None]):
                if n is None or held and held + n > size or i - start >= ROWS:
                    if i > start:
                        yield fold, b.slice(start, i - start), [t or b"" for t in text.slice(start, i - start).to_pylist()]
                    start, held = i, 0
                held += n or 0


def _dealt(groups: list[tuple[np.ndarray, list]], buckets: int) -> list[tuple[int, list[bytes]]]:
    """For each bucket the packed columns of each group; ``groups`` are (key, [(column, pack)]), dealt by ranges of
    the key, 48 bits that are spread evenly: sorted columns then stay dense however many buckets there are. A bucket has
    RANGES of them, from all over. The order of a group's rows stays."""
    places = []
    for key, _ in groups:
        ranges = (key >> np.uint64(WORD_BITS - 32)) * np.uint64(buckets * RANGES) >> np.uint64(32)
        bucket = (ranges % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        places.append((order, np.searchsorted(bucket[order], np.arange(buckets + 1))))
    filled = [b for b in range(buckets) if any(cuts[b + 1] > cuts[b] for _, cuts in places)]
    return [(b, [pack(column[order[cuts[b] : cuts[b + 1]]]) for (order, cuts), (_, columns) in zip(places, groups) for column, pack in columns]) for b in filled]


def _rare(o: Occurrences, far: str, with_doc: bool) -> tuple[np.ndarray, list]:
    """The rare words as a group for ``_dealt``, with the hashes of rare ``far`` neighbours."""
    order = np.lexsort((o.doc, o.word) if with_doc else (o.doc, o.before, o.word))
    columns = [(o.word, P.squeezed_sorted), (o.before, P.squeezed), (o.after, P.squeezed), (getattr(o, far), lambda v: P.squeezed(v[v > 0]))]
    columns += [(o.doc.astype(np.uint16), P.squeezed)] if with_doc else []
    return o.word[order], [(c[order], pack) for c, pack in columns]


def _occurrences(blobs: list[list[bytes]], far: str, folds: list[int]) -> tuple[Occurrences, list[int]]:
    """The rare words of some parcels, by their columns from ``_rare``, and how many each parcel has."""
    word = [P.expanded_sorted(b[0]) for b in blobs]
    before, after = (np.concatenate([P.expanded(b[k], np.uint32) for b in blobs]) for k in (1, 2))
    beside = np.zeros(len(before), np.uint64)
    beside[(before if far == "before_word" else after) == RARE] = np.concatenate([P.expanded(b[3], np.uint64) for b in blobs])
    sizes = [len(w) for w in word]
    doc = np.concatenate([P.expanded(b[4], np.uint16) for b in blobs]).astype(np.int64) if len(blobs[0]) > 4 else None
    return Occurrences(np.concatenate(word), before, after, beside, beside, doc, np.repeat(folds, sizes)), sizes


def fitted(docs: DataFrame, buckets: int, vocabulary: int = VOCABULARY) -> tuple[Model, DataFrame]:
    """The models of both halves of ``docs`` (digest, text), and what the buckets must know of pairs of rare words.

    Only tables with a proven bound reach the driver: the ``vocabulary`` most frequent words (of those that
    are three times in a slice) with their totals, and bigrams of them with a 2 ** -19 share of the tokens or more. Rare words are counted in hash buckets.
    """

    def words(batches):
        for _, _, texts in _slices(batches, 5 << 20):
            h = P.Words(texts).hash >> np.uint64(64 - WORD_BITS)
            tokens = len(h)
            h, n = np.unique(h, return_counts=True)
            some = n > 2  # a word that is never three times in a slice isn't frequent
            h, n = h[some], n[some].astype(np.uint32)
            found = _dealt([(h, [(h, P.squeezed_sorted), (n, P.squeezed)])], buckets) or [(0, [P.squeezed_sorted(h), P.squeezed(n)])]
            own = [tokens, *[0] * (len(found) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.list_(pa.binary())), pa.array(own, pa.int64())], names=["bucket", "blob", "tokens"])

    share = vocabulary / buckets  # words fall in buckets by hash: none has many more of the top than its share
    most = int(share + 8 * share**0.5 + 8)

    def tally(t):
        blobs = t["blob"].to_pylist()
        h = np.concatenate([P.expanded_sorted(b[0]) for b in blobs])
        order, starts, _ = P.runs(h)
        n = np.concatenate([P.expanded(b[1], np.uint32) for b in blobs])[order].astype(np.int64)
        n = np.add.reduceat(n, starts) if len(starts) else n
        top = np.argsort(-n, kind="stable")[:most]
        whole = np.zeros(len(top) + 1, np.int64)
        whole[0] = sum(t["tokens"].to_pylist())  # in a row without a word
        h = pa.array(np.append(0, h[order[starts]].view(np.int64)[top]), mask=np.arange(len(top) + 1) == 0)
        return pa.table({"h": h, "n": pa.array(np.append(0, n[top])), "tokens": pa.array(whole)})

    seen = Observation()
    counted = docs.mapInArrow(words, "bucket int, blob array<binary>, tokens long").groupBy("bucket").applyInArrow(tally, "h long, n long, tokens long")
    counted = counted.observe(seen, F.sum("tokens").alias("tokens"))
    with freeing_shuffles(docs.sparkSession):
        top = counted.where("h is not null").select("h", "n").orderBy(F.col("n").desc(), "h").limit(vocabulary).toArrow()
    tokens = seen.get["tokens"] or 0
    hashes = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    model = Model(hashes[order], order, top["n"].to_numpy())

    def pairs(batches):
        for fold, _, texts in _slices(batches, 5 << 20):
            key, _, rare = model.bigrams(P.Words(texts))
            key, n = np.unique(key, return_counts=True)
            n = n.astype(np.uint32)
            found = _dealt([(model.places(key), [(key, P.squeezed_sorted), (n, P.squeezed)]), _rare(rare, "before_word", False)], buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in found], pa.int32()), pa.array([fold] * len(found), pa.int32()), pa.array([x for _, x in found], pa.list_(pa.binary()))], names=["bucket", "fold", "blob"])

    least = max(2, -(-tokens // HOT))

    def contexts(fold, first, n):
        ids, at = np.unique(first, return_inverse=True)
        return 0, fold, ids, [np.bincount(at, n, len(ids)), *(np.bincount(at[np.minimum(n, 3) == k], minlength=len(ids)) for k in (1, 2, 3))]

    def continuations(fold, second):
        ids, n = np.unique(second, return_counts=True)
        return 1, fold, ids, [n]

    def counts(kind, fold, n):
        return kind, fold, np.zeros(1), [np.array([(n == k).sum()]) for k in (1, 2, 3, 4)]

    def rows(found):
        """(kind, fold, range, blob) rows of (kind, fold, ids, columns): ids that repeat are added up, and cut in ranges."""
        out = []
        for kind, fold in sorted({x[:2] for x in found}):
            parts = [x[2:] for x in found if x[:2] == (kind, fold)]
            ids, at = np.unique(np.concatenate([i for i, _ in parts]).astype(np.int64), return_inverse=True)
            columns = [np.bincount(at, np.concatenate(c), len(ids)).astype(np.int64) for c in zip(*(c for _, c in parts))]
            part = np.minimum(ids // RANGE, 1 << ID_BITS)
            for k in np.unique(part).tolist():
                lo, hi = np.searchsorted(part, [k, k + 1])
                out.append((kind, fold, k, [P.squeezed(ids[lo:hi]), *(P.squeezed(c[lo:hi]) for c in columns)]))
        return out

    def as_table(found):
        kinds = ("kind", pa.int32()), ("fold", pa.int32()), ("part", pa.int32()), ("blob", pa.list_(pa.binary()))
        return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds, zip(*found))})

    def add(t):
        found = [(k, f, P.expanded(b[0], np.int64), [P.expanded(c, np.int64) for c in b[1:]]) for k, f, b in zip(t["kind"].to_pylist(), t["fold"].to_pylist(), t["blob"].to_pylist())]
        return as_table(rows(found))

    def totals(key, t):
        blobs, folds = t["blob"].to_pylist(), t["fold"].to_pylist()
        keys = [P.expanded_sorted(b[0]) for b in blobs]
        fold = np.repeat(folds, [len(k) for k in keys])
        order, starts, run = P.runs(np.concatenate(keys))
        pair = np.concatenate(keys)[order[starts]].astype(np.int64)
        count = by_fold(run, fold, np.concatenate([P.expanded(b[1], np.uint32) for b in blobs]).astype(np.int64), len(starts))
        hot = np.flatnonzero(count[0] + count[1] >= least)
        out = [(3, 0, pair[hot], [n[hot] for n in count])]
        for f, n in enumerate(count):
            some = n > 0
            out += [contexts(f, pair[some] >> ID_BITS, n[some]), continuations(f, pair[some] & (1 << ID_BITS) - 1), counts(2, f, n)]
        (o, _), side = _occurrences([b[2:] for b in blobs], "before_word", folds), []
        if len(o.word):
            ones = np.ones(len(o.word), np.int64)
            # each distinct bigram that ends with a rare word of this bucket
            order, starts, run = P.runs(o.word, o.before, o.before_word)
            pick = order[starts]
            word, before, hash_ = o.word[pick], o.before[pick].astype(np.int64), o.before_word[pick]
            known = before != RARE
            _, begin, of = P.runs(word)
            follows, rare = [], []
            for f, n in enumerate(by_fold(run, o.fold, ones, len(starts))):
                follows.append(np.add.reduceat(n > 0, begin, dtype=np.int64))
                rare.append(np.bincount(of[~known & (n > 0)], minlength=len(begin)))
                some = known & (n > 0)
                out += [contexts(f, before[some], n[some]), counts(2, f, n), counts(4, f, follows[f]), (5, f, np.zeros(1), [follows[f].sum(keepdims=True), (follows[f] > 0).sum(keepdims=True)])]
            some = np.flatnonzero(rare[0] + rare[1])
            if len(some):
                side.append((8, key[0].as_py(), [P.squeezed_sorted(word[begin][some]), *(P.squeezed(r[some].astype(np.uint32)) for r in rare)]))
                first, second = hash_[~known], word[~known]
                order = np.lexsort((second, first))
                columns = [(first, P.squeezed_sorted), (second, P.squeezed), *((x[of][~known].astype(np.uint32), P.squeezed) for x in follows)]
                side += [(9, b, x) for b, x in _dealt([(first[order], [(c[order], pack) for c, pack in columns])], buckets)]
            # and each that begins with one and ends with a frequent word
            at = np.flatnonzero(o.after < RARE)
            order, starts, run = P.runs(o.word[at], o.after[at])
            after = o.after[at][order[starts]].astype(np.int64)
            for f, n in enumerate(by_fold(run, o.fold[at], ones[at], len(starts))):
                out += [counts(2, f, n), continuations(f, after[n > 0])]
        return as_table(rows(out) + [(kind, 0, b, x) for kind, b, x in side])

    schema = "kind int, fold int, part int, blob array<binary>"
    sent = docs.mapInArrow(pairs, "bucket int, fold int, blob array<binary>")
    path = kept(sent.groupBy("bucket").applyInArrow(totals, schema).withColumn("side", F.col("kind") >= 8), "side")
    read = docs.sparkSession.read.schema(f"{schema}, side boolean")
    whole = read.parquet(path).where("not side").drop("side").groupBy("kind", "fold", "part").applyInArrow(add, schema)
    with freeing_shuffles(docs.sparkSession):
        model.settle([(r.kind, r.fold, [bytes(x) for x in r.blob]) for r in whole.collect()])
    Store(docs.sparkSession, path).delete(f"{path}/side=false")  # they are in the model now
    return model, read.parquet(path).where("side").select(F.col("part").alias("bucket"), "kind", "blob")


def scored(docs: DataFrame, model: Model, side: DataFrame, buckets: int) -> DataFrame:
    """(id, lang, digest, base statistics, cost, n_anchors, n_copied) for each row of (id, lang, digest, text).

    ``cost`` is the negative log probability by the model of the other half, times SCALE; ``n_copied`` counts
    the anchors that another document has."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def send(batches):
        m, part, n_batch = shared.value, TaskContext.get().partitionId(), 0
        for fold, b, texts in _slices(batches):
            words = P.Words(texts)
            key, of, rare = m.bigrams(words)
            key, own = np.unique((of.astype(np.uint64) << np.uint64(2 * ID_BITS)) | key, return_counts=True)
            doc, key, own = (key >> np.uint64(2 * ID_BITS)).astype(np.int64), key & np.uint64((1 << 2 * ID_BITS) - 1), own.astype(np.uint32)
            at = np.minimum(np.searchsorted(m.hot, key), max(0, len(m.hot) - 1))
            hot = m.hot[at] == key if len(m.hot) else np.zeros(len(key), bool)
            local = np.zeros(len(texts), np.int64)
            if hot.any():
                other = m.folds[1 - fold]
                np.add.at(local, doc[hot], own[hot] * other.pair_costs(key[hot], other.hot_count[at[hot]]))
            key, doc, own = key[~hot], doc[~hot], own[~hot]
            order = np.lexsort((doc, key))
            key, doc, own = key[order], doc[order], own[order]
            anchor, anchor_doc = anchors(words)
            found = _dealt([
                (m.places(key), [(key, P.squeezed_sorted), (doc.astype(np.uint16), P.squeezed), (own, P.squeezed)]), _rare(rare, "after_word", True),
                (anchor, [(anchor, P.squeezed_sorted), (anchor_doc.astype(np.uint16), P.squeezed)])], buckets) or [(0, [])]
            n, batch = len(found), part << 32 | n_batch
            n_anchors = np.bincount(anchor_doc, minlength=len(texts))
            about = [b["id"].to_pylist(), b["lang"].to_pylist(), b["digest"].to_pylist(), base_statistics(texts, words).reshape(-1).tolist(), local.tolist(), n_anchors.tolist()]
            carrier = n_batch % n  # one parcel carries what is known of the documents
            cols = [pa.array([x if i == carrier else None for i in range(n)], pa.list_(t)) for x, t in zip(about, (pa.int64(), pa.string(), *[pa.int64()] * 4))]
            yield pa.RecordBatch.from_arrays([
                pa.array([x for x, _ in found], pa.int32()), pa.array([batch] * n, pa.int64()), pa.array([fold] * n, pa.int32()), pa.array([len(texts)] * n, pa.int32()),
                pa.array([x for _, x in found], pa.list_(pa.binary())), *cols], names=names)
            n_batch += 1

    about = ["id", "lang", "digest", "base", "local", "anchors"]
    names = ["bucket", "batch", "fold", "size", "blob", *about]
    about_type = ", ".join(f"{c} array<{'string' if c == 'lang' else 'long'}>" for c in about)

    def answer(t, side):
        blobs, sizes, folds = t["blob"].to_pylist(), t["size"].to_pylist(), t["fold"].to_pylist()
        full = [i for i, b in enumerate(blobs) if b]
        out = [[]] * len(blobs)
        if full:
            edge = np.cumsum([sizes[i] for i in full])
            shift, docs = edge - [sizes[i] for i in full], int(edge[-1])  # documents of all parcels have numbers of their own

            def place(kind, column):
                docs_of = [P.expanded(blobs[i][column], kind).astype(np.int32) for i in full]
                return np.concatenate(docs_of) + np.repeat(shift, [len(x) for x in docs_of]).astype(np.int32)

            key = [P.expanded_sorted(blobs[i][0]) for i in full]
            fold = np.repeat(np.array([folds[i] for i in full], np.int8), [len(k) for k in key])
            key = np.concatenate(key)
            order, starts, run = P.runs(key)
            key, run = key[order[starts]], run.astype(np.int32)
            del order
            own, doc = np.concatenate([P.expanded(blobs[i][2], np.uint32) for i in full]), place(np.uint16, 1)
            count, cost = by_fold(run, fold, own, len(starts)), np.zeros(docs, np.int64)
            for f in (0, 1):
                here = fold == f
                cost += np.bincount(doc[here], own[here] * shared.value.folds[1 - f].pair_costs(key, count[1 - f])[run[here]], docs).astype(np.int64)
            del key, fold, own, doc, run, here
            rare, lengths = _occurrences([blobs[i][3:8] for i in full], "after_word", [folds[i] for i in full])
            rare.doc = rare.doc + np.repeat(shift, lengths)
            kinds = {8: (np.uint32, np.uint32), 9: (np.uint64, np.uint32, np.uint32)}
            known = [(k, [P.expanded_sorted(x[0]), *(P.expanded(y, kind) for y, kind in zip(x[1:], kinds[k]))]) for k, x in zip(side["kind"].to_pylist(), side["blob"].to_pylist())]
            cost += shared.value.rare_costs(rare, known, docs)
            anchor = np.concatenate([P.expanded_sorted(blobs[i][8]) for i in full])
            of = place(np.uint16, 9)
            order, starts, run = P.runs(anchor)
            copied = np.bincount(of[(np.diff(np.append(starts, len(order))) > 1)[run]], minlength=docs)
            for i, c, n in zip(full, np.split(cost, edge[:-1]), np.split(copied, edge[:-1])):
                out[i] = [P.squeezed(c), P.squeezed(n.astype(np.uint32))]
        return t.drop_columns(["bucket", "fold", "blob"]).append_column("sums", pa.array(out, pa.list_(pa.binary())))

    def gather(t):
        n = t["size"][0].as_py()
        i = next(i for i, x in enumerate(t["id"].to_pylist()) if x is not None)
        cost, copied = np.array(t["local"][i].as_py(), np.int64), np.zeros(n, np.int64)
        for x in t["sums"].to_pylist():
            if x:
                cost += P.expanded(x[0], np.int64)
                copied += P.expanded(x[1], np.uint32)
        base = np.array(t["base"][i].as_py(), np.int64).reshape(n, len(BASE))
        return pa.table({
            "id": pa.array(t["id"][i].as_py(), pa.int64()), "lang": pa.array(t["lang"][i].as_py(), pa.string()), "digest": pa.array(t["digest"][i].as_py(), pa.int64()),
            **{c: pa.array(base[:, k]) for k, c in enumerate(BASE)}, "cost": pa.array(cost), "n_anchors": pa.array(t["anchors"][i].as_py(), pa.int64()), "n_copied": pa.array(copied)})

    sent = docs.mapInArrow(send, f"bucket int, batch long, fold int, size int, blob array<binary>, {about_type}")
    sums_ = sent.groupBy("bucket").cogroup(side.groupBy("bucket")).applyInArrow(answer, f"batch long, size int, {about_type}, sums array<binary>")
    return sums_.groupBy("batch").applyInArrow(gather, "id long, lang string, digest long, " + ", ".join(f"{c} long" for c in [*BASE, "cost", "n_anchors", "n_copied"]))


def quality(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", fence: float = 3.0, most_copied: float = 0.25, least_range: float = 0.3,
    bucket_bytes: int = 16 << 20, vocabulary: int = VOCABULARY,
) -> DataFrame:
    """(id, digest, lang, base statistics, base_failed, perplexity, copied, lower, upper, kept) for each row.

    The models are interpolated modified Kneser-Ney bigram models, one of each half of the texts (by a hash,
    so copies are in one half): Spark counts words, then bigrams, in hash buckets that each hold their bigrams
    as a sorted array. A text is scored by the model of the other half, so neither it nor its copies vouch for
    it; words which that half lacks are one unknown word. Every word is a word of the model: the ``vocabulary``
    most frequent ones have short ids, all others are counted and scored by their hashes. Frequent bigrams are
    scored where they are read; the others travel as sorted postings to their buckets, which answer with sums
    for each document, so texts are never shuffled for it.

    ``copied`` is the share of a document's content-selected passages of eight words that another document has
    too. Text that others copied is easy to predict, which says nothing of its quality: documents with more than
    ``most_copied`` of it are not held to the lower edge, and dedup judges them.

    The band of a language is made of the quartiles of log perplexity of its distinct texts that pass the base
    rules and are not copied: from ``fence`` interquartile ranges under the first to as many over the third
    (3, the outer fences of a box plot; a range is taken as ``least_range`` at least). A language without such
    texts has no band. Outside the band a document is rejected.

    Null and empty texts have no words and fail the base rules (fewer than 50 words, or over half the words in
    repeated trigrams). A null language is a language of its own; a null id is kept as one. ``digest`` is
    xxhash64 of the text. Rows that repeat others share their scores, an empty table gives none, and other columns are ignored.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    source = docs.select(F.col(id).cast("long").alias("id"), F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    found = scored(source, *fitted(source.select("digest", "text"), buckets, vocabulary), buckets)
    rated = found.withColumn("log_ppl", F.when(F.col("n_words") > 0, F.col("cost") / (F.col("n_words") * SCALE)))
    rated = rated.withColumn("copied", F.coalesce(F.try_divide("n_copied", "n_anchors"), F.lit(0.0)))
    rated = rated.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    rated = checkpointed(rated)
    fair = rated.where(~F.col("base_failed") & (F.col("copied") <= most_copied))
    once = fair.groupBy("lang", "digest").agg(F.min("log_ppl").alias("log_ppl"))  # copies count once
    one, three = (F.percentile_approx("log_ppl", q, 10000) for q in (0.25, 0.75))
    bands = once.groupBy(F.col("lang").alias("band_lang")).agg(one.alias("one"), three.alias("three"))
    bands = bands.withColumn("reach", fence * F.greatest(F.lit(least_range), F.col("three") - F.col("one")))
    joined = rated.join(bands, F.col("lang").eqNullSafe(F.col("band_lang")), "left")
    low, high = F.col("one") - F.col("reach"), F.col("three") + F.col("reach")
    inside = F.coalesce((F.col("log_ppl") <= high) & ((F.col("log_ppl") >= low) | (F.col("copied") > most_copied)), F.lit(True))
    return joined.select(
        F.col("id").alias(id), "digest", F.col("lang").alias(lang), *BASE, "base_failed", F.exp("log_ppl").alias("perplexity"), "copied",
        F.exp(low).alias("lower"), F.exp(high).alias("upper"), (~F.col("base_failed") & inside).alias("kept"))


def keep_good(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", **how) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns; rows with one text and language
    share their verdict."""
    good = quality(docs, id, text, lang, **how).where("kept").select(F.col(lang).alias("good_lang"), F.col("digest").alias("good_digest")).distinct()
    columns = [f"c{i}" for i in range(len(docs.columns))]
    own_text, own_lang = (F.col(columns[docs.columns.index(c)]) for c in (text, lang))
    kept = docs.toDF(*columns).join(good, (F.xxhash64(own_text) == F.col("good_digest")) & own_lang.cast("string").eqNullSafe(F.col("good_lang")), "left_semi")
    return kept.toDF(*docs.columns)
