"""Passages that repeat across documents, by sparse suffix arrays over minimiser positions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewise.llm import passages as P

ANCHOR_BITS = 48
#: Suffixes with one gram that are compared in one task. Those of a more frequent gram are told apart by their windows.
HOT = 4096
DEAD, LIVE, SPLIT = 0, 1, 2


def sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each run of n values."""
    out, have = values, 1
    while have * 2 <= n:
        out = pick(out[: len(out) - have], out[have:])
        have *= 2
    return pick(out[: len(out) - (n - have)], out[n - have :]) if n > have else out


class Suffixes:
    """The retained suffixes of a batch: positions whose gram is the least in some window of ``window`` words.

    ``at`` are their word positions, ``key`` the distinct 48-bit gram hashes in order, ``entry`` the
    place of each suffix among them, ``several`` whether documents with different ids have the gram,
    ``count`` how many suffixes have it.
    """

    def __init__(self, words: P.Words, ids: np.ndarray, window: int, gram: int, buckets: int):
        self.words, self.ids = words, ids
        h, inside = words.rolling(gram, 7)
        reach = window - gram + 1
        if len(h) >= reach:
            least = sliding(h, reach, np.minimum)
            whole = words.doc[: len(least)] == words.doc[window - 1 :]
            low = np.where(whole, least, np.uint64(0))
            pad = np.zeros(reach - 1, np.uint64)
            best = sliding(np.concatenate([pad, low, pad]), reach, np.maximum)
            self.at = np.flatnonzero((best == h) & inside)
        else:
            self.at = np.zeros(0, np.int64)
        self.gram = P.mixed(h[self.at])  # least hashes are small ones: mixed, they fill all buckets alike
        order, starts, self.entry = P.runs(self.gram >> np.uint64(64 - ANCHOR_BITS))
        self.key = self.gram[order[starts]] >> np.uint64(64 - ANCHOR_BITS)
        self.cuts = P.cut_at_buckets(self.key, buckets, ANCHOR_BITS)
        owner = ids[words.doc[self.at]][order]
        self.several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts) if len(starts) else np.zeros(0, bool)
        self.count = np.minimum(np.diff(np.append(starts, len(order))), HOT + 1).astype(np.uint16)


class Windows:
    """The distinct windows of a batch around its suffixes of split grams, sorted: ``high`` and ``low`` (64 and
    32 bits of hash) and ``least``, the smallest id that has one; ``at`` and ``entry`` place each occurrence."""

    def __init__(self, s: Suffixes, verdict: np.ndarray, window: int, gram: int, buckets: int):
        words = s.words
        h, inside = words.rolling(window, 9)
        ends = np.zeros(len(words.hash) + 1, np.int64)
        suffix = s.at[verdict[s.entry] == SPLIT]
        np.add.at(ends, np.maximum(suffix - (window - gram), 0), 1)  # a window holds the whole gram
        np.add.at(ends, suffix + 1, -1)
        at = np.flatnonzero((np.cumsum(ends)[: len(h)] > 0) & inside)
        high, low = h[at], (words.rolling(window, 10)[0][at] >> np.uint64(32)).astype(np.uint32)
        order, starts, self.entry = P.runs(high, low)
        self.at, self.high, self.low = at, high[order[starts]], low[order[starts]]
        self.owner = s.ids[words.doc[at]]
        self.least = np.minimum.reduceat(self.owner[order], starts) if len(starts) else np.zeros(0, np.int64)
        self.cuts = P.cut_at_buckets(self.high, buckets, 64)


class Contexts:
    """The distinct live suffixes of a batch with ``left`` words before them and ``window`` from them on,
    as 32-bit hashes (0 beyond the document), and ``least``, the smallest id that has each."""

    def __init__(self, s: Suffixes, verdict: np.ndarray, window: int, gram: int, buckets: int):
        words, self.left, live = s.words, window - gram, verdict == LIVE
        self.at = s.at[live[s.entry]]
        place = self.at[:, None] + np.arange(-self.left, window)
        first, end = words.first[words.doc[self.at]], words.first[words.doc[self.at] + 1]
        inside = (place >= first[:, None]) & (place < end[:, None])
        short = (words.hash >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        around = np.where(inside, short[np.clip(place, 0, max(0, len(short) - 1))] if len(short) else 0, np.uint32(0))
        # a window may start 0 to ``left`` words before the suffix, where all of it lies in the document
        back = np.arange(self.left + 1)
        self.fits = (self.at[:, None] - back >= first[:, None]) & (self.at[:, None] - back + window <= end[:, None])
        factors = P.odd_numbers(around.shape[1], 8)
        whole = P.mixed((around.astype(np.uint64) * factors).sum(axis=1, dtype=np.uint64))
        gram_hash = s.gram[live[s.entry]]
        order, starts, self.entry = P.runs(gram_hash, whole)
        self.gram, self.around = gram_hash[order[starts]], around[order[starts]]
        self.owner = s.ids[words.doc[self.at]]
        self.least = np.minimum.reduceat(self.owner[order], starts) if len(starts) else np.zeros(0, np.int64)
        self.cuts = P.cut_at_buckets(self.gram, buckets, 64)


def shared_windows(gram: np.ndarray, around: np.ndarray, least: np.ndarray, left: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix and each o in 0..left, whether an earlier document has the window that starts o words
    before it; and the smallest id of those documents.

    The suffixes are sorted by what follows; the common prefix of neighbours tells the intervals that
    agree on the words from the suffix on. In each interval the words before it are compared, one more
    for each o.
    """
    window = around.shape[1] - left
    if not len(gram):
        return np.zeros((0, left + 1), bool), np.zeros(0, np.int64)
    right = np.ascontiguousarray(around[:, left:].astype(">u4"))
    order = np.lexsort((np.arange(len(gram)), right.view(f"V{4 * window}").reshape(-1).argsort(kind="stable").argsort(), gram))
    g, r = gram[order], right[order]
    same = (r[1:] == r[:-1]) & (g[1:] == g[:-1])[:, None]
    common = np.append(0, np.where(same.all(axis=1), window, same.argmin(axis=1)))
    own = least[order]
    before = np.zeros(len(g), np.uint64)
    found, source = np.zeros((len(g), left + 1), bool), np.full(len(g), P.NO_ID)
    for o in range(left + 1):
        if o:
            before = P.mixed(before * np.uint64(0x9E3779B97F4A7C15) + around[order, left - o])
        interval = np.cumsum(common < window - o)
        at, starts, run = P.runs(interval, before)
        low = np.minimum.reduceat(own[at], starts)[run]
        found[:, o] = low < own
        source = np.where(found[:, o], np.minimum(source, low), source)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return found[back], source[back]


def repeated_passages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 50, gram: int = 12, batch_bytes: int | None = None, hot_suffixes: int = HOT,
) -> DataFrame:
    """(id, start, n_words, first_id): each maximal run of words that lie in windows of ``window`` words which
    a document with a smaller id has too; ``first_id`` is the smallest such id met in the run.

    Only suffixes at content-selected positions are kept: those whose gram of ``gram`` words hashes least
    in a window. Equal windows select equal positions, so no repeat of ``window`` words is missed, and
    about 2 of window - gram + 2 suffixes stay. In rounds between document batches and hash buckets (see
    ``substring_dedup``): grams that several documents have are found; only their suffixes travel, with
    the words around them as hashes, once for each distinct context of a batch; buckets sort them, compare
    neighbours and extend matches left and right; batches join the windows to maximal runs. The suffixes of
    one gram meet in one bucket, so a gram of more than HOT suffixes is split: for its suffixes the windows
    around them travel as hashes of their own, each to its own bucket, and the smallest id answers.

    Null, empty and short texts have no passages. Repeats within one document, or between rows with equal
    ids, don't count. A null id is larger than every other. Other columns are ignored. Words beside a
    suffix are compared by 32 bits of hash, the gram by 64.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    batches, buckets = P.dealing(total, batch_bytes)
    left = window - gram
    dealt = docs.select(P.batch_number(id, text, batches), F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sent, answer = "bucket int, batch int, blob array<binary>", "batch int, bucket int, round int, blob array<binary>"
    sent_type = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("blob", pa.list_(pa.binary()))])
    answer_type = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("round", pa.int32()), ("blob", pa.list_(pa.binary()))])

    def parcels(batch, *kinds):
        """For each bucket the columns of its range; ``kinds`` are (cuts, columns), empty columns where a kind has none."""
        filled = [b for b in range(buckets) if any(cuts[b + 1] > cuts[b] for cuts, _ in kinds)]
        blobs = [[pack(v[cuts[b] : cuts[b + 1]]) for cuts, columns in kinds for v, pack in columns] for b in filled]
        return pa.table([pa.array(filled, pa.int32()), pa.array([batch] * len(filled), pa.int32()), pa.array(blobs, pa.list_(pa.binary()))], schema=sent_type)

    def answers(t, n_round, blobs):
        return pa.table([t["batch"], t["bucket"], pa.array([n_round] * len(blobs), pa.int32()), pa.array(blobs, pa.list_(pa.binary()))], schema=answer_type)

    def suffixes(t):
        return Suffixes(P.group_words(t)[1], P.group_ids(t), window, gram, buckets)

    def send_grams(key, t):
        s = suffixes(t)
        return parcels(key[0].as_py(), (s.cuts, [(s.key, P.squeezed_sorted), (s.several.astype(np.uint8), P.squeezed), (s.count, P.squeezed)]))

    def match_grams(t):
        blobs = t["blob"].to_pylist()
        keys = [P.expanded_sorted(b[0]) for b in blobs]
        order, starts, run = P.runs(np.concatenate(keys))
        several, count = (np.concatenate([P.expanded(b[k], kind) for b in blobs])[order] for k, kind in ((1, np.uint8), (2, np.uint16)))
        live = (np.maximum.reduceat(several, starts) > 0) | (np.diff(np.append(starts, len(order))) > 1)
        hot = np.add.reduceat(count.astype(np.int64), starts) > hot_suffixes
        verdict = np.where(live, np.where(hot, SPLIT, LIVE), DEAD).astype(np.uint8)[run]
        return answers(t, 1, [[P.squeezed(v)] for v in np.split(verdict, np.cumsum([len(k) for k in keys])[:-1])])

    def found_so_far(t, back):
        s = suffixes(t)
        verdict, back = np.zeros(len(s.key), np.uint8), back.filter(pc.equal(back["round"], 1))
        for bucket, blob in zip(back["bucket"].to_pylist(), back["blob"].to_pylist()):
            verdict[s.cuts[bucket] : s.cuts[bucket + 1]] = P.expanded(blob[0], np.uint8)
        return s, Contexts(s, verdict, window, gram, buckets), Windows(s, verdict, window, gram, buckets)

    def send_contexts(key, t, back):
        if not t.num_rows:
            return sent_type.empty_table()
        _, c, w = found_so_far(t, back)
        return parcels(
            key[0].as_py(), (c.cuts, [(c.gram, P.squeezed_sorted), (c.around, lambda v: P.squeezed(v.reshape(-1))), (c.least, P.squeezed)]),
            (w.cuts, [(w.high, P.squeezed_sorted), (w.low, P.squeezed), (w.least, P.squeezed)]))

    def compare(t):
        blobs = t["blob"].to_pylist()
        gram_hash, high = ([P.expanded_sorted(b[k]) for b in blobs] for k in (0, 3))
        around = np.concatenate([P.expanded(b[1], np.uint32) for b in blobs]).reshape(-1, window + left)
        found, source = shared_windows(np.concatenate(gram_hash), around, np.concatenate([P.expanded(b[2], np.int64) for b in blobs]), left)
        least = np.concatenate([P.expanded(b[5], np.int64) for b in blobs])
        order, starts, run = P.runs(np.concatenate(high), np.concatenate([P.expanded(b[4], np.uint32) for b in blobs]))
        lowest = np.minimum.reduceat(least[order], starts)[run] if len(starts) else least
        cuts, window_cuts = (np.cumsum([len(x) for x in k])[:-1] for k in (gram_hash, high))
        parts = zip(np.split(found, cuts), np.split(source, cuts), np.split(lowest, window_cuts))
        return answers(t, 2, [[np.packbits(f).tobytes(), P.squeezed(x), P.squeezed(w)] for f, x, w in parts])

    def join(key, t, back):
        s, c, w = found_so_far(t, back)
        words, back = s.words, back.filter(pc.equal(back["round"], 2))
        found, source = np.zeros((len(c.gram), left + 1), bool), np.full(len(c.gram), P.NO_ID)
        lowest = w.least.copy()
        for bucket, (bits, sources, windows) in zip(back["bucket"].to_pylist(), back["blob"].to_pylist()):
            lo, hi = int(c.cuts[bucket]), int(c.cuts[bucket + 1])
            found[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=(hi - lo) * (left + 1)).reshape(hi - lo, left + 1)
            source[lo:hi] = P.expanded(sources, np.int64)
            lowest[w.cuts[bucket] : w.cuts[bucket + 1]] = P.expanded(windows, np.int64)
        inner = c.least[c.entry] < c.owner  # a document of this very batch has the same context
        marked = (found[c.entry] | inner[:, None]) & c.fits
        row, back_by = np.nonzero(marked)
        origin = np.minimum(source[c.entry], np.where(inner, c.least[c.entry], P.NO_ID))[row]
        earlier = lowest[w.entry] < w.owner
        at, origin = np.append(c.at[row] - back_by, w.at[earlier]), np.append(origin, lowest[w.entry][earlier])
        marks = np.zeros(len(words.hash) + 1, bool)
        marks[at] = True
        start, length = P.spans(P.covered(marks, window, len(words.hash)), words)
        first = np.full(len(start), P.NO_ID)
        if len(at):
            np.minimum.at(first, np.searchsorted(start, at, side="right") - 1, origin)
        owner = t["id"].combine_chunks().take(pa.array(words.doc[start]))
        return pa.table({"id": owner, "start": pa.array(words.place[start], pa.int64()), "n_words": pa.array(length, pa.int64()), "first_id": pa.array(first, pa.int64())})

    def batchwise(answered, work, schema):
        return dealt.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(work, schema)

    one = dealt.groupBy("batch").applyInArrow(send_grams, sent).groupBy("bucket").applyInArrow(match_grams, answer)
    two = batchwise(one, send_contexts, sent).groupBy("bucket").applyInArrow(compare, answer)
    found = batchwise(one.unionByName(two), join, "id long, start long, n_words long, first_id long")
    return found.select(F.col("id").alias(id), "start", "n_words", "first_id")


#: The query in DuckDB: every window of 50 words by its text, runs joined where they touch.
SQL = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') words from documents),
grams as (select doc_id, pos, array_to_string(words[pos:pos + 49], ' ') gram from (select doc_id, words, unnest(range(1, len(words) - 48)) pos from docs)),
firsts as (select gram, min(doc_id) least from grams group by gram),
hits as (select doc_id, pos, least, pos > coalesce(lag(pos) over (partition by doc_id order by pos), -100) + 50 fresh from grams join firsts using (gram) where least < doc_id),
runs as (select *, sum(fresh::int) over (partition by doc_id order by pos) run from hits)
select doc_id, min(pos) - 1 as start, max(pos) + 50 - min(pos) as n_words, min(least) as first_doc_id from runs group by doc_id, run
"""
