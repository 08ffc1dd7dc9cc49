"""Exact substring dedup of documents by fixed-block anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewise.llm import passages as P

#: Bits of an anchor's hash that travel. Anchors only propose; windows travel with 96 bits.
ANCHOR_BITS = 48


class Anchors:
    """The distinct rolling blocks of a batch, sorted: ``key``, whether one is an aligned (indexed) block
    of a document, whether several documents have it; ``entry`` has each position's place among them."""

    def __init__(self, words: P.Words, ids: np.ndarray, block: int, buckets: int):
        h, self.inside = words.rolling(block, 3)
        h = h[self.inside] >> np.uint64(64 - ANCHOR_BITS)
        at = np.flatnonzero(self.inside)
        order, starts, self.entry = P.runs(h)
        self.key = h[order[starts]]
        self.cuts = P.cut_at_buckets(self.key, buckets, ANCHOR_BITS)
        owner = ids[words.doc[at]][order]
        if len(starts):
            self.indexed = np.logical_or.reduceat((words.place[at] % block == 0)[order], starts)
            self.several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
        else:
            self.indexed = self.several = np.zeros(0, bool)


class Windows:
    """The distinct windows of a batch around its live anchors, sorted: ``high`` and ``low`` (64 and 32
    bits of hash) and ``least``, the smallest id that has one; ``at`` and ``entry`` place each occurrence."""

    def __init__(self, words: P.Words, ids: np.ndarray, anchors: Anchors, live: np.ndarray, window: int, block: int, buckets: int):
        h, inside = words.rolling(window, 4)
        hit = np.zeros(len(words.hash) + 1, np.int64)
        hit[np.flatnonzero(anchors.inside)[live[anchors.entry]] + 1] = 1
        hits = np.cumsum(hit)
        reach = window - block + 1  # an anchor hit is extended to every window that holds it
        at = np.flatnonzero(inside & (hits[reach:][: len(h)] > hits[: len(h)]))
        high = h[at]
        low = (words.rolling(window, 5)[0][at] >> np.uint64(32)).astype(np.uint32)
        order, starts, self.entry = P.runs(high, low)
        self.at, self.high, self.low = at, high[order[starts]], low[order[starts]]
        self.owner = ids[words.doc[at]]
        self.least = np.minimum.reduceat(self.owner[order], starts) if len(starts) else np.zeros(0, np.int64)
        self.cuts = P.cut_at_buckets(self.high, buckets, 64)


def substring_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 13, block: int = 7, batch_bytes: int | None = None,
) -> DataFrame:
    """``docs`` with n_words, n_removed, ``kept_text`` and ``removed`` (first word and length of each span).

    A word goes if it lies in a window of ``window`` words whose word sequence also starts in a document
    with a smaller id; the windows are those of the input. Spans are the unions of such windows, so
    every removed span is a chain of maximal exact repeats.

    Documents are dealt by hash to batches of a few MB (``batch_bytes``); batches talk to hash buckets in
    three rounds, with packed binary columns instead of a row for each word:

    1. Each batch sends its distinct rolling blocks of ``block`` words, marking those that are aligned,
       non-overlapping blocks of a document (the index). A window of 2 * block - 1 words or more always
       holds an aligned block. A bucket answers with a bit for each: an indexed block that a second
       document has too.
    2. Each batch extends those hits to every window that holds one, and sends the distinct windows with
       the smallest id that has them. A bucket answers with a bit: a smaller id elsewhere has it.
    3. Each batch marks the windows and cuts the words.

    A passage that a third of all documents share is one entry for each batch, not one for each
    document. Windows are compared by 96 bits of hash. Null and empty texts have no words and an empty
    ``kept_text``; documents shorter than a window keep all. A null id counts as larger than every
    other; rows with equal ids don't cut each other. Columns of the four names are replaced.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold an aligned block: window >= 2 * block - 1")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    batches, buckets = P.dealing(total, batch_bytes)
    made = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_text": T.StringType(),
            "removed": T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))}
    rest = [c for c in docs.columns if c not in (id, text, *made)]
    dealt = docs.select(
        P.batch_number(id, text, batches), F.col(id).cast("long").alias("id"),
        F.col(text).alias("text"), F.struct(F.lit(0).alias("none"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(rest))).alias("rest"),
    )
    sent, answer = "bucket int, batch int, blob array<binary>", "batch int, bucket int, round int, bits binary"
    sent_type = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("blob", pa.list_(pa.binary()))])
    answer_type = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("round", pa.int32()), ("bits", pa.binary())])

    def parcels(batch, cuts, columns):
        filled = [b for b in range(buckets) if cuts[b + 1] > cuts[b]]
        blobs = [[pack(v[cuts[b] : cuts[b + 1]]) for v, pack in columns] for b in filled]
        return pa.table([pa.array(filled, pa.int32()), pa.array([batch] * len(filled), pa.int32()), pa.array(blobs, pa.list_(pa.binary()))], schema=sent_type)

    def answers(t, n_round, found, sizes):
        parts = np.split(found, np.cumsum(sizes)[:-1])
        return pa.table([t["batch"], t["bucket"], pa.array([n_round] * len(parts), pa.int32()), pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())], schema=answer_type)

    def send_blocks(key, t):
        anchors = Anchors(P.group_words(t)[1], P.group_ids(t), block, buckets)
        flags = anchors.indexed * np.uint8(1) + anchors.several * np.uint8(2)
        return parcels(key[0].as_py(), anchors.cuts, [(anchors.key, P.squeezed_sorted), (flags, P.squeezed)])

    def match_blocks(t):
        blobs = t["blob"].to_pylist()
        keys, flags = [P.expanded_sorted(b[0]) for b in blobs], np.concatenate([P.expanded(b[1], np.uint8) for b in blobs])
        order, starts, run = P.runs(np.concatenate(keys))
        either = np.bitwise_or.reduceat(flags[order], starts)
        live = (either & 1 > 0) & ((either & 2 > 0) | (np.diff(np.append(starts, len(order))) > 1))
        return answers(t, 1, live[run], [len(k) for k in keys])

    def windows_of(t, back):
        words, ids = P.group_words(t)[1], P.group_ids(t)
        anchors = Anchors(words, ids, block, buckets)
        live = P.joined_bits(back.filter(pc.equal(back["round"], 1)), anchors.cuts)
        return words, Windows(words, ids, anchors, live, window, block, buckets)

    def send_windows(key, t, back):
        if not t.num_rows:
            return sent_type.empty_table()
        _, w = windows_of(t, back)
        return parcels(key[0].as_py(), w.cuts, [(w.high, P.squeezed_sorted), (w.low, P.squeezed), (w.least, P.squeezed)])

    def match_windows(t):
        blobs = t["blob"].to_pylist()
        high = [P.expanded_sorted(b[0]) for b in blobs]
        least = np.concatenate([P.expanded(b[2], np.int64) for b in blobs])
        order, starts, run = P.runs(np.concatenate(high), np.concatenate([P.expanded(b[1], np.uint32) for b in blobs]))
        return answers(t, 2, np.minimum.reduceat(least[order], starts)[run] < least, [len(h) for h in high])

    def cut(key, t, back):
        words, w = windows_of(t, back)
        earlier = P.joined_bits(back.filter(pc.equal(back["round"], 2)), w.cuts)
        gone = P.covered(np.bincount(w.at[earlier[w.entry] | (w.least[w.entry] < w.owner)], minlength=len(words.hash) + 1), window, len(words.hash))
        start, length = P.spans(gone, words)
        by_doc = np.searchsorted(words.doc[start], np.arange(len(words.first)))
        count = np.add.reduceat(np.append(gone, False), words.first[:-1]) if len(gone) else np.zeros(t.num_rows, np.int64)
        count = np.where(np.diff(words.first) > 0, count, 0)
        texts = []
        for i, x in enumerate(t["text"].cast(pa.binary()).to_pylist()):
            own = (x or b"").split()
            if count[i]:
                own = [w for w, g in zip(own, gone[words.first[i] : words.first[i + 1]].tolist()) if not g]
            texts.append(b" ".join(own))
        entry = pa.StructArray.from_arrays([pa.array(words.place[start], pa.int64()), pa.array(length, pa.int64())], ["start", "length"])
        return pa.table({
            "id": t["id"], "text": t["text"], "rest": t["rest"], "n_words": pa.array(np.diff(words.first), pa.int64()), "n_removed": pa.array(count.astype(np.int64)),
            "kept_text": pa.array(texts, pa.binary()).cast(pa.string()), "removed": pa.ListArray.from_arrays(pa.array(by_doc, pa.int32()), entry)})

    def batchwise(answered, work, schema):
        return dealt.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(work, schema)

    one = dealt.groupBy("batch").applyInArrow(send_blocks, sent).groupBy("bucket").applyInArrow(match_blocks, answer)
    two = batchwise(one, send_windows, sent).groupBy("bucket").applyInArrow(match_windows, answer)
    schema = T.StructType([*(dealt.schema[c] for c in ("id", "text", "rest")), *(T.StructField(c, k) for c, k in made.items())])
    done = batchwise(one.unionByName(two), cut, schema)
    return done.select(F.col("id").alias(id), F.col("text").alias(text), *(F.col("rest")[f"c{i}"].alias(c) for i, c in enumerate(rest)), *made)


#: The query in DuckDB: every window of 13 words by its text, not by anchors.
SQL = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') words from documents),
grams as (select doc_id, pos, array_to_string(words[pos:pos + 12], ' ') gram from (select doc_id, words, unnest(range(1, len(words) - 11)) pos from docs)),
firsts as (select gram, min(doc_id) least from grams group by gram),
gone as (select distinct doc_id, pos + unnest(range(13)) as pos from grams join firsts using (gram) where least < doc_id),
words as (select doc_id, unnest(words) word, unnest(range(1, len(words) + 1)) pos from docs),
marked as (select w.*, g.pos is not null gone from words w left join gone g on g.doc_id = w.doc_id and g.pos = w.pos)
select d.doc_id, len(d.words) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from docs d left join (select doc_id, count(*) filter (gone) n, string_agg(word, ' ' order by pos) filter (not gone) kept from marked group by doc_id) m using (doc_id)
"""
