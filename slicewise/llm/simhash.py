"""Near-duplicate documents by SimHash fingerprints joined on pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewise.llm.common import checkpointed, dealt, in_tiles, numbered, runs_of
from slicewise.llm.components import connected_components
from slicewise.llm.passages import Words, expanded, mixed, odd_numbers, squeezed

SEED = 42
#: Fingerprints that share a key on average, at most; a comparison is cheap beside a key that is shuffled.
CROWD = 64
#: Runs of up to so many rows that share a key are compared pair by pair, larger ones breadth first.
SMALL = 32
#: Bytes of text that are cut into shingles at a time.
PIECE = 1 << 20
#: Cells of the sketch of how frequent shingles are, of 2 ** CELL_BITS, and the ranges that they are added up in.
CELL_BITS, RANGES = 18, 64


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, lower-cased in ASCII; of all words if they are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.fromiter((digest(line[s:e], SEED) for s, e in spans), np.uint64, len(words) - k + 1)


def _mixed(h: np.ndarray, lane: int) -> np.ndarray:
    """Lane 0 is the hash itself; further lanes remix it, for fingerprints of over 64 bits."""
    if not lane:
        return h
    h = h + np.uint64(0x9E3779B97F4A7C15 * lane & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(h: np.ndarray, lanes: int = 1) -> list[int]:
    """For each lane the 64 bits that are set in over half the hashes, as a signed long; zero if none."""
    out = []
    for lane in range(lanes):
        rows = np.unpackbits(_mixed(h, lane).astype(">u8").view(np.uint8)).reshape(-1, 64)
        ones = np.zeros(64, np.int64)
        for i in range(0, len(rows), 255):
            ones += np.add.reduce(rows[i : i + 255], axis=0, dtype=np.uint8)
        out.append(int(np.packbits(2 * ones > len(h)).view(">i8")[0]))
    return out


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, lanes: int = 1) -> DataFrame:
    """``docs`` with column ``fingerprint``, an array of ``lanes`` longs of 64 bits. A null text has no words."""

    def work(batches):
        for b in batches:
            fp = [fingerprint(shingle_hashes(x.as_py(), shingle), lanes) for x in b["_text"]]
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fp, pa.list_(pa.int64()))], names=names)

    kept = [c for c in docs.columns if c not in (text, "fingerprint")]
    names = [*kept, "fingerprint"]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("fingerprint", T.ArrayType(T.LongType()))])
    return docs.select(*kept, F.col(text).alias("_text")).mapInArrow(work, schema)


def shingle_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The rising hashes of the distinct shingles of each text, one text after the other, and where each begins, with an end.

    Shingles are as in ``shingle_hashes``; their hashes are rolled over the hashes of all words at once.
    """
    words = Words([(t or "").encode().lower() for t in texts])
    n = np.diff(words.first)
    count = np.where(n < size, np.minimum(n, 1), n - size + 1)
    first = np.append(0, np.cumsum(count))
    h = np.empty(first[-1], np.uint64)
    rolled, inside = words.rolling(size, SEED)
    h[np.repeat(n >= size, count)] = rolled[inside]
    for k in range(1, size):
        short = np.flatnonzero(n == k)
        if len(short):
            h[first[short]] = mixed(sum(words.hash[words.first[short] + i] * f for i, f in enumerate(odd_numbers(k, SEED + k))))
    for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
        h[s:e].sort()
    new = np.append(True, h[1:] != h[:-1])[: len(h)]
    new[first[:-1][count > 0]] = True
    return h[new], np.append(0, np.cumsum(new))[first]


def pieces(batches, text: str):
    """The record batches in slices of about PIECE bytes of text, so that what is made of a slice stays small."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // PIECE
        cuts = np.flatnonzero(np.diff(ends, prepend=-1, append=-1)) if len(ends) else []
        for s, e in zip(cuts[:-1], cuts[1:]):
            yield b.slice(s, e - s)


def majorities(h: np.ndarray, first: np.ndarray, lanes: int) -> np.ndarray:
    """``fingerprint`` of each of the sets that begin at ``first`` in ``h``, a row each."""
    n = np.diff(first)
    out = np.zeros((len(n), lanes), np.int64)
    if not len(h):
        return out
    runs = -(-n // 255)  # a byte counts one bit of up to 255 hashes
    run = np.cumsum(runs) - runs
    begin = np.repeat(first[:-1] - 255 * run, runs) + 255 * np.arange(runs.sum())
    some = n > 0
    for lane in range(lanes):
        x, ones = _mixed(h, lane), np.zeros((len(n), 64), np.int64)
        for bit in range(8):
            eight = np.add.reduceat((x >> np.uint64(bit)) & np.uint64(0x0101010101010101), begin).astype("<u8").view(np.uint8).reshape(-1, 8)
            ones[some, bit::8] = np.add.reduceat(eight, run[some], axis=0, dtype=np.int64)
        out[:, lane] = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<i8")[:, 0]
    return out


def rarity(docs: DataFrame, text: str, shingle: int) -> np.ndarray:
    """Ranks of a fixed number of cells by how many texts have a shingle of the cell, added up over its shingles.

    It only orders shingles, rare ones first, so that the ones many texts share are seldom keys.
    """

    def count(batches):
        total = np.zeros(1 << CELL_BITS, np.int64)
        for b in pieces(batches, text):
            total += np.bincount(cells_of(shingle_sets(b[text].to_pylist(), shingle)[0]), minlength=len(total))
        blobs = [squeezed(x) for x in total.reshape(RANGES, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def add(t):
        total = sum(expanded(x, np.int64) for x in t["blob"].to_pylist())
        return pa.table({"part": t["part"][:1], "blob": pa.array([squeezed(total)], pa.binary())})

    schema = "part int, blob binary"
    rows = docs.select(text).mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    found = {r["part"]: expanded(bytes(r["blob"]), np.int64) for r in rows}
    total = np.concatenate([found.get(i, np.zeros((1 << CELL_BITS) // RANGES, np.int64)) for i in range(RANGES)])
    rank = np.empty(len(total), np.uint16)
    rank[np.argsort(total, kind="stable")] = np.arange(len(total)) >> (CELL_BITS - 16)  # numbers of 16 bits are sorted fastest
    return rank


def cells_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def prefixes(h: np.ndarray, first: np.ndarray, rank: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of each of the sets that begin at ``first`` in ``h``, as many that sets alike by ``least`` or more share one of
    them, and where each set's begin.

    Such sets have least * n of n shingles in common, so one is left among any n - ceil(least * n) + 1; with
    one order for all sets (by the rank of the cell, then by the hash), the first common shingle is among the first so many of both.
    """
    n, rank = np.diff(first), rank[cells_of(h)]
    most = np.minimum(n, n - np.ceil(least * n - 1e-9).astype(np.int64) + 1)
    at = [s + np.argsort(rank[s : s + k], kind="stable")[:m] for s, k, m in zip(first.tolist(), n.tolist(), most.tolist())]
    return h[np.concatenate([np.zeros(0, np.int64), *at])], np.append(0, np.cumsum(most))


def lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A list for each of the runs of ``values`` that begin at ``first``."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values))


def prefixed(docs: DataFrame, shingle: int, lanes: int, least: float) -> DataFrame:
    """(_id, digest, fingerprint of the distinct shingles, prefix) for each row of (_id, digest, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs, "text", shingle))

    def work(batches):
        for b in pieces(batches, "text"):
            h, first = shingle_sets(b["text"].to_pylist(), shingle)
            bits = lists(majorities(h, first, lanes).reshape(-1), np.arange(b.num_rows + 1) * lanes)
            keys, begin = prefixes(h, first, shared.value, least)
            yield pa.RecordBatch.from_arrays([b["_id"], b["digest"], bits, lists(keys.view(np.int64), begin)], names=["_id", "digest", "fingerprint", "prefix"])

    return docs.select("_id", "digest", "text").mapInArrow(work, "_id long, digest long, fingerprint array<long>, prefix array<long>")


def shared_keys(batches):
    """The rows of batches sorted by ``key`` whose key the row before or behind has too; one row is held at a time."""
    held, again = None, False
    for b in batches:
        t = pa.Table.from_batches([b] if held is None else [held, b])
        if not t.num_rows:
            continue
        key = t["key"].to_numpy()
        same = np.concatenate([[again], key[1:] == key[:-1], [False]])
        for x in t.slice(0, t.num_rows - 1).filter(pa.array((same[:-1] | same[1:])[:-1])).to_batches():
            yield x
        held, again = t.slice(t.num_rows - 1).combine_chunks().to_batches()[0], bool(same[-2])
    if again:
        yield held


def block_keys(lanes: int, blocks: int, share: int) -> Column:
    """The keys of a fingerprint: its bits cut into ``blocks`` runs, each choice of ``share`` runs one key.

    With at most k bits differing, blocks - k of the runs are equal, so blocks >= k + share misses no
    pair; with fewer blocks a pair is found if any of its keys agree.
    """
    width, cuts = 64 * lanes, []
    edges = [round(i * width / blocks) for i in range(blocks + 1)]
    for lo, hi in zip(edges, edges[1:]):
        parts = []
        while lo < hi:  # a run may cross lanes
            lane, bit = divmod(lo, 64)
            n = min(hi - lo, 64 - bit)
            word = F.shiftrightunsigned(F.col("fingerprint")[lane], 64 - bit - n)
            parts.append(word.bitwiseAND(F.lit((1 << n) - 1)) if n < 64 else word)
            lo += n
        cuts.append(parts)
    keys = [F.xxhash64(F.lit(i), *(p for c in chosen for p in cuts[c])) for i, chosen in enumerate(combinations(range(blocks), share))]
    return F.array(*keys)


def blocks_for(classes: int, width: int, max_bits: int) -> tuple[int, int]:
    """How many blocks to cut fingerprints into, and how many of them make a key, for so many distinct fingerprints.

    Every choice of max_bits blocks may differ, so with ``share`` more none misses a pair. More blocks give longer keys, but more of
    them: the fewest are taken whose keys are shared by at most CROWD fingerprints on average.
    """
    share = 2
    while classes >> width // (max_bits + share) * share > CROWD and share < 8:
        share += 1
    return max_bits + share, share


def near_edges(fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that span the components of rows within ``most`` differing bits.

    Breadth first: a row is compared with the rows not yet reached, which shrink as a dense group is
    found, so a group of n close rows costs far fewer than n * n comparisons and gives n - 1 pairs.
    """
    a, b, left = [], [], np.arange(len(fp))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[at]).sum(axis=1, dtype=np.int64) <= most
            if near.any():
                found = left[near]
                a.append(found)
                b.append(np.full(len(found), at))
                queue.extend(found.tolist())
                left = left[~near]
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def alike_edges(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that span the components of sets with a Jaccard similarity of ``least`` or more.

    Breadth first like ``near_edges``: a set is compared only with those not yet reached, all at once, by counting along
    the lists of sets that hold each of its shingles. The lists are made anew whenever half of their sets are reached.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    owner, first = np.repeat(np.arange(len(sets)), size), np.cumsum(size) - size
    names, code = np.unique(np.concatenate(sets), return_inverse=True)
    a, b, left, queue, listed = [], [], np.arange(len(sets)), [], None
    while len(left) > (0 if queue else 1):
        if not queue:
            queue, left = [left[0]], left[1:]
        if listed is None or 2 * len(left) <= listed:
            listed, open_ = len(left), np.zeros(len(sets), bool)
            open_[left] = True
            held = open_[owner]
            order = np.argsort(code[held], kind="stable")
            lists, begin = owner[held][order], np.append(0, np.cumsum(np.bincount(code[held], minlength=len(names))))
        at = queue.pop()
        own = code[first[at] : first[at] + size[at]]
        n = begin[own + 1] - begin[own]
        where = np.repeat(begin[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(lists[where], minlength=len(sets))[left]
        near = common / np.maximum(1, size[left] + size[at] - common) >= least
        if near.any():
            found = left[near]
            a.append(found)
            b.append(np.full(len(found), at))
            queue.extend(found.tolist())
            left = left[~near]
    empty = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def confirmed(docs: DataFrame, classes: DataFrame, groups: DataFrame, least: float, shingle: int, lanes: int, tile: int) -> DataFrame:
    """Edges (a, b) that span the classes with alike shingle sets, within the candidate ``groups``.

    ``docs`` has _id, digest and text, ``classes`` a node, its fingerprint and its first document (_id,
    digest), ``groups`` the nodes that met another and their component. Only the texts of those documents
    are read again; each is reduced to the sorted 32-bit hashes of its distinct shingles. Groups are small,
    or cut into tiles.
    """
    members = groups.join(classes.select("node", "first"), "node").select(F.col("component").alias("key"), "node", "first")
    members = numbered(members, "key", tile, "node").select("*", F.col("first._id").alias("_first_id"), F.col("first.digest").alias("_first_digest")).drop("first")
    names = ["key", "node", "tiles", "tile"]

    def reduce(batches):
        for b in pieces(batches, "text"):
            h, first = shingle_sets(b["text"].to_pylist(), shingle)
            h = (h >> np.uint64(32)).astype(np.uint32)
            new = np.append(True, h[1:] != h[:-1])[: len(h)]
            new[first[:-1][np.diff(first) > 0]] = True
            sets = lists(h[new].view(np.int32), np.append(0, np.cumsum(new))[first])
            yield pa.RecordBatch.from_arrays([*b.select(names).columns, sets], names=[*names, "shingles"])

    texts = docs.join(members, F.col("_id").eqNullSafe(F.col("_first_id")) & (F.col("digest") == F.col("_first_digest"))).select(*names, "text")
    cells = dealt(texts.mapInArrow(reduce, "key long, node long, tiles int, tile int, shingles array<int>"))
    parts = ["key", "tile_a", "tile_b"]

    def verify(batches):
        for t in runs_of(batches, parts):
            key = np.stack([t[c].to_numpy().astype(np.int64) for c in parts])
            cuts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0), True]).tolist()
            node, out = t["node"].to_numpy(), [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            shingles = t["shingles"].combine_chunks()
            flat, ends = shingles.flatten().to_numpy().view(np.uint32), np.cumsum(np.asarray(pc.list_value_length(shingles)))
            sets = np.split(flat, ends[:-1])
            for s, e in zip(cuts, cuts[1:]):
                for column, at in zip(out, alike_edges(sets[s:e], least)):
                    column.append(node[s + at])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], ["a", "b"])

    met = cells.select(*parts, "node", "shingles").repartition(*parts).sortWithinPartitions(*parts)
    return met.mapInArrow(verify, "a long, b long")


def grouped(
    docs: DataFrame, id: str, text: str, shingle: int, lanes: int, max_bits: int, blocks: int | None, share: int | None, tile: int, similarity: float | None,
) -> DataFrame:
    """(_id, digest, fingerprint, first) for each row; ``first`` is the first document (_id, digest) of its group.

    The smallest id is first, then the smallest digest; null ids are last. Groups as in ``near_duplicates``.
    """
    source = docs.select(F.col(id).cast("long").alias("_id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    fp = checkpointed(fingerprints(source, "text", shingle, lanes) if similarity is None else prefixed(source, shingle, lanes, similarity))
    own = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "digest")).alias("first")
    if similarity is None:
        found = fp.groupBy("fingerprint").agg(own)
    else:
        found = fp.groupBy("fingerprint").agg(own, F.min_by("prefix", F.struct(F.col("_id").isNull(), "_id", "digest")).alias("prefix"))
    classes = checkpointed(found.withColumn("node", F.monotonically_increasing_id()))
    if similarity is None:
        blocks, share = (blocks, share) if blocks else blocks_for(classes.count(), 64 * lanes, max_bits)
        keyed = classes.select("node", "fingerprint", F.explode(block_keys(lanes, blocks, share)).alias("key"))
    else:
        keyed = classes.select("node", F.explode("prefix").alias("key")).repartition("key").sortWithinPartitions("key")
        keyed = checkpointed(keyed.mapInArrow(shared_keys, "node long, key long")).join(classes.select("node", "fingerprint"), "node")
    cells = in_tiles(keyed, "key", tile, "node")
    parts = ["key", "tile_a", "tile_b"]

    def verify(batches):
        for t in runs_of(batches, parts):
            key = np.stack([t[c].to_numpy().astype(np.int64) for c in parts])
            starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
            bits = t["fingerprint"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, lanes)
            node, out_a, out_b = t["node"].to_numpy(), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            ends = np.r_[starts[1:], t.num_rows]
            size = ends - starts
            for k in np.unique(size[(size > 1) & (size <= SMALL)]).tolist():  # all runs of one size at once
                left, right = np.triu_indices(k, 1)
                own = starts[size == k]
                for i in range(0, len(own), max(1, 500_000 // len(left))):
                    a, b = (((own[i : i + max(1, 500_000 // len(left)), None]) + side).reshape(-1) for side in (left, right))
                    near = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64) <= max_bits
                    out_a.append(node[a[near]])
                    out_b.append(node[b[near]])
            for s, e in zip(starts[size > SMALL].tolist(), ends[size > SMALL].tolist()):
                a, b = near_edges(bits[s:e], max_bits)
                out_a.append(node[s + a])
                out_b.append(node[s + b])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (out_a, out_b)], ["a", "b"])

    edges = cells.repartition(*parts).sortWithinPartitions(*parts).select(*parts, "node", "fingerprint").mapInArrow(verify, "a long, b long")
    found = connected_components(edges)
    if similarity is not None:
        found = connected_components(confirmed(source, classes, found, similarity, shingle, lanes, max(1, tile // 4)))
    named = classes.select("node", "fingerprint", "first").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = named.groupBy("component").agg(F.min("first").alias("first"))
    named = named.drop("first").join(firsts, "component").select(F.col("fingerprint").alias("_fp"), "first")
    return fp.join(named, F.col("fingerprint") == F.col("_fp")).select("_id", "digest", "fingerprint", "first")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, lanes: int = 1,
    max_bits: int = 4, blocks: int | None = None, share: int | None = None, tile: int = 4096,
    similarity: float | None = None,
) -> DataFrame:
    """(id, fingerprint array, component_id) for each row; documents within ``max_bits`` bits are linked.

    With ``similarity`` these links only propose: documents are one class where their sets of shingles
    have this Jaccard similarity or more, looked for within each group of proposed links; documents with
    equal fingerprints stay one class. Fingerprints are then of the distinct shingles, and documents meet on
    the rarest of them (``prefix``) instead of blocks, which no pair of this similarity can miss;
    ``max_bits`` should be wide, as it alone can lose a pair.

    Equal fingerprints collapse first, so copies cost one row each. Distinct ones meet on their block
    keys (of a number of blocks that follows the number of distinct fingerprints, see ``blocks_for``, unless given), are verified by Hamming distance, and give the edges that span each cell; components follow.
    Hot keys are cut into tiles (``in_tiles``). Null and empty texts have the zero fingerprint and are
    linked like any other. A null id keeps its row, and its class is named by the smallest id there is
    (null if there is none); rows with one id, of one text or several, are each returned with their own
    class. Other columns are ignored.
    """
    found = grouped(docs, id, text, shingle, lanes, max_bits, blocks, share, tile, similarity)
    return found.select(F.col("_id").alias(id), "fingerprint", F.col("first._id").alias("component_id"))


def keep_first(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, lanes: int = 1, max_bits: int = 4, blocks: int | None = None, share: int | None = None,
    tile: int = 4096, similarity: float | None = None,
) -> DataFrame:
    """``docs`` with one document of each group of ``near_duplicates``: that with the smallest id.

    Ids may be null or shared by unlike texts: verdicts are by id and text. Null ids come last, so such a
    document stays only if its group has no other; of equal ids the text with the smallest hash stays. Rows
    that repeat both id and text are one document and share its verdict. All columns are kept as they are.
    """
    found = grouped(docs, id, text, shingle, lanes, max_bits, blocks, share, tile, similarity)
    later = found.where(~(F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("digest") == F.col("first.digest")))).select("_id", "digest").distinct()
    columns = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*columns)
    own_id, own_text = (F.col(columns[docs.columns.index(c)]) for c in (id, text))
    kept = rows.join(later, own_id.cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(own_text) == F.col("digest")), "left_anti")
    return kept.toDF(*docs.columns)
