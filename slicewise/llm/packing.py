"""Packing of tokenised documents into fixed-length sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import json
import unicodedata
import zlib
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewise.llm.common import checkpointed
from slicewise.llm.bpe import gathered
from slicewise.llm.passages import expanded, squeezed
from slicewise.llm.token_counts import byte_letters

#: Distinct runs of text that a worker remembers within a task, and texts that are encoded together.
REMEMBERED, STEP = 500_000, 1_500
#: Code points that str.split takes for white space and the tokenizer doesn't.
SEPARATORS = regex.compile("[\x1c-\x1f]")


class WordIds:
    """Ids of a lower-casing word BPE: each distinct run of non-space characters is encoded once.

    The vocabulary's pre-tokens never cross white space, so a text's ids are those of its runs, one
    after another. Special strings are cut out first, as the library does, and only as they stand in
    the text: a run that becomes one by lower-casing is ordinary text. A special string is its id among runs.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.model, self.letters = tokenizer.model, byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.forget()

    def forget(self) -> None:
        self.number: dict[str | int, int] = {}
        self.flat, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def runs(self, text: str) -> list[str | int]:
        if "<|" in text and self.cut.search(text):
            out = []
            for part in self.cut.split(text):
                out += [self.special[part]] if part in self.special else self.runs(part)
            return out
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        return regex.split(r"\s+", text) if SEPARATORS.search(text) else text.split()

    def ids_of(self, run: str | int) -> list[int]:
        if isinstance(run, int):
            return [run]
        return [t.id for p in self.pieces.findall(run) for t in self.model.tokenize(p.encode().decode("latin1").translate(self.letters))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.number) > REMEMBERED:
            self.forget()
        number, old, rows = self.number, len(self.number), []
        for text in texts:
            runs = self.runs(text)
            for r in runs:
                if r not in number:
                    number[r] = len(number)
            rows.append(np.fromiter(map(number.__getitem__, runs), np.int64, len(runs)))
        new = [self.ids_of(r) for r in islice(number, old, None)]
        self.flat = np.concatenate([self.flat, np.fromiter((i for ids in new for i in ids), np.uint32)])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, new), np.int64, len(new))])
        starts = np.cumsum(self.sizes) - self.sizes
        return [gathered(self.flat, starts, self.sizes, row) for row in rows]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0, id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids): every document's ids and ``end_id``, cut at ``capacity``.

    ``ids`` are squeezed (see ``passages``), as they travel, or null."""

    def work(batches):
        encoder = word_ids(path)
        for b in batches:
            texts, keys = b["_text"].to_pylist(), b["_id"]
            for lo in range(0, len(texts), STEP):
                cols = [[], [], [], [], [], []]
                for i, ids in enumerate(encoder.encode(texts[lo : lo + STEP]), lo):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        for c, v in zip(cols, (keys[i].as_py(), piece, start, len(part), zlib.crc32(part.tobytes()), squeezed(part) if with_ids else None)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
        encoder.forget()  # a task's words fill the store, and the worker lives on

    names = ["_id", "piece", "start", "length", "ids_crc32", "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = "_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    source = docs.select(F.col(id).cast("long").alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    return source.mapInArrow(work, schema).withColumnRenamed("_id", id)


def best_fit(lengths: np.ndarray, items: np.ndarray, room: np.ndarray, bins: np.ndarray, fresh: int, capacity: int, into: np.ndarray) -> int:
    """Put each of ``items``, in order, into the bin with the least room that holds it, else a new one.

    ``bins`` are the open bins and ``room`` what each has left; the bins chosen go to ``into``. Bins
    wait in lists by their room, and the bits of one integer tell which lists have any. Returns the
    next free bin number.
    """
    waiting: dict[int, list[int]] = {}
    for b, r in zip(bins.tolist(), room.tolist()):
        waiting.setdefault(r, []).append(b)
    mask = sum(1 << r for r in waiting)
    for item, n in zip(items.tolist(), lengths[items].tolist()):
        fit = mask >> n
        if fit:
            r = n + (fit & -fit).bit_length() - 1
            b = waiting[r].pop()
            if not waiting[r]:
                del waiting[r]
                mask ^= 1 << r
        else:
            r, b, fresh = capacity, fresh, fresh + 1
        into[item] = b
        if r > n:
            waiting.setdefault(r - n, []).append(b)
            mask |= 1 << (r - n)
    return fresh


class Island:
    """A population of packings of the same items; a packing is each item's bin number, from 0."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int):
        self.lengths, self.capacity, self.rng = lengths, capacity, np.random.default_rng(seed)
        self.packings: list[tuple[tuple[int, float], np.ndarray]] = []

    def fill(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, weights=self.lengths)

    def admit(self, bins: np.ndarray) -> None:
        """Add a packing with dense bin numbers; few bins, then unevenly filled ones, are better."""
        bins = np.unique(bins, return_inverse=True)[1]
        fill = self.fill(bins)
        self.packings.append(((len(fill), -float(np.square(fill / self.capacity).sum())), bins))
        self.packings.sort(key=lambda p: p[0])

    def settle(self, size: int) -> None:
        """Fill the population with best-fit packings of loosely falling lengths: poor, unlike parents."""
        for _ in range(len(self.packings), size):
            order = np.argsort(-self.lengths * np.exp(0.5 * self.rng.standard_normal(len(self.lengths))), kind="stable")
            into = np.empty(len(order), np.int64)
            none = np.zeros(0, np.int64)
            best_fit(self.lengths, order, none, none, 0, self.capacity, into)
            self.admit(into)

    def child(self, receiver: np.ndarray, donor: np.ndarray) -> np.ndarray:
        """Inject well-filled bins of the donor whole; bins of the receiver that hold any of their items
        go, and their other items are put back by best fit, the longest first."""
        fill = self.fill(donor)
        good = np.flatnonzero(fill >= np.quantile(fill, 0.3))
        chosen = np.zeros(len(fill), bool)
        chosen[self.rng.choice(good, max(1, int(len(good) * self.rng.uniform(0.1, 0.4))), replace=False)] = True
        injected = chosen[donor]
        hit = np.zeros(int(receiver.max()) + 1, bool)
        hit[receiver[injected]] = True
        # also open a few of the worst bins, so that displaced items find partners
        worst = self.fill(receiver)
        hit[np.argsort(worst)[: max(1, len(worst) // 50)]] = True
        loose = np.flatnonzero(hit[receiver] & ~injected)
        out = np.where(injected, donor + len(hit), receiver)
        room = self.capacity - np.bincount(receiver, weights=self.lengths, minlength=len(hit)).astype(np.int64)
        open_bins = np.flatnonzero(~hit & (room > 0))
        own = np.flatnonzero(chosen & (fill < self.capacity))
        bins = np.concatenate([open_bins, own + len(hit)])
        room = np.concatenate([room[open_bins], self.capacity - fill[own].astype(np.int64)])
        loose = loose[np.argsort(-self.lengths[loose], kind="stable")]
        best_fit(self.lengths, loose, room, bins, len(hit) + len(fill), self.capacity, out)
        return out

    def evolve(self, size: int, generations: int) -> np.ndarray:
        """Cross pairs of parents both ways; stops early only where no packing can have fewer bins."""
        self.settle(size)
        least = -(-int(self.lengths.sum()) // self.capacity)
        for _ in range(generations if len(self.lengths) > 1 else 0):
            a, b = sorted(self.rng.choice(len(self.packings), 2, replace=False).tolist())
            children = self.child(self.packings[a][1], self.packings[b][1]), self.child(self.packings[b][1], self.packings[a][1])
            for bins in children:
                self.admit(bins)
            del self.packings[size:]
            if self.packings[0][0][0] <= least:
                break
        return self.packings[0][1]


def _rounds(items: DataFrame, capacity: int, islands: int, epochs: int, size: int, generations: int) -> DataFrame:
    """Evolve each cell's items (cell, item, length, bin or -1) and return the best packing's bins."""

    def evolve(key, t):
        t = t.combine_chunks().sort_by([("origin", "ascending"), ("item", "ascending")])
        cell, home, epoch = (t[c][0].as_py() for c in ("cell", "island", "epoch"))
        origin, item = t["origin"].to_numpy(), t["item"].to_numpy()
        first = origin == origin[0]
        n = int(first.sum())
        length = t["length"].to_numpy()[:n].astype(np.int64)
        island = Island(length, capacity, seed=(cell * 1009 + home * 31 + epoch) & 0x7FFFFFFF)
        for bins in t["bin"].to_numpy().reshape(-1, n):
            if (bins >= 0).all():
                island.admit(bins)
        best = island.evolve(size, generations)
        bins, square = island.packings[0][0]
        full = lambda v, kind: pa.array(np.full(n, v), kind)
        return pa.table({"cell": full(cell, pa.int64()), "island": full(home, pa.int32()), "item": pa.array(item[:n]), "length": pa.array(length), "bin": pa.array(best, pa.int64()), "bins": full(bins, pa.int64()), "square": full(square, pa.float64())})

    schema = "cell long, island int, item long, length long, bin long, bins long, square double"
    at = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))).withColumn("origin", F.col("island"))
    for epoch in range(epochs):
        if epoch:  # each island's elite stays and also goes to the next island of the ring
            at = at.withColumn("origin", F.col("island")).withColumn("island", F.explode(F.array("island", ((F.col("island") + 1) % islands).cast("int"))))
        at = at.select("cell", "island", "origin", "item", "length", "bin", F.lit(epoch).alias("epoch"))
        at = checkpointed(at.groupBy("cell", "island").applyInArrow(evolve, schema))
    best = at.groupBy("cell").agg(F.min(F.struct("bins", "square", "island"))["island"].alias("island"))
    return at.join(best, ["cell", "island"], "left_semi").select("cell", "item", "length", "bin")


def packed(
    docs: DataFrame, path: str, capacity: int = 2048, id: str = "doc_id", text: str = "text", end_id: int = 0,
    with_ids: bool = False, cell: int = 8192, islands: int = 2, epochs: int = 2, size: int = 5, generations: int = 24,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): each piece's place.

    Documents longer than ``capacity`` are cut; full pieces are sequences of their own. The others are
    dealt by hash to cells of about ``cell`` pieces. Each cell evolves on ``islands`` islands, Spark
    groups with their own seeds, from poor packings; after each epoch the elites migrate around the ring. Then the worse
    filled bins of all cells are dealt anew, whole, to fewer cells, and evolve once more; a cell never
    ends with more bins than it got. A null or empty text is one piece with ``end_id`` alone. Rows with
    one id, or none, are packed as rows. Other columns are ignored.
    """
    found = checkpointed(pieces(docs, path, capacity, end_id, id, text, with_ids).drop(*([] if with_ids else ["ids"])).withColumn("item", F.monotonically_increasing_id()))
    loose = found.where(F.col("length") < capacity).select("item", "length")
    cells = max(1, -(-loose.count() // cell))
    dealt = loose.select(F.pmod(F.xxhash64("item"), F.lit(cells)).alias("cell"), "item", "length", F.lit(-1).cast("long").alias("bin"))
    first = _rounds(dealt, capacity, islands, epochs, size, generations).select((F.col("cell") * (1 << 20) + F.col("bin")).alias("bin"), "item", "length")
    first = checkpointed(first)
    fills = first.groupBy("bin").agg(F.sum("length").alias("fill"), F.count("*").alias("n"))
    poor = fills.where(F.col("fill") < 0.97 * capacity)
    again = max(1, -(-(poor.agg(F.sum("n")).first()[0] or 0) // cell))
    retry = first.join(poor.select("bin"), "bin").select(F.pmod(F.xxhash64("bin"), F.lit(again)).alias("cell"), "item", "length", "bin")
    second = checkpointed(_rounds(retry, capacity, 1, 1, size, generations))
    moved = second.select("item", (F.lit(1 << 61) + F.col("cell") * (1 << 20) + F.col("bin")).alias("sequence_id"))
    stayed = first.join(poor.select("bin"), "bin", "left_anti").select("item", F.col("bin").alias("sequence_id"))
    full = found.where(F.col("length") >= capacity).select("item", (-1 - F.col("item")).alias("sequence_id"))
    before = "coalesce(sum(length) over (partition by sequence_id order by length desc, item rows between unbounded preceding and 1 preceding), 0L)"
    places = moved.unionByName(stayed).unionByName(full).join(found.select("item", "length"), "item").withColumn("offset", F.expr(before))
    placed = found.join(places.drop("length"), "item").drop("item")
    if not with_ids:
        return placed

    def unpack(batches):
        for b in batches:
            at = b.schema.get_field_index("ids")
            yield b.set_column(at, "ids", pa.array([expanded(x, "<u4").tobytes() for x in b["ids"].to_pylist()], pa.binary()))

    return placed.mapInArrow(unpack, placed.schema)
