"""Near-duplicate vectors by spherical-cap filters with structured random product codes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewise.llm.common import checkpointed, in_tiles, runs_of
from slicewise.llm.components import connected_components, spanning

SEED = 7


#: Pairs of random unit vectors that a code is calibrated on, and how many are scored at a time.
PAIRS, STEP = 600, 50
#: Filters of a vector at most; where more would be wanted, or the dimensions are as few as GRID, a grid takes their place.
MOST, GRID = 384, 8
#: Lengths of vectors that the driver calibrates a code for; where there are more, workers do it for theirs.
LENGTHS = 16


class CapFilters:
    """code * code filter directions in ``dim`` dimensions: every pair of a word of one random code for
    the first half of the rotated axes and one of another for the second half.

    ``each`` is about how many filters a vector exceeds. It is the least power of two (or the half between
    two) by which a share ``recall`` of random pairs at cosine ``cosine`` meets in a filter, so it rises
    slowly with the code; ``met`` is the share reached, less than ``recall`` where MOST wouldn't do. ``threshold`` is what a random unit vector's score exceeds for about ``each``
    filters (the mean of the each-th best score of random vectors). Both depend on the parameters, not on
    data, and are drawn from a fixed seed.
    """

    def __init__(self, dim: int, code: int, cosine: float, recall: float, least: int, known: tuple[float, float] | None = None):
        rng = np.random.default_rng(SEED + dim)
        self.dim, self.wide, self.code = dim, max(2, dim + dim % 2), code
        self.turn = np.linalg.qr(rng.standard_normal((self.wide, self.wide)))[0]
        half = self.wide // 2
        self.words = [v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, code, half))]
        if known:  # calibrated before, to this threshold and share
            self.threshold, self.met = known
            return
        probes = [self.pairs(rng, STEP, cosine) for _ in range(PAIRS // STEP)]
        most = min(512, code * code)
        best = np.concatenate([self.best_sums(a, most) for a, _ in probes])
        for self.each in (e for k in range(3, 9) for e in (1 << k, 3 << k - 1) if e <= MOST):
            self.threshold = float(best[:, min(self.each, most) - 1].mean())
            self.met = self.meeting(probes, least)
            if self.met >= recall or self.each >= most:
                break

    def pairs(self, rng: np.random.Generator, n: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """n pairs of random unit vectors at the given cosine (as near as one dimension allows)."""
        a, b = rng.standard_normal((2, n, self.dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
        b = cosine * a + np.sqrt(1 - cosine**2) * b
        return a, b / np.linalg.norm(b, axis=1, keepdims=True)

    def best_sums(self, unit: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` best scores of each vector, falling."""
        first, second = (-np.sort(-s, axis=1)[:, :most] for s in self.scores(unit))
        # the k-th best sum pairs ranks i, j with i * j <= k
        i, j = np.nonzero(np.outer(np.arange(1, first.shape[1] + 1), np.arange(1, second.shape[1] + 1)) <= most)
        return -np.sort(-(first[:, i] + second[:, j]), axis=1)[:, :most]

    def meeting(self, probes: list[tuple[np.ndarray, np.ndarray]], least: int) -> float:
        """The share of pairs that have a filter in common."""
        hits = [len(np.intersect1d(x, y)) > 0 for a, b in probes for x, y in zip(self.decoded(a, least), self.decoded(b, least))]
        return float(np.mean(hits))

    def scores(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(unit), self.wide))
        x[:, : self.dim] = unit
        x = x @ self.turn
        half = self.wide // 2
        return x[:, :half] @ self.words[0].T, x[:, half:] @ self.words[1].T

    def decoded(self, unit: np.ndarray, least: int) -> list[np.ndarray]:
        """For each vector all filters whose score exceeds the threshold, or its ``least`` best if fewer do.

        A list decoder: for every first word the second words that suffice are a prefix of the second
        scores in falling order, found by binary search; most first words have an empty one.
        """
        out = []
        for a, b in zip(*self.scores(unit)):
            order = np.argsort(-b)
            falling = b[order]
            n = np.searchsorted(-falling, a - self.threshold, side="right")
            first = np.flatnonzero(n)
            n = n[first]
            if n.sum() >= least:
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                out.append(np.sort(np.repeat(first, n) * self.code + order[at]))
                continue
            top_a, top_b = np.argsort(-a)[:least], order[:least]
            sums = a[top_a][:, None] + b[top_b][None, :]
            best = np.argsort(-sums, axis=None)[:least]
            out.append(np.sort(top_a[best // len(top_b)] * self.code + top_b[best % len(top_b)]))
        return out


class GridFilters:
    """Cells of a grid in few dimensions: any two unit vectors with a cosine of ``cosine`` or more share a cell, whatever their number.

    They are at most r = sqrt(2 - 2 * cosine) apart. A vector goes to the cells, 2 * r wide, that the box of r / 2 around
    it touches; the boxes of two such vectors both hold the place midway. Only the first axes count, GRID at most.
    """

    def __init__(self, dim: int, cosine: float):
        self.reach = np.sqrt(max(0.0, 2 - 2 * cosine)) / 2 * (1 + 1e-9) + 1e-9
        self.low, high = (int(np.floor(side * (1 + self.reach) / (4 * self.reach))) for side in (-1, 1))
        self.base = high - self.low + 1
        self.axes = max(1, min(dim, GRID, int(40 / np.log2(self.base))))  # so that a cell's number is below 2^40
        self.met = 1.0

    def decoded(self, unit: np.ndarray, least: int) -> list[np.ndarray]:
        first, last = (np.floor((unit[:, : self.axes] + side) / (4 * self.reach)).astype(np.int64) - self.low for side in (-self.reach, self.reach))
        rows, cells = np.arange(len(unit)), np.zeros(len(unit), np.int64)
        for axis in range(self.axes):
            two = np.flatnonzero(last[rows, axis] > first[rows, axis])
            rows, cells, second = np.append(rows, rows[two]), np.append(cells, cells[two]), np.append(np.zeros(len(rows), bool), np.ones(len(two), bool))
            cells = cells * self.base + np.where(second, last[rows, axis], first[rows, axis])
        order = np.lexsort((cells, rows))
        return np.split(cells[order], np.cumsum(np.bincount(rows, minlength=len(unit)))[:-1])


@lru_cache(maxsize=8)
def cap_filters(dim: int, code: int, cosine: float, recall: float, least: int, known: tuple[float, float] | None = None) -> CapFilters | GridFilters:
    """The filters for vectors of a length: caps, or a grid where dimensions are few or caps don't reach the recall."""
    if dim <= GRID:
        return GridFilters(dim, cosine)
    found = CapFilters(dim, code, cosine, recall, least, known)
    return found if found.met >= recall else GridFilters(dim, cosine)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.square(v).sum(axis=1, keepdims=True))


def first_met(i: np.ndarray, j: np.ndarray, filters: list[np.ndarray], at: int) -> np.ndarray:
    """Which of the row pairs have no common filter before ``at``: each pair counts in one filter alone."""
    early = [f[f < at] for f in filters]
    flat = np.concatenate(early) if early else np.zeros(0, np.int64)
    if not len(flat) or not len(i):
        return np.ones(len(i), bool)
    names, column = np.unique(flat, return_inverse=True)
    has = np.zeros((len(filters), len(names)), np.float32)
    has[np.repeat(np.arange(len(filters)), [len(f) for f in early]), column] = 1
    out = np.empty(len(i), bool)
    for s in range(0, len(i), 20_000):
        out[s : s + 20_000] = np.einsum("ij,ij->i", has[i[s : s + 20_000]], has[j[s : s + 20_000]]) == 0
    return out


def near_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", least_cosine: float = 0.95,
    recall: float = 0.97, least: int = 6, tile: int = 1024,
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row; vectors with cosine >= ``least_cosine`` are linked.

    Equal vectors collapse to one class first; a class is linked within itself. Each class is decoded to
    all spherical-cap filters that it exceeds (its ``least`` best at least), as many that random pairs at
    ``least_cosine`` meet with a chance of ``recall`` or more at any number of classes; closer pairs meet more often. Up to GRID
    dimensions, or where that would take over MOST filters, the cells of a grid are the filters, and every pair meets. Classes
    meet on filters, and pairs are verified in double precision. A pair counts in the first filter that
    it shares, so that n_links, weighted by class sizes, counts each link once. Hot filters are cut
    into tiles; a cell returns link counts and the edges that span it, never its pairs.

    The number of filters follows the number of classes, about four classes to a filter direction, so
    buckets stay at about four times a vector's filters at every size. A pair is missed if it shares no filter;
    the README has the measured recall. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing, nor do rows with a null id (component_id null) or vectors of unlike
    length; they are all kept. Rows with equal ids each count and share n_links if their vectors are
    equal. Other columns are ignored.
    """
    good = F.expr("coalesce(_id is not null and size(v) > 0 and forall(v, x -> x is not null and abs(x) < double('inf')) and exists(v, x -> x <> 0), false)")
    rows = vectors.select(F.col(id).cast("long").alias("_id"), F.col(vector).alias("v")).withColumn("good", good)
    classes = rows.where("good").groupBy("v").agg(F.min("_id").alias("rep"), F.count("*").alias("copies"))
    classes = checkpointed(classes.withColumn("node", F.monotonically_increasing_id()))
    code = max(4, round((classes.count() / 4) ** 0.5))
    lengths = [r["n"] for r in classes.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(LENGTHS).collect()]
    known = {}
    for dim in lengths:
        if dim > GRID:
            caps = cap_filters(dim, code, least_cosine, recall, least)
            known[dim] = (getattr(caps, "threshold", 0.0), caps.met if isinstance(caps, CapFilters) else 0.0)

    def decode(batches):
        for b in batches:
            sizes = np.asarray(pc.list_value_length(b["v"]))
            flat = b["v"].flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            found = [None] * len(sizes)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                unit = unit_rows(flat[starts[at][:, None] + np.arange(dim)])
                for i, f in zip(at.tolist(), cap_filters(dim, code, least_cosine, recall, least, known.get(dim)).decoded(unit, least)):
                    found[i] = (f << 20) + dim  # vectors of unlike length never share a filter
            yield pa.RecordBatch.from_arrays([b["node"], b["copies"], b["v"], pa.array(found, pa.list_(pa.int64()))], names=["node", "copies", "v", "filters"])

    kind = classes.schema["v"].dataType.simpleString()
    decoded = classes.select("node", "copies", "v").mapInArrow(decode, f"node long, copies long, v {kind}, filters array<long>")
    spread = decoded.select("node", "copies", "v", "filters", F.posexplode("filters").alias("_at", "filter"))
    spread = spread.select("node", "copies", "v", "filter", F.slice("filters", F.lit(1), F.col("_at")).alias("filters"))  # those before: a pair counts in the first
    cells = in_tiles(spread, "filter", tile, "node")
    parts = ["filter", "tile_a", "tile_b"]

    def verify(batches):
        for t in runs_of(batches, parts):
            key = np.stack([t[c].to_numpy().astype(np.int64) for c in parts])
            cuts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0), True])
            node, copies, own = (t[c].to_numpy() for c in ("node", "copies", "tile"))
            v, filters = t["v"].combine_chunks(), t["filters"].combine_chunks()
            flat, sizes = filters.flatten().to_numpy(), np.asarray(pc.list_value_length(filters))
            starts = np.cumsum(sizes) - sizes
            values = v.flatten().to_numpy()
            dims = np.asarray(pc.list_value_length(v))
            at = np.cumsum(dims) - dims
            out = [[], [], []]
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if e - s < 2:
                    continue
                unit = unit_rows(values[at[s] : at[s] + dims[s] * (e - s)].reshape(e - s, -1))
                near = np.triu(unit @ unit.T >= least_cosine, 1)
                if key[1, s] != key[2, s]:
                    near &= own[s:e, None] != own[None, s:e]
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                a, b = spanning(node[s + i], node[s + j])
                new = first_met(i, j, [flat[starts[r] : starts[r] + sizes[r]] for r in range(s, e)], int(key[0, s]))
                i, j = i[new], j[new]
                links = np.bincount(i, copies[s + j], e - s) + np.bincount(j, copies[s + i], e - s)
                hit = np.flatnonzero(links)
                for column, x in zip(out, ((a, node[s + hit]), (b, np.full(len(hit), -1)), (np.zeros(len(a)), links[hit]))):
                    column += x
            made = [np.concatenate([*c, np.zeros(0)]).astype(np.int64) for c in out]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["a", "b", "n"])

    met = cells.select(*parts, "tile", "node", "copies", "v", "filters").repartition(*parts).sortWithinPartitions(*parts)
    found = checkpointed(met.mapInArrow(verify, "a long, b long, n long"))
    linked = found.where("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = connected_components(found.where("b >= 0").select("a", "b")).join(classes.select("node", "rep"), "node")
    named = groups.groupBy("component").agg(F.min("rep").alias("component_id")).join(groups.select("node", "component"), "component")
    info = classes.join(linked, "node", "left").join(named.select("node", "component_id"), "node", "left").select(
        F.col("v").alias("cv"), F.lit(True).alias("classed"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component_id", "rep").alias("component_id"))
    done = rows.join(info, F.col("good") & (F.col("v") == F.col("cv")), "left")
    component = F.when(F.col("classed"), F.col("component_id")).otherwise(F.col("_id"))
    return done.select(
        F.col("_id").alias(id), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))


#: The query in DuckDB: all pairs, and the closure of the links.
SQL = r"""
with recursive good as (select vec_id, cast(embedding as double[]) v from embeddings where vec_id is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id a, b.vec_id b from good a join good b on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.95),
reach as (select vec_id a, vec_id b from embeddings union select reach.a, links.b from reach join links on links.a = reach.b),
counts as (select a, count(*) n from links group by a), least as (select a, min(b) component_id from reach group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, component_id = vec_id as kept from embeddings left join counts on counts.a = vec_id left join least on least.a = vec_id
"""
