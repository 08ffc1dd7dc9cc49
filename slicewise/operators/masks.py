"""Masks of overlapping windows: index sets, overlap, and the choice of one label for each pixel.

Rows are label slices of windows: (stack, z, pseudo_slice, height, width, pixels), as ``volume.fan_out`` makes them.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewise.operators import images
from slicewise.sources.shared import joined, stored

MASK = ["stack", "z", "label", "pseudo_slice"]
WINDOW = ["stack", "z", "pseudo_slice", "height", "width"]
#: Slices whose windows are painted in one group; a group costs milliseconds besides its pixels.
SLICES_AT_ONCE = 8
#: A mask's number in its slice, from 1.
RANK = "cast(row_number() over (partition by stack, z order by label, pseudo_slice) as long) i"


def mask_index(rows: DataFrame) -> DataFrame:
    """A row for each mask (label and pseudo-slice at a z): its distinct rows and columns, and their area,
    which is twice its pixels. Label 0 is a mask like others.

    ``rows`` are label slices with a pseudo_slice; masks are found where a slice is read, without a shuffle.
    """

    def work(batches):
        for b in batches:
            out = [[] for _ in names]
            for stack, z, p, image in zip(*(b[c].to_pylist() for c in ("stack", "z", "pseudo_slice")), images.arrays(b)):
                flat = image.ravel().astype(np.int64)
                order = np.argsort(flat, kind="stable")
                labels, first = np.unique(flat[order], return_index=True)
                for label, at in zip(labels.tolist(), np.split(order, first[1:]) if len(labels) else []):
                    for column, v in zip(out, (stack, z, label, p, np.unique(at // image.shape[1]), np.unique(at % image.shape[1]), 2 * len(at))):
                        column.append(v)
            kinds = pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    names = [*MASK, "ys", "xs", "area"]
    return rows.select(*WINDOW, "pixels").mapInArrow(work, "stack int, z int, label int, pseudo_slice int, ys array<int>, xs array<int>, area long")


def candidates(masks: DataFrame, above: float = 0.8) -> DataFrame:
    """(stack, z, i, j) with i < j: the masks of a slice whose coordinate sets may overlap by more than ``above``.

    Sets that do share one of their least coordinates, of n the first n - ceil(above * n) + 1 (a prefix filter in the order
    of numbers), and neither is smaller than ``above`` of the other, so masks meet on those alone.
    """
    n = F.size("coords")
    least = F.slice(F.array_sort("coords"), F.lit(1), (n - F.ceil(above * n - 1e-9) + 1).cast("int"))
    prefix = masks.select("stack", "z", "i", n.alias("n"), F.explode(least).alias("c"))
    other = prefix.select("stack", "z", "c", F.col("i").alias("j"), F.col("n").alias("_n"))
    met = joined(prefix, other, ["stack", "z", "c"]).where("i < j").where((F.col("_n") >= above * F.col("n")) & (F.col("n") >= above * F.col("_n")))
    return met.select("stack", "z", "i", "j").distinct()


def overlaps(masks: DataFrame, above: float = 0.8) -> DataFrame:
    """Ordered pairs (i, j) of masks of one slice whose coordinate sets overlap by more than ``above``.

    The compared set of a mask is its row numbers together with its column numbers. i and j are ranks by
    label, then pseudo-slice; the winner is the larger mask, i in a tie. Only ``candidates`` are compared, each pair once.
    """
    m = stored(masks.selectExpr(*MASK, "area", RANK, "array_distinct(concat(ys, xs)) coords"))
    side = lambda k: m.select("stack", "z", F.col("i").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in ("label", "pseudo_slice", "area", "coords")))
    common = F.size(F.array_intersect("coords_i", "coords_j"))
    pairs = joined(joined(candidates(m, above), side("i"), ["stack", "z", "i"]), side("j"), ["stack", "z", "j"])
    return _both_ways(pairs.withColumn("iou", common / (F.size("coords_i") + F.size("coords_j") - common)), above)


def _both_ways(pairs: DataFrame, above: float) -> DataFrame:
    """The pairs whose overlap is over ``above``, as (i, j) and as (j, i), with the winner of each."""
    names = ("label", "pseudo_slice")
    ways = [F.struct(F.col(a).alias("i"), F.col(b).alias("j"), *(F.when(F.col(f"area_{a}") >= F.col(f"area_{b}"), F.col(f"{c}_{a}")).otherwise(F.col(f"{c}_{b}")).alias(c) for c in names)) for a, b in (("i", "j"), ("j", "i"))]
    over = pairs.where(F.col("iou") > above).select("stack", "z", F.round("iou", 6).alias("iou"), F.explode(F.array(*ways)).alias("_p"))
    return over.select("stack", "z", "_p.i", "_p.j", "iou", "_p.label", "_p.pseudo_slice")


def pixel_overlaps(rows: DataFrame, above: float = 0.8) -> DataFrame:
    """As ``overlaps``, by true overlap of pixels instead of coordinate sets.

    The windows of one slice are a Spark group; masks of one window share no pixel.
    """

    def work(t):
        found = sorted(zip(t["pseudo_slice"].to_pylist(), images.arrays(t)), key=lambda x: x[0])
        out = [np.zeros(0, np.int64)] * 5
        for (p, a), (q, b) in itertools.combinations(found, 2):
            pairs, common = np.unique(np.stack([a.ravel(), b.ravel()]).astype(np.int64), axis=1, return_counts=True)
            out = [np.concatenate([c, x]) for c, x in zip(out, (pairs[0], np.full(len(common), p), pairs[1], np.full(len(common), q), common))]
        n = len(out[0])
        return pa.table({"stack": pa.array([t["stack"][0].as_py()] * n, pa.int32()), "z": pa.array([t["z"][0].as_py()] * n, pa.int32()), **{c: pa.array(v.astype(k)) for c, v, k in zip(("label_i", "pseudo_slice_i", "label_j", "pseudo_slice_j", "common"), out, ("i4", "i4", "i4", "i4", "i8"))}})

    common = rows.select(*WINDOW, "pixels").groupBy("stack", "z").applyInArrow(work, "stack int, z int, label_i int, pseudo_slice_i int, label_j int, pseudo_slice_j int, common long")
    m = stored(mask_index(rows).selectExpr(*MASK, "area", RANK))
    side = lambda k: m.select("stack", "z", F.col("i").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in ("label", "pseudo_slice", "area")))
    pairs = common.join(side("i"), ["stack", "z", "label_i", "pseudo_slice_i"]).join(side("j"), ["stack", "z", "label_j", "pseudo_slice_j"])
    return _both_ways(pairs.withColumn("iou", F.col("common") / (F.col("area_i") / 2 + F.col("area_j") / 2 - F.col("common"))), above)


def decoupled(rows: DataFrame, above: float = 0.8, iou: str = "coordinate_set") -> DataFrame:
    """Label slices (stack, z, height, width, pixels) with one label for each pixel that a winning mask covers, else -1.

    Winners are painted in the order of their pairs (i, j), the last paint stays. A mask's last paint is
    all that counts of it, so pairs fold to one turn for each winner before they meet pixels, which move once. The
    windows of up to ``SLICES_AT_ONCE`` slices are a Spark group. Slices without any winner don't come.
    """
    if iou not in ("coordinate_set", "pixel"):
        raise ValueError(f"no such overlap: {iou}")
    pairs = overlaps(mask_index(rows), above) if iou == "coordinate_set" else pixel_overlaps(rows, above)
    last = pairs.groupBy(*MASK).agg(F.max(F.struct("i", "j")).alias("_turn"))
    of_range = F.floor(F.col("z") / SLICES_AT_ONCE).cast("int").alias("_range")
    turns = last.select("stack", of_range, "z", "_turn.i", "_turn.j", "label", "pseudo_slice")

    def paint(t, turns):
        t, made = t.combine_chunks(), []
        if not t.num_rows:
            return images.rows_of(0, made)
        at_z, at_window, found = t["z"].to_numpy(), t["pseudo_slice"].to_numpy(), images.arrays(t)
        turns = turns.combine_chunks().sort_by([("z", "ascending"), ("i", "ascending"), ("j", "ascending")])
        turn_z, label_of, window_of = (turns[c].to_numpy() for c in ("z", "label", "pseudo_slice"))
        for z in np.unique(turn_z).tolist():
            winners, windows = label_of[turn_z == z], window_of[turn_z == z]
            rows = np.flatnonzero(at_z == z).tolist()
            best, label = np.zeros(found[rows[0]].shape, np.int64), np.full(found[rows[0]].shape, -1.0)
            for window, image in ((at_window[row], found[row]) for row in rows):
                turn = np.flatnonzero(windows == window) + 1
                if not len(turn):
                    continue
                order = np.argsort(winners[turn - 1])
                labels, turn = winners[turn - 1][order], turn[order]
                at = np.minimum(np.searchsorted(labels, image), len(labels) - 1)
                mine = np.where(labels[at] == image, turn[at], 0)
                label = np.where(mine > best, image, label)
                best = np.maximum(mine, best)
            made.append((z, label))
        return images.rows_of(t["stack"][0].as_py(), made)

    ranges = rows.select(*WINDOW, "pixels", of_range).groupBy("stack", "_range")
    return ranges.cogroup(turns.groupBy("stack", "_range")).applyInArrow(paint, images.SLICES)
