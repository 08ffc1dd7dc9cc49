"""Linking of objects across slices: centroids, a proximity graph, shortest paths, whole objects."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicewise.operators import images
from slicewise.sources.shared import joined, stored

COMPARTMENTS = ("nuclei", "cell")


def compartment(name: str) -> str:
    """The name, if objects of it can be linked; whole organoids can't."""
    if name not in COMPARTMENTS:
        raise ValueError(f"compartment must be one of {COMPARTMENTS}, not {name!r}")
    return name


def centroids(slices: DataFrame, min_objects: int = 2) -> DataFrame:
    """(stack, slice, label, centroid_0, centroid_1, unique_id) of objects in label slices with ``min_objects`` or more.

    A slice's objects are found where it is read; only their rows are shuffled, for unique_id, which counts from 0
    within a stack, by slice and label.
    """

    def work(batches):
        for b in batches:
            out = [[], [], [], [], []]
            for stack, z, image in zip(b["stack"].to_pylist(), b["z"].to_pylist(), images.arrays(b)):
                y, x = np.nonzero(image > 0)
                labels, at, n = np.unique(image[y, x], return_inverse=True, return_counts=True)
                if len(labels) >= min_objects:
                    middle = (np.bincount(at, v) / n for v in (y, x))
                    for column, v in zip(out, ([stack] * len(labels), [z] * len(labels), labels.astype(int).tolist(), *middle)):
                        column.extend(v)
            kinds = pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["stack", "slice", "label", "centroid_0", "centroid_1"])

    objects = slices.select(*images.SHAPE, "pixels").mapInArrow(work, "stack int, slice int, label int, centroid_0 double, centroid_1 double")
    return objects.withColumn("unique_id", (F.row_number().over(Window.partitionBy("stack").orderBy("slice", "label")) - 1).cast("long"))


def edges(objects: DataFrame, radius: float = 10.0) -> DataFrame:
    """(stack, slice, src, dst, weight): objects of adjacent slices nearer than ``radius``; ``slice`` is that of ``src``.

    Objects meet in squares of side 2 * ``radius``: one goes to its own, those it may link with in the next slice to the
    two that their reach touches along each axis, so comparisons grow with an object's neighbours and not with the objects of a slice.
    """
    square = lambda c: F.floor(c / (2 * radius))
    reach = lambda c: F.explode(F.sequence(square(F.col(c) - radius), square(F.col(c) + radius)))
    a = objects.select("stack", "slice", square(F.col("centroid_0")).alias("_s0"), square(F.col("centroid_1")).alias("_s1"), F.col("unique_id").alias("src"), F.col("centroid_0").alias("_a0"), F.col("centroid_1").alias("_a1"))
    b = objects.select("stack", (F.col("slice") - 1).alias("slice"), reach("centroid_0").alias("_s0"), "centroid_0", "centroid_1", F.col("unique_id").alias("dst"))
    b = b.select("stack", "slice", "_s0", reach("centroid_1").alias("_s1"), "dst", F.col("centroid_0").alias("_b0"), F.col("centroid_1").alias("_b1"))
    weight = F.sqrt((F.col("_a0") - F.col("_b0")) * (F.col("_a0") - F.col("_b0")) + (F.col("_a1") - F.col("_b1")) * (F.col("_a1") - F.col("_b1")))
    return joined(a, b, ["stack", "slice", "_s0", "_s1"]).select("stack", "slice", "src", "dst", weight.alias("weight")).where(F.col("weight") < radius)


def components(links: DataFrame) -> DataFrame:
    """(stack, node, component): linked nodes share the least of their numbers.

    Each round every node takes the least component beside it, then that node's own (pointers double), until
    nothing changes; a round is two joins of rows of numbers.
    """
    ends = stored(links.select("stack", F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("node"), F.col("src").alias("other")))).alias("_e")).select("stack", "_e.node", "_e.other"))
    at = ends.groupBy("stack", "node").agg(F.least(F.col("node"), F.min("other")).alias("component"))
    while True:
        beside = joined(ends, at.select("stack", F.col("node").alias("other"), "component"), ["stack", "other"]).groupBy("stack", "node").agg(F.min("component").alias("near"))
        least = joined(at, beside, ["stack", "node"]).select("stack", "node", "component", F.least("component", "near").alias("near"))
        jump = at.select("stack", F.col("node").alias("near"), F.col("component").alias("beyond"))
        on = stored(joined(least, jump, ["stack", "near"]).select("stack", "node", F.col("beyond").alias("component"), (F.col("beyond") != F.col("component")).alias("moved")))
        moved = on.where("moved").limit(1).count()
        at = on.drop("moved")
        if not moved:
            return at


def _walks(t: pa.Table) -> pa.Table:
    """Fewest-hop path and least total weight from each node to each it reaches in its slice or a later one; one component or more."""
    beside: dict[int, list] = {}
    level: dict[int, int] = {}
    for z, a, b, w in zip(*(t[c].to_pylist() for c in ("slice", "src", "dst", "weight"))):
        beside.setdefault(a, []).append((b, w))
        beside.setdefault(b, []).append((a, w))
        level[a], level[b] = z, z + 1
    for near in beside.values():
        near.sort()
    out = [], [], [], []
    for start in sorted(beside):
        path, queue = {start: [start]}, [start]
        for node in queue:  # neighbours in order: of equally short paths the least by its nodes comes first
            for other, _ in beside[node]:
                if other not in path:
                    path[other] = [*path[node], other]
                    queue.append(other)
        far, heap = {}, [(0.0, start)]
        while heap:
            d, node = heapq.heappop(heap)
            if node not in far:
                far[node] = d
                for other, w in beside[node]:
                    heapq.heappush(heap, (d + w, other))
        ends = [n for n in queue[1:] if level[n] >= level[start]]
        for column, x in zip(out, ([start] * len(ends), ends, [path[n] for n in ends], [far[n] for n in ends])):
            column += x
    kinds = pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64()
    columns = [pa.array([t["stack"][0].as_py()] * len(out[0]), pa.int32()), *(pa.array(c, k) for c, k in zip(out, kinds))]
    return pa.Table.from_arrays(columns, names=["stack", "node1", "node2", "path", "distance"])


def paths(links: DataFrame, most_links: int = 20_000) -> DataFrame:
    """(stack, node1, node2, path, distance) for reachable pairs whose first node isn't in a later slice.

    ``path`` has the fewest hops, of equals the one whose node list is least; ``distance`` is the least
    total weight, maybe along another path. A stack of up to ``most_links`` links is one Spark group; of a larger one
    the connected components are found first, and each is a group. The result is kept in the shared folder.
    """
    links = stored(links)
    large = links.groupBy("stack").count().where(F.col("count") > most_links).select("stack")
    grouped = links.withColumn("component", F.lit(-1).cast("long"))
    if large.limit(1).count():
        own = links.join(large, "stack", "left_semi")
        rest = links.join(large, "stack", "left_anti").withColumn("component", F.lit(-1).cast("long"))
        grouped = rest.unionByName(joined(own, components(own).withColumnRenamed("node", "src"), ["stack", "src"]))
    return stored(grouped.groupBy("stack", "component").applyInArrow(_walks, "stack int, node1 long, node2 long, path array<long>, distance double"))


def containers(found: DataFrame) -> DataFrame:
    """Pairs (stack, path, longer) of a path and a longer one that holds its rarest node: those that ``longest`` compares.

    The inverted index has a row for each node of each path. A path looks up its node with the fewest paths alone (of
    equals the least), as any path that holds all its nodes holds that one.
    """
    index = found.select("stack", "path", F.explode("path").alias("node"))
    often = index.groupBy("stack", "node").agg(F.count("*").alias("n"))
    rarest = joined(index, often, ["stack", "node"]).groupBy("stack", "path").agg(F.min(F.struct("n", "node"))["node"].alias("node"))
    found = joined(rarest.withColumnRenamed("path", "_short"), index, ["stack", "node"])  # columns as above: the index is shuffled once
    return found.where(F.size("path") > F.size("_short")).select("stack", F.col("_short").alias("path"), F.col("path").alias("longer"))


def longest(found: DataFrame) -> DataFrame:
    """Paths whose nodes don't all lie on a longer path of their stack; equally long ones stay.

    Paths that another one extends by a node at either end go by an equality join, which leaves few. A longer path
    that was extended has a holder among those left, so these are compared with each other only, through
    an inverted index (``containers``).
    """
    shorter = found.select("stack", F.explode(F.array(F.expr("slice(path, 1, size(path) - 1)"), F.expr("slice(path, 2, size(path) - 1)"))).alias("path"))
    left = stored(joined(found, shorter, ["stack", "path"], "left_anti"))
    inside = containers(left).where(F.size(F.array_except("path", "longer")) == 0).select("stack", "path")
    return joined(left, inside, ["stack", "path"], "left_anti").select(*found.columns)


def numbered(found: DataFrame, first_object: int = 0) -> DataFrame:
    """Paths with object_number, by their node lists within a stack."""
    order = Window.partitionBy("stack").orderBy("path", "node1", "node2")
    return found.withColumn("object_number", (F.row_number().over(order) - 1 + first_object).cast("int"))


def path_nodes(objects: DataFrame, numbers: DataFrame) -> DataFrame:
    """A row for each node of each object, with its place."""
    nodes = numbers.select("stack", "object_number", F.posexplode("path").alias("step", "unique_id"))
    return joined(nodes, objects, ["stack", "unique_id"]).select("stack", "object_number", "step", "unique_id", "slice", "label", "centroid_0", "centroid_1")


def relabelled(slices: DataFrame, nodes: DataFrame) -> DataFrame:
    """Label slices with their object's number instead of the slice label; the last object of a label wins, and
    pixels of no object are 0."""
    last = nodes.groupBy("stack", F.col("slice").alias("z"), "label").agg(F.max("object_number").alias("object"))
    return images.renamed(slices, last)
