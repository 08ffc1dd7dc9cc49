"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewise.llm.common import checkpointed


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) that span the given edges."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _whole_stars(batches):
    """One pass over all edges of the task."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        a.append(batch["a"].to_numpy())
        b.append(batch["b"].to_numpy())
    a, b = spanning(np.concatenate(a), np.concatenate(b))
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _local_stars(batches):
    for batch in batches:
        a, b = spanning(batch["a"].to_numpy(), batch["b"].to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


#: Edges (16 bytes each) that one task may finish by itself.
FEW = 1 << 19


def connected_components(edges: DataFrame, max_rounds: int = 60, few: int = FEW) -> DataFrame:
    """(node, component) for every node with an edge; component is its smallest reachable node.

    ``edges`` has long columns a and b; loops, repeats and nulls are ignored. Each round is two
    aggregations with map-side minima and two joins on a unique side; it ends when no edge changes, or
    when at most ``few`` edges are left, which one task spans. The edges never leave the executors. They
    are shuffled once before the local stars, so a task never holds a Python worker for them beside one of
    the operator that found them.
    """
    e = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct().mapInArrow(_local_stars, "a long, b long").distinct()
    )
    e, before = checkpointed(e), None
    for _ in range(max_rounds):
        if before is None and e.count() <= few or before is not None and before[0] <= few:
            e = e.repartition(1).mapInArrow(_whole_stars, "a long, b long")
            break
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        far = e.join(low.select(F.col("a").alias("b"), "m"), "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        far = far.distinct()
        low = far.groupBy("a").agg(F.min("b").alias("m"))
        near = far.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = checkpointed(near.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    ).groupBy("node").agg(F.min("component").alias("component"))
