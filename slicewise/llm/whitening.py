"""Whitening of vectors by hierarchical merging of singular value decompositions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewise.llm.common import checkpointed
from slicewise.llm.vectors import matrix, whole_vectors

#: Whole numbers stay below 2^BITS, exact in a double; summaries that one task merges.
BITS, FAN = 50, 8
SUMMARY = "node int, n long, total array<string>, values array<double>, vectors binary"


class Summary:
    """n rows by their sums and the full-rank decomposition of the rows less their mean: singular values and right vectors.

    ``total`` holds Python integers for whole-number rows, so means and their differences are exact before they are
    rounded once. No direction is ever cut off, so merging loses nothing but rounding.
    """

    def __init__(self, n: int, total: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.total, self.values, self.vectors = n, total, values, vectors

    @classmethod
    def of(cls, rows: np.ndarray) -> Summary:
        n = len(rows)
        if rows.dtype == np.int64:
            total = rows.astype(object).sum(axis=0) if int(np.abs(rows).max()) * n >= 2**62 else rows.sum(axis=0).astype(object)
        else:
            total = rows.sum(axis=0)
        return cls(n, total, *decomposed(centred(rows, n, total)))

    def merged(self, other: Summary) -> Summary:
        """Both lists of rows: a row for the difference of the means is appended to the two factors, then all are decomposed again."""
        gap = ((self.total * other.n - other.total * self.n) / (self.n * other.n)).astype(np.float64)
        step = np.sqrt(self.n / (self.n + other.n) * other.n) * gap
        stacked = [self.values[:, None] * self.vectors, other.values[:, None] * other.vectors, step[None, :]]
        return Summary(self.n + other.n, self.total + other.total, *decomposed(np.concatenate(stacked)))

    def row(self, node: int) -> pa.RecordBatch:
        cells = [[node], [self.n], [[repr(v) for v in self.total.tolist()]], [self.values], [self.vectors.tobytes()]]
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=["node", "n", "total", "values", "vectors"])

    @classmethod
    def read(cls, r: dict) -> Summary:
        whole = not any(c in v for v in r["total"] for c in ".en")
        total = np.array([int(v) for v in r["total"]], object) if whole else np.array([float(v) for v in r["total"]])
        values = np.asarray(r["values"], np.float64)
        return cls(r["n"], total, values, np.frombuffer(r["vectors"]).reshape(len(values), len(total)))

    def covariance(self) -> np.ndarray:
        return (self.vectors.T * np.square(self.values)) @ self.vectors / self.n


def centred(rows: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """rows - total / n; whole numbers lose the whole part of the mean first, so nothing large is rounded."""
    if rows.dtype != np.int64:
        return rows - total / n
    base = total // n
    return (rows - base.astype(np.int64)) - ((total - base * n) / n).astype(np.float64)


def decomposed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right vectors; tall matrices are made square first, by a QR decomposition."""
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    _, values, vectors = np.linalg.svd(rows, full_matrices=False)
    return values, vectors


def summarised(rows: DataFrame, dim: int, read=lambda batch: batch) -> Summary | None:
    """The summary of all rows that ``read`` makes of the batches of ``rows``; None if there are none.

    A task folds its batches to one summary, then FAN of them meet in a Spark group, round by round. A summary
    has dim * (dim + 2) numbers at most, whatever the rows, and one is collected at the end.
    """

    def summarise(batches):
        whole = None
        for b in batches:
            if b.num_rows:
                one = Summary.of(read(b))
                whole = whole.merged(one) if whole else one
        if whole:
            yield whole.row(TaskContext.get().partitionId())

    def merge(t):
        rows = sorted(t.to_pylist(), key=lambda r: r["from"])
        whole = Summary.read(rows[0])
        for r in rows[1:]:
            whole = whole.merged(Summary.read(r))
        return pa.Table.from_batches([whole.row(rows[0]["node"])])

    level = checkpointed(rows.mapInArrow(summarise, SUMMARY))
    top = level.agg(F.max("node")).first()[0]
    while top:
        level = level.withColumn("from", F.col("node")).withColumn("node", F.expr(f"cast(node div {FAN} as int)")).groupBy("node").applyInArrow(merge, SUMMARY)
        top //= FAN
    found = level.collect()
    return Summary.read(found[0].asDict()) if found else None


def whitened(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable vector and component from 1.

    Components become x = floor(scale * c) + shift. All usable vectors are the fit list; its covariance has divisor n.
    The strongest ``components`` eigenvectors come from the merged decomposition (each with its largest entry
    positive), fewer where the vectors have fewer dimensions or don't vary in more: a direction whose singular value is
    within rounding of zero has none. ``deviation`` is exact, null where it passes a long. ``identity_error`` is found by the same merging over the whitened rows.

    Vectors that are null, empty, hold null or non-finite components, or aren't of the most frequent length go (see
    ``vectors.whole_vectors``). Null, repeated and equal ids stay, each row for itself. An empty table, or one whose vectors are all equal,
    gives none. Other columns are ignored.
    """
    rows, dim = whole_vectors(vectors, vector, scale, shift, BITS, (id, "id"))
    kind = rows.schema["id"].dataType.simpleString()
    fit = summarised(rows.select("x"), dim, lambda b: matrix(b["x"], dim))
    none = rows.limit(0).select(F.col("id").alias(id), *(F.lit(None).cast(k).alias(c) for c, k in (("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))))
    if fit is None or not fit.values[0] > 0:
        return none
    strong = int((fit.values > fit.values[0] * dim * np.finfo(float).eps).sum())
    axes = fit.vectors[: min(components, strong)]
    axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
    turn = (axes / (fit.values[: len(axes), None] / np.sqrt(fit.n))).T
    explained = (np.square(fit.values[: len(axes)]) / np.square(fit.values).sum()).tolist()
    n, total = fit.n, fit.total

    def project(b: pa.RecordBatch) -> np.ndarray:
        return centred(matrix(b["x"], dim), n, total) @ turn

    def work(batches):
        for b in batches:
            x, made = matrix(b["x"], dim), np.ascontiguousarray(project(b))
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(axes)), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([b["id"], deviations(x, n, total), cells], names=["id", "deviation", "w"])

    check = summarised(rows.select("x"), len(axes), project)
    error = float(np.abs(check.covariance() - np.eye(len(axes))).max())
    made = rows.mapInArrow(work, f"id {kind}, deviation long, w array<double>").select("id", "deviation", F.posexplode("w").alias("_at", "whitened"))
    share = F.element_at(F.array(*map(F.lit, explained)), F.col("_at") + 1)
    return made.select(
        F.col("id").alias(id), (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).alias("identity_error"))


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> pa.Array:
    """The sum over components of (n * x - total)^2 of each row; null where it passes a long."""
    base = total // n
    away, rest = x - base.astype(np.int64), total - base * n
    most = n * (int(np.abs(away).max(initial=0)) + 1)
    if most * most * x.shape[1] < 2**63:
        return pa.array(np.square(n * away - rest.astype(np.int64)).sum(axis=1))
    exact = np.square(n * away.astype(object) - rest).sum(axis=1)
    return pa.array([v if v < 2**63 else None for v in exact.tolist()], pa.int64())
