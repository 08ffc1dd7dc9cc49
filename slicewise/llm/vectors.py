"""What the operators on vectors share: whole-number vectors of one length, and their Arrow columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(vectors: DataFrame, vector: str, scale: int, shift: int, bits: int, *others: tuple[str, str]) -> tuple[DataFrame, int]:
    """(others..., x array<long>) with x = floor(scale * component) + shift, and the length of the vectors.

    Rows whose vector is null, empty or holds a null or non-finite component go. So do those that can't be
    computed with exactly: a whole number of 2^bits or more counts as non-finite, and vectors must be of one
    length, the most frequent (the lesser of two); without any row the length is 0.
    """
    usable = f"coalesce(size(v) > 0 and forall(v, e -> e is not null and abs(double(e)) * {scale}D < {float(2**bits)!r}D), false)"
    rows = vectors.select(*(F.col(c).alias(n) for c, n in others), F.col(vector).alias("v")).where(usable)
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = sizes["n"] if sizes else 0
    names = [n for _, n in others]
    return rows.where(F.size("v") == dim).select(*names, F.expr(f"transform(v, e -> floor(double(e) * {scale}D) + {shift}L)").alias("x")), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column whose rows all have ``dim`` entries, as an array of rows, without Python objects."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
