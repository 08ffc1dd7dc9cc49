"""Folders that driver and executors share, tables kept in them, and small tables that every task may have."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewise.sources.store import Store

#: Rows of a table that is sent to every task; more are joined by a shuffle.
FEW = 20_000
#: Spark's setting for executions that free their shuffle files at their end.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def is_local(spark: SparkSession) -> bool:
    """Whether Spark runs in one process, where a local folder is a shared one."""
    return spark.sparkContext.master.split("[")[0] == "local"


def until_end(spark: SparkSession, shared: str) -> str:
    """The folder in ``shared`` of this application's working tables, which is deleted when the driver ends."""
    folder = f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}-tables"
    Store(spark, folder).delete_at_end(folder)
    return folder


def scratch(spark: SparkSession) -> str:
    """A new folder name in the session's shared checkpoint folder; a local one only where Spark itself is local.

    What is written there goes when the driver ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="slices"))
        shared = spark.sparkContext.getCheckpointDir()
    return f"{until_end(spark, shared)}/{uuid4().hex}"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Executions inside free their shuffle files when they end, for those whose result is kept or collected.

    Otherwise the files stay until the driver's garbage is collected. A plan that runs again shuffles again.
    """
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in a new shared folder and read again: its lineage is cut where all executors see it."""
    path = scratch(df.sparkSession)
    with freeing_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined(left: DataFrame, right: DataFrame, on: list, how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the input, by a shuffle and a sort whatever their size is held to be.

    Spark goes by the size of compressed files or blocks; rows of small numbers and paths take a hundred times that in
    memory, and would be broadcast: held by the driver and by every task.
    """
    return left.join(right.hint("merge"), on, how)


def bounded(df: DataFrame, most: int = FEW) -> DataFrame:
    """``df``, to be broadcast if it has at most ``most`` rows; else to be joined by a shuffle and a sort.

    For small aggregates whose number of groups isn't known: they are computed once, with a limit of one row more.
    """
    rows = df.limit(most + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= most else df.hint("merge")
