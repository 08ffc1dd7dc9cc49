"""What the operators share: the shared folder, lineage cuts, and skew-safe tiling of bucket joins."""

from __future__ import annotations

import tempfile
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewise.sources.shared import freeing_shuffles, is_local, until_end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and Spark itself is local (tests, a laptop) is a local one chosen.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints"))
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    with freeing_shuffles(df.sparkSession):
        return df.checkpoint(eager=True)


def kept(df: DataFrame, *by: str) -> str:
    """The folder of ``df``, written as Parquet in the shared folder, with a folder inside for each value of ``by``; it goes when the driver ends."""
    path = f"{until_end(df.sparkSession, shared_folder(df.sparkSession))}/{uuid4().hex}"
    with freeing_shuffles(df.sparkSession):
        df.write.partitionBy(*by).parquet(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` kept in the shared folder and read again, for tables with texts."""
    return df.sparkSession.read.parquet(kept(df))


def in_tiles(df: DataFrame, key: str, tile: int, by: str) -> DataFrame:
    """Deal the rows of each ``key`` to cells (key, tile_a, tile_b) so that any two meet in a cell.

    A key with up to ``tile`` rows stays one cell (0, 0). A larger one is cut by the hash of column
    ``by`` into T tiles; each row goes to the T cells that its tile shares with the others, so no task
    holds more than about two tiles of a hot key, and still every pair of rows meets: rows of different
    tiles (column ``tile``) in one cell, those of one tile in its own cell (t, t) and in others.
    """
    return dealt(numbered(df, key, tile, by))


def numbered(df: DataFrame, key: str, tile: int, by: str) -> DataFrame:
    """``df`` with ``tiles``, the number of tiles of its ``key``, and ``tile``, the row's own (see ``in_tiles``)."""
    hot = (
        df.groupBy(key).count().where(F.col("count") > tile)
        .select(F.col(key).alias("_hot"), F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    )
    return (
        df.join(hot, F.col(key) == F.col("_hot"), "left").drop("_hot")
        .withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        .withColumn("tile", F.pmod(F.xxhash64(by), F.col("tiles")).cast("int"))
    )


def dealt(df: DataFrame) -> DataFrame:
    """Numbered rows, each once for every cell (tile_a, tile_b) of its key that its tile is part of."""
    return (
        df.withColumn("_u", F.explode(F.expr("sequence(0, tiles - 1)")))
        .withColumn("tile_a", F.least("tile", "_u"))
        .withColumn("tile_b", F.greatest("tile", "_u"))
        .drop("tiles", "_u")
    )


def runs_of(batches, names: list[str]):
    """Tables of whole runs from sorted record batches: rows equal in ``names`` are never parted."""
    held = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        if not new.num_rows:
            continue
        held = new if held is None else pa.concat_tables([held, new])
        last = [held[n][-1] for n in names]
        if all(held[n][0] == v for n, v in zip(names, last)):
            continue
        lo, hi = 0, held.num_rows - 1  # first row of the last run; runs are sorted
        while lo < hi:
            mid = (lo + hi) // 2
            if all(held[n][mid] == v for n, v in zip(names, last)):
                hi = mid
            else:
                lo = mid + 1
        yield held.slice(0, lo).combine_chunks()
        held = held.slice(lo)
    if held is not None and held.num_rows:
        yield held.combine_chunks()
