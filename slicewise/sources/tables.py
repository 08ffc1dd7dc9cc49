"""The library's tables from the driver's: image measurements, image paths, voxels, a platemap, folders.

Each is a deterministic, arithmetic-only view of a given table, read with only the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewise import schema


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where an image belongs, by the arithmetic of an event's numbers.
PLACE = (
    "concat('NF00', cast(14 + 2 * (user_id % 3) as string)) plate",
    "concat(substr('CDEFG', cast(floor(user_id / 3) as int) % 5 + 1, 1), cast(2 + cast(floor(user_id / 15) as int) % 10 as string)) well",
    "cast(floor(user_id / 150) as int) site",
    "concat('ZS', lpad(cast(event_id % 40 as string), 3, '0')) zslice",
)


def _placed(events: DataFrame) -> DataFrame:
    return events.selectExpr("event_id", "event_type", "value", *PLACE)


def zslice_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each measured z-slice image; keys repeat, as in reruns."""
    slopes = zip(("dna", "mito", "er", "agp", "brightfield"), (2, 3, 5, 4, 7))
    shares = zip(("dna", "mito", "er", "agp", "brightfield"), (3, 5, 2, 4, 11))
    return _placed(read(spark, sf_dir, "events")).selectExpr(
        "event_id", *schema.ZSLICE,
        *(f"-value / (1 + event_id % {k}) slope_{c}" for c, k in slopes),
        *(f"value / (1 + event_id % {k}) pctmax_{c}" for c, k in shares),
    )


def image_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, path): the image file of each z-slice, its identity in the path text."""
    text = "case event_type when 'click' then '405' when 'view' then '488' when 'purchase' then '555' when 'signup' then '640' else 'TRANS' end"
    path = f"concat('/data/', plate, '_raw_images/', well, '-', cast(site as string), '/img_', {text}, '_', zslice, '.tif') path"
    return _placed(read(spark, sf_dir, "events")).selectExpr("event_id", path)


def voxels(spark: SparkSession, sf_dir: str, depth: int, threshold: float = 0.1) -> DataFrame:
    """(stack, z, y, x, v, lab): 8 x 8 slices in stacks of ``depth``; an object is a quadrant over ``threshold``."""
    cells = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "e"))
    return cells.selectExpr(
        f"cast(floor(vec_id / {depth}) as int) stack", f"cast(vec_id % {depth} as int) z",
        "cast(floor(p / 8) as int) y", "cast(p % 8 as int) x",
        "cast(floor((cast(e as double) + cast(0.6 as double)) * 100) as int) v",
        f"case when cast(e as double) > cast({threshold} as double) then 1 + cast(floor((p % 8) / 4) as int) + 2 * cast(floor(p / 32) as int) else 0 end lab",
    )


def slices(spark: SparkSession, sf_dir: str, depth: int, threshold: float = 0.1) -> DataFrame:
    """(stack, z, height, width, pixels, labels): ``voxels`` with a row for each slice, made without a shuffle."""
    return read(spark, sf_dir, "embeddings").selectExpr(
        f"cast(floor(vec_id / {depth}) as int) stack", f"cast(vec_id % {depth} as int) z", "8 height", "8 width",
        "transform(embedding, e -> cast(floor((cast(e as double) + cast(0.6 as double)) * 100) as double)) pixels",
        f"transform(embedding, (e, p) -> cast(case when cast(e as double) > cast({threshold} as double) then 1 + cast(floor((p % 8) / 4) as int) + 2 * cast(floor(p / 32) as int) else 0 end as double)) labels",
    )


def nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, path): acquisition trees, with a folder or two between a well and its images, some of other kinds."""
    path = "replace(path, '/img_', case when event_id % 7 = 0 then '/scan/deep/img_' when event_id % 5 = 0 then '/img_' else '/scan/img_' end)"
    kind = "case when event_id % 11 = 0 then '.TIFF' when event_id % 13 = 0 then '.png' else '.tif' end"
    return image_paths(spark, sf_dir).selectExpr("event_id", f"replace({path}, '.tif', {kind}) path")


def platemap(spark: SparkSession, sf_dir: str, wells: int = 50) -> DataFrame:
    """(well_position, treatment, dose, wellrow, wellcol) for the first ``wells`` wells."""
    row = "substr('CDEFG', cast(p_size - 1 as int) % 5 + 1, 1)"
    column = "2 + cast(floor((p_size - 1) / 5) as int)"
    return (
        read(spark, sf_dir, "part").where(F.col("p_size") <= wells)
        .groupBy("p_size").agg(F.min("p_type").alias("treatment"))
        .selectExpr(f"concat({row}, cast({column} as string)) well_position", "treatment", "cast(p_size % 4 as string) dose", f"{row} wellrow", f"{column} wellcol")
    )


def folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(plate, folder): a directory listing, with two folders that have no images."""
    seen = zslice_qc(spark, sf_dir).selectExpr("plate", "concat(well, '-', cast(site as string), ' acq') folder").distinct()
    return seen.union(spark.createDataFrame(schema.EXTRA_FOLDERS, "plate string, folder string"))
