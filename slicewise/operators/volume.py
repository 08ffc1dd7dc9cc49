"""Operators over voxel rows (stack, z, y, x, value), and over slice rows whose pixels are arrays (see ``images``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewise.sources.shared import bounded

VOXEL = ["stack", "z", "y", "x"]
SLICE = ["stack", "z"]
SHAPE = [*SLICE, "height", "width"]


def fan_out(windows: DataFrame, width: int, depth: int | None = None) -> DataFrame:
    """Window z gives its rows to slices z .. z + width - 1 (below ``depth``), as pseudo_slice z. Rows are voxels or slices."""
    spread = windows.withColumnRenamed("z", "pseudo_slice").withColumn("z", F.explode(F.sequence(F.col("pseudo_slice"), F.col("pseudo_slice") + width - 1)))
    return spread if depth is None else spread.where(F.col("z") < depth)


def to_byte(value: Column) -> Column:
    """Cut to whole numbers and wrap at 256, as a cast to unsigned bytes does."""
    return F.pmod(F.floor(value).cast("int"), F.lit(256))


def _of(value: Column, most: Column) -> Column:
    """value / most * 255 as a byte; 0 where ``most`` is 0."""
    return to_byte(F.coalesce(value / F.nullif(most, F.lit(0)), F.lit(0.0)) * 255)


def with_range(slices: DataFrame, pixels: str = "pixels") -> DataFrame:
    """Slices with the least and the greatest value of their stack. Only two numbers of a slice are aggregated."""
    ranges = slices.groupBy("stack").agg(F.min(F.array_min(pixels)).alias("_lo"), F.max(F.array_max(pixels)).alias("_hi"))
    return slices.join(bounded(ranges), "stack")


def rescaled_to_range(slices: DataFrame) -> DataFrame:
    """(v - least) / (most - least) * 255 of the stack, as a byte; 0 in a constant stack."""
    return with_range(slices).select(*SHAPE, F.transform("pixels", lambda v: _of(v - F.col("_lo"), F.col("_hi") - F.col("_lo"))).alias("pixels"))


def rescaled_to_max(slices: DataFrame) -> DataFrame:
    """v / most * 255 of the stack, as a byte; 0 where the most is 0."""
    return with_range(slices).select(*SHAPE, F.transform("pixels", lambda v: _of(v, F.col("_hi"))).alias("pixels"))


def rgb_composite(slices: DataFrame, red: str, blue: str) -> DataFrame:
    """(stack, z, height, width, r, g, b): both channels scaled to their slice's maximum, green 0, then all to the
    composite's. No shuffle: a slice has all that it needs."""
    own = slices.select(*SHAPE, F.col(red).alias("r"), F.col(blue).alias("b"), F.array_max(red).alias("_r"), F.array_max(blue).alias("_b"))
    scaled = own.select(*SHAPE, F.transform("r", lambda v: _of(v, F.col("_r"))).alias("r"), F.transform("b", lambda v: _of(v, F.col("_b"))).alias("b"))
    again = scaled.withColumn("_most", F.greatest(F.array_max("r"), F.array_max("b")))
    return again.select(*SHAPE, F.transform("r", lambda v: _of(v, F.col("_most"))).alias("r"), F.transform("r", lambda v: F.lit(0)).alias("g"), F.transform("b", lambda v: _of(v, F.col("_most"))).alias("b"))


def video_scaled(voxels: DataFrame) -> DataFrame:
    """Frames for a film: image to its high byte times 8, mask times 16, both wrapping at 256."""
    return voxels.select(*VOXEL, F.pmod(to_byte(F.col("v") / 255) * 8, F.lit(256)).alias("image"), F.pmod(to_byte(F.col("lab")) * 16, F.lit(256)).alias("mask"))


def frames(voxels: DataFrame) -> DataFrame:
    """(stack, z, image, mask): each slice's film bytes in row order, a frame for an animation writer."""
    row = F.struct("y", "x", "image", "mask")
    whole = video_scaled(voxels).groupBy(*SLICE).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return whole.select(*SLICE, F.col("rows.image").alias("image"), F.col("rows.mask").alias("mask"))


def cytoplasm(cell: DataFrame, nuclei: DataFrame) -> DataFrame:
    """Cell label slices without the pixels of any nucleus; a slice or a pixel that ``nuclei`` lacks has none."""
    inner = nuclei.select(*SLICE, F.col("pixels").alias("_inner"))
    joined = cell.join(inner, SLICE, "left")
    return joined.select(*SHAPE, F.zip_with("pixels", F.coalesce("_inner", "pixels"), lambda c, n: F.when(F.col("_inner").isNotNull() & (n > 0), F.lit(0.0)).otherwise(c)).alias("pixels"))


def channel_max(voxels: DataFrame, channels: list[str]) -> DataFrame:
    return voxels.select(*VOXEL, F.greatest(*channels).alias("v"))


def percent_maximal(voxels: DataFrame, value: str = "v") -> DataFrame:
    """Share of a slice's voxels at its maximum, 0 to 100: values are counted, then the largest is looked up."""
    counts = voxels.groupBy(*SLICE, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*SLICE).agg(F.round(100 * F.max_by("n", value) / F.sum("n"), 6).alias("percent_maximal"))
