"""Whole flows from images to masks and objects, each a chain of this library's operators on slice rows.

Labels are kept in the shared folder after a model has made them and where they are read more than once, as are the links and
paths of the operators; what comes before a model is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewise.functions import imagemath
from slicewise.operators import images, linking, masks, volume
from slicewise.sources.shared import stored

Segment = Callable[..., np.ndarray]


def _decoupled(labels: DataFrame, width: int) -> DataFrame:
    """Labels of windows given back to their slices, one label for each pixel; 0 where none wins."""
    found = masks.decoupled(volume.fan_out(labels, width))
    return found.withColumn("pixels", F.transform("pixels", lambda v: F.greatest(v, F.lit(0.0))))


def nuclei(slices: DataFrame, width: int = 3, scale: float = 1.0, segment: Segment = imagemath.watershed_segment) -> DataFrame:
    """Label slices of nuclei: equalised volumes, maxima of windows, objects stitched through them, windows decoupled.

    Slices for which no mask wins don't come.
    """
    model = images.MODELS["nuclei"]
    windows = images.sliding_max(images.equalised(slices, model["clip_limit"]), width)
    labels = stored(images.segmented(windows, model["diameter"] * scale, segment))
    return _decoupled(stored(images.stitched(labels, model["stitch"])), width)


def cells(slices: DataFrame, second: str, width: int = 3, scale: float = 1.0, segment: Segment = imagemath.watershed_segment) -> DataFrame:
    """Label slices of cells, seen with their nuclei in column ``second``: only the cells' channel is equalised, maxima of windows of
    both become red and blue bytes of one picture, each is segmented by itself, windows are decoupled."""
    model = images.MODELS["cell"]
    flat = images.sliding_max(images.equalised(slices, model["clip_limit"]), width)
    blue = images.sliding_max(slices.withColumn("pixels", F.col(second)), width)
    both = flat.join(blue.select("stack", "z", F.col("pixels").alias("_blue")), ["stack", "z"])
    picture = volume.rgb_composite(both, "pixels", "_blue").select(*images.SHAPE, *(F.col(c).cast("array<double>").alias(n) for c, n in (("r", "pixels"), ("b", "blue"))))
    return _decoupled(stored(images.segmented(picture, model["diameter"] * scale, segment, "blue")), width)


def organoids(slices: DataFrame, width: int = 3, scale: float = 1.0, segment: Segment = imagemath.watershed_segment) -> DataFrame:
    """Label slices of whole organoids: equalised volumes, blurred windows and their maxima, a low-pass over these, objects
    stitched, and for each slice the largest label of its windows."""
    model = images.MODELS["organoid"]
    smooth = images.low_pass(images.blurred_maximum(images.equalised(slices, model["clip_limit"]), width))
    labels = stored(images.segmented(smooth, model["diameter"] * scale, segment))
    return images.merged_windows(images.stitched(labels, model["stitch"]), width)


def objects(labels: DataFrame, radius: float = 10.0, first_object: int = 0) -> tuple[DataFrame, DataFrame]:
    """(label slices with one number for each object through z, the nodes of the objects): masks as bytes over
    the stack's range, centroids linked within ``radius``, longest paths numbered, and slices relabelled.

    Bytes leave labels of a stack apart if there are fewer than 256 of them.
    """
    scaled = stored(volume.rescaled_to_range(labels).withColumn("pixels", F.col("pixels").cast("array<double>")))
    found = stored(linking.centroids(scaled))
    numbers = linking.numbered(linking.longest(linking.paths(linking.edges(found, radius))), first_object)
    nodes = stored(linking.path_nodes(found, numbers))
    return linking.relabelled(scaled, nodes), nodes
