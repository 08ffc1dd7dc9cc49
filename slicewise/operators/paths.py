"""Relations over image paths: parsing, channels, order in a stack, copies, counts of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewise import schema


def extracted(path: Column, pattern: str, group: int) -> Column:
    """The group of the first match, null without one."""
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def parse(paths: DataFrame) -> DataFrame:
    """``paths`` with plate, well, site, channel text and zslice; null where the path doesn't have them."""
    p = F.col("path")
    return paths.select(
        "*", extracted(p, schema.FOLDER, 1).alias("plate"), extracted(p, schema.FOLDER, 2).alias("well"), extracted(p, schema.FOLDER, 3).cast("int").alias("site"),
        extracted(p, schema.FILE, 1).alias("channel_text"), extracted(p, schema.FILE, 2).alias("zslice"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def directory(path: Column, up: int = 1) -> Column:
    return F.element_at(F.split(path, "/"), -1 - up)


def images(paths: DataFrame, any_case: bool = True) -> DataFrame:
    """Paths that end in .tif or .tiff, in any case or in lower case only."""
    p = F.lower("path") if any_case else F.col("path")
    return paths.where(p.endswith(".tif") | p.endswith(".tiff"))


def unmerged(paths: DataFrame) -> DataFrame:
    return paths.where(~file_name(F.col("path")).contains("Merge"))


def channel(text: Column) -> Column:
    """The channel whose text is found first, in the fixed order; null without any."""
    out = F
    for mark, name in schema.CHANNEL_TEXT.items():
        out = out.when(text.contains(mark), name)
    return out


def flattened(paths: DataFrame, root: str) -> DataFrame:
    """(folder, file, path): the images of a nested acquisition below ``root``, dealt to folders by name.

    Every folder two levels or more below the root gets each image that lies two levels or more below it;
    extensions count in any case. The last path wins where names collide.
    """
    parts = F.split(F.substr("path", F.lit(len(root) + 2)), "/")
    below = images(paths.where(F.startswith("path", F.lit(root + "/")))).select("path", parts.alias("_parts"))
    folders = below.where(F.size("_parts") >= 4).select("path", F.explode(F.slice("_parts", 2, F.size("_parts") - 3)).alias("folder"))
    return folders.groupBy("folder", file_name(F.col("path")).alias("file")).agg(F.max("path").alias("path"))


def stack_order(paths: DataFrame) -> DataFrame:
    """Files in z order: their rank by path within folder and channel, from 0; files of no channel are out.

    Folder and channel follow from the path, so paths alone are made distinct; whether a file has any channel is one search.
    """
    marked = file_name(F.col("path")).rlike("|".join(schema.CHANNEL_TEXT))
    files = paths.select("path").where(marked).distinct()
    at = files.select(directory(F.col("path")).alias("folder"), channel(file_name(F.col("path"))).alias("channel"), "path")
    return at.withColumn("z", (F.row_number().over(Window.partitionBy("folder", "channel").orderBy("path")) - 1).cast("int"))


def last_of_channel(paths: DataFrame) -> DataFrame:
    """For each folder and channel the file that comes last by path."""
    at = paths.select(directory(F.col("path")).alias("folder"), channel(F.col("path")).alias("channel"), "path").where("channel is not null")
    return at.groupBy("folder", "channel").agg(F.max("path").alias("path"))


def aligned_channels(order: DataFrame, channels: list[str]) -> DataFrame:
    """Image sets by order: the files of equal rank in each channel of a folder, side by side."""
    picks = [F.max(F.when(F.col("channel") == c, F.col("path"))).alias(c.lower()) for c in channels]
    return order.groupBy("folder", "z").agg(*picks)


def without_bad_slice(paths: DataFrame, folder: str, slice_text: str) -> DataFrame:
    """Paths but those of one slice of one folder; no file is deleted."""
    return paths.where(~((directory(F.col("path")) == folder) & file_name(F.col("path")).contains(slice_text)))


def file_counts(paths: DataFrame, expected: int) -> DataFrame:
    """Files of each folder, and whether they are as many as expected."""
    return paths.groupBy(directory(F.col("path")).alias("folder")).agg(F.count("*").alias("n_files")).withColumn("complete", F.col("n_files") == expected)


def copy_manifest(trees: DataFrame, raw: DataFrame, there: DataFrame, root: str, overwrite: bool = True) -> DataFrame:
    """(source, destination, action): what fills ``root`` with a folder for each well.

    A well's files in ``trees`` (path) go there as a whole: ``copy`` if ``there`` (folder) doesn't have the
    well yet, else ``replace``, or ``skip`` without ``overwrite``. The images of ``raw`` (path; only
    lower-case extensions) go to the folder of the same name, if one is there by then: ``add``. A null path is no file.
    """
    at = lambda df: df.select(F.col("path").alias("source"), directory(F.col("path")).alias("folder"), file_name(F.col("path")).alias("file")).distinct()
    known = there.select("folder", F.lit(True).alias("_there")).distinct()
    whole = at(trees).join(known, "folder", "left").withColumn("action", F.when(F.col("_there"), F.lit("replace" if overwrite else "skip")).otherwise("copy"))
    wells = whole.select("folder").union(known.select("folder")).distinct()
    added = at(images(raw, any_case=False)).join(wells, "folder", "left_semi").withColumn("action", F.lit("add"))
    both = whole.drop("_there").unionByName(added)
    return both.select("source", F.concat(F.lit(root), F.lit("/"), "folder", F.lit("/"), "file").alias("destination"), "action")


# Files of the compartments: text in the name of the image that shows one, its mask and its sliding windows. Fixed values.
SHOWN_IN = {"nuclei": "405", "cell": "555", "cytoplasm": "555"}
MASKS = {"nuclei": ("nuclei_masks.tiff", "nuclei_reconstruction_dict.npy"), "cell": ("cell_masks.tiff", "cell_reconstruction_dict.npy")}


def decoupling_files(folders: DataFrame, compartment: str) -> DataFrame:
    """(folder, mask, windows): the files that the decoupling of a compartment reads and writes in each folder."""
    if compartment not in MASKS:
        raise ValueError(f"compartment must be one of {tuple(MASKS)}, not {compartment!r}")
    mask, windows = (F.concat("folder", F.lit(f"/{name}")) for name in MASKS[compartment])
    return folders.select("folder", mask.alias("mask"), windows.alias("windows")).distinct()


def video_files(paths: DataFrame, compartment: str) -> DataFrame:
    """(folder, image, mask): of each folder the last image and the last mask, by path, of a compartment's film."""
    if compartment not in SHOWN_IN:
        raise ValueError(f"compartment must be one of {tuple(SHOWN_IN)}, not {compartment!r}")
    name = file_name(F.col("path"))
    image = F.max(F.when(name.contains(SHOWN_IN[compartment]), F.col("path")))
    mask = F.max(F.when(name.contains(compartment) & name.contains("mask"), F.col("path")))
    return paths.groupBy(directory(F.col("path")).alias("folder")).agg(image.alias("image"), mask.alias("mask"))


def plate_jobs(paths: DataFrame) -> DataFrame:
    """One job for each plate: its name, first image folder and result folder."""
    plate = extracted(F.col("path"), schema.FOLDER, 1)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return paths.select(plate.alias("plate"), folder.alias("folder")).where("plate is not null").groupBy("plate").agg(F.min("folder").alias("images")).withColumn("results", F.concat("plate", F.lit("_qc_results")))
