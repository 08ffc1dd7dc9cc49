"""The report on failed slices and organoids: by channel, by depth, by organoid, by treatment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicewise import schema
from slicewise.operators.quality_control import any_of


def long_flags(qc: DataFrame) -> DataFrame:
    """Keys, condition, channel, failed: a row for each slice and flag."""
    long = qc.unpivot(schema.ZSLICE, schema.FLAGS, "flag", "failed")
    name = F.split("flag", "_")
    return long.select(*schema.ZSLICE, name[0].alias("condition"), name[1].alias("channel"), "failed")


def failed_counts(qc: DataFrame, by: list[str] = ()) -> DataFrame:
    """Failed slices for each condition and channel (and ``by``); groups without any stay, with 0.

    The ten flags are summed before they are melted, so the shuffle carries one row for each group.
    """
    sums = qc.groupBy(*by).agg(*(F.count_if(F.col(f)).alias(f) for f in schema.FLAGS))
    ids = [F.col(b) for b in by]
    pairs = F.explode(F.array(*(F.struct(F.lit(f.split("_")[0]).alias("condition"), F.lit(f.split("_")[1]).alias("channel"), F.col(f).alias("failed_count")) for f in schema.FLAGS)))
    return sums.select(*ids, pairs.alias("p")).select(*ids, "p.condition", "p.channel", "p.failed_count")


def with_depth(qc: DataFrame) -> DataFrame:
    """``qc`` with depth: each slice's number within its organoid, from 0 to 1; null if it has only one.

    Depth is rounded to 6 places, as it serves as a group key.
    """
    organoid = Window.partitionBy(*schema.ORGANOID)
    n = F.try_to_number(F.replace("zslice", F.lit("ZS"), F.lit("")), F.lit("999"))
    low, high = F.min("_z").over(organoid), F.max("_z").over(organoid)
    return qc.withColumn("_z", n.cast("double")).withColumn("depth", F.round((F.col("_z") - low) / F.nullif(high - low, F.lit(0.0)), 6)).drop("_z")


def failed_slices(qc: DataFrame) -> DataFrame:
    return qc.where(any_of(schema.FLAGS))


def failed_per_organoid(qc: DataFrame) -> DataFrame:
    """Failed slices of each organoid that has any, and whether it is one or more."""
    counted = failed_slices(qc).groupBy(*schema.ORGANOID).agg(F.count("*").alias("failed_slices"))
    return counted.withColumn("class", F.when(F.col("failed_slices") == 1, "only 1 failed").otherwise("more than 1 failed"))


def with_treatment(organoids: DataFrame, platemap: DataFrame) -> DataFrame:
    """``organoids`` with treatment_dose of their well; a missing part is written NA, as a well not in
    the map is NA_NA, and a well mapped twice gives two rows.

    The platemap has one row for each well of a plate layout; Spark broadcasts it if it is small.
    """
    label = F.concat_ws("_", F.coalesce("treatment", F.lit("NA")), F.coalesce("dose", F.lit("NA")))
    return organoids.join(platemap.drop("wellrow", "wellcol"), F.col("well").eqNullSafe(F.col("well_position")), "left").withColumn("treatment_dose", label).drop("well_position", "treatment", "dose")


def treatment_failure(qc: DataFrame, platemap: DataFrame) -> DataFrame:
    """Failed organoids by plate and treatment, and their share of the plate's organoids.

    Slices are folded to one row for each organoid first; all that follows works on those.
    """
    organoids = qc.groupBy(*schema.ORGANOID).agg(F.bool_or(any_of(schema.FLAGS)).alias("failed"))
    totals = organoids.groupBy(F.col("plate").alias("_plate")).agg(F.count("*").alias("total_organoids"))
    failed = with_treatment(organoids.where("failed"), platemap).groupBy("plate", "treatment_dose").agg(F.count("*").alias("failed_organoids"))
    joined = failed.join(totals, F.col("plate").eqNullSafe(F.col("_plate")), "left").drop("_plate")
    return joined.withColumn("proportion_failed", F.round(F.col("failed_organoids") / F.col("total_organoids"), 6))


def failure_share(qc: DataFrame) -> DataFrame:
    """One row: organoids with a failed slice, all organoids, and the percentage."""
    organoids = qc.groupBy(*schema.ORGANOID).agg(F.bool_or(any_of(schema.FLAGS)).alias("failed"))
    share = organoids.agg(F.count_if("failed").alias("failed_organoids"), F.count("*").alias("total_organoids"))
    return share.withColumn("percent_failed", F.round(100 * F.try_divide("failed_organoids", "total_organoids"), 6))


def flag_share(qc: DataFrame, columns: list[str]) -> DataFrame:
    """One row: slices with any of the flags, all slices, and the percentage."""
    share = qc.agg(F.count_if(any_of(columns)).alias("flagged"), F.count("*").alias("total"))
    return share.withColumn("percent_flagged", F.round(100 * F.try_divide("flagged", "total"), 6))


def folder_inventory(folders: DataFrame) -> DataFrame:
    """(plate, well, site) from folder names: the text before a space, split at the hyphen; extra pieces
    are dropped, and missing or non-numeric ones are null. A site has any number of digits."""
    parts = F.split(F.split("folder", " ")[0], "-")
    return folders.select("plate", parts[0].alias("well"), F.get(parts, F.lit(1)).try_cast("int").alias("site"))


def missing_organoids(inventory: DataFrame, qc: DataFrame) -> DataFrame:
    """Folders without any measured slice."""
    seen = qc.select(*(F.col(k).alias(f"_{k}") for k in schema.ORGANOID)).distinct()
    return inventory.join(seen, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in schema.ORGANOID], "left_anti")
