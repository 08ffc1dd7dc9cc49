"""Quality control of z-slice images: outliers by z-score, flags for each slice, merged and counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicewise import schema


def select_prefixes(df: DataFrame, *prefixes: str) -> DataFrame:
    """The columns whose names begin with one of the prefixes, so that the scan reads no others."""
    return df.select(*(c for c in df.columns if c.startswith(prefixes)))


def z_scores(df: DataFrame, features: list[str], deviation=F.stddev_pop) -> DataFrame:
    """``df`` with ``z_<feature>`` over all rows; nulls stay out, and a feature that doesn't vary has null.

    All features take one aggregation; its single row is broadcast.
    """
    stats = df.agg(*(F.avg(f).alias(f"_m_{f}") for f in features), *(deviation(f).alias(f"_s_{f}") for f in features))
    scored = df.crossJoin(F.broadcast(stats))
    for f in features:
        scored = scored.withColumn(f"z_{f}", (F.col(f) - F.col(f"_m_{f}")) / F.nullif(F.col(f"_s_{f}"), F.lit(0.0)))
    return scored.drop(*stats.columns)


def beyond(feature: str, threshold: float) -> Column:
    """A negative threshold marks z-scores below it, a positive one those above."""
    z = F.col(f"z_{feature}")
    return z < threshold if threshold < 0 else z > threshold


def outliers(df: DataFrame, feature: str, threshold: float) -> DataFrame:
    """The rows beyond the threshold, with their z-score."""
    return z_scores(df, [feature]).where(beyond(feature, threshold))


def flags(df: DataFrame, limits: dict[str, tuple[str, float]], keys: list[str] = schema.ZSLICE) -> DataFrame:
    """A row for each key with one boolean for each name in ``limits`` {name: (feature, threshold)}.

    A key is flagged if any of its rows is an outlier; null keys are keys like others. One pass for the
    statistics and one aggregation with map-side maxima, whatever the number of features.
    """
    scored = z_scores(df, sorted({f for f, _ in limits.values()}))
    return scored.groupBy(*keys).agg(*(F.coalesce(F.bool_or(beyond(f, t)), F.lit(False)).alias(n) for n, (f, t) in limits.items()))


def blur_flags(df: DataFrame) -> DataFrame:
    return flags(df, {f"blurry_{c}": (f"slope_{c}", t) for c, t in schema.BLUR.items()})


def saturation_flags(df: DataFrame) -> DataFrame:
    return flags(df, {f"saturated_{c}": (f"pctmax_{c}", t) for c, t in schema.SATURATION.items()})


def merged_flags(df: DataFrame) -> DataFrame:
    """Blur and saturation flags of each slice; both come from one aggregation of the same rows."""
    return flags(df, {f"blurry_{c}": (f"slope_{c}", t) for c, t in schema.BLUR.items()} | {f"saturated_{c}": (f"pctmax_{c}", t) for c, t in schema.SATURATION.items()})


def merge(blur: DataFrame, saturation: DataFrame, keys: list[str] = schema.ZSLICE) -> DataFrame:
    """Left join of two flag tables on keys that may be null."""
    right = saturation.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in saturation.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return blur.join(right, on, "left").drop(*(f"_{k}" for k in keys))


def any_of(columns: list[str]) -> Column:
    """True if any is; nulls count as false."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.col(c), F.lit(False))
    return out


def outlier_union(df: DataFrame, limits: dict[str, tuple[str, float]], keys: list[str] = schema.ZSLICE) -> DataFrame:
    """All outliers of all features in one table, tagged by ``channel``: one scan, rows multiplied by hits."""
    scored = z_scores(df, sorted({f for f, _ in limits.values()}))
    tags = F.array_compact(F.array(*(F.when(beyond(f, t), F.lit(n)) for n, (f, t) in limits.items())))
    return scored.select(*keys, F.explode(tags).alias("channel"))


def fill_metadata(df: DataFrame, source: str, marker: str, values: dict) -> DataFrame:
    """Nulls of the named columns get their values where ``source`` contains ``marker``."""
    here = F.col(source).contains(marker)
    for c, v in values.items():
        df = df.withColumn(c, F.when(here, F.coalesce(F.col(c), F.lit(v))).otherwise(F.col(c)))
    return df


def slices_of_organoid(df: DataFrame, keys: list[str] = schema.ORGANOID) -> DataFrame:
    """``df`` with n_slices, its organoid's rows; null where a key is null."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return df.withColumn("n_slices", F.when(whole, F.count(keys[-1]).over(Window.partitionBy(*keys))))


def one_of_each(df: DataFrame, keys: list[str], by: list[str], seed: int = 0) -> DataFrame:
    """One row of each group, the same at every run: the least by a hash of ``by`` and the seed.

    A minimum with map-side combine, so a hot group is one row for each task before the shuffle.
    """
    rank = F.struct(((F.col(by[0]) * 7919 + seed) % 10007).alias("_r"), *(F.col(c) for c in by), *(F.col(c) for c in df.columns if c not in by))
    least = df.groupBy(*keys).agg(F.min(rank).alias("_row"))
    return least.select(*(F.col(f"_row.{c}").alias(c) if c not in keys else F.col(c) for c in df.columns))


def melted(df: DataFrame, values: dict[str, str], name: str, value: str, ids: list[str]) -> DataFrame:
    """Wide to long: a row for each column of ``values`` {column: label}; null values are dropped."""
    long = df.select(*ids, *(F.col(c).alias(label) for c, label in values.items())).unpivot(ids, list(values.values()), name, value)
    return long.where(F.col(value).isNotNull())


def histogram(df: DataFrame, value: str, by: list[str], width: float) -> DataFrame:
    """Counts of ``value`` in bins of ``width`` for each group."""
    return df.groupBy(*by, F.floor(F.col(value) / width).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def density(df: DataFrame, value: str, by: list[str], points: int = 50, bins: int = 2000) -> DataFrame:
    """Gaussian kernel density of each group at ``points`` places between its extremes, Scott's bandwidth.

    Values are first counted in ``bins`` bins of the group's range, so a group costs points times bins
    kernels however many rows it has.
    """
    stats = df.where(F.col(value).isNotNull()).groupBy(*by).agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.stddev_samp(value).alias("sd"), F.count("*").alias("total"))
    stats = stats.where("total > 1 and sd > 0").withColumn("h", F.col("sd") * F.pow("total", F.lit(-0.2))).select(*(F.col(b).alias(f"_{b}") for b in by), "lo", "hi", "h", "total")
    on = [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by]
    step = (F.col("hi") - F.col("lo")) / bins
    counted = df.join(stats, on).groupBy(*by, "lo", "hi", "h", "total", F.floor((F.col(value) - F.col("lo")) / step).alias("bin")).agg(F.count("*").alias("n"))
    grid = counted.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("at", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("k") / (points - 1))
    u = (F.col("at") - (F.col("lo") + (F.col("bin") + 0.5) * step)) / F.col("h")
    return grid.groupBy(*by, "k", "at").agg(F.sum(F.col("n") * F.exp(-u * u / 2) / (F.col("total") * F.col("h") * F.sqrt(F.lit(6.283185307179586)))).alias("density"))


def diagnostics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_rows, n_columns, n_missing, n_values, least, most): a row for each of ``columns``, as text; one pass.

    ``n_values`` counts distinct values.
    """
    found = [F.struct(F.lit(c).alias("column"), F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), F.count_if(F.col(c).isNull()).alias("n_missing"),
                      F.count_distinct(c).alias("n_values"), F.min(c).cast("string").alias("least"), F.max(c).cast("string").alias("most")).alias(f"_{i}") for i, c in enumerate(columns)]
    return df.agg(*found).select(F.explode(F.array(*(f"_{i}" for i in range(len(columns))))).alias("d")).select("d.*")


def nan_detect(df: DataFrame, by: str, keys: list[str] = schema.ORGANOID) -> DataFrame:
    """Whether any of the key columns has a null, for each value of ``by``."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(by).agg(F.bool_or(missing).alias("has_nan"))


def full_path(folder: Column | str, file: Column | str) -> Column:
    """Folder and file name; null if either is."""
    return F.concat(folder, F.lit("/"), file)


def title(n: Column | str = "n_slices") -> Column:
    """The title of an example image; null if a part is."""
    return F.concat("plate", F.lit("_"), "well", F.lit("-"), F.col("site").cast("int").cast("string"), F.lit("_"), "zslice", F.lit(" (Total z-slices: "), F.col(n).cast("string"), F.lit(")"))
