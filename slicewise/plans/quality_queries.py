"""Quality-control and report queries: {name: (Spark query, DuckDB SQL or None)}."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicewise import schema
from slicewise.operators import quality_control as qc
from slicewise.operators import report
from slicewise.plans import sql
from slicewise.sources import files
from slicewise.sources import tables as t

BLURRY, SATURATED = schema.FLAGS[:5], schema.FLAGS[5:]
KEYS = "plate, well, site, zslice"
#: Wells of a plate, all in the platemap (a well that it lacks shows as NA_NA).
WELLS = 50


SATURATION = {c: (f"pctmax_{c}", th) for c, th in schema.SATURATION.items()}


def flags_of(spark, d):
    return qc.merged_flags(t.zslice_qc(spark, d))


def outlier_query(feature, threshold):
    return lambda spark, d: qc.outliers(t.zslice_qc(spark, d), feature, threshold).select("event_id", *schema.ZSLICE, F.col(feature).alias("value"), F.round(f"z_{feature}", 6).alias("z"))


def outlier_sql(feature, flag):
    return f"with {sql.BASE} select event_id, {KEYS}, {feature} as value, round(z_{feature}, 6) as z from rated where {sql.TEST[flag]}"


QUERIES = {
    "blur_flags": (lambda s, d: qc.blur_flags(t.zslice_qc(s, d)), f"with {sql.BASE} select {KEYS}, {', '.join(BLURRY)} from qc"),
    "sat_flags": (lambda s, d: qc.saturation_flags(t.zslice_qc(s, d)), f"with {sql.BASE} select {KEYS}, {', '.join(SATURATED)} from qc"),
    "qc_merge": (lambda s, d: flags_of(s, d), f"with {sql.BASE} select * from qc"),
    "treatment_failure": (
        lambda s, d: report.treatment_failure(flags_of(s, d), t.platemap(s, d, WELLS)),
        f"with {sql.BASE}, {sql.platemap(WELLS)}, organoids as (select plate, well, site, bool_or{sql.ANY} failed from qc group by all), "
        "totals as (select plate, count(*) total_organoids from organoids group by all), "
        "failed as (select plate, coalesce(treatment, 'NA') || '_' || coalesce(dose, 'NA') treatment_dose, count(*) failed_organoids from organoids left join platemap on well = well_position where failed group by all) "
        "select failed.*, total_organoids, round(failed_organoids / total_organoids, 6) as proportion_failed from failed left join totals using (plate)"),
    **{f"blur_outliers_{c}": (outlier_query(f"slope_{c}", th), outlier_sql(f"slope_{c}", f"blurry_{c}")) for c, th in schema.BLUR.items()},
    **{f"sat_outliers_{c}": (outlier_query(f"pctmax_{c}", th), outlier_sql(f"pctmax_{c}", f"saturated_{c}")) for c, th in schema.SATURATION.items()},
    "outlier_union": (
        lambda s, d: qc.outlier_union(t.zslice_qc(s, d), {c: (f"slope_{c}", th) for c, th in schema.BLUR.items()}),
        f"with {sql.BASE} " + " union all ".join(f"select {KEYS}, '{c}' as channel from rated where {sql.TEST[f'blurry_{c}']}" for c in schema.BLUR)),
    "outlier_groups": (
        lambda s, d: qc.outlier_union(t.zslice_qc(s, d), {c: (f"slope_{c}", th) for c, th in schema.BLUR.items()})
        .where("plate is not null and well is not null and site is not null").groupBy("channel").agg(F.count_distinct("plate", "well", "site").alias("n_groups")),
        f"with {sql.BASE}, u as (" + " union all ".join(f"select plate, well, site, '{c}' channel from rated where {sql.TEST[f'blurry_{c}']}" for c in schema.BLUR)
        + ") select channel, count(distinct (plate, well, site)) as n_groups from u group by channel"),
    "sat_outlier_union": (
        lambda s, d: qc.outlier_union(t.zslice_qc(s, d), SATURATION),
        f"with {sql.BASE} " + " union all ".join(f"select {KEYS}, '{c}' as channel from rated where {sql.TEST[f'saturated_{c}']}" for c in schema.SATURATION)),
    "sat_outlier_groups": (
        lambda s, d: qc.outlier_union(t.zslice_qc(s, d), SATURATION)
        .where("plate is not null and well is not null and site is not null").groupBy("channel").agg(F.count_distinct("plate", "well", "site").alias("n_groups")),
        f"with {sql.BASE}, u as (" + " union all ".join(f"select plate, well, site, '{c}' channel from rated where {sql.TEST[f'saturated_{c}']}" for c in schema.SATURATION)
        + ") select channel, count(distinct (plate, well, site)) as n_groups from u group by channel"),
    "sat_sample_per_group": (
        lambda s, d: qc.one_of_each(qc.outliers(t.zslice_qc(s, d), "pctmax_er", 2.0).select("event_id", *schema.ZSLICE), schema.ORGANOID, ["event_id"], seed=1),
        f"with {sql.BASE} select event_id, {KEYS} from rated where {sql.TEST['saturated_er']} "
        "qualify row_number() over (partition by plate, well, site order by (event_id * 7919 + 1) % 10007, "
        "event_id) = 1"),
    "diagnostics": (
        lambda s, d: qc.diagnostics(t.zslice_qc(s, d).select(*schema.ZSLICE), schema.ZSLICE),
        f"with {sql.ZSLICE_QC} " + " union all ".join(
            f"select '{c}' as \"column\", count(*) as n_rows, 4 as n_columns, count(*) filter ({c} is null) as n_missing, count(distinct {c}) as n_values, "
            f"cast(min({c}) as varchar) as least, cast(max({c}) as varchar) as most from zslice_qc" for c in schema.ZSLICE)),
    "distinct_organoids": (lambda s, d: t.zslice_qc(s, d).select(*schema.ORGANOID).distinct(), f"with {sql.ZSLICE_QC} select distinct plate, well, site from zslice_qc"),
    "qc_scan_prune": (lambda s, d: qc.select_prefixes(t.zslice_qc(s, d), "plate", "well", "site", "zslice", "slope"), f"with {sql.ZSLICE_QC} select {KEYS}, {', '.join(f'slope_{c}' for c in schema.CHANNELS)} from zslice_qc"),
    "qc_csv_scan": (
        lambda s, d: _ragged(s, t.zslice_qc(s, d)).withColumn("plate", F.coalesce("plate", F.col("source"))),
        f"with {sql.ZSLICE_QC} select event_id, {KEYS}, " + ", ".join(f"case when plate = 'NF0018' and '{c}' = 'mito' then null else slope_{c} end as slope_{c}" for c in schema.CHANNELS) + ", plate as source from zslice_qc"),
    "qc_self_overwrite": (lambda s, d: _overwritten(s, qc.blur_flags(t.zslice_qc(s, d)), qc.saturation_flags(t.zslice_qc(s, d))), f"with {sql.BASE} select * from qc"),
    "plate_union": (
        lambda s, d: _plate_union(t.zslice_qc(s, d)),
        f"with {sql.ZSLICE_QC} select event_id, plate, slope_dna, case "
        "when plate = 'NF0014' then null else slope_mito end as slope_mito from zslice_qc"),
    "fill_metadata": (
        lambda s, d: qc.fill_metadata(_blanked(t.zslice_qc(s, d)), "source", "NF0018_qc_results", {"plate": "NF0018", "well": "E5", "site": 3}).select("event_id", *schema.ZSLICE),
        f"with {sql.ZSLICE_QC}, b as (select event_id, plate = 'NF0018' and event_id % 97 = 0 gone, plate, well, site, zslice, plate || '_qc_results' source from zslice_qc) "
        "select event_id, case when gone then 'NF0018' else plate end as plate, case when gone then 'E5' else well end as well, case when gone then 3 else site end as site, zslice from b"),
    "nan_detect": (
        lambda s, d: qc.nan_detect(_blanked(t.zslice_qc(s, d)), "source").withColumnRenamed("has_nan", "any_missing"),
        f"with {sql.ZSLICE_QC} select plate || '_qc_results' as source, bool_or(plate = 'NF0018' "
        "and event_id % 97 = 0) as any_missing from zslice_qc group by all"),
    "na_counts": (
        lambda s, d: _blanked(t.zslice_qc(s, d)).agg(*(F.count_if(F.col(k).isNull()).alias(k) for k in schema.ZSLICE)).unpivot([], schema.ZSLICE, "column", "n_missing"),
        f"with {sql.ZSLICE_QC}, n as (select count(*) filter (plate = 'NF0018' and event_id % 97 = 0) k from zslice_qc) "
        "select unnest(['plate', 'well', 'site', 'zslice']) as \"column\", unnest([k, k, k, 0]) as n_missing from n"),
    "zslice_total": (
        lambda s, d: qc.slices_of_organoid(_blanked(t.zslice_qc(s, d))).select("event_id", "n_slices"),
        f"with {sql.ZSLICE_QC}, b as (select *, plate = 'NF0018' and event_id % 97 = 0 gone from zslice_qc), n as (select plate, well, site, count(*) k from b where not gone group by all) "
        "select event_id, case when gone then null else k end as n_slices from b left join n using (plate, well, site)"),
    "full_path": (
        lambda s, d: _blanked(t.zslice_qc(s, d)).select("event_id", qc.full_path(F.concat("plate", F.lit("_raw_images")), F.concat("well", F.lit("_"), "zslice", F.lit(".tif"))).alias("full_path")),
        f"with {sql.ZSLICE_QC} select event_id, case when plate = 'NF0018' "
        "and event_id % 97 = 0 then null else plate || '_raw_images/' "
        "|| well || '_' || zslice || '.tif' end as full_path from zslice_qc"),
    "title_format": (
        lambda s, d: qc.slices_of_organoid(t.zslice_qc(s, d)).select("event_id", qc.title().alias("title")),
        f"with {sql.ZSLICE_QC} select event_id, "
        "plate || '_' || well || '-' || site || '_' || zslice || ' (Total z-slices: "
        "' || count(*) over (partition by plate, well, site) || ')' as title from zslice_qc"),
    "blur_melt": (
        lambda s, d: qc.melted(t.zslice_qc(s, d), {f"slope_{c}": c for c in schema.CHANNELS}, "channel", "slope", ["event_id", *schema.ZSLICE]),
        f"with {sql.ZSLICE_QC} " + " union all ".join(f"select event_id, {KEYS}, '{c}' as channel, slope_{c} as slope from zslice_qc where slope_{c} is not null" for c in schema.CHANNELS)),
    "blur_hist": (
        lambda s, d: qc.histogram(qc.melted(t.zslice_qc(s, d), {f"slope_{c}": c for c in schema.CHANNELS}, "channel", "slope", ["plate"]), "slope", ["plate", "channel"], 25.0),
        f"with {sql.ZSLICE_QC}, m as (" + " union all ".join(f"select plate, '{c}' channel, slope_{c} slope from zslice_qc" for c in schema.CHANNELS)
        + ") select plate, channel, cast(floor(slope / 25.0) as bigint) as bin, count(*) as n from m where slope is not null group by all"),
    "blur_kde": (
        lambda s, d: qc.density(qc.melted(t.zslice_qc(s, d), {f"slope_{c}": c for c in schema.CHANNELS}, "channel", "slope", ["plate"]), "slope", ["plate", "channel"])
        .select("plate", "channel", "k", F.round("at", 6).alias("at"), F.round("density", 8).alias("density")),
        f"with {sql.ZSLICE_QC}, m as (" + " union all ".join(f"select plate, '{c}' channel, slope_{c} slope from zslice_qc where slope_{c} is not null" for c in schema.CHANNELS)
        + "), s as (select plate, channel, min(slope) lo, max(slope) hi, stddev_samp(slope) sd, count(*) total from m group by all having count(*) > 1 and stddev_samp(slope) > 0), "
        "b as (select m.plate, m.channel, lo, hi, sd * pow(total, -0.2) h, total, (hi - lo) / 2000 step, floor((slope - lo) / ((hi - lo) / 2000)) bin, count(*) n from m join s on m.plate = s.plate and m.channel = s.channel group by all), "
        "g as (select *, lo + (hi - lo) * k / 49 as \"at\" from b, (select cast(unnest(range(50)) as int) k)) "
        "select plate, channel, k, round(\"at\", 6) as \"at\", round(sum(n * exp(-pow((\"at\" - (lo + (bin + 0.5) * step)) / h, 2) / 2) / (total * h * sqrt(6.283185307179586))), 8) as density from g group by plate, channel, k, \"at\""),
    "sample_per_group": (
        lambda s, d: qc.one_of_each(qc.outliers(t.zslice_qc(s, d), "slope_dna", -2.0).select("event_id", *schema.ZSLICE), schema.ORGANOID, ["event_id"], seed=1),
        f"with {sql.BASE} select event_id, {KEYS} from rated where {sql.TEST['blurry_dna']} "
        "qualify row_number() over (partition by plate, well, site order by (event_id * 7919 + 1) % 10007, "
        "event_id) = 1"),
    "sample_three": (
        lambda s, d: qc.outliers(t.zslice_qc(s, d), "slope_er", -2.0).select("event_id", *schema.ZSLICE).orderBy(F.expr("(event_id * 7919 + 1) % 10007"), "event_id").limit(3),
        f"with {sql.BASE} select event_id, {KEYS} from rated where {sql.TEST['blurry_er']} "
        "order by (event_id * 7919 + 1) % 10007, event_id limit 3"),
    "mito_sorted": (
        lambda s, d: qc.outliers(t.zslice_qc(s, d), "slope_mito", -3.0).select("event_id", *schema.ZSLICE, "slope_mito").orderBy("slope_mito", "event_id"),
        f"with {sql.BASE} select event_id, {KEYS}, slope_mito from rated where {sql.TEST['blurry_mito']} order by slope_mito, event_id"),
    "top3": (
        lambda s, d: qc.outliers(t.zslice_qc(s, d), "slope_mito", -3.0).select("event_id", *schema.ZSLICE, "slope_mito").orderBy("slope_mito", "event_id").limit(3),
        f"with {sql.BASE} select event_id, {KEYS}, slope_mito from rated where {sql.TEST['blurry_mito']} "
        "order by slope_mito, event_id limit 3"),
    "blur_percent": (lambda s, d: report.flag_share(flags_of(s, d), BLURRY),
        f"with {sql.BASE} select count(*) filter ({' or '.join(BLURRY)}) as flagged, count(*) as total, "
        f"round(100 * count(*) filter ({' or '.join(BLURRY)}) / count(*), 6) as percent_flagged from qc"),
    "sat_percent": (lambda s, d: report.flag_share(flags_of(s, d), SATURATED),
        f"with {sql.BASE} select count(*) filter ({' or '.join(SATURATED)}) as flagged, count(*) as total, "
        f"round(100 * count(*) filter ({' or '.join(SATURATED)}) / count(*), 6) as percent_flagged from qc"),
    "qc_melt": (lambda s, d: report.long_flags(flags_of(s, d)), f"with {sql.BASE}, {sql.LONG} select * from long"),
    "failed_counts": (lambda s, d: report.failed_counts(flags_of(s, d)),
        f"with {sql.BASE}, {sql.LONG} select condition, channel, count(*) filter (failed) as failed_count from long "
        "group by all"),
    "failed_by_z": (lambda s, d: report.failed_counts(flags_of(s, d), ["zslice"]),
        f"with {sql.BASE}, {sql.LONG} select zslice, condition, channel, count(*) filter (failed) as failed_count "
        "from long group by all"),
    "max_failed": (
        lambda s, d: report.failed_counts(flags_of(s, d), ["zslice"]).agg(F.max("failed_count").alias("max_failed")),
        f"with {sql.BASE}, {sql.LONG}, c as (select zslice, condition, channel, count(*) filter (failed) n from long "
        "group by all) select max(n) as max_failed from c"),
    "norm_zslice": (
        lambda s, d: report.with_depth(flags_of(s, d)).select(*schema.ZSLICE, "depth"),
        f"with {sql.BASE}, n as (select {KEYS}, cast(replace(zslice, 'ZS', '') as double) k from qc) select {KEYS}, "
        "round((k - min(k) over w) / nullif(max(k) over w - min(k) over w, 0), 6) as depth from n window w as (partition by plate, well, site)"),
    "norm_failed_by_z": (
        lambda s, d: report.failed_counts(report.with_depth(flags_of(s, d)), ["depth", "plate"]),
        f"with {sql.BASE}, {sql.LONG}, n as (select {KEYS}, cast(replace(zslice, 'ZS', '') as double) k from qc), "
        "m as (select plate, well, site, zslice, round((k - min(k) over w) / nullif(max(k) over w - min(k) over w, 0), 6) depth from n window w as (partition by plate, well, site)) "
        "select depth, plate, condition, channel, count(*) filter (failed) as failed_count from long join m using (plate, well, site, zslice) group by all"),
    "failed_zslices": (lambda s, d: report.failed_slices(flags_of(s, d)), f"with {sql.BASE} select * from qc where {sql.ANY}"),
    "failed_per_organoid": (
        lambda s, d: report.failed_per_organoid(flags_of(s, d)).drop("class"),
        f"with {sql.BASE} select plate, well, site, count(*) as failed_slices from qc where {sql.ANY} group by all"),
    "failure_class": (
        lambda s, d: report.failed_per_organoid(flags_of(s, d)),
        f"with {sql.BASE} select plate, well, site, count(*) as failed_slices, case "
        f"when count(*) = 1 then 'only 1 failed' else 'more than 1 failed' end as class from qc where {sql.ANY} "
        "group by all"),
    "fail_percent": (
        lambda s, d: report.failure_share(flags_of(s, d)),
        f"with {sql.BASE}, o as (select plate, well, site, bool_or{sql.ANY} failed from qc group by all) "
        "select count(*) filter (failed) as failed_organoids, count(*) as total_organoids, round(100 * count(*) filter (failed) / count(*), 6) as percent_failed from o"),
    "treatment_dose": (
        lambda s, d: report.with_treatment(report.failed_per_organoid(flags_of(s, d)), t.platemap(s, d, WELLS)),
        f"with {sql.BASE}, {sql.platemap(WELLS)}, f as (select plate, well, site, count(*) failed_slices, case when count(*) = 1 then 'only 1 failed' else 'more than 1 failed' end as class from qc where {sql.ANY} group by all) "
        "select f.*, coalesce(treatment, 'NA') || '_' || coalesce(dose, 'NA') as treatment_dose from f left join platemap on well = well_position"),
    "bar_treatment_class": (
        lambda s, d: report.with_treatment(report.failed_per_organoid(flags_of(s, d)), t.platemap(s, d, WELLS)).groupBy("treatment_dose", "class").agg(F.count("*").alias("n")),
        f"with {sql.BASE}, {sql.platemap(WELLS)}, f as (select plate, well, site, case when count(*) = 1 then 'only 1 failed' else 'more than 1 failed' end as class from qc where {sql.ANY} group by all) "
        "select coalesce(treatment, 'NA') || '_' || coalesce(dose, 'NA') as treatment_dose, class, count(*) as n from f left join platemap on well = well_position group by all"),
    "platemap_scan": (lambda s, d: t.platemap(s, d).drop("wellrow", "wellcol"), f"with {sql.platemap(50)} select well_position, treatment, dose from platemap"),
    "folder_inventory": (lambda s, d: report.folder_inventory(t.folders(s, d)), f"with {sql.ZSLICE_QC}, {sql.FOLDERS}, {sql.INVENTORY} select * from inventory"),
    "missing_organoids": (
        lambda s, d: report.missing_organoids(report.folder_inventory(t.folders(s, d)), t.zslice_qc(s, d)),
        f"with {sql.ZSLICE_QC}, {sql.FOLDERS}, {sql.INVENTORY} select * from inventory i where not exists (select 1 "
        "from zslice_qc q where q.plate = i.plate and q.well = i.well and q.site = i.site)"),
    "missing_per_plate": (
        lambda s, d: report.missing_organoids(report.folder_inventory(t.folders(s, d)), t.zslice_qc(s, d)).groupBy("plate").agg(F.count("*").alias("n_missing")),
        f"with {sql.ZSLICE_QC}, {sql.FOLDERS}, {sql.INVENTORY} select plate, count(*) as n_missing from inventory i "
        "where not exists (select 1 from zslice_qc q where q.plate = i.plate and q.well = i.well and q.site = i.site) "
        "group by plate"),
}


def _blanked(df):
    """Measurements of one plate's results with some keys missing, and the folder that they come from."""
    gone = F.expr("plate = 'NF0018' and event_id % 97 = 0")
    source = F.concat("plate", F.lit("_qc_results")).alias("source")
    others = [c for c in df.columns if c not in schema.ORGANOID]
    return df.select(*(F.when(~gone, F.col(k)).alias(k) for k in schema.ORGANOID), *others, source)


def _plate_union(df):
    """Plates as separate tables, one without a channel's column, put together by name."""
    first = df.where("plate = 'NF0014'").select("event_id", "plate", "slope_dna")
    return first.unionByName(df.where("plate <> 'NF0014'").select("event_id", "plate", "slope_dna", "slope_mito"), allowMissingColumns=True)


def _ragged(spark, df):
    """Plates as CSV files of three kinds, read in one call: one has columns more, in another order, another lacks two."""
    root, wide = files.scratch(spark), df.select("event_id", *schema.ZSLICE, *(f"{p}_{c}" for c in schema.CHANNELS for p in ("slope", "pctmax")))
    kinds = {
        "NF0014": wide.where("plate = 'NF0014'"),
        "NF0016": wide.where("plate = 'NF0016'").select(*(wide.columns[::-1]), F.lit(7).alias("count_objects"), F.lit("a, b").alias("remark")),
        "NF0018": wide.where("plate = 'NF0018'").drop("plate", "slope_mito"),
    }
    for plate, rows in kinds.items():
        files.write_measurements(rows, f"{root}/{plate}")
    wanted = ["event_id", "plate", "well", "site", "zslice", "slope"]
    return files.read_csv_by_prefix(spark, f"{root}/*/*.csv", wanted, {"event_id": "long", **files.KINDS})


def _overwritten(spark, blur, saturation):
    """Blur flags kept as a table, read, joined with the saturation flags, and written over themselves."""
    table = files.Versions(spark, files.scratch(spark))
    first = table.overwrite(blur, 0)
    table.overwrite(qc.merge(table.read(), saturation), first)
    return table.read()
