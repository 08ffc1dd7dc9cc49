"""Queries over image paths: {name: (Spark query, DuckDB SQL or None)}."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicewise import schema
from slicewise.operators import paths as p
from slicewise.plans import sql
from slicewise.sources import tables as t

W = f"with {sql.PATHS} "
CHANNEL = sql.CHANNEL_CASE
STACK = f"ordered as (select folder, channel, path, cast(row_number() over (partition by folder, channel order by path) - 1 as int) z from (select distinct folder, {CHANNEL.format('file')} channel, path from parts) where channel is not null)"
NESTED = (
    "nested as (select event_id, replace(replace(path, '/img_', case when event_id % 7 = 0 then '/scan/deep/img_' when event_id % 5 = 0 then '/img_' else '/scan/img_' end), "
    "'.tif', case when event_id % 11 = 0 then '.TIFF' when event_id % 13 = 0 then '.png' else '.tif' end) path from image_paths)"
)
N = f"with {sql.PATHS}, {NESTED} "
MANIFEST = (
    N + ", known as (select distinct folder from parts where folder like 'C%'), trees as (select distinct path, folder, file from parts where event_id % 3 = 0), "
    "raw as (select distinct path, string_split(path, '/')[-2] folder, string_split(path, '/')[-1] file from nested where event_id % 3 = 1 and (path like '%.tif' or path like '%.tiff')), "
    "wells as (select folder from trees union select folder from known) "
    "select path as source, '/cellprofiler/' || folder || '/' || file as destination, case when folder in (from known) then '{}' else 'copy' end as action from trees "
    "union all select path, '/cellprofiler/' || folder || '/' || file, 'add' from raw where folder in (from wells)"
)
VIDEO = (
    ", files as (select path, folder from parts union all select '/data/' || folder || '/{c}_masks.tiff', folder from parts) "
    "select folder, max(case when contains(string_split(path, '/')[-1], '{mark}') then path end) as image, "
    "max(case when contains(string_split(path, '/')[-1], '{c}') and contains(string_split(path, '/')[-1], 'mask') then path end) as mask from files group by folder"
)


def _manifest(spark, d, overwrite):
    trees, nested = t.image_paths(spark, d), t.nested_paths(spark, d)
    there = trees.select(p.directory(F.col("path")).alias("folder")).where("folder like 'C%'")
    return p.copy_manifest(trees.where("event_id % 3 = 0"), nested.where("event_id % 3 = 1"), there, "/cellprofiler", overwrite)


def _video(compartment):
    def query(spark, d):
        found = t.image_paths(spark, d).select("path")
        masks = found.select(F.concat(F.lit("/data/"), p.directory(F.col("path")), F.lit(f"/{compartment}_masks.tiff")).alias("path"))
        return p.video_files(found.union(masks), compartment)

    return query


QUERIES = {
    "scan_image_paths": (lambda s, d: p.images(t.image_paths(s, d)), W + "select event_id, path from parts where lower(path) like '%.tif' or lower(path) like '%.tiff'"),
    "scan_tif_case_sensitive": (lambda s, d: p.images(t.image_paths(s, d), any_case=False), W + "select event_id, path from parts where path like '%.tif' or path like '%.tiff'"),
    "flatten_paths": (
        lambda s, d: p.flattened(t.nested_paths(s, d), "/data"),
        N + ", b as (select path, string_split(substr(path, 7), '/') q from nested where lower(path) like '%.tif' or lower(path) like '%.tiff'), "
        "f as (select path, unnest(q[2:len(q) - 2]) folder from b where len(q) >= 4) "
        "select folder, string_split(path, '/')[-1] as file, max(path) as path from f group by all"),
    "parse_path_metadata": (
        lambda s, d: p.parse(t.image_paths(s, d)),
        W + f"select event_id, path, nullif(regexp_extract(path, '{schema.FOLDER}', 1), '') as plate, nullif(regexp_extract(path, '{schema.FOLDER}', 2), '') as well, "
        f"cast(nullif(regexp_extract(path, '{schema.FOLDER}', 3), '') as int) as site, nullif(regexp_extract(path, '{schema.FILE}', 1), '') as channel_text, nullif(regexp_extract(path, '{schema.FILE}', 2), '') as zslice from parts"),
    "filter_merge": (lambda s, d: p.unmerged(t.image_paths(s, d)), W + "select event_id, path from parts where not contains(file, 'Merge')"),
    "channel_assign": (
        lambda s, d: t.image_paths(s, d).select("event_id", p.channel(p.file_name(F.col("path"))).alias("channel")), W + f"select event_id, {CHANNEL.format('file')} as channel from parts"),
    "channel_last_wins": (
        lambda s, d: p.last_of_channel(t.image_paths(s, d)),
        W +
            f"select folder, {CHANNEL.format('path')} as channel, max(path) as path from parts "
            f"where {CHANNEL.format('path')} is not null group by all"),
    "stack_zorder": (lambda s, d: p.stack_order(t.image_paths(s, d)), W + f", {STACK} select * from ordered"),
    "channel_align": (
        lambda s, d: p.aligned_channels(p.stack_order(t.image_paths(s, d)), list(schema.CHANNEL_TEXT.values())),
        W + f", {STACK} select folder, z, " + ", ".join(f"max(case when channel = '{c}' then path end) as {c.lower()}" for c in schema.CHANNEL_TEXT.values()) + " from ordered group by all"),
    "plate_names": (
        lambda s, d: t.image_paths(s, d).select(F.substring_index(p.directory(F.col("path"), 2), "_", 1).alias("plate")).distinct(), W + "select distinct split_part(plate_dir, '_', 1) as plate from parts"),
    "plate_jobs": (
        lambda s, d: p.plate_jobs(t.image_paths(s, d)),
        W + f", j as (select nullif(regexp_extract(path, '{schema.FOLDER}', 1), '') plate, regexp_replace(path, '/[^/]*$', '') folder from parts) "
        "select plate, min(folder) as images, plate || '_qc_results' as results from j where plate is not null group by plate"),
    "drop_bad_slice": (
        lambda s, d: p.without_bad_slice(t.image_paths(s, d), "F11-3", "ZS000"), W + "select event_id, path from parts where not (folder = 'F11-3' and contains(file, 'ZS000'))"),
    "file_count_check": (
        lambda s, d: p.file_counts(t.image_paths(s, d), schema.EXPECTED_FILES), W + f"select folder, count(*) as n_files, count(*) = {schema.EXPECTED_FILES} as complete from parts group by folder"),
    "rerun_jobs": (
        lambda s, d: p.file_counts(t.image_paths(s, d), schema.EXPECTED_RESULTS).where("not complete").select("folder", "n_files"),
        W + f"select folder, count(*) as n_files from parts group by folder having count(*) <> {schema.EXPECTED_RESULTS}"),
    "copy_manifest": (lambda s, d: _manifest(s, d, True), MANIFEST.format("replace")),
    "copy_manifest_keep": (lambda s, d: _manifest(s, d, False), MANIFEST.format("skip")),
    "decoupling_files": (
        lambda s, d: p.decoupling_files(t.image_paths(s, d).select(p.directory(F.col("path")).alias("folder")), "cell"),
        W +
            "select distinct folder, folder || '/cell_masks.tiff' as mask, "
            "folder || '/cell_reconstruction_dict.npy' as windows from parts"),
    **{f"video_files_{c}": (_video(c), W + VIDEO.format(c=c, mark=mark)) for c, mark in p.SHOWN_IN.items()},
}
