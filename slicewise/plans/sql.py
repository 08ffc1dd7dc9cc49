"""DuckDB SQL for the driver's tables as the library's tables (see ``sources.tables``), shared by the oracles."""

from slicewise import schema

_SLOPES = dict(zip(("dna", "mito", "er", "agp", "brightfield"), (2, 3, 5, 4, 7)))
_SHARES = dict(zip(("dna", "mito", "er", "agp", "brightfield"), (3, 5, 2, 4, 11)))
CHANNEL_CASE = "case " + " ".join(f"when contains({{0}}, '{m}') then '{c}'" for m, c in schema.CHANNEL_TEXT.items()) + " end"

ZSLICE_QC = (
    "zslice_qc as (select event_id, event_type, 'NF00' || cast(14 + 2 * (user_id % 3) as varchar) plate, "
    "substr('CDEFG', cast(floor(user_id / 3) as int) % 5 + 1, 1) || cast(2 + cast(floor(user_id / 15) as int) % 10 as varchar) well, "
    "cast(floor(user_id / 150) as int) site, 'ZS' || lpad(cast(event_id % 40 as varchar), 3, '0') zslice, "
    + ", ".join(f"-value / (1 + event_id % {k}) slope_{c}" for c, k in _SLOPES.items()) + ", "
    + ", ".join(f"value / (1 + event_id % {k}) pctmax_{c}" for c, k in _SHARES.items()) + " from events)"
)
_FEATURES = [f"{p}_{c}" for p in ("slope", "pctmax") for c in schema.CHANNELS]
STATS = "stats as (select " + ", ".join(f"avg({f}) m_{f}, stddev_pop({f}) s_{f}" for f in _FEATURES) + " from zslice_qc)"
RATED = "rated as (select q.*, " + ", ".join(f"({f} - m_{f}) / s_{f} z_{f}" for f in _FEATURES) + " from zslice_qc q, stats)"
TEST = {f"blurry_{c}": f"z_slope_{c} < {t}" for c, t in schema.BLUR.items()} | {f"saturated_{c}": f"z_pctmax_{c} > {t}" for c, t in schema.SATURATION.items()}
QC = "qc as (select plate, well, site, zslice, " + ", ".join(f"bool_or({t}) {n}" for n, t in TEST.items()) + " from rated group by all)"
BASE = f"{ZSLICE_QC}, {STATS}, {RATED}, {QC}"
ANY = "(" + " or ".join(schema.FLAGS) + ")"
LONG = "long as (" + " union all ".join(
    f"select plate, well, site, zslice, '{f.split('_')[0]}' condition, '{f.split('_')[1]}' channel, {f} failed "
    "from qc" for f in schema.FLAGS) + ")"


def platemap(wells: int) -> str:
    return (
        "platemap as (select substr('CDEFG', cast(p_size - 1 as int) % 5 + 1, 1) || cast(2 + cast(floor((p_size - 1) / 5) as int) as varchar) well_position, "
        "min(p_type) treatment, cast(p_size % 4 as varchar) dose, substr('CDEFG', cast(p_size - 1 as int) % 5 + 1, 1) wellrow, "
        f"2 + cast(floor((p_size - 1) / 5) as int) wellcol from part where p_size <= {wells} group by p_size)"
    )


FOLDERS = (
    "folders as (select distinct plate, well || '-' || cast(site as varchar) || ' acq' folder from zslice_qc "
    + "".join(f"union all select '{p}', '{f}' " for p, f in schema.EXTRA_FOLDERS) + ")"
)
INVENTORY = "inventory as (select plate, split_part(split_part(folder, ' ', 1), '-', 1) well, try_cast(split_part(split_part(folder, ' ', 1), '-', 2) as int) site from folders)"
PATHS = (
    f"{ZSLICE_QC}, image_paths as (select event_id, '/data/' || plate || '_raw_images/' || well || '-' || cast(site as varchar) || '/img_' || "
    "case event_type when 'click' then '405' when 'view' then '488' when 'purchase' then '555' when 'signup' then '640' else 'TRANS' end || '_' || zslice || '.tif' path from zslice_qc), "
    "parts as (select event_id, path, string_split(path, '/')[-1] file, string_split(path, '/')[-2] folder, string_split(path, '/')[-3] plate_dir from image_paths)"
)


def voxels(depth: int, threshold: float = 0.1, name: str = "voxels") -> str:
    return (
        f"{name} as (select cast(floor(vec_id / {depth}) as int) stack, cast(vec_id % {depth} as int) z, cast(floor(p / 8) as int) y, cast(p % 8 as int) x, "
        "cast(floor((cast(e as double) + cast(0.6 as double)) * 100) as int) v, "
        f"case when cast(e as double) > cast({threshold} as double) then 1 + cast(floor((p % 8) / 4) as int) + 2 * cast(floor(p / 32) as int) else 0 end lab "
        "from (select vec_id, unnest(embedding) e, unnest(range(64)) p from embeddings))"
    )
