"""Queries over voxels, masks and linked objects: {name: (Spark query, DuckDB SQL or None)}."""

from __future__ import annotations

from pyspark.sql import functions as F

from slicewise.operators import flows, images, linking, masks, volume
from slicewise.plans import sql
from slicewise.sources import files, gif
from slicewise.sources import tables as t
from slicewise.sources.shared import stored

#: Slices of a stack for projections and for linking, window width, and linking radius.
DEEP, SHALLOW, WIDTH, RADIUS = 20, 5, 3, 3.0
VD, VS = sql.voxels(DEEP), sql.voxels(SHALLOW)
BYTE = "cast(floor({0}) as int) % 256"


def deep(s, d):
    return t.voxels(s, d, DEEP)


def labels(s, d, depth, threshold=0.1):
    return t.slices(s, d, depth, threshold).drop("pixels").withColumnRenamed("labels", "pixels")


def with_nuclei(s, d):
    """Slices with a second channel: the pixels of objects, 0 elsewhere."""
    return t.slices(s, d, DEEP).withColumn("nuclei", F.zip_with("pixels", "labels", lambda v, lab: F.when(lab > 0, v).otherwise(0.0)))


def fanned(s, d):
    """Each slice that starts a full window stands for its mask, and gives it to the window's slices."""
    return volume.fan_out(labels(s, d, SHALLOW).where(F.col("z") <= SHALLOW - WIDTH), WIDTH, SHALLOW)


def fanned_voxels(s, d):
    long = fanned(s, d).select("stack", "z", "pseudo_slice", "width", F.posexplode("pixels").alias("_at", "lab"))
    return long.selectExpr("stack", "z", "pseudo_slice", "cast(_at div width as int) y", "_at % width x", "cast(lab as int) lab")


FAN = f"fan as (select stack, cast(z + k as int) as z, z as pseudo_slice, y, x, lab from voxels, (select unnest(range({WIDTH})) k) where z <= {SHALLOW - WIDTH} and z + k < {SHALLOW})"
MASKS = "masks as (select stack, z, lab label, pseudo_slice, list_sort(list(distinct y)) ys, list_sort(list(distinct x)) xs, 2 * count(*) area from fan group by all)"
RANKED = "ranked as (select *, row_number() over (partition by stack, z order by label, pseudo_slice) r, list_distinct(list_concat(ys, xs)) coords from masks)"
PAIRS = (
    "pairs as (select a.stack, a.z, a.r i, b.r j, len(list_intersect(a.coords, b.coords)) / len(list_distinct(list_concat(a.coords, b.coords))) iou, "
    "case when a.area >= b.area then a.label else b.label end label, case when a.area >= b.area then a.pseudo_slice else b.pseudo_slice end pseudo_slice "
    "from ranked a join ranked b on a.stack = b.stack and a.z = b.z and a.r <> b.r)"
)
OBJECTS = (
    "o1 as (select stack, z slice, lab label, avg(y) centroid_0, avg(x) centroid_1 from voxels where lab > 0 group by all), "
    "objects as (select *, row_number() over (partition by stack order by slice, label) - 1 unique_id from (select *, count(*) over (partition by stack, slice) n from o1) where n >= 2)"
)
EDGES = (
    "edges as (select a.stack, a.unique_id src, b.unique_id dst, sqrt((a.centroid_0 - b.centroid_0) * (a.centroid_0 - b.centroid_0) + (a.centroid_1 - b.centroid_1) * (a.centroid_1 - b.centroid_1)) weight "
    f"from objects a join objects b on a.stack = b.stack and b.slice = a.slice + 1 where weight < {RADIUS})"
)
WALKS = (
    "linked as (select stack, src, dst, weight from edges union all select stack, dst, src, weight from edges), "
    "walks as (select stack, src node1, dst node2, [src, dst] path, weight distance from linked union all "
    "select w.stack, node1, dst, list_append(path, dst), distance + weight from walks w join linked b on w.stack = b.stack and w.node2 = b.src where not list_contains(path, dst)), "
    "fewest as (select stack, node1, node2, min(distance) distance, arg_min(path, lpad(cast(len(path) as varchar), 3, '0') || list_aggregate([lpad(cast(p as varchar), 4, '0') for p in path], 'string_agg', ',')) path from walks group by all), "
    "paths as (select f.* from fewest f join objects a on a.stack = f.stack and a.unique_id = node1 join objects b on b.stack = f.stack and b.unique_id = node2 where a.slice <= b.slice), "
    "longest as (select * from paths p where not exists (select 1 from paths q where q.stack = p.stack and len(q.path) > len(p.path) and list_has_all(q.path, p.path))), "
    "numbered as (select *, cast(row_number() over (partition by stack order by list_aggregate([lpad(cast(p as varchar), 4, '0') for p in path], 'string_agg', ',')) - 1 as int) object_number from longest), "
    "nodes as (select stack, object_number, unnest(path) unique_id, unnest(range(len(path))) step from numbered)"
)
L = f"with recursive {VS}, {OBJECTS}, {EDGES}, {WALKS} "
PATH_TEXT = "list_aggregate(path, 'string_agg', ',')"


def shown(column):
    """A list as text, so that results compare by value."""
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


def objects(s, d):
    return stored(linking.centroids(labels(s, d, SHALLOW)))


def found_paths(s, d):
    o = objects(s, d)
    return o, linking.paths(linking.edges(o, RADIUS))


def numbered(s, d):
    o, found = found_paths(s, d)
    return o, linking.numbered(linking.longest(found))


def nodes(s, d):
    return linking.path_nodes(*numbered(s, d))


RGB = (
    f"with {VD}, m as (select *, case when lab > 0 then v else 0 end nuc from voxels), "
    f"a as (select stack, z, y, x, {BYTE.format('coalesce(v / nullif(max(v) over w, 0), 0) * 255')} r, {BYTE.format('coalesce(nuc / nullif(max(nuc) over w, 0), 0) * 255')} b from m window w as (partition by stack, z)), "
    "c as (select *, max(greatest(r, b)) over (partition by stack, z) most from a) "
    f"select stack, z, y, x, {BYTE.format('coalesce(r / nullif(most, 0), 0) * 255')} as r, 0 as g, {BYTE.format('coalesce(b / nullif(most, 0), 0) * 255')} as b from c"
)
#: The spectrum by its definition: a sum over all pixels for each of the frequencies -4 to 3 along both axes.
SLOPES = (
    f"with {VD}, m as (select stack, z, y, x, v - avg(v) over w d, max(v) over w - min(v) over w contrast from voxels window w as (partition by stack, z)), "
    "f as (select unnest(range(-4, 4)) k), g as (select a.k ky, b.k kx, cast(floor(sqrt(a.k * a.k + b.k * b.k)) as int) r from f a, f b), "
    "p as (select stack, z, ky, kx, r, pow(sum(d * cos(2 * pi() * (ky * y + kx * x) / 8)), 2) + pow(sum(d * sin(2 * pi() * (ky * y + kx * x) / 8)), 2) power from m, g where r between 1 and 4 and contrast > 0 group by all), "
    "q as (select stack, z, r, avg(power) power from p group by all), "
    "s as (select stack, z, regr_slope(ln(power), ln(r)) slope from q where power > 0 group by all having count(*) > 1) "
    "select stack, z, round(slope, 6) as slope from (select distinct stack, z from voxels) left join s using (stack, z)"
)
#: The blur by its definition: weights of all places that reflect into a pixel, along each axis.
WEIGHTS = (
    "{0} as (select i, case when q % 2 = 0 then p - {1} * q else {1} - 1 - (p - {1} * q) end j, sum(weight) weight from "
    "(select i, i + d p, cast(floor((i + d) / {1}) as int) q, exp(-d * d / 2) / (select sum(exp(-pow(e, 2) / 2)) from (select unnest(range(-4, 5)) e)) weight "
    "from (select cast(unnest(range({1})) as int) i), (select cast(unnest(range(-4, 5)) as int) d)) group by all)"
)
BLURRED = (
    f"with {VD}, {WEIGHTS.format('deep', WIDTH)}, {WEIGHTS.format('wide', 8)}, "
    f"a as (select stack, z, y, w.i x, sum(v * weight) v from voxels join wide w on w.j = x group by all), b as (select stack, z, w.i y, x, sum(v * weight) v from a join wide w on w.j = y group by all), "
    f"windows as (select stack, z, max(z) over (partition by stack) + 1 depth from (select distinct stack, z from voxels) qualify z <= depth - {WIDTH}), "
    "c as (select w.stack, w.z, k.i, y, x, sum(v * weight) v from windows w join b on b.stack = w.stack join deep k on b.z = w.z + k.j group by all) "
    "select stack, z, y, x, round(max(v), 6) as v from c group by all"
)


def _turned(name, source, axis, sign):
    """One axis of a discrete Fourier transform (re, im) by its definition; ``n_<axis>`` is its length."""
    other = ", ".join(c for c in ("stack", "z", "y", "x", "n_z", "n_y", "n_x") if c != axis)
    angle = f"2 * pi() * k * {axis} / n_{axis}"
    return (
        f"{name} as (select {other}, k {axis}, sum(re * cos({angle}) - ({sign}) * im * sin({angle})) re, sum(im * cos({angle}) + ({sign}) * re * sin({angle})) im "
        f"from (select *, cast(unnest(range(n_{axis})) as int) k from {source}) group by all)"
    )


def _frequency(axis):
    return f"pow((case when {axis} < (n_{axis} + 1) // 2 then {axis} else {axis} - n_{axis} end) / n_{axis} / 0.1, 2)"


LOW_PASS = (
    f"with {VD}, v as (select stack, z, y, x, cast(v as double) re, 0.0::double im, "
    "max(z) over (partition by stack) + 1 n_z, 8 n_y, 8 n_x from voxels), "
    + ", ".join((_turned("a", "v", "x", -1), _turned("b", "a", "y", -1), _turned("c", "b", "z", -1)))
    +
        ", g as (select * replace (re * gain as re, im * gain as im) from (select *, "
        f"1 / (1 + pow({_frequency('z')} + {_frequency('y')} + {_frequency('x')}, 5)) gain from c)), "
    + ", ".join((_turned("d", "g", "x", 1), _turned("e", "d", "y", 1), _turned("f", "e", "z", 1)))
    + " select stack, z, y, x, round(re / (n_z * n_y * n_x), 6) as v from f"
)
#: The equalisation by its definition: parts of an axis, middles beside a place, clipped counts up to a level. Both
#: sides add 1e-9, as the shares are fractions that often end in the digit that rounding cuts.
_AXIS = (
    "{0}_cut as (select n, i, cast(floor(i * n / least(8, n)) as int) low, cast(floor((i + 1) * n / least(8, n)) as int) high from (select distinct n_{0} n from v), (select unnest(range(8)) i) where i < least(8, n)), "
    "{0}_near as (select n, p, i, least(i + 1, least(8, n) - 1) j, (low + high - 1) / 2 m from (select distinct n, unnest(range(n)) p from {0}_cut) join {0}_cut using (n) "
    "qualify i = coalesce(max(case when m <= p then i end) over (partition by n, p), 0)), "
    "{0}_share as (select a.n, p, a.i, a.j, case when a.i = a.j then 0 else greatest(0, least(1, (p - a.m) / ((b.low + b.high - 1) / 2 - a.m))) end w from {0}_near a join {0}_cut b on b.n = a.n and b.i = a.j), "
    "{0}_mix as (select n, p, i t, 1 - w w from {0}_share union all select n, p, j, w from {0}_share)"
)
EQUALISED = (
    f"with {VD}, v as (select *, min(v) over s lo, max(v) over s hi, max(z) over s + 1 n_z, 8 n_y, 8 n_x from voxels window s as (partition by stack)), "
    + ", ".join(_AXIS.format(a) for a in "zyx")
    + ", l as (select stack, z, y, x, n_z, n_y, n_x, case when hi > lo then least(255, cast(floor((v - lo) / (hi - lo) * 256) as int)) else -1 end level from v), "
    "h as (select stack, tz.i tz, ty.i ty, tx.i tx, level, count(*) n from l join z_cut tz on tz.n = n_z and z >= tz.low and z < tz.high "
    "join y_cut ty on ty.n = n_y and y >= ty.low and y < ty.high join x_cut tx on tx.n = n_x and x >= tx.low and x < tx.high where level >= 0 group by all), "
    "s as (select *, sum(n) over k size, greatest(0.05 * sum(n) over k, sum(n) over k / 256) most from h window k as (partition by stack, tz, ty, tx)), "
    "c as (select stack, tz, ty, tx, level, size, least(n, most) n, sum(greatest(n - most, 0)) over (partition by stack, tz, ty, tx) spare from s), "
    "near as (select l.stack, l.z, l.y, l.x, l.level, mz.t tz, my.t ty, mx.t tx, sum(mz.w * my.w * mx.w) w from l join z_mix mz on mz.n = n_z and mz.p = z join y_mix my on my.n = n_y and my.p = y "
    "join x_mix mx on mx.n = n_x and mx.p = x where l.level >= 0 group by all having sum(mz.w * my.w * mx.w) > 0), "
    "m as (select near.stack, z, y, x, any_value(w) * (sum(case when c.level <= near.level then n else 0 end) + any_value(spare) * (near.level + 1) / 256) / any_value(size) share "
    "from near join c using (stack, tz, ty, tx) group by near.stack, z, y, x, near.level, tz, ty, tx), "
    "t as (select stack, z, y, x, sum(share) share from m group by all) "
    "select stack, z, y, x, round(coalesce(share, 0) + 1e-9, 6) as v from v left join t using (stack, z, y, x)"
)
PAGES = (
    f"with {VD}, p as (select stack, z, string_agg(cast(greatest(v, 0) as varchar), ',' order by y, x) pixels from voxels group by all) "
    "select stack, cast(row_number() over (partition by stack order by z) - 1 as int) as page, pixels from p"
)
STITCHED = (
    f"with recursive {sql.voxels(DEEP, 0.05)}, a as (select stack, z, lab, count(*) n from voxels where lab > 0 group by all), "
    "c as (select p.stack, q.z, p.lab old, q.lab new, count(*) n from voxels p join voxels q on p.stack = q.stack and q.z = p.z + 1 and p.y = q.y and p.x = q.x where p.lab > 0 and q.lab > 0 group by all), "
    "i as (select c.*, c.n / (o.n + w.n - c.n) iou from c join a o on o.stack = c.stack and o.z = c.z - 1 and o.lab = old join a w on w.stack = c.stack and w.z = c.z and w.lab = new), "
    "most as (select * from i where iou >= {} qualify iou = max(iou) over (partition by stack, z, old)), "
    "link as (select stack, z, new, old from most qualify row_number() over (partition by stack, z, new order by iou desc, old) = 1), "
    "roots as (select stack, z, lab, cast(row_number() over (partition by stack order by z, lab) as int) object from a where not exists (select 1 from link l where l.stack = a.stack and l.z = a.z and l.new = a.lab)), "
    "chain as (select * from roots union all select l.stack, l.z, l.new, c.object from chain c join link l on l.stack = c.stack and l.z = c.z + 1 and l.old = c.lab) "
    "select stack, z, y, x, coalesce(object, 0) as object from voxels left join chain using (stack, z, lab)"
)

QUERIES = {
    "sliding_max": (
        lambda s, d: images.as_voxels(images.sliding_max(t.slices(s, d, DEEP), WIDTH), "v", "int"),
        f"with {VD}, w as (select stack, z, y, x, max(v) over w v, count(*) over w n "
        "from voxels window w as (partition by stack, y, x order by z rows between current row "
        f"and {WIDTH - 1} following)) select stack, z, y, x, v from w where n = {WIDTH}"),
    "window_fanout": (lambda s, d: fanned_voxels(s, d), f"with {VS}, {FAN} select stack, z, pseudo_slice, y, x, lab from fan"),
    "organoid_merge": (lambda s, d: images.as_voxels(images.merged_windows(labels(s, d, SHALLOW).where(F.col("z") <= SHALLOW - WIDTH), WIDTH, SHALLOW), "lab", "int"), f"with {VS}, {FAN} select stack, z, y, x, max(lab) as lab from fan group by all"),
    "rescale_minmax": (
        lambda s, d: images.as_voxels(volume.rescaled_to_range(t.slices(s, d, DEEP)), "v", "int"),
        f"with {VD} select stack, z, y, x, "
        f"{BYTE.format('coalesce((v - min(v) over w) / nullif(max(v) over w - min(v) over w, 0), 0) * 255')} as v "
        "from voxels window w as (partition by stack)"),
    "rescale_max": (
        lambda s, d: images.as_voxels(volume.rescaled_to_max(t.slices(s, d, DEEP)), "v", "int"),
        f"with {VD} select stack, z, y, x, {BYTE.format('coalesce(v / nullif(max(v) over w, 0), 0) * 255')} as v "
        "from voxels window w as (partition by stack)"),
    "rgb_composite": (lambda s, d: _rgb(volume.rgb_composite(with_nuclei(s, d), "pixels", "nuclei")), RGB),
    "video_scale": (
        lambda s, d: volume.video_scaled(deep(s, d)),
            f"with {VD} select stack, z, y, x, (({BYTE.format('v / 255')}) * 8) % 256 as image, "
            "(lab % 256 * 16) % 256 as mask from voxels"),
    "gif_frames": (
        lambda s, d: volume.frames(deep(s, d)).select("stack", "z", shown("image"), shown("mask")),
        f"with {VD}, f as (select stack, z, y, x, (({BYTE.format('v / 255')}) * 8) % 256 image, (lab % 256 * 16) % 256 mask from voxels) "
        "select stack, z, string_agg(image, ',' order by y, x) as image, string_agg(mask, ',' order by y, x) as mask from f group by all"),
    "cytoplasm": (
        lambda s, d: images.as_voxels(volume.cytoplasm(labels(s, d, DEEP, 0.05), labels(s, d, DEEP, 0.2)), "lab", "int"),
        f"with {sql.voxels(DEEP, 0.05, 'cell')}, {sql.voxels(DEEP, 0.2, 'nuclei')} select stack, z, y, x, case "
        "when n.lab > 0 then 0 else c.lab end as lab from cell c join nuclei n using (stack, z, y, x)"),
    "channel_max": (
        lambda s, d: volume.channel_max(deep(s, d).withColumn("w", F.col("lab") * 20), ["v", "w"]), f"with {VD} select stack, z, y, x, greatest(v, lab * 20) as v from voxels"),
    "percent_maximal": (
        lambda s, d: volume.percent_maximal(deep(s, d)),
        f"with {VD}, m as (select *, max(v) over (partition by stack, z) most from voxels) select stack, z, "
        "round(100 * count(*) filter (v = most) / count(*), 6) as percent_maximal from m group by all"),
    "stitch_iou": (
        lambda s, d: images.close_overlaps(labels(s, d, DEEP), 0.4),
        f"with {VD}, a as (select stack, z, lab, count(*) n from voxels where lab > 0 group by all), "
        "c as (select p.stack, p.z, p.lab label, q.lab next_label, count(*) n from voxels p join voxels q on p.stack = q.stack and q.z = p.z + 1 and p.y = q.y and p.x = q.x where p.lab > 0 and q.lab > 0 group by all), "
        "i as (select c.stack, c.z, label, next_label, c.n / (a.n + b.n - c.n) iou from c join a on a.stack = c.stack and a.z = c.z and a.lab = label join a b on b.stack = c.stack and b.z = c.z + 1 and b.lab = next_label) "
        "select stack, z, label, next_label, round(iou, 6) as iou from i where iou >= 0.4"),
    "mask_index": (
        lambda s, d: masks.mask_index(fanned(s, d)).select(*masks.MASK, shown("ys"), shown("xs"), "area"),
        f"with {VS}, {FAN}, {MASKS} select stack, z, label, pseudo_slice, list_aggregate(ys, 'string_agg', ',') as ys, "
        "list_aggregate(xs, 'string_agg', ',') as xs, area from masks"),
    "mask_overlap": (
        lambda s, d: masks.overlaps(masks.mask_index(fanned(s, d))),
        f"with {VS}, {FAN}, {MASKS}, {RANKED}, {PAIRS} select stack, z, i, j, round(iou, 6) as iou, label, pseudo_slice "
        "from pairs where iou > 0.8"),
    "decouple_masks": (
        lambda s, d: images.as_voxels(masks.decoupled(fanned(s, d)), "label", "int").where("label >= 0"),
        f"with {VS}, {FAN}, {MASKS}, {RANKED}, {PAIRS} select f.stack, f.z, f.y, f.x, arg_max(f.lab, "
        "i * 1000000 + j) as label from pairs p join fan f on f.stack = p.stack and f.z = p.z and f.lab = p.label "
        "and f.pseudo_slice = p.pseudo_slice where iou > 0.8 group by all"),
    "centroids": (
        lambda s, d: objects(s, d).withColumns({c: F.round(c, 6) for c in ("centroid_0", "centroid_1")}),
        f"with {VS}, {OBJECTS} select stack, slice, label, round(centroid_0, 6) as centroid_0, round(centroid_1, "
        "6) as centroid_1, unique_id from objects"),
    "slice_edges": (
        lambda s, d: linking.edges(objects(s, d), RADIUS).drop("slice").withColumn("weight", F.round("weight", 6)), f"with {VS}, {OBJECTS}, {EDGES} select stack, src, dst, round(weight, 6) as weight from edges"),
    "node_pairs": (
        lambda s, d: _node_pairs(objects(s, d)),
        f"with {VS}, {OBJECTS} select a.stack, a.unique_id as node1, b.unique_id as node2 from objects a "
        "join objects b on a.stack = b.stack and a.slice <= b.slice and a.unique_id <> b.unique_id"),
    "hop_distance": (lambda s, d: found_paths(s, d)[1].select("stack", "node1", "node2", (F.size("path") - 1).alias("hops"), shown("path")), L + f"select stack, node1, node2, cast(len(path) - 1 as int) as hops, {PATH_TEXT} as path from paths"),
    "weighted_distance": (lambda s, d: found_paths(s, d)[1].select("stack", "node1", "node2", F.round("distance", 6).alias("distance")), L + "select stack, node1, node2, round(distance, 6) as distance from paths"),
    "longest_paths": (lambda s, d: linking.longest(found_paths(s, d)[1]).select("stack", shown("path")), L + f"select stack, {PATH_TEXT} as path from longest"),
    "object_number": (lambda s, d: numbered(s, d)[1].select("stack", "object_number", shown("path")), L + f"select stack, object_number, {PATH_TEXT} as path from numbered"),
    "path_nodes": (
        lambda s, d: nodes(s, d).withColumns({c: F.round(c, 6) for c in ("centroid_0", "centroid_1")}),
        L +
            "select stack, object_number, cast(step as int) as step, unique_id, slice, label, round(centroid_0, "
            "6) as centroid_0, round(centroid_1, 6) as centroid_1 from nodes join objects using (stack, unique_id)"),
    "relabel_3d": (
        lambda s, d: images.as_voxels(linking.relabelled(labels(s, d, SHALLOW), nodes(s, d)), "object", "int"),
        L +
            ", last as (select stack, slice z, label lab, max(object_number) k from nodes join objects using (stack, "
            "unique_id) group by all) select stack, z, y, x, coalesce(k, 0) as object from voxels left "
            "join last using (stack, z, lab)"),
    "relabel_rescaled": (
        lambda s, d: images.as_voxels(volume.rescaled_to_max(stored(linking.relabelled(labels(s, d, SHALLOW), nodes(s, d)))), "object", "int"),  # read for the range, then to be rescaled
        L + ", last as (select stack, slice z, label lab, max(object_number) k from nodes join objects using (stack, unique_id) group by all), "
        "o as (select stack, z, y, x, coalesce(k, 0) as object from voxels left join last using (stack, z, lab)) "
        f"select stack, z, y, x, {BYTE.format('coalesce(object / nullif(max(object) over w, 0), 0) * 255')} as object from o window w as (partition by stack)"),
    "stitch_labels": (lambda s, d: _stitched(s, d, 0.8), STITCHED.format(0.8)),
    "stitch_labels_loosely": (lambda s, d: _stitched(s, d, 0.4), STITCHED.format(0.4)),
    "power_loglog_slope": (lambda s, d: images.power_slopes(t.slices(s, d, DEEP)).withColumn("slope", F.round("slope", 6)), SLOPES),
    "clahe": (lambda s, d: images.as_voxels(images.equalised(t.slices(s, d, DEEP))).withColumn("v", F.round(F.col("v") + 1e-9, 6)), EQUALISED),
    "gauss_max": (lambda s, d: images.as_voxels(images.blurred_maximum(t.slices(s, d, DEEP), WIDTH)).withColumn("v", F.round("v", 6)), BLURRED),
    "butterworth": (lambda s, d: images.as_voxels(images.low_pass(t.slices(s, d, DEEP))).withColumn("v", F.round("v", 6)), LOW_PASS),
    "segment": (lambda s, d: images.segmented(t.slices(s, d, DEEP), 4.0), None),
    **{
        f"segment_{name}": ((lambda name: lambda s, d: images.compartment(
            with_nuclei(s, d), name, scale=4.0 / images.MODELS[name]["diameter"], nuclei="nuclei" if name == "cell" else None))(name), None)
        for name in images.MODELS},
    "flow_nuclei": (lambda s, d: flows.nuclei(t.slices(s, d, DEEP), WIDTH, 4.0 / 75), None),
    "flow_cells": (lambda s, d: flows.cells(with_nuclei(s, d), "nuclei", WIDTH, 4.0 / 150), None),
    "flow_organoids": (lambda s, d: flows.organoids(t.slices(s, d, DEEP), WIDTH, 4.0 / 750), None),
    "flow_cytoplasm": (lambda s, d: volume.cytoplasm(flows.cells(with_nuclei(s, d), "nuclei", WIDTH, 4.0 / 150), flows.nuclei(t.slices(s, d, DEEP), WIDTH, 4.0 / 75)), None),
    "flow_objects": (lambda s, d: flows.objects(flows.nuclei(t.slices(s, d, SHALLOW), WIDTH, 4.0 / 75), RADIUS)[0], None),
    "decode_tiff": (lambda s, d: _pages(images.encoded(t.slices(s, d, DEEP))), PAGES),
    "tiff_sink": (lambda s, d: _written(s, images.encoded(t.slices(s, d, DEEP))), PAGES),
    "window_sink": (lambda s, d: _windows(s, fanned_voxels(s, d)), f"with {VS}, {FAN} select stack, z, pseudo_slice, y, x, lab from fan"),
    "gif_files": (
        lambda s, d: _films(s, images.animated(t.slices(s, d, DEEP))),
        f"with {VD}, f as (select stack, z, string_agg(cast(((v % 256) + 256) % 256 as varchar), ',' order by y, x) pixels from voxels group by all) "
        "select 'stack' || stack || '.gif' as path, cast(row_number() over (partition by stack order by z) - 1 as int) as page, 8 as height, 8 as width, pixels from f"),
}


def _stitched(spark, d, least):
    return images.as_voxels(images.stitched(labels(spark, d, DEEP, 0.05), least), "object", "int")


def _rgb(found):
    """A row for each pixel of three channels that are arrays."""
    long = found.select("stack", "z", "width", F.posexplode(F.arrays_zip("r", "g", "b")).alias("_at", "_c"))
    return long.select("stack", "z", F.expr("cast(_at div width as int)").alias("y"), (F.col("_at") % F.col("width")).alias("x"), "_c.r", "_c.g", "_c.b")


def _pages(found):
    """Pages by the number in their file's name, their pixels as text."""
    stack = F.regexp_extract("path", "stack([0-9]+)[.]tif$", 1).cast("int")
    return images.decoded(found).select(stack.alias("stack"), "page", F.array_join(F.transform("pixels", lambda v: v.cast("int")), ",").alias("pixels"))


def _written(spark, found):
    folder = files.scratch(spark)
    files.write_files(found, folder)
    return _pages(files.image_files(spark, folder))


def _films(spark, found):
    """The frames of animations that were written and read again."""
    folder = files.scratch(spark)
    files.write_files(found, folder)
    back = images.decoded(spark.read.format("binaryFile").load(folder), gif.decode)
    name = F.element_at(F.split("path", "/"), -1)
    return back.select(name.alias("path"), "page", "height", "width", F.array_join(F.transform("pixels", lambda v: v.cast("int")), ",").alias("pixels"))


def _windows(spark, rows):
    folder = files.scratch(spark)
    files.write_slices(rows, folder, "lab", ["stack", "z", "pseudo_slice"])
    return files.read_slices(spark, folder, "lab", ["stack", "z", "pseudo_slice"])


def _node_pairs(o):
    a = o.select("stack", F.col("unique_id").alias("node1"), F.col("slice").alias("_s1"))
    b = o.select("stack", F.col("unique_id").alias("node2"), F.col("slice").alias("_s2"))
    return a.join(b, "stack").where("_s1 <= _s2 and node1 <> node2").select("stack", "node1", "node2")
