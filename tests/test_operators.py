"""Edge cases and properties of the operators on small fixtures, and brute-force versions."""

import itertools
import random
import re

import numpy as np
import pytest
import whole_volumes
from pyspark.sql import functions as F

from slicewise.functions import imagemath
from slicewise.operators import images, linking, masks, paths, quality_control, report, volume
from slicewise.sources import tiff
from slicewise.sources.shared import bounded, stored

VOXEL = "stack int, z int, y int, x int, v int, lab int"


@pytest.fixture(scope="module")
def voxels(spark):
    rng = random.Random(0)
    rows = [(s, z, y, x, rng.randrange(200), rng.choice([0, 0, 1, 2])) for s in range(3) for z in range(5) for y in range(4) for x in range(4)]
    return spark.createDataFrame(rows, VOXEL)


def test_outliers_with_constant_features_nulls_and_repeats(spark):
    rows = [("p", "w", 1, f"ZS{i:03d}", float(v), 5.0) for i, v in enumerate([0] * 50 + [-100])] + [(None, None, None, "ZS900", -100.0, None), ("p", "w", 1, "ZS050", 0.0, 5.0)]
    df = spark.createDataFrame(rows, "plate string, well string, site int, zslice string, a double, b double")
    assert {r.zslice for r in quality_control.outliers(df, "a", -2.0).collect()} == {"ZS050", "ZS900"}
    flags = quality_control.flags(df, {"bad_a": ("a", -2.0), "bad_b": ("b", 2.0)}).collect()
    assert len(flags) == 52 and not any(r.bad_b for r in flags)
    assert {r.zslice for r in flags if r.bad_a} == {"ZS050", "ZS900"}
    left = spark.createDataFrame([(None, None, None, "ZS900", True)], "plate string, well string, site int, zslice string, x boolean")
    right = left.withColumnRenamed("x", "y")
    assert quality_control.merge(left, right).first().y is True


def test_fill_only_where_the_source_says_so(spark):
    df = spark.createDataFrame([(None, "a_qc"), (None, "b_qc"), ("P", "a_qc")], "plate string, source string")
    assert [r.plate for r in quality_control.fill_metadata(df, "source", "a_qc", {"plate": "A"}).collect()] == ["A", None, "P"]


def test_report_edges(spark):
    flag = ", ".join(f"{f} boolean" for f in report.schema.FLAGS)
    row = lambda z, first: ("p", "C2", 1, z, first, *[None] * 9)
    qc = spark.createDataFrame([row("ZS000", None), row("ZS001", True), ("p", "D2", 1, "ZS005", *[False] * 10)], f"plate string, well string, site int, zslice string, {flag}")
    assert report.failed_slices(qc).count() == 1
    assert {(r.well, r.zslice): r.depth for r in report.with_depth(qc).collect()} == {("C2", "ZS000"): 0.0, ("C2", "ZS001"): 1.0, ("D2", "ZS005"): None}
    platemap = spark.createDataFrame([("C2", "drug", None, "C", 2), ("C2", "drug", "1", "C", 2)], "well_position string, treatment string, dose string, wellrow string, wellcol int")
    organoids = report.failed_per_organoid(qc)
    assert sorted(r.treatment_dose for r in report.with_treatment(organoids, platemap).collect()) == ["drug_1", "drug_NA"]
    assert report.with_treatment(organoids, platemap.limit(0)).first().treatment_dose == "NA_NA"
    folders = spark.createDataFrame([("p", "C4-2 extra text"), ("p", "C4"), ("p", "C4-x"), ("p", "C4-3-9")], "plate string, folder string")
    assert [(r.well, r.site) for r in report.folder_inventory(folders).collect()] == [("C4", 2), ("C4", None), ("C4", None), ("C4", 3)]


def test_sites_of_two_digits_and_more_are_found(spark):
    folders = spark.createDataFrame([("p", "C4-9 acq"), ("p", "C4-10 acq"), ("p", "C4-599 acq"), ("p", "D4-12 acq")], "plate string, folder string")
    inventory = report.folder_inventory(folders)
    assert [r.site for r in inventory.collect()] == [9, 10, 599, 12]
    qc = spark.createDataFrame([("p", "C4", 9), ("p", "C4", 10), ("p", "C4", 599)], "plate string, well string, site int")
    missing = report.missing_organoids(inventory, qc)
    assert [tuple(r) for r in missing.collect()] == [("p", "D4", 12)]
    assert [tuple(r) for r in missing.groupBy("plate").count().collect()] == [("p", 1)]


def test_path_edges(spark):
    rows = ["/d/NF0014_raw_images/F11-3/img_405_ZS000.tif", "/d/NF0014_raw_images/F11-3/img_405_488_ZS001.TIF", "/d/x/y/MergeTRANS_ZS002.tiff", "/d/NF0014_raw_images/F11-3/sub/img_640.png"]
    df = spark.createDataFrame([(p,) for p in rows], "path string")
    assert paths.images(df).count() == 3 and paths.images(df, any_case=False).count() == 2
    assert paths.unmerged(df).count() == 3
    parsed = {r.path: r for r in paths.parse(df).collect()}
    assert (parsed[rows[0]].plate, parsed[rows[0]].well, parsed[rows[0]].site, parsed[rows[0]].zslice) == ("NF0014", "F11", 3, "ZS000")
    assert parsed[rows[2]].plate is None and parsed[rows[2]].channel_text == "TRANS"
    assert [r.c for r in df.select(paths.channel(F.col("path")).alias("c")).collect()] == ["DNA", "DNA", "Brightfield", "Mito"]
    assert paths.without_bad_slice(df, "F11-3", "ZS000").count() == 3


def test_stacks_shuffle_paths_alone_before_they_are_ordered(spark):
    names = ["/r/A/img_405_b.tif", "/r/A/img_405_a.tif", "/r/A/img_405_a.tif", "/s/A/img_405_a.tif", "/r/405/img_488.tif", "/r/405/none.tif", "/r/A/640_555.tif", "/r/A/TRANS/", "", None, None]
    found = paths.stack_order(spark.createDataFrame([(i, x) for i, x in enumerate(names)], "event_id long, path string"))
    shown = plan(found)  # once it has run, the plan also has what it was before
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", shown)
    assert [re.sub(r"#\d+", "", x) for x in exchanges] == ["folder, channel", "path"]
    assert re.findall(r"HashAggregate\(keys=\[(\w+)#\d+\]", shown) == ["path", "path"]
    assert sorted(map(tuple, found.collect())) == [
        ("405", "ER", "/r/405/img_488.tif", 0), ("A", "AGP", "/r/A/640_555.tif", 0),
        ("A", "DNA", "/r/A/img_405_a.tif", 0), ("A", "DNA", "/r/A/img_405_b.tif", 1), ("A", "DNA", "/s/A/img_405_a.tif", 2)]


def test_windows_count_and_fan_out(voxels):
    slices = images.as_slices(voxels)
    for width in (1, 3, 5, 6):
        windows = images.sliding_max(slices, width)
        assert windows.count() == 3 * max(0, 5 - width + 1)
        assert volume.fan_out(windows, width, 5).count() == width * windows.count()


def stacks(slices):
    """{stack: volume} of slice rows."""
    found = {}
    for r in slices.collect():
        found.setdefault(r.stack, {})[r.z] = np.array(r.pixels).reshape(r.height, r.width)
    return {s: np.stack([v[z] for z in sorted(v)]) for s, v in found.items()}


@pytest.fixture(scope="module")
def deep(spark):
    """Two volumes of 23 and 9 slices, and a constant one; as slices and as arrays."""
    rng = np.random.default_rng(5)
    volumes = {0: rng.random((23, 20, 11)), 1: rng.integers(0, 50, (9, 7, 30)).astype(float), 2: np.full((3, 2, 2), 4.0)}
    rows = [(s, z, *image.shape, image.ravel().tolist()) for s, v in volumes.items() for z, image in enumerate(v)]
    return spark.createDataFrame(rows, images.SLICES).repartition(5), volumes


def test_operators_across_slices_are_those_of_whole_volumes(deep, monkeypatch):
    slices, volumes = deep
    for width in (1, 2, 3, 7, 9, 12):
        got = stacks(images.sliding_max(slices, width))
        want = {s: np.stack([v[i : i + width].max(axis=0) for i in range(len(v) - width + 1)]) for s, v in volumes.items() if len(v) >= width}
        assert got.keys() == want.keys() and all(np.array_equal(got[s], want[s]) for s in want)
        merged = stacks(images.merged_windows(slices, width, 20))
        want = {s: np.stack([v[max(0, z - width + 1) : z + 1].max(axis=0) for z in range(min(20, len(v) + width - 1))]) for s, v in volumes.items()}
        assert all(np.array_equal(merged[s], want[s]) for s in want)
    for limit in (0.02, 0.5):
        got = stacks(images.equalised(slices, limit))
        assert all(np.allclose(got[s], whole_volumes.equalised(v, limit)) for s, v in volumes.items())
    for strip in (1 << 16, 40):
        monkeypatch.setattr(images, "STRIP", strip)
        got = stacks(images.low_pass(slices))
        assert all(np.allclose(got[s], whole_volumes.butterworth(v)) for s, v in volumes.items())
    got = stacks(images.blurred_maximum(slices, 3))
    assert all(np.allclose(got[s], [imagemath.gaussian(v[i : i + 3]).max(axis=0) for i in range(len(v) - 2)]) for s, v in volumes.items())


def test_stitching_by_pairs_is_that_of_whole_volumes(spark):
    rng = np.random.default_rng(6)
    volumes = {}
    for s in range(4):
        labels = rng.integers(0, 4, (6, 6))
        volume = [labels]
        for _ in range(20):
            labels = np.where(rng.random((6, 6)) < 0.12, rng.integers(0, 6, (6, 6)), labels)
            volume.append(labels * (rng.random() > 0.05))
        volumes[s] = np.stack(volume)
    rows = [(s, z, 6, 6, image.ravel().astype(float).tolist()) for s, v in volumes.items() for z, image in enumerate(v)]
    slices = spark.createDataFrame(rows, images.SLICES)
    for least in (0.3, 0.5, 0.8):
        got = stacks(images.stitched(slices, least))
        assert all(np.array_equal(got[s], whole_volumes.stitched(v, least)) for s, v in volumes.items())


def test_plans_hold_no_voxel_rows_and_no_whole_volume(deep):
    slices, _ = deep
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for df in (images.sliding_max(slices, 3), volume.rescaled_to_range(slices), volume.rescaled_to_max(slices), volume.rgb_composite(slices.withColumn("b", F.col("pixels")), "pixels", "b"), volume.cytoplasm(slices, slices)):
        assert "Window" not in plan(df) and "explode(pixels" not in plan(df)
    for df in (images.equalised(slices), images.low_pass(slices), images.sliding_max(slices, 3)):
        for line in plan(df).split("\n"):
            if "FlatMapGroupsInArrow" in line:
                assert re.search(r"\[stack#\d+, (_range|_strip|z|layer)#\d+\]", line), line


def test_rescaling_constant_and_blank_volumes(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 5, 0), (0, 1, 0, 0, 5, 0), (1, 0, 0, 0, 0, 300), (2, 0, 0, 0, 10, 1), (2, 0, 0, 1, 20, 1)], VOXEL)
    slices = images.as_slices(df)
    assert {(r.stack, r.v) for r in images.as_voxels(volume.rescaled_to_range(slices)).collect()} == {(0, 0), (1, 0), (2, 0), (2, 255)}
    assert {(r.stack, r.v) for r in images.as_voxels(volume.rescaled_to_max(slices)).collect()} == {(0, 255), (1, 0), (2, 127), (2, 255)}
    blank = volume.rgb_composite(slices.withColumn("b", F.transform("pixels", lambda v: v * 0)), "pixels", "b").where("stack = 1").first()
    assert (blank.r, blank.g, blank.b) == ([0], [0], [0])
    assert {(r.image, r.mask) for r in volume.video_scaled(df).where("stack = 1").collect()} == {(0, 300 % 256 * 16 % 256)}


def test_cytoplasm_lies_in_the_cell_and_out_of_the_nuclei(voxels):
    nuclei = voxels.withColumn("lab", F.when(F.col("v") > 150, F.col("lab")).otherwise(0))
    made = images.as_voxels(volume.cytoplasm(images.as_slices(voxels, "lab"), images.as_slices(nuclei, "lab").where("z < 4")), "lab", "int")
    joined = made.where("z < 4").alias("c").join(voxels.alias("v"), volume.VOXEL).join(nuclei.alias("n"), volume.VOXEL)
    rows = joined.select(F.col("c.lab").alias("c"), F.col("v.lab").alias("v"), F.col("n.lab").alias("n")).collect()
    assert made.count() == 240 and len(rows) == 192 and all(r.c in (0, r.v) and not (r.c and r.n) for r in rows)


def brute_decouple(cells):
    """cells: {(pseudo_slice, y, x): label} of one slice."""
    found = {}
    for (p, y, x), label in cells.items():
        found.setdefault((label, p), []).append((y, x))
    order = sorted(found)
    paint = {}
    for i, j in itertools.permutations(range(len(order)), 2):
        a, b = found[order[i]], found[order[j]]
        ca, cb = ({v for yx in m for v in yx} for m in (a, b))
        if len(ca & cb) / len(ca | cb) > 0.8:
            winner = order[i] if len(a) >= len(b) else order[j]
            for yx in found[winner]:
                paint[yx] = winner[0]
    return paint


def windows_of(spark, rows):
    """Label slices of windows from rows (stack, z, pseudo_slice, y, x, label); what has no row is 0."""
    found = {}
    for s, z, p, y, x, lab in rows:
        found.setdefault((s, z, p), {})[y, x] = lab
    h, w = (1 + max(at[k] for cells in found.values() for at in cells) for k in (0, 1))
    made = [(s, z, p, h, w, [float(cells.get((y, x), 0)) for y in range(h) for x in range(w)]) for (s, z, p), cells in found.items()]
    return spark.createDataFrame(made, "stack int, z int, pseudo_slice int, height int, width int, pixels array<double>")


def brute_pixel_overlaps(rows, above):
    out = {}
    for z in {r[1] for r in rows}:
        found = {}
        for _, zz, p, y, x, lab in rows:
            if zz == z:
                found.setdefault((lab, p), set()).add((y, x))
        for (i, a), (j, b) in itertools.permutations(enumerate(sorted(found), 1), 2):
            iou = len(found[a] & found[b]) / len(found[a] | found[b])
            if iou > above:
                out[z, i, j] = round(iou, 6)
    return out


def test_decoupling_is_the_brute_force_one(spark):
    rng = random.Random(3)
    for trial in range(3):
        rows = [(0, z, p, y, x, rng.choice([0, 1, 1, 2, 3])) for z in range(3) for p in range(rng.randint(1, 3)) for y in range(4) for x in range(4)]
        df = windows_of(spark, rows)
        got = {}
        for r in images.as_voxels(masks.decoupled(df), "label", "int").where("label >= 0").collect():
            got.setdefault(r.z, {})[r.y, r.x] = r.label
        assert got == {z: b for z in range(3) if (b := brute_decouple({(p, y, x): lab for _, zz, p, y, x, lab in rows if zz == z}))}
        shared = {}
        for r in masks.pixel_overlaps(df, 0.3).collect():
            shared[r.z, r.i, r.j] = r.iou
        assert shared == brute_pixel_overlaps(rows, 0.3)
        assert (masks.decoupled(df, 0.3, iou="pixel").count() > 0) == bool(shared)
    with pytest.raises(ValueError):
        masks.decoupled(df, iou="volume")


def test_windows_are_painted_in_ranges_of_slices(spark):
    rng = np.random.default_rng(3)
    rows = [(7, z, p, 4, 4, rng.integers(0, 3, 16).astype(float).tolist()) for z in range(20) for p in range(z, z + 2)]
    cells = spark.createDataFrame(rows, "stack int, z int, pseudo_slice int, height int, width int, pixels array<double>")
    painted = masks.decoupled(cells)
    assert "FlatMapCoGroupsInArrow" in plan(painted) and "_range" in plan(painted) and "Broadcast" not in plan(painted)
    apart = cells.withColumn("stack", F.col("z")).withColumn("z", F.lit(0))  # a group for each slice
    shown = lambda df, at: {r[at]: r.pixels for r in df.collect()}
    assert shown(painted, "z") and shown(painted, "z") == shown(masks.decoupled(apart), "stack")


def test_linking_rules(spark):
    at = [(0, 0, 1, 0.0, 0.0), (0, 0, 2, 0.0, 9.0), (0, 1, 1, 1.0, 0.0), (0, 1, 2, 0.0, 19.0), (0, 3, 1, 0.0, 0.0), (0, 3, 2, 5.0, 5.0)]
    objects = spark.createDataFrame([(*r, i) for i, r in enumerate(at)], "stack int, slice int, label int, centroid_0 double, centroid_1 double, unique_id long")
    edges = {(r.src, r.dst) for r in linking.edges(objects, 10.0).collect()}
    assert {r.slice for r in linking.edges(objects, 10.0).collect()} == {0}
    assert edges == {(0, 2), (1, 2)}  # the distance 10 itself, and gaps in z, don't link
    found = linking.paths(linking.edges(objects, 10.0))
    assert {(r.node1, r.node2): list(r.path) for r in found.collect()} == {(0, 1): [0, 2, 1], (1, 0): [1, 2, 0], (0, 2): [0, 2], (1, 2): [1, 2]}
    assert {tuple(r.path) for r in linking.longest(found).collect()} == {(0, 2, 1), (1, 2, 0)}
    assert {r.object_number for r in linking.numbered(linking.longest(found), 1).collect()} == {1, 2}
    with pytest.raises(ValueError):
        linking.compartment("organoid")


def test_no_surviving_path_lies_in_a_longer_one(spark, voxels):
    objects = linking.centroids(images.as_slices(voxels, "lab"))
    found = linking.longest(linking.paths(linking.edges(objects, 1.2))).collect()
    for a, b in itertools.permutations(found, 2):
        assert not (a.stack == b.stack and len(a.path) < len(b.path) and set(a.path) <= set(b.path))


def test_edges_are_those_of_all_pairs(spark):
    rng = random.Random(14)
    at = [(s, z, i, rng.choice([rng.uniform(-40, 40), float(rng.randrange(-40, 40))]), rng.uniform(0, 30)) for s in range(2) for z in (0, 1, 2, 4) for i in range(40)]
    objects = spark.createDataFrame([(s, z, lab, y, x, i) for i, (s, z, lab, y, x) in enumerate(at)], "stack int, slice int, label int, centroid_0 double, centroid_1 double, unique_id long")
    for radius in (0.7, 10.0, 500.0):
        want = {(i, j) for (i, a), (j, b) in itertools.permutations(enumerate(at), 2) if a[0] == b[0] and b[1] == a[1] + 1 and ((a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2) ** 0.5 < radius}
        got = [(r.src, r.dst) for r in linking.edges(objects, radius).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_an_object_meets_others_in_few_squares(spark, monkeypatch):
    rng = random.Random(15)
    at = [(0, 1, i, rng.uniform(-900, 900), rng.uniform(-900, 900), i) for i in range(200)]
    objects = spark.createDataFrame([*at, (None, 1, 0, 1.0, 1.0, 300), (0, None, 0, 1.0, 1.0, 301), (0, 1, 0, None, 1.0, 302)], "stack int, slice int, label int, centroid_0 double, centroid_1 double, unique_id long")
    sides, joined = [], linking.joined
    monkeypatch.setattr(linking, "joined", lambda a, b, *more: sides.append((a.count(), b.count())) or joined(a, b, *more))
    assert linking.edges(objects, 10.0).count() == 0
    assert sides == [(203, 4 * 202)]  # one has no place
    edge = [(0, 0, 0, 0.0, 0.0, 0), (0, 1, 0, 10.0, 0.0, 1), (0, 1, 1, -9.999999, 0.0, 2), (0, 1, 2, 0.0, 9.999999, 3), (0, 1, 3, 20.0, 0.0, 4)]
    assert {(r.src, r.dst) for r in linking.edges(spark.createDataFrame(edge, objects.schema), 10.0).collect()} == {(0, 2), (0, 3)}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_edges_are_joined_without_a_broadcast(spark):
    rows = [(s, z, 1, float(s), float(z), z) for s in range(50) for z in range(4)]
    objects = spark.createDataFrame(rows, "stack int, slice int, label int, centroid_0 double, centroid_1 double, unique_id long")
    assert "Broadcast" not in plan(linking.edges(stored(objects), 10.0))


def test_objects_and_paths_meet_without_a_broadcast(spark):
    found = stored(spark.createDataFrame([(0, 1, 2, [1, 2], 1.0, 0)], "stack int, node1 long, node2 long, path array<long>, distance double, object_number int"))
    objects = stored(spark.createDataFrame([(0, z, 1, 0.0, 0.0, z + 1) for z in range(2)], "stack int, slice int, label int, centroid_0 double, centroid_1 double, unique_id long"))
    nodes = stored(linking.path_nodes(objects, found))
    slices = stored(spark.createDataFrame([(0, z, 1, 1, [1.0]) for z in range(2)], images.SLICES))
    for df in (linking.path_nodes(objects, found), linking.longest(found), linking.containers(found), linking.relabelled(slices, nodes)):
        assert "Broadcast" not in plan(df)
    assert "Broadcast" not in plan(slices.join(bounded(slices.groupBy("stack").count(), most=0), "stack"))


def random_links(spark, seed, stacks=6):
    rng = random.Random(seed)
    rows = set()
    for s in range(stacks):
        for z in range(rng.randint(1, 9)):
            for _ in range(rng.randint(0, 5)):
                rows.add((s, z, 10 * z + rng.randrange(4), 10 * (z + 1) + rng.randrange(4)))
    return spark.createDataFrame([(*r, rng.random()) for r in sorted(rows)], "stack int, slice int, src long, dst long, weight double"), rows


def test_paths_by_component_are_those_by_stack(spark):
    links, rows = random_links(spark, 11)
    found = {(r.stack, r.node): r.component for r in linking.components(links).collect()}
    root = {n: n for s, _, a, b in rows for n in ((s, a), (s, b))}

    def find(x):
        return x if root[x] == x else find(root[x])

    for s, _, a, b in rows:
        x, y = sorted((find((s, a)), find((s, b))))
        root[y] = x
    assert found == {n: find(n)[1] for n in root}
    shown = lambda df: sorted((r.stack, r.node1, r.node2, tuple(r.path), round(r.distance, 9)) for r in df.collect())
    whole = shown(linking.paths(links))
    assert whole and shown(linking.paths(links, most_links=0)) == whole and shown(linking.paths(links, most_links=8)) == whole
    assert linking.paths(links.limit(0), 0).count() == 0


def test_longest_paths_compare_candidates_only(spark):
    links, _ = random_links(spark, 12, stacks=25)
    found = linking.paths(links)
    rows = [(r.stack, tuple(r.path)) for r in found.collect()]
    held = {(s, p) for s, p in rows for t, q in rows if s == t and len(q) > len(p) and set(p) <= set(q)}
    assert sorted((r.stack, tuple(r.path)) for r in linking.longest(found).collect()) == sorted(x for x in rows if x not in held)
    by_stack = {s: sum(t == s for t, _ in rows) for s, _ in rows}
    assert 10 * linking.containers(linking.longest(found)).count() < sum(n * n for n in by_stack.values())


def test_paths_and_holders_share_the_shuffle_of_their_index(spark):
    rows = [(0, [1, 2, 3]), (0, [2, 3]), (0, [2, 3]), (0, [3, 4]), (1, [2, 3]), (None, [2, 3]), (0, None), (0, [])]
    found = linking.containers(stored(spark.createDataFrame(rows, "stack int, path array<long>")))
    assert [(r.stack, r.path, r.longer) for r in found.collect()] == [(0, [2, 3], [1, 2, 3])] and found.columns == ["stack", "path", "longer"]
    assert "ReusedExchange" in plan(found)


def test_masks_meet_on_few_coordinates_only(spark):
    rng = random.Random(13)
    rows = []
    for z in range(3):
        for label in range(40):
            y, x, h, w = rng.randrange(60), rng.randrange(60), rng.randint(1, 6), rng.randint(1, 6)
            for p in range(rng.randint(1, 3)):
                rows += [(0, z, p, y + a, x + b, label) for a in range(h) for b in range(w) if rng.random() < 0.95]
    df = windows_of(spark, rows)
    index = masks.mask_index(df).collect()
    want, pairs = set(), 0
    for z in range(3):
        own = sorted((r.label, r.pseudo_slice, {*r.ys, *r.xs}) for r in index if r.z == z)
        for (i, a), (j, b) in itertools.permutations(enumerate(own, 1), 2):
            pairs += i < j
            if len(a[2] & b[2]) / len(a[2] | b[2]) > 0.8:
                want.add((z, i, j))
    ranked = masks.mask_index(df).selectExpr("*", "row_number() over (partition by stack, z order by label, pseudo_slice) i", "array_distinct(concat(ys, xs)) coords")
    met = {(r.z, r.i, r.j) for r in masks.candidates(ranked).collect()}
    assert {(r.z, r.i, r.j) for r in masks.overlaps(masks.mask_index(df)).collect()} == want
    assert {w for w in want if w[1] < w[2]} <= met and 10 * len(met) < pairs


def test_tiff_round_trip(spark, voxels):
    pages = [np.arange(12, dtype="u2").reshape(3, 4), np.full((2, 2), 7, "u1"), np.ones((1, 3), "f4")]
    assert all(np.array_equal(a, b) for a, b in zip(tiff.decode(tiff.encode(pages)), pages))
    with pytest.raises(ValueError):
        tiff.decode(b"nothing")
    back = images.decoded(images.encoded(images.as_slices(voxels))).collect()
    assert len(back) == 15 and sum(sum(r.pixels) for r in back) == voxels.agg(F.sum("v")).first()[0]


def test_kernels():
    rng = np.random.default_rng(0)
    image = rng.random((16, 16))
    smooth = imagemath.gaussian(image, 2.0)
    assert imagemath.power_slope(smooth) < imagemath.power_slope(image) < 1
    assert np.isnan(imagemath.power_slope(np.ones((16, 16))))
    assert smooth.mean() == pytest.approx(image.mean(), rel=0.05)
    assert np.allclose(imagemath.gaussian(np.full((3, 4, 5), 2.0)), 2.0)
    assert np.allclose(whole_volumes.butterworth(np.full((4, 8, 8), 3.0)), 3.0)
    flat = whole_volumes.equalised(image, 0.5)
    assert 0 <= flat.min() and flat.max() <= 1 + 1e-9 and not whole_volumes.equalised(np.ones((4, 4))).any()
    mask = np.array([[1, 1, 0, 1], [0, 1, 0, 1], [1, 0, 0, 1]], bool)
    assert imagemath.components(mask).tolist() == [[1, 1, 0, 2], [0, 1, 0, 2], [3, 0, 0, 2]]
    spots = np.zeros((20, 20))
    spots[2:8, 2:8] = spots[12:18, 12:18] = 5
    spots[10, 0] = 5
    assert imagemath.watershed_segment(spots, 10.0).max() == 2


def plain_components(mask):
    """Labels by flood fill from each pixel in order."""
    out, n = np.zeros(mask.shape, int), 0
    for start in zip(*np.nonzero(mask)):
        if not out[start]:
            n, todo = n + 1, [start]
            while todo:
                y, x = todo.pop()
                if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not out[y, x]:
                    out[y, x] = n
                    todo += [(y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)]
    return out


def plain_flood(level, markers):
    """The watershed's rounds, pixel by pixel over the whole image."""
    h, w = level.shape
    out = np.where(level >= 0, markers, 0)
    for now in range(level.max(initial=-1), -1, -1):
        while True:
            new = out.copy()
            for y, x in itertools.product(range(h), range(w)):
                if level[y, x] >= now and not out[y, x]:
                    beside = [out[a, b] for a, b in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)) if 0 <= a < h and 0 <= b < w and out[a, b]]
                    new[y, x] = min(beside, default=0)
            if (new == out).all():
                break
            out = new
    return out


def test_components_distances_and_flooding_are_the_plain_ones():
    rng = np.random.default_rng(8)
    for trial in range(60):
        h, w = rng.integers(1, 14, 2)
        mask = rng.random((h, w)) < rng.choice([0.3, 0.6, 0.9])
        assert np.array_equal(imagemath.components(mask), plain_components(mask))
        padded = np.pad(mask, 1)
        back = np.argwhere(~padded)
        want = [((back - p - 1) ** 2).sum(axis=1).min() for p in np.argwhere(mask)]
        assert imagemath.squared_distances(mask)[mask].tolist() == want
        level = np.where(mask, rng.integers(0, 4, (h, w)), -1)
        markers = np.where(rng.random((h, w)) < 0.1, rng.integers(1, 5, (h, w)), 0)
        assert np.array_equal(imagemath.flooded(level, markers), plain_flood(level, markers))


def discs(shape, *found):
    y, x = np.indices(shape)
    return np.any([(y - cy) ** 2 + (x - cx) ** 2 <= r * r for cy, cx, r in found], axis=0) * 7.0


def plain_segment(image, diameter, nuclei=None):
    """The default segmenter by definition: every threshold, distance, peak and round in turn."""
    values = np.unique(image)
    best, mask = -1, np.zeros(image.shape, bool)
    for v in values[:-1]:
        low, k = image[image <= v].sum(), (image <= v).sum()
        spread = (low * image.size - image.sum() * k) ** 2 / (k * (image.size - k))
        if spread > best * (1 + 1e-12):
            best, mask = spread, image > v
    part, padded = plain_components(mask), np.pad(mask, 1)
    back = np.argwhere(~padded) - 1
    distance = np.zeros(image.shape, int)
    for p in np.argwhere(mask):
        distance[tuple(p)] = ((back - p) ** 2).sum(axis=1).min()
    seeds = np.zeros(image.shape, int)
    for y, x in sorted(map(tuple, np.argwhere(mask)), key=lambda p: (-distance[p], p)):
        near = distance[max(0, y - 1) : y + 2, max(0, x - 1) : x + 2]
        taken = [p for p in np.argwhere(seeds) if part[tuple(p)] == part[y, x]]
        if distance[y, x] == near.max() and all((p[0] - y) ** 2 + (p[1] - x) ** 2 >= (diameter / 2) ** 2 for p in taken):
            seeds[y, x] = seeds.max() + 1
    if nuclei is not None:
        inner = plain_segment(nuclei, diameter / 2) * mask
        for k in range(1, part.max() + 1):
            own = part == k
            seeds[own] = inner[own] if inner[own].any() else np.where(seeds[own] > 0, seeds[own] + inner.max(), 0)
    label = plain_flood(np.where(mask, np.sqrt(distance).astype(int), -1), seeds)
    names = [n for n in dict.fromkeys(label.ravel().tolist()) if n and (label == n).sum() >= np.pi * diameter**2 / 200]
    return sum(((label == n) * k for k, n in enumerate(names, 1)), np.zeros(image.shape, int))


def test_segment_queries_are_the_plain_ones(spark):
    from slicewise.plans import registry, volume_queries

    d = "/root/testdata/sf0.001"
    slices = stacks(volume_queries.t.slices(spark, d, 20))
    nuclei = stacks(volume_queries.with_nuclei(spark, d).withColumn("pixels", F.col("nuclei")))
    got = stacks(registry.queries()["segment"](spark, d))
    assert all(np.array_equal(got[s], [plain_segment(image, 4.0) for image in v]) for s, v in slices.items())
    for name, model in images.MODELS.items():
        got = stacks(registry.queries()[f"segment_{name}"](spark, d))
        for s, v in slices.items():
            flat = whole_volumes.equalised(v, model["clip_limit"])
            want = np.stack([plain_segment(np.round(image, 9), 4.0, *([nuclei[s][z]] if name == "cell" else [])) for z, image in enumerate(flat)])
            assert np.array_equal(got[s], want if model["stitch"] is None else whole_volumes.stitched(want, model["stitch"])), (name, s)


def plain_decoupled(windows, width):
    """{z: labels} of windows {z: labels}, by the painting of ``brute_decouple``."""
    out, shape = {}, next(iter(windows.values())).shape
    for z in sorted({z + k for z in windows for k in range(width)}):
        cells = {(p, y, x): int(windows[p][y, x]) for p in range(z - width + 1, z + 1) if p in windows for y in range(shape[0]) for x in range(shape[1])}
        paint = brute_decouple(cells)
        if paint:
            out[z] = np.array([[paint.get((y, x), 0) for x in range(shape[1])] for y in range(shape[0])])
    return out


def plain_byte(v, most):
    return np.floor(v / most * 255).astype(int) % 256 if most else np.zeros(v.shape, int)


def plain_objects(labels, radius):
    """{z: object numbers} of one stack's label slices, by all paths in one graph."""
    low, high = min(v.min() for v in labels.values()), max(v.max() for v in labels.values())
    scaled = {z: plain_byte(v - low, high - low) for z, v in labels.items()}
    nodes = []
    for z in sorted(scaled):
        names = [n for n in np.unique(scaled[z]).tolist() if n]
        if len(names) > 1:
            nodes += [(z, n, *np.argwhere(scaled[z] == n).mean(axis=0)) for n in names]
    near = {i: sorted(j for j, b in enumerate(nodes) if abs(b[0] - a[0]) == 1 and np.hypot(a[2] - b[2], a[3] - b[3]) < radius) for i, a in enumerate(nodes)}
    paths = []
    for i in near:
        found, queue = {i: [i]}, [i]
        for n in queue:
            for m in near[n]:
                if m not in found:
                    found[m] = [*found[n], m]
                    queue.append(m)
        paths += [p for m, p in found.items() if m != i and nodes[m][0] >= nodes[i][0]]
    paths = sorted(p for p in paths if not any(len(q) > len(p) and set(p) <= set(q) for q in paths))
    number = {}
    for k, p in enumerate(paths):
        for n in p:
            number[nodes[n][:2]] = max(k, number.get(nodes[n][:2], 0))
    return {z: np.vectorize(lambda v, z=z: number.get((z, v), 0), otypes=[int])(v) for z, v in scaled.items()}


def by_slice(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.stack, {})[r.z] = np.array(r.pixels).reshape(r.height, r.width).astype(int)
    return found


def test_flows_are_the_plain_ones(spark):
    from slicewise.plans import registry, volume_queries

    d, q = "/root/testdata/sf0.001", registry.queries()
    t = volume_queries.t
    slices, blue = stacks(t.slices(spark, d, 20)), stacks(volume_queries.with_nuclei(spark, d).withColumn("pixels", F.col("nuclei")))
    slide = lambda v: [v[i : i + 3].max(axis=0) for i in range(len(v) - 2)]

    def nuclei(v):
        labels = np.stack([plain_segment(np.round(w, 9), 4.0) for w in slide(whole_volumes.equalised(v, 0.05))])
        return plain_decoupled(dict(enumerate(whole_volumes.stitched(labels, 0.8))), 3)

    def cells(v, b):
        windows = {}
        for z, (red, inner) in enumerate(zip(slide(whole_volumes.equalised(v, 0.1)), slide(b))):
            r, n = plain_byte(red, red.max()), plain_byte(inner, inner.max())
            most = max(r.max(), n.max())
            windows[z] = plain_segment(plain_byte(r, most).astype(float), 4.0, plain_byte(n, most).astype(float))
        return plain_decoupled(windows, 3)

    def organoids(v):
        flat = whole_volumes.equalised(v, 0.1)
        smooth = whole_volumes.butterworth(np.stack([imagemath.gaussian(flat[i : i + 3]).max(axis=0) for i in range(len(v) - 2)]))
        labels = whole_volumes.stitched(np.stack([plain_segment(np.round(w, 9), 4.0) for w in smooth]), 0.8)
        return {z: labels[max(0, z - 2) : z + 1].max(axis=0) for z in range(len(v))}

    some = sorted(slices)[:6]
    got = {name: by_slice(q[f"flow_{name}"](spark, d).where(F.col("stack") <= some[-1])) for name in ("nuclei", "cells", "organoids", "cytoplasm")}
    for s in some:
        n, c = nuclei(slices[s]), cells(slices[s], blue[s])
        same = lambda a, b: a.keys() == b.keys() and all(np.array_equal(a[z], b[z]) for z in b)
        assert same(got["nuclei"].get(s, {}), n) and same(got["cells"].get(s, {}), c) and same(got["organoids"][s], organoids(slices[s]))
        assert same(got["cytoplasm"].get(s, {}), {z: np.where(n[z] > 0, 0, v) if z in n else v for z, v in c.items()})
    shallow = stacks(t.slices(spark, d, 5))
    found = by_slice(q["flow_objects"](spark, d))
    numbers = 0
    for s, v in shallow.items():
        want = plain_objects(nuclei(v), 3.0) if nuclei(v) else {}
        assert found.get(s, {}).keys() == want.keys() and all(np.array_equal(found[s][z], want[z]) for z in want)
        numbers = max(numbers, *(w.max() for w in want.values())) if want else numbers
    assert numbers > 1


def test_density_by_bins_is_near_the_plain_one(spark):
    rng = random.Random(9)
    values = [rng.gauss(0, 1) for _ in range(400)] + [rng.gauss(5, 0.5) for _ in range(200)]
    got = quality_control.density(spark.createDataFrame([("a", v) for v in values], "k string, v double"), "v", ["k"]).collect()
    x = np.array(values)
    h = x.std(ddof=1) * len(x) ** -0.2
    want = [np.exp(-0.5 * ((r["at"] - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi)) for r in got]
    assert len(got) == 50 and np.abs(np.array([r.density for r in got]) - want).max() < 1e-3 * max(want)


def test_touching_objects_are_parted_by_their_diameter(spark):
    pair = discs((60, 120), (30, 35, 21), (30, 74, 21))
    found = imagemath.watershed_segment(pair, 40)
    assert imagemath.components(pair > 0).max() == 1 and found.max() == 2
    assert found[30, 20] == 1 and found[30, 90] == 2 and abs((found == 1).sum() - (found == 2).sum()) < 60 and ((found > 0) == (pair > 0)).all()
    assert imagemath.watershed_segment(pair, 200).max() == 1  # one large object at that diameter
    assert imagemath.watershed_segment(np.pad(pair, 8) + 0.0, 40).max() == 2 and not imagemath.watershed_segment(np.ones((5, 5)), 3).any()
    # one cell by its shape, but with two nuclei; and a cell without any
    cell = discs((60, 160), (30, 40, 24), (30, 56, 24), (30, 130, 20))
    nuclei = discs((60, 160), (30, 30, 7), (30, 66, 7))
    assert imagemath.watershed_segment(cell, 48).max() == 2
    both = imagemath.watershed_segment(cell, 48, nuclei)
    assert both.max() == 3 and both[30, 30] == 1 and both[30, 66] == 2 and both[30, 130] == 3 and ((both > 0) == (cell > 0)).all()
    row = lambda *a: (0, 0, 60, 160, *(v.ravel().tolist() for v in a))
    slices = spark.createDataFrame([row(cell, nuclei)], images.SLICES + ", blue array<double>")
    got = images.segmented(slices, 48, second="blue").first()
    assert np.array_equal(np.array(got.pixels).reshape(60, 160), both)
    assert max(images.compartment(slices, "cell", scale=48 / 150, nuclei="blue").first().pixels) == 3
    with pytest.raises(ValueError):
        images.compartment(slices, "nuclei", nuclei="blue")


def gif_frames(data):
    """The frames of a grey GIF, by a plain decoder of its variable-length codes."""
    width, height = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    at, frames = 13 + 768, []
    while data[at] != 0x3B:
        if data[at] == 0x21:
            at += 2
        else:
            assert data[at] == 0x2C and data[at + 10] == 8
            at += 11
        block = b""
        extension = data[at - 2] == 0x21
        while data[at]:
            block, at = block + data[at + 1 : at + 1 + data[at]], at + 1 + data[at]
        at += 1
        if extension:
            continue
        bits, n, out, table, before, size, place = int.from_bytes(block, "little"), len(block) * 8, [], {}, None, 9, 0
        while place + size <= n:
            code, place = bits >> place & (1 << size) - 1, place + size
            if code == 257:
                break
            if code == 256:
                table, before, size = {i: [i] for i in range(256)}, None, 9
                continue
            now = table.get(code) or [*before, before[0]]
            if before is not None:
                table[len(table) + 2] = [*before, now[0]]
                size = 10 if len(table) + 2 >= 512 else size
            out, before = out + now, now
        frames.append(np.array(out).reshape(height, width))
    return frames


def test_animations_hold_their_frames(spark, voxels):
    from slicewise.sources import gif

    rng = np.random.default_rng(1)
    pages = [rng.integers(0, 256, (30, 41)).astype("u1") for _ in range(3)]
    assert all(np.array_equal(a, b) for a, b in zip(gif_frames(gif.encode(pages)), pages, strict=True))
    films = images.animated(images.as_slices(voxels)).collect()
    assert sum(len(gif_frames(r.content)) for r in films) == 15


def test_volumes_are_equalised_as_a_whole():
    rng = np.random.default_rng(4)
    volume = rng.random((10, 16, 16))
    flat = whole_volumes.equalised(volume, 0.5)
    assert flat.shape == volume.shape and 0 <= flat.min() and flat.max() <= 1 + 1e-9
    assert not np.allclose(flat[0], whole_volumes.equalised(volume[0], 0.5))
    one = whole_volumes.equalised(volume, 1.0, tiles=1)  # one tile without clipping is plain equalisation
    level = np.minimum(((volume - volume.min()) / np.ptp(volume) * 256).astype(int), 255)
    share = np.cumsum(np.bincount(level.ravel(), minlength=256)) / volume.size
    assert np.allclose(one, share[level])


def test_labels_go_on_through_z():
    a = np.zeros((4, 10), int)
    a[:, :5], a[:, 6:] = 1, 2
    b = a.copy()
    b[b == 1], b[b == 2] = 3, 1
    c = b.copy()
    c[:, 7:] = 4  # 12 of 16 pixels left: under 0.8
    got = whole_volumes.stitched(np.stack([a, b, c, np.zeros_like(a), a]), 0.8)
    assert np.array_equal(got[0], a) and np.array_equal(got[1], a)
    assert set(np.unique(got[2][:, :5])) == {1} and set(np.unique(got[2][:, 7:])) == {4} and set(np.unique(got[2][:, 6])) == {3}
    assert not got[3].any() and got[4].max() > got[2].max()


def test_rules_of_paths_and_compartments(spark):
    from slicewise.operators import paths

    rows = ["/r/a/b/c/i.tif", "/r/a/b/c/d/i.TIFF", "/r/a/b/x.tif", "/r/a/b/c/j.png", "/q/a/b/c/k.tif", "/r/z/b/c/i.tif"]
    df = spark.createDataFrame([(r,) for r in rows], "path string")
    got = {(r.folder, r.file): r.path for r in paths.flattened(df, "/r").collect()}
    assert got == {("b", "i.tif"): "/r/z/b/c/i.tif", ("b", "i.TIFF"): rows[1], ("c", "i.TIFF"): rows[1]}
    for f in (paths.decoupling_files, paths.video_files):
        with pytest.raises(ValueError):
            f(df, "organoid")
    with pytest.raises(ValueError):
        images.compartment(None, "membrane")


def test_measurements_as_a_stream(spark, tmp_path):
    from slicewise.streaming import ingest

    rows = [(f"2024-01-01 00:0{i}:00", "p" if i % 2 else "q", i > 3) for i in range(8)]
    spark.createDataFrame(rows, "t string, plate string, failed boolean").select(F.to_timestamp("t").alias("t"), "plate", "failed").write.parquet(str(tmp_path / "in"))
    stream = ingest.measurements(spark, str(tmp_path / "in"), "t timestamp, plate string, failed boolean")
    query = ingest.failed_by_window(stream, "t", "failed").writeStream.outputMode("complete").format("memory").queryName("failed_by_window").start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r.plate, r.failed, r.slices) for r in spark.table("failed_by_window").collect()) == [("p", 2, 4), ("q", 2, 4)]
