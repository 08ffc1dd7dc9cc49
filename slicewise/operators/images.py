"""Array kernels applied to slice rows (stack, z, height, width, pixels): a slice is one row, its pixels one array.

Pixels are in row order, so a slice costs one row however large it is, and kernels of single slices need no
shuffle. Operators that look across slices never gather a volume: a task holds two slices, a few neighbouring
ones, or a strip of all of them. Slices of a stack are of one shape.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicewise.functions import imagemath
from slicewise.sources import gif, tiff
from slicewise.sources.shared import bounded, joined, stored

SHAPE = ["stack", "z", "height", "width"]
SLICES = "stack int, z int, height int, width int, pixels array<double>"
SLICE_TYPE = pa.schema([("stack", pa.int32()), ("z", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("pixels", pa.list_(pa.float64()))])

#: Settings of the three models: expected diameter in pixels, clip limit of the equalisation before (none if
#: null), and overlap from which objects of adjacent slices are one (not stitched if null). Fixed values.
MODELS = {
    "nuclei": {"diameter": 75, "clip_limit": 0.05, "stitch": 0.8},
    "cell": {"diameter": 150, "clip_limit": 0.1, "stitch": None},
    "organoid": {"diameter": 750, "clip_limit": 0.1, "stitch": 0.8},
}
#: Tiles along each axis and levels of an equalisation; complex numbers of a slice in a strip of the transform along z.
TILES, BINS, STRIP = 8, 256, 1 << 16


def as_slices(voxels: DataFrame, value: str = "v") -> DataFrame:
    """Slice rows of voxel rows (stack, z, y, x, value) that fill their rectangles."""
    rows = F.sort_array(F.collect_list(F.struct("y", "x", F.col(value).cast("double").alias("p"))))
    found = voxels.groupBy("stack", "z").agg(rows.alias("_r"), F.count_distinct("y").cast("int").alias("height"), F.count_distinct("x").cast("int").alias("width"))
    return found.select("stack", "z", "height", "width", F.col("_r.p").alias("pixels"))


def as_voxels(slices: DataFrame, value: str = "v", kind: str = "double", pixels: str = "pixels") -> DataFrame:
    """Voxel rows of slice rows."""
    long = slices.select("stack", "z", "width", F.posexplode(pixels).alias("_at", value))
    return long.select("stack", "z", F.expr("cast(_at div width as int)").alias("y"), (F.col("_at") % F.col("width")).alias("x"), F.col(value).cast(kind).alias(value))


def arrays(t: pa.Table | pa.RecordBatch, column: str = "pixels") -> list[np.ndarray]:
    """The images of a list column, as views of its flat values: no Python object for each pixel."""
    lists = t[column].combine_chunks() if isinstance(t, pa.Table) else t[column]
    flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    shapes = zip(t["height"].to_pylist(), t["width"].to_pylist())
    return [flat[at[i] : at[i + 1]].reshape(shape) for i, shape in enumerate(shapes)]


def _lists(images: list[np.ndarray]) -> pa.Array:
    """A list column of images; the counterpart of ``_arrays``."""
    ends = np.cumsum([0, *(image.size for image in images)]).astype(np.int32)
    flat = np.concatenate([np.asarray(image, np.float64).ravel() for image in images]) if images else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def rows_of(stack: int, made: list[tuple[int, np.ndarray]]) -> pa.Table:
    """A table of slices (z, image) of one stack."""
    ints = [[stack] * len(made), [z for z, _ in made], *([image.shape[k] for _, image in made] for k in (0, 1))]
    return pa.Table.from_arrays([*(pa.array(c, pa.int32()) for c in ints), _lists([image for _, image in made])], schema=SLICE_TYPE)


def per_slice(slices: DataFrame, kernel: Callable[..., np.ndarray], *more: str) -> DataFrame:
    """Apply ``kernel`` to the image of each slice, and those of the columns ``more``; it keeps the shape. No shuffle."""

    def work(batches):
        for b in batches:
            made = [kernel(*images) for images in zip(*(arrays(b, c) for c in ("pixels", *more)))]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in SHAPE), _lists(made)], schema=SLICE_TYPE)

    return slices.select(*SHAPE, "pixels", *more).mapInArrow(work, SLICES)


def per_range(slices: DataFrame, before: int, after: int, kernel: Callable[[int, int, dict[int, np.ndarray]], Iterator[tuple[int, np.ndarray]]]) -> DataFrame:
    """Slices that depend on neighbours: ``kernel(first, last, images)`` makes (z, image) for z from first to last.

    ``images`` holds, by z, the slices from first - before to last + after that there are. Ranges of z are
    Spark groups; slices near an edge also go to the range beside it, so a task holds a range and its halo.
    """
    size = max(8, before + after)

    def work(t):
        images = dict(zip(t["z"].to_pylist(), arrays(t)))
        first = t["_range"][0].as_py() * size
        return rows_of(t["stack"][0].as_py(), list(kernel(first, first + size - 1, images)))

    ranges = F.sequence(F.floor((F.col("z") - after) / size), F.floor((F.col("z") + before) / size))
    return slices.select(*SHAPE, "pixels", F.explode(ranges.cast("array<int>")).alias("_range")).groupBy("stack", "_range").applyInArrow(work, SLICES)


def sliding_max(slices: DataFrame, width: int) -> DataFrame:
    """Maximum over slices z .. z + width - 1 at each pixel; only windows whose slices are all there.

    Two passes whatever the width: maxima up to and from the cuts between blocks of ``width`` slices; a
    window lies in two blocks at most, so it is the greater of one of each.
    """

    def kernel(first, last, images):
        ahead: dict[int, np.ndarray] = {}
        back: dict[int, np.ndarray] = {}
        for z in sorted(images):
            ahead[z] = np.maximum(ahead[z - 1], images[z]) if (z - first) % width and z - 1 in ahead else images[z]
        for z in sorted(images, reverse=True):
            back[z] = np.maximum(back[z + 1], images[z]) if (z + 1 - first) % width and z + 1 in back else images[z]
        for z in range(first, last + 1):
            if all(z + k in images for k in range(width)):
                yield z, np.maximum(back[z], ahead[z + width - 1])

    return per_range(slices, 0, width - 1, kernel)


def merged_windows(windows: DataFrame, width: int, depth: int | None = None) -> DataFrame:
    """The inverse for labels: a slice (below ``depth``) has at each pixel the largest label of the windows that hold it.

    Window z holds slices z .. z + width - 1; slices that no window holds don't come.
    """

    def kernel(first, last, images):
        end = min(last, max(images) + width - 1)
        for z in range(max(first, min(images)), (end if depth is None else min(end, depth - 1)) + 1):
            near = [images[k] for k in range(z - width + 1, z + 1) if k in images]
            if near:
                yield z, np.maximum.reduce(near)

    return per_range(windows, width - 1, 0, kernel)


def blurred_maximum(slices: DataFrame, width: int, sigma: float = 1.0) -> DataFrame:
    """Each window of ``width`` slices is blurred as a volume, then projected to its maximum."""

    def kernel(first, last, images):
        for z in range(first, last + 1):
            if all(z + k in images for k in range(width)):
                yield z, imagemath.gaussian(np.stack([images[z + k] for k in range(width)]), sigma).max(axis=0)

    return per_range(slices, 0, width - 1, kernel)


def equalised(slices: DataFrame, clip_limit: float = 0.05) -> DataFrame:
    """Contrast-limited adaptive histogram equalisation of whole volumes to 0..1; constant ones give zeros.

    Each axis is cut into up to TILES parts and the stack's range into BINS levels. A tile's histogram is clipped at
    ``clip_limit`` of its pixels and the excess dealt evenly; a pixel blends the maps of the nearest two tiles
    along each axis. Histograms are an aggregation over (stack, tile, level), a small table with a row for the
    layer of tiles of each part of z; a slice meets the two layers beside it and makes their clipped maps. Its pixels move
    once. Slices of a stack follow each other in z.
    """
    ranges = bounded(slices.groupBy("stack").agg(
        F.min(F.array_min("pixels")).alias("_low"), F.max(F.array_max("pixels")).alias("_high"), F.min("z").alias("_first"), (F.max("z") - F.min("z") + 1).alias("_depth")))
    known = slices.select(*SHAPE, "pixels").join(ranges, "stack")

    def count(batches):
        for b in batches:
            low, high, first, depth, stack, z = (b[c].to_numpy() for c in ("_low", "_high", "_first", "_depth", "stack", "z"))
            layers, found = [], []
            for i, image in enumerate(arrays(b)):
                layers.append(imagemath.tile_of(int(depth[i]), TILES)[z[i] - first[i]])
                tile, _ = imagemath.tiles_of(image.shape, TILES)
                found.append(np.unique(tile * BINS + imagemath.levels(image, low[i], high[i], BINS), return_counts=True))
            sizes = [len(cell) for cell, _ in found]
            cell, n = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*found) if found else ([], [])))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(stack, sizes)), pa.array(np.repeat(np.array(layers, np.int32), sizes)), pa.array(cell), pa.array(n)], names=["stack", "layer", "cell", "n"])

    counts = known.mapInArrow(count, "stack int, layer int, cell long, n long").groupBy("stack", "layer", "cell").agg(F.sum("n").alias("n"))
    layers = counts.groupBy("stack", "layer").agg(F.collect_list(F.struct(F.col("cell").cast("int").alias("cell"), "n")).alias("layer_counts"))

    def beside(batches):
        """Which layers a slice blends, and the share of the second: rows (stack, z, layer, second, share)."""
        for b in batches:
            out = [[], [], [], [], []]
            for stack, first, depth in zip(*(b[c].to_pylist() for c in ("stack", "_first", "_depth"))):
                (at, near), (after, share) = imagemath.blend(depth, TILES)
                for second, layer in ((0, at), (1, after)):
                    for column, x in zip(out, ([stack] * depth, range(first, first + depth), layer.tolist(), [second] * depth, share.tolist())):
                        column.extend(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()))], names=["stack", "z", "layer", "second", "share"])

    places = ranges.select("stack", "_first", "_depth").mapInArrow(beside, "stack int, z int, layer int, second int, share double")
    pairs = joined(places, layers, ["stack", "layer"]).groupBy("stack", "z").agg(
        *(F.max(F.when(F.col("second") == k, F.col("layer_counts"))).alias(f"_c{k}") for k in (0, 1)), F.max("share").alias("_share"))
    pairs = pairs.select("stack", "z", "_share", *(F.col(f"_c{k}.{c}").alias(f"_{c}{k}") for k in (0, 1) for c in ("cell", "n")))

    def blend(batches):
        for b in batches:
            made, shapes = [], zip(b["height"].to_pylist(), b["width"].to_pylist())
            low, high, share = (b[c].to_numpy() for c in ("_low", "_high", "_share"))
            for i, (image, shape) in enumerate(zip(arrays(b), shapes)):
                if low[i] == high[i]:
                    made.append(np.zeros(shape))
                    continue
                maps = []
                for k in (0, 1):
                    dense = np.zeros(imagemath.tiles_of(shape, TILES)[1] * BINS)
                    dense[b[f"_cell{k}"][i].values.to_numpy()] = b[f"_n{k}"][i].values.to_numpy()
                    maps.append(imagemath.clipped_maps(dense.reshape(-1, BINS), clip_limit))
                made.append(imagemath.mapped(imagemath.levels(image, low[i], high[i], BINS), maps, share[i], TILES))
            yield pa.RecordBatch.from_arrays([*(b[c] for c in SHAPE), _lists(made)], schema=SLICE_TYPE)

    return joined(known, pairs, ["stack", "z"]).mapInArrow(blend, SLICES)


def low_pass(slices: DataFrame, cutoff: float = 0.1, order: int = 5) -> DataFrame:
    """Squared Butterworth low-pass of whole volumes; ``cutoff`` is a share of the sampling frequency.

    The transform goes axis by axis: each slice is transformed in its plane, rows of it travel as strips, a strip of
    all slices is transformed along z, damped and turned back, and slices are put together again. A task holds
    a slice, or STRIP numbers of each slice of a stack.
    """
    complex_strip = "stack int, z int, height int, width int, _strip int, _part binary"
    names = [*SHAPE, "_strip", "_part"]

    def cut(shape: tuple[int, int]) -> int:
        return max(1, STRIP // (shape[1] // 2 + 1))

    def plane(batches):
        for b in batches:
            rows = []
            for z, stack, image in zip(b["z"].to_pylist(), b["stack"].to_pylist(), arrays(b)):
                turned, step = np.fft.rfft2(image), cut(image.shape)
                rows += [(stack, z, *image.shape, k // step, turned[k : k + step].tobytes()) for k in range(0, len(turned), step)]
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns[:5]), pa.array(columns[5], pa.binary())], names=names)

    def along(t):
        t = t.combine_chunks().sort_by("z")
        shape, strip = (t["height"][0].as_py(), t["width"][0].as_py()), t["_strip"][0].as_py()
        half, step, depth = shape[1] // 2 + 1, cut(shape), t.num_rows
        rows = np.stack([np.frombuffer(p, complex).reshape(-1, half) for p in t["_part"].to_pylist()])
        y = np.fft.fftfreq(shape[0])[strip * step : strip * step + rows.shape[1]]
        squares = (np.fft.fftfreq(depth)[:, None, None] ** 2 + y[None, :, None] ** 2 + np.fft.rfftfreq(shape[1])[None, None, :] ** 2) / cutoff**2
        rows = np.fft.ifft(np.fft.fft(rows, axis=0) / (1 + squares**order), axis=0)
        return t.set_column(5, "_part", pa.array([r.tobytes() for r in rows], pa.binary()))

    def back(t):
        t = t.combine_chunks().sort_by("_strip")
        shape = t["height"][0].as_py(), t["width"][0].as_py()
        turned = np.frombuffer(b"".join(t["_part"].to_pylist()), complex).reshape(shape[0], -1)
        return rows_of(t["stack"][0].as_py(), [(t["z"][0].as_py(), np.fft.irfft2(turned, shape))])

    strips = slices.select(*SHAPE, "pixels").mapInArrow(plane, complex_strip)
    return strips.groupBy("stack", "_strip").applyInArrow(along, complex_strip).groupBy("stack", "z").applyInArrow(back, SLICES)


def segmented(slices: DataFrame, diameter: float, segment: Callable[..., np.ndarray] = imagemath.watershed_segment, second: str | None = None) -> DataFrame:
    """Labels of each slice by a pluggable model ``segment(image, diameter[, second image])``; pixels are labels.

    ``second`` names a column with another channel of the slices, such as the nuclei of cells.
    """
    return per_slice(slices, lambda image, *other: segment(image, diameter, *other), *([second] if second else []))


def overlaps(slices: DataFrame) -> DataFrame:
    """(stack, z, label, before, common, area, area_before): objects of a slice and of the slice before that share pixels.

    Slices meet the ones before them in a join, and a task holds two at a time.
    """
    earlier = slices.select("stack", (F.col("z") + 1).alias("z"), F.col("pixels").alias("_before"))

    def work(batches):
        for b in batches:
            made = [[np.zeros(0, np.int64)] * 7]
            for stack, z, now, old in zip(b["stack"].to_pylist(), b["z"].to_pylist(), arrays(b), arrays(b, "_before")):
                now, old = now.astype(np.int64), old.astype(np.int64)
                both = (now > 0) & (old > 0)
                pairs, common = np.unique(np.stack([now[both], old[both]]), axis=1, return_counts=True)
                area = [n[np.searchsorted(names, p)] for (names, n), p in zip((np.unique(a, return_counts=True) for a in (now, old)), pairs)]
                made.append((np.full(len(common), stack), np.full(len(common), z), *pairs, common, *area))
            out = [np.concatenate(c) for c in zip(*made)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(out, ("i4", "i4", "i8", "i8", "i8", "i8", "i8"))], names=names)

    names = ["stack", "z", "label", "before", "common", "area", "area_before"]
    return joined(slices.select(*SHAPE, "pixels"), earlier, ["stack", "z"]).mapInArrow(work, "stack int, z int, label long, before long, common long, area long, area_before long")


def close_overlaps(slices: DataFrame, least_overlap: float = 0.8) -> DataFrame:
    """(stack, z, label, next_label, iou): objects of adjacent slices whose overlap over union reaches ``least_overlap``."""
    iou = F.col("common") / (F.col("area") + F.col("area_before") - F.col("common"))
    return overlaps(slices).where(iou >= least_overlap).select("stack", (F.col("z") - 1).alias("z"), F.col("before").alias("label"), F.col("label").alias("next_label"), F.round(iou, 6).alias("iou"))


def labels_of(slices: DataFrame) -> DataFrame:
    """(stack, z, label) of the objects in each slice."""
    return slices.select("stack", "z", F.explode(F.array_distinct("pixels")).alias("_p")).where("_p > 0").select("stack", "z", F.col("_p").cast("long").alias("label"))


def renamed(slices: DataFrame, names: DataFrame) -> DataFrame:
    """Label slices with the ``object`` that ``names`` (stack, z, label, object) has for each label, else 0.

    Names fold to one list for each slice, which meets the slice; pixels stay arrays.
    """
    lists = names.groupBy("stack", "z").agg(F.sort_array(F.collect_list(F.struct(F.col("label").cast("double").alias("label"), F.col("object").cast("double").alias("object")))).alias("_names"))
    found = joined(slices.select(*SHAPE, "pixels"), lists.select("stack", "z", F.col("_names.label").alias("_from"), F.col("_names.object").alias("_to")), ["stack", "z"], "left")

    def work(batches):
        for b in batches:
            made = []
            for i, image in enumerate(arrays(b)):
                if not b["_from"][i].is_valid:
                    made.append(np.zeros(image.shape))
                    continue
                old, new = (b[c][i].values.to_numpy() for c in ("_from", "_to"))
                at = np.minimum(np.searchsorted(old, image), len(old) - 1)
                made.append(np.where(old[at] == image, new[at], 0))
            yield pa.RecordBatch.from_arrays([*(b[c] for c in SHAPE), _lists(made)], schema=SLICE_TYPE)

    return found.mapInArrow(work, SLICES)


def stitched(slices: DataFrame, least_overlap: float = 0.8) -> DataFrame:
    """Label slices with one label for each object through z.

    An object continues the one of the slice before that it overlaps most, by overlap over union of
    ``least_overlap`` or more, if it is also the one that overlaps that most (the smaller label in a tie).
    Objects number from 1 within a stack, by their first slice and label. Overlaps are counted for each pair of
    slices; links are rows, and each object finds the first of its chain by doubling pointers, in as many rounds as
    the longest chain's logarithm.
    """
    iou = F.col("common") / (F.col("area") + F.col("area_before") - F.col("common"))
    close = overlaps(slices).select("stack", "z", "label", "before", iou.alias("iou")).where(F.col("iou") >= least_overlap)
    most = close.withColumn("_most", F.max("iou").over(Window.partitionBy("stack", "z", "before"))).where("iou = _most")
    link = most.groupBy("stack", "z", "label").agg(F.min(F.struct(-F.col("iou"), "before"))["before"].alias("label0"))
    own = F.struct(F.col("z").alias("z0"), F.col("label").alias("label0"))
    at = joined(labels_of(slices), link, ["stack", "z", "label"], "left")
    at = at.select("stack", "z", "label", F.when(F.col("label0").isNull(), own).otherwise(F.struct((F.col("z") - 1).alias("z0"), "label0")).alias("first"))
    at = stored(at.select("stack", "z", "label", "first.z0", "first.label0"))
    while True:
        to = at.select("stack", F.col("z").alias("z0"), F.col("label").alias("label0"), F.col("z0").alias("_z"), F.col("label0").alias("_label"))
        on = stored(joined(at, to, ["stack", "z0", "label0"]).select("stack", "z", "label", F.col("_z").alias("z0"), F.col("_label").alias("label0"), (F.col("_z") != F.col("z0")).alias("moved")))
        moved = on.where("moved").limit(1).count()
        at = on.drop("moved")
        if not moved:
            break
    roots = at.where("z = z0").select("stack", "z0", "label0", F.row_number().over(Window.partitionBy("stack").orderBy("z0", "label0")).alias("object"))
    return renamed(slices, joined(at, roots, ["stack", "z0", "label0"]).select("stack", "z", "label", "object"))


def compartment(slices: DataFrame, name: str, segment: Callable[..., np.ndarray] = imagemath.watershed_segment, scale: float = 1.0, nuclei: str | None = None) -> DataFrame:
    """Labels by the settings of one of MODELS; ``scale`` fits its diameter to smaller images.

    Cells may have a second channel: ``nuclei`` names its column, which isn't equalised.
    """
    if name not in MODELS:
        raise ValueError(f"compartment must be one of {tuple(MODELS)}, not {name!r}")
    if nuclei and name != "cell":
        raise ValueError("only cells are segmented with their nuclei")
    model = MODELS[name]
    flat = equalised(slices, model["clip_limit"])
    if nuclei:
        flat = flat.join(slices.select("stack", "z", F.col(nuclei).alias("nuclei")), ["stack", "z"])
    found = segmented(flat, model["diameter"] * scale, segment, "nuclei" if nuclei else None)
    return found if model["stitch"] is None else stitched(stored(found), model["stitch"])


def power_slopes(slices: DataFrame) -> DataFrame:
    """(stack, z, slope): log-log slope of each slice's power spectrum; null where there is none. No shuffle."""

    def work(batches):
        for b in batches:
            slopes = np.array([imagemath.power_slope(image) for image in arrays(b)], float)
            yield pa.RecordBatch.from_arrays([b["stack"], b["z"], pa.array(slopes, pa.float64(), mask=np.isnan(slopes))], names=["stack", "z", "slope"])

    return slices.select("stack", "z", "height", "width", "pixels").mapInArrow(work, "stack int, z int, slope double")


def decoded(files: DataFrame, decode: Callable[[bytes], list[np.ndarray]] = tiff.decode) -> DataFrame:
    """(path, page, height, width, pixels) of image ``files`` (path, content), as from the binaryFile source: TIFF, or what ``decode`` reads."""

    def work(batches):
        for b in batches:
            for path, content in zip(b["path"].to_pylist(), b["content"]):
                pages = decode(content.as_py()) if content.is_valid and content.as_py() else []
                ints = [list(range(len(pages))), [p.shape[0] for p in pages], [p.shape[1] for p in pages]]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(pages), pa.string()), *(pa.array(c, pa.int32()) for c in ints), _lists(pages)], names=["path", "page", "height", "width", "pixels"])

    return files.select("path", "content").mapInArrow(work, "path string, page int, height int, width int, pixels array<double>")


def _files(slices: DataFrame, name: Callable[[int], str], encode: Callable[[list[np.ndarray]], bytes]) -> DataFrame:
    """(path, content): one file for each stack, of its slices in z order."""

    def work(t):
        t = t.sort_by("z")
        return pa.table({"path": [name(t["stack"][0].as_py())], "content": pa.array([encode(arrays(t))], pa.binary())})

    return slices.select("stack", "z", "height", "width", "pixels").groupBy("stack").applyInArrow(work, "path string, content binary")


def encoded(slices: DataFrame) -> DataFrame:
    """(path, content): each stack as a TIFF file of 16-bit pages (see ``files.write_files``)."""
    return _files(slices, lambda stack: f"stack{stack}.tif", lambda pages: tiff.encode([np.clip(p, 0, 65535).astype("u2") for p in pages]))


def animated(slices: DataFrame, hundredths: int = 10, loops: int = 10) -> DataFrame:
    """(path, content): each stack as an animated GIF, a frame for each slice; pixels wrap at 256."""
    return _files(slices, lambda stack: f"stack{stack}.gif", lambda pages: gif.encode([(p.astype(int) % 256).astype("u1") for p in pages], hundredths, loops))
