"""Array kernels that SQL functions can't express, for use inside Arrow-backed functions."""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np


def power_slope(image: np.ndarray) -> float:
    """Slope of log power against log frequency of the radially averaged spectrum; steeper is blurrier.

    NaN for images under 4 pixels on a side or without contrast.
    """
    h, w = image.shape
    if min(h, w) < 4 or np.ptp(image) == 0:
        return float("nan")
    power = np.abs(np.fft.fftshift(np.fft.fft2(image - image.mean()))) ** 2
    y, x = np.indices(power.shape)
    radius = np.hypot(y - h // 2, x - w // 2).astype(int)
    total = np.bincount(radius.ravel(), power.ravel())
    mean = total / np.maximum(1, np.bincount(radius.ravel()))
    r = np.arange(1, min(h, w) // 2 + 1)
    mean = mean[r]
    good = mean > 0
    if good.sum() < 2:
        return float("nan")
    return float(np.polyfit(np.log(r[good]), np.log(mean[good]), 1)[0])


def gaussian(volume: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Separable Gaussian blur of every axis, edges reflected, kernel cut at four sigma."""
    reach = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    k /= k.sum()
    out = volume.astype(float)
    for axis in range(out.ndim):
        n = out.shape[axis]
        at = np.arange(-reach, n + reach)
        at = np.where((at // n) % 2 == 0, at % n, n - 1 - at % n)  # reflect, the edge repeated
        moved = np.moveaxis(out, axis, -1)[..., at]
        out = np.moveaxis(np.apply_along_axis(lambda v: np.convolve(v, k, "valid"), -1, moved), -1, axis)
    return out


def cuts(length: int, tiles: int) -> np.ndarray:
    """Edges of up to ``tiles`` nearly equal parts of an axis."""
    n = min(tiles, length)
    return np.arange(n + 1) * length // n


@lru_cache(maxsize=64)
def tile_of(length: int, tiles: int) -> np.ndarray:
    """The part that each position of an axis lies in."""
    return np.searchsorted(cuts(length, tiles), np.arange(length), side="right") - 1


@lru_cache(maxsize=64)
def tiles_of(shape: tuple[int, int], tiles: int) -> tuple[np.ndarray, int]:
    """The tile of each pixel of an image, and the number of tiles."""
    y, x = (tile_of(n, tiles) for n in shape)
    wide = min(tiles, shape[1])
    return y[:, None] * wide + x[None, :], min(tiles, shape[0]) * wide


def levels(image: np.ndarray, low: float, high: float, bins: int) -> np.ndarray:
    """Values from ``low`` to ``high`` as whole levels from 0; one level if they are equal."""
    if low == high:
        return np.zeros(image.shape, int)
    return np.minimum(((image - low) / (high - low) * bins).astype(int), bins - 1)


def clipped_maps(counts: np.ndarray, clip_limit: float) -> np.ndarray:
    """For each row of counts: the share of pixels up to each level, after counts over ``clip_limit`` of all are cut and
    the excess is dealt evenly."""
    size, bins = counts.sum(axis=1, keepdims=True), counts.shape[1]
    most = np.maximum(clip_limit * size, size / bins)
    return np.cumsum(np.minimum(counts, most) + np.maximum(counts - most, 0).sum(axis=1, keepdims=True) / bins, axis=1) / size


@lru_cache(maxsize=64)
def blend(length: int, tiles: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """The two parts of an axis whose middles are beside each position, and their shares."""
    edges = cuts(length, tiles)
    middle = (edges[:-1] + edges[1:] - 1) / 2
    at = np.clip(np.searchsorted(middle, np.arange(length), side="right") - 1, 0, len(middle) - 1)
    after = np.minimum(at + 1, len(middle) - 1)
    share = np.clip((np.arange(length) - middle[at]) / np.where(after > at, middle[after] - middle[at], 1), 0, 1)
    return (at, 1 - share), (after, share)


@lru_cache(maxsize=64)
def corners(shape: tuple[int, int], tiles: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The four tiles of a layer beside each pixel of a slice, and their shares."""
    wide = min(tiles, shape[1])
    pairs = itertools.product(*(blend(n, tiles) for n in shape))
    return [(y[:, None] * wide + x[None, :], of_y[:, None] * of_x[None, :]) for (y, of_y), (x, of_x) in pairs]


def mapped(level: np.ndarray, maps: list[np.ndarray], share: float, tiles: int) -> np.ndarray:
    """A slice's levels by the maps (tiles, levels) of the two layers beside it, the second by ``share``, blended in its plane."""
    near = corners(level.shape, tiles)
    return sum(of_z * of_yx * layer[tile, level] for layer, of_z in zip(maps, (1 - share, share)) for tile, of_yx in near)


def components(mask: np.ndarray) -> np.ndarray:
    """Labels from 1 of 4-connected foreground, in order of first pixel; 0 is background.

    Runs of a row are the nodes, runs that touch in the next row the edges; roots are found by hooking the
    greater root to the lesser and doubling pointers, so rounds grow with the logarithm of the runs.
    """
    h, w = mask.shape
    step = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(step == 1)
    last = np.nonzero(step == -1)[1] - 1
    if not len(row):
        return np.zeros(mask.shape, int)
    # the runs of the next row that a run touches are neighbours in order
    low = np.searchsorted(row * (w + 1) + last, (row + 1) * (w + 1) + first)
    n = np.maximum(np.searchsorted(row * (w + 1) + first, (row + 1) * (w + 1) + last, side="right") - low, 0)
    a = np.repeat(np.arange(len(row)), n)
    b = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    root = np.arange(len(row))
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            break
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]
    number = np.unique(root, return_inverse=True)[1] + 1
    out = np.zeros(h * w + 1, int)
    start, end = row * w + first, row * w + last + 1
    np.add.at(out, start, number)
    np.add.at(out, end, -number)
    return np.cumsum(out)[:-1].reshape(h, w)


def otsu(image: np.ndarray) -> np.ndarray:
    """Pixels over the threshold that parts the values best (the lesser of two); none in a constant image."""
    flat = np.sort(image.ravel().astype(float))
    n, total = len(flat), flat.sum()
    if not n or flat[0] == flat[-1]:
        return np.zeros(image.shape, bool)
    left = np.cumsum(flat)[:-1]
    k = np.arange(1, n)
    between = np.where(flat[1:] > flat[:-1], (left * n - total * k) ** 2 / (k * (n - k)), -1)  # whole numbers tie exactly
    return image > flat[int(np.argmax(between))]


def squared_distances(mask: np.ndarray) -> np.ndarray:
    """Squared distance of each foreground pixel from the nearest background pixel; the image's border is background.

    Exact: distances within columns first, then the least of (column distance^2 + k^2) over offsets k along a
    row, for as many k as can still be less.
    """
    inside = np.pad(mask, 1)
    h, w = inside.shape
    place = np.arange(h)[:, None]
    above = np.maximum.accumulate(np.where(inside, -1, place), axis=0)
    below = np.minimum.accumulate(np.where(inside, h, place)[::-1], axis=0)[::-1]
    column = np.minimum(place - above, below - place) ** 2
    out = column.copy()
    k = 1
    while k < w and k * k < out.max():
        out[:, k:] = np.minimum(out[:, k:], column[:, :-k] + k * k)
        out[:, :-k] = np.minimum(out[:, :-k], column[:, k:] + k * k)
        k += 1
    return out[1:-1, 1:-1]


def _beside(shape: tuple[int, int], at: np.ndarray) -> np.ndarray:
    """(4, n): flat places of the 4-neighbours, -1 outside the image."""
    h, w = shape
    y, x = np.divmod(at, w)
    return np.stack([np.where(y > 0, at - w, -1), np.where(x > 0, at - 1, -1), np.where(x < w - 1, at + 1, -1), np.where(y < h - 1, at + w, -1)])


def flooded(level: np.ndarray, markers: np.ndarray) -> np.ndarray:
    """Watershed from ``markers`` (labels, 0 none) over the pixels with ``level`` >= 0, from the highest level down.

    At each level, rounds label every unlabelled pixel of that level or above that has a labelled 4-neighbour,
    all at once, with the least label beside it, until none is left; then the next level comes. Pixels that no
    marker reaches stay 0. Work is in proportion to the pixels, which wait in a list for their level.
    """
    level, out = level.ravel(), np.append(np.where(level >= 0, markers, 0).ravel(), 0)
    waiting: dict[int, list[np.ndarray]] = {}

    def wait(done: np.ndarray, now: int) -> np.ndarray:
        """The unlabelled neighbours of ``done``: those of the level ``now`` or above are returned, others wait."""
        near = np.unique(_beside(markers.shape, done))
        near = near[near >= 0]
        near = near[(out[near] == 0) & (level[near] >= 0)]
        for one in np.unique(level[near][level[near] < now]).tolist():
            waiting.setdefault(one, []).append(near[level[near] == one])
        return near[level[near] >= now]

    start = np.flatnonzero(out[:-1])
    if not len(start):
        return out[:-1].reshape(markers.shape)
    top = int(level.max())
    waiting[top] = [wait(start, top)]
    for now in range(top, -1, -1):
        fresh = np.unique(np.concatenate(waiting.pop(now, [np.zeros(0, int)])))
        fresh = fresh[out[fresh] == 0]
        while len(fresh):
            labels = out[_beside(markers.shape, fresh)]  # place -1 is the 0 at the end
            out[fresh] = np.where(labels > 0, labels, np.iinfo(out.dtype).max).min(axis=0)
            fresh = wait(fresh, now)
    return out[:-1].reshape(markers.shape)


def spaced_seeds(distance: np.ndarray, part: np.ndarray, spacing: float) -> np.ndarray:
    """Seeds (labels from 1, else 0) at the peaks of squared ``distance``, two of one ``part`` no nearer than ``spacing``.

    A peak is as high as all its 8 neighbours. Peaks are taken from the highest (of equals the first
    in row order) unless a taken one of their part is nearer than the spacing, so each part has one at least.
    """
    h, w = distance.shape
    padded = np.pad(distance, 1, constant_values=-1)
    around = np.max([padded[1 + dy : h + 1 + dy, 1 + dx : w + 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
    at = np.flatnonzero((part > 0) & (distance == around))
    at = at[np.argsort(-distance.ravel()[at], kind="stable")]
    y, x = np.divmod(at, w)
    own, free, out = part.ravel()[at], np.ones(len(at), bool), np.zeros(h * w, int)
    number = 0
    for i in range(len(at)):
        if free[i]:
            number += 1
            out[at[i]] = number
            free &= (own != own[i]) | ((y - y[i]) ** 2 + (x - x[i]) ** 2 >= spacing**2)
    return out.reshape(h, w)


def renumbered(label: np.ndarray) -> np.ndarray:
    """Labels from 1 in order of first pixel; 0 stays."""
    found, first, at = np.unique(label, return_index=True, return_inverse=True)
    number = np.zeros(len(found), int)
    order = np.argsort(np.where(found > 0, first, -1), kind="stable")
    number[order] = np.arange(len(found)) + (0 if (found == 0).any() else 1)
    return number[at].reshape(label.shape)


def watershed_segment(image: np.ndarray, diameter: float, nuclei: np.ndarray | None = None) -> np.ndarray:
    """The default segmenter: Otsu foreground, parted by a seeded watershed over the distance from the background.

    Seeds are peaks of the distance, half a ``diameter`` apart at least. With a ``nuclei`` channel its own objects, expected at half
    the diameter, are the seeds instead; foreground without a nucleus keeps its peaks. Flooding goes down whole
    pixels of distance. Objects under a fiftieth of a disc of ``diameter`` go; others count from 1 by first pixel.
    """
    mask = otsu(image)
    part, distance = components(mask), squared_distances(mask)
    level = np.where(mask, np.sqrt(distance).astype(int), -1)
    markers = spaced_seeds(distance, part, diameter / 2)
    if nuclei is not None:
        inner = np.where(mask, watershed_segment(nuclei, diameter / 2), 0)
        seeded = np.isin(part, np.unique(part[inner > 0])) & mask
        markers = np.where(seeded, inner, np.where(markers > 0, markers + inner.max(), 0))
    label = flooded(level, markers)
    size = np.bincount(label.ravel())
    label[size[label] < np.pi * diameter**2 / 4 / 50] = 0
    return renumbered(label)
