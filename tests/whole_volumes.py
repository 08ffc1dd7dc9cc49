"""Second implementations that take a whole volume at once."""

import itertools

import numpy as np


def butterworth(volume: np.ndarray, cutoff: float = 0.1, order: int = 5) -> np.ndarray:
    """Squared Butterworth low-pass in the frequency domain; cutoff is a share of the sampling frequency."""
    squares = np.zeros(volume.shape)
    for axis, n in enumerate(volume.shape):
        shape = [1] * volume.ndim
        shape[axis] = n
        squares = squares + (np.fft.fftfreq(n).reshape(shape) / cutoff) ** 2
    gain = 1 / (1 + squares**order)
    return np.real(np.fft.ifftn(np.fft.fftn(volume) * gain))


def equalised(image: np.ndarray, clip_limit: float = 0.05, tiles: int = 8, bins: int = 256) -> np.ndarray:
    """Contrast-limited adaptive histogram equalisation of an image or a volume to 0..1; constant ones give zeros.

    Each axis is cut into up to ``tiles`` parts. A tile's histogram is clipped at ``clip_limit`` of its
    pixels and the excess dealt evenly; a pixel blends the maps of the nearest two tiles along each axis.
    """
    low, high = float(image.min()), float(image.max())
    if high == low:
        return np.zeros(image.shape)
    level = np.minimum(((image - low) / (high - low) * bins).astype(int), bins - 1)
    cuts = [np.linspace(0, n, min(tiles, n) + 1).astype(int) for n in image.shape]
    counts = [len(c) - 1 for c in cuts]
    own = [np.searchsorted(c, np.arange(n), side="right") - 1 for c, n in zip(cuts, image.shape)]
    tile = np.ravel_multi_index(np.ix_(*own), counts)
    n = np.bincount((tile * bins + level).ravel(), minlength=int(np.prod(counts)) * bins).reshape(-1, bins).astype(float)
    size = n.sum(axis=1, keepdims=True)
    most = np.maximum(clip_limit * size, size / bins)
    over = np.maximum(n - most, 0).sum(axis=1, keepdims=True)
    maps = np.cumsum(np.minimum(n, most) + over / bins, axis=1) / size

    def blend(edges: np.ndarray, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The two tiles beside each position, and their shares."""
        middle = (edges[:-1] + edges[1:] - 1) / 2
        at = np.clip(np.searchsorted(middle, np.arange(length), side="right") - 1, 0, len(middle) - 1)
        after = np.minimum(at + 1, len(middle) - 1)
        share = np.clip((np.arange(length) - middle[at]) / np.where(after > at, middle[after] - middle[at], 1), 0, 1)
        return [(at, 1 - share), (after, share)]

    out = np.zeros(image.shape)
    for corner in itertools.product(*(blend(c, n) for c, n in zip(cuts, image.shape))):
        weight = 1.0
        for axis, (_, share) in enumerate(corner):
            weight = weight * share.reshape([-1 if k == axis else 1 for k in range(image.ndim)])
        out += weight * maps[np.ravel_multi_index(np.ix_(*(at for at, _ in corner)), counts), level]
    return out


def stitched(volume: np.ndarray, least_overlap: float = 0.8) -> np.ndarray:
    """Labels through z: an object takes that of the object before it which it overlaps most, if both are
    each other's most and their overlap over union is ``least_overlap`` or more; else a new one, from 1."""
    out, before, last = np.zeros_like(volume), {}, 0
    for z, image in enumerate(volume):
        labels, area = np.unique(image[image > 0], return_counts=True)
        best: dict[int, int] = {}
        if z and len(labels):
            both = (image > 0) & (volume[z - 1] > 0)
            pairs, common = np.unique(np.stack([image[both], volume[z - 1][both]]), axis=1, return_counts=True)
            old, old_area = np.unique(volume[z - 1][volume[z - 1] > 0], return_counts=True)
            here, there = np.searchsorted(labels, pairs[0]), np.searchsorted(old, pairs[1])
            iou = np.zeros((len(labels), len(old)))
            iou[here, there] = common / (area[here] + old_area[there] - common)
            iou[iou < least_overlap] = 0
            if len(old):
                iou[iou < iou.max(axis=0)] = 0
                best = {int(labels[i]): int(old[iou[i].argmax()]) for i in np.flatnonzero(iou.max(axis=1) > 0)}
        now = {}
        for label in labels.tolist():
            if label in best:
                now[label] = before[best[label]]
            else:
                last += 1
                now[label] = last
            out[z][image == label] = now[label]
        before = now
    return out
