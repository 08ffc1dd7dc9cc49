"""Baseline TIFF: uncompressed grey pages of 8 or 16 bits or 32-bit floats, read and written."""

from __future__ import annotations

import struct

import numpy as np

# Fixed values of the format: tag numbers, and bytes and struct codes of field types.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 339
SIZES = {1: (1, "B"), 3: (2, "H"), 4: (4, "I")}
KINDS = {(8, 1): "u1", (16, 1): "u2", (32, 1): "u4", (32, 3): "f4"}


def decode(data: bytes) -> list[np.ndarray]:
    """The pages, in file order. Raises ValueError for what isn't baseline grey TIFF."""
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    pages, at, seen = [], struct.unpack_from(order + "I", data, 4)[0], set()
    while at and at not in seen:
        seen.add(at)
        n, tags = struct.unpack_from(order + "H", data, at)[0], {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            if kind in SIZES:
                size, code = SIZES[kind]
                place = at + 10 + 12 * i
                if size * count > 4:
                    place = struct.unpack_from(order + "I", data, place)[0]
                tags[tag] = struct.unpack_from(f"{order}{count}{code}", data, place)
        kind = KINDS.get((tags.get(BITS, (1,))[0], tags.get(FORMAT, (1,))[0]))
        if kind is None or tags.get(COMPRESSION, (1,))[0] != 1 or tags.get(SAMPLES, (1,))[0] != 1:
            raise ValueError("only uncompressed grey pages are read")
        raw = b"".join(data[o : o + c] for o, c in zip(tags[OFFSETS], tags[COUNTS]))
        pages.append(np.frombuffer(raw, order + kind).reshape(tags[HEIGHT][0], tags[WIDTH][0]).astype(kind))
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]
    return pages


def encode(pages: list[np.ndarray]) -> bytes:
    """A little-endian file with one strip for each page."""
    out, link = bytearray(b"II" + struct.pack("<HI", 42, 0)), 4
    for page in pages:
        page = np.ascontiguousarray(page)
        bits, form = next(k for k, v in KINDS.items() if np.dtype(v) == page.dtype)
        strip = len(out)
        out += page.astype(page.dtype.newbyteorder("<")).tobytes()
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        tags = [(WIDTH, page.shape[1]), (HEIGHT, page.shape[0]), (BITS, bits), (COMPRESSION, 1), (PHOTOMETRIC, 1), (OFFSETS, strip), (SAMPLES, 1), (ROWS, page.shape[0]), (COUNTS, page.nbytes), (FORMAT, form)]
        out += struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags)
        link = len(out)
        out += struct.pack("<I", 0)
    return bytes(out)
