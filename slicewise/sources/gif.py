"""Animated grey GIF files."""

from __future__ import annotations

import struct

import numpy as np


def _packed(codes: np.ndarray) -> bytes:
    """9-bit codes, least significant bit first, in blocks of up to 255 bytes."""
    bits = ((codes[:, None] >> np.arange(9)) & 1).astype(np.uint8).ravel()
    data = np.packbits(bits, bitorder="little").tobytes()
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def encode(frames: list[np.ndarray], hundredths: int = 10, loops: int = 10) -> bytes:
    """A GIF89a file of 8-bit grey frames of one shape, each shown for ``hundredths`` of a second.

    Pixels are written as plain codes; the code table is cleared before it would grow beyond 9 bits.
    """
    h, w = frames[0].shape
    grey = bytes(v for i in range(256) for v in (i, i, i))
    out = [b"GIF89a", struct.pack("<HHBBB", w, h, 0xF7, 0, 0), grey, b"\x21\xff\x0bNETSCAPE2.0\x03\x01", struct.pack("<HB", loops, 0)]
    for frame in frames:
        flat = frame.astype(np.uint16).ravel()
        runs = [np.concatenate([[256], flat[i : i + 250]]) for i in range(0, len(flat), 250)]  # 256 clears, 257 ends
        out += [b"\x21\xf9\x04\x04", struct.pack("<HBB", hundredths, 0, 0), struct.pack("<BHHHHB", 0x2C, 0, 0, w, h, 0), b"\x08", _packed(np.concatenate([*runs, [257]]).astype(np.uint16))]
    return b"".join([*out, b"\x3b"])


def _values(data: bytes, least: int, count: int) -> np.ndarray:
    """``count`` pixels of variable-length codes: a code that clears the table, one that ends, and runs that grow by a value."""
    clear, n, at, size = 1 << least, 8 * len(data), 0, least + 1
    table, before, out = [bytes([i]) for i in range(clear)] + [b"", b""], None, bytearray()
    while at + size <= n and len(out) < count:
        code = int.from_bytes(data[at >> 3 : (at + size + 7) >> 3], "little") >> (at & 7) & (1 << size) - 1
        at += size
        if code == clear + 1:
            break
        if code == clear:
            table, before, size = table[: clear + 2], None, least + 1
            continue
        run = table[code] if code < len(table) else before + before[:1]
        out += run
        if before is not None and len(table) < 4096:
            table.append(before + run[:1])
        before = run
        size = max(size, min(12, len(table).bit_length()))
    return np.frombuffer(bytes(out[:count]), np.uint8)


def decode(data: bytes) -> list[np.ndarray]:
    """The frames of a GIF as palette numbers, which are grey values in files that ``encode`` made; a frame fills the screen."""
    if data[:4] != b"GIF8":
        raise ValueError("not a GIF file")
    flags = data[10]
    at, frames = 13 + (3 << (flags & 7) + 1 if flags & 0x80 else 0), []
    while at < len(data) and data[at] != 0x3B:
        image = data[at] == 0x2C
        if image:
            w, h, own = struct.unpack_from("<HHB", data, at + 5)
            at += 10 + (3 << (own & 7) + 1 if own & 0x80 else 0)
            if own & 0x40:
                raise ValueError("interlaced frames aren't read")
            least, at = data[at], at + 1
        else:
            at += 2
        blocks = []
        while data[at]:
            blocks.append(data[at + 1 : at + 1 + data[at]])
            at += 1 + data[at]
        at += 1
        if image:
            frames.append(_values(b"".join(blocks), least, w * h).reshape(h, w))
    return frames
