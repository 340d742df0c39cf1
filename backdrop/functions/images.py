"""Image files of the plain kinds, decoded to the bytes that Spark's image source gives.

Plain are PNG of 8-bit grey, RGB or RGBA (not interlaced, no chunks but the
necessary ones, rows unfiltered or filtered by Sub or Up, as OpenCV and this
library write them) and uncompressed 24-bit BMP. Whatever differs, or is
damaged in any way, is not decoded here.
"""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

import numpy as np

from backdrop import schemas

_PNG = b"\x89PNG\r\n\x1a\n"
_MODES = {1: schemas.MODE_GREY, 3: schemas.MODE_BGR, 4: schemas.MODE_BGRA}
_CHANNELS = {0: 1, 2: 3, 6: 4}  # by PNG colour type
_MAX_BYTES = 10**9 - 1  # the image source takes no larger ones


class Pixels(NamedTuple):
    height: int
    width: int
    n_channels: int
    mode: int
    data: bytes


def decode_plain(content) -> Pixels | None:
    """The pixels of a plain image file (grey, BGR or BGRA); None for any other."""
    found = None
    if content[:8] == _PNG:
        found = _png(content)
    elif content[:2] == b"BM":
        found = _bmp(content)
    if found is None:
        return None
    return Pixels(*found.shape, _MODES[found.shape[2]], found.tobytes())


def _png_parts(content) -> tuple[bytes, bytes] | None:
    """Header and compressed pixels of a PNG that holds nothing else and whose checksums hold."""
    at, kinds, bodies = 8, [], []
    while at + 12 <= len(content):
        size, kind = struct.unpack_from("!I4s", content, at)
        end = at + 12 + size
        if end > len(content) or kind not in (b"IHDR", b"IDAT", b"IEND"):
            return None
        body = content[at + 8:end - 4]
        if zlib.crc32(body, zlib.crc32(kind)) != struct.unpack_from("!I", content, end - 4)[0]:
            return None
        kinds.append(kind)
        bodies.append(body)
        at = end
    plain = len(kinds) > 2 and kinds == [b"IHDR", *[b"IDAT"] * (len(kinds) - 2), b"IEND"]
    if at != len(content) or not plain or len(bodies[0]) != 13 or bodies[-1]:
        return None
    return bodies[0], b"".join(bodies[1:-1])


def _png(content) -> np.ndarray | None:
    parts = _png_parts(content)
    if parts is None:
        return None
    w, h, depth, color, packing, filtering, interlaced = struct.unpack("!IIBBBBB", parts[0])
    c = _CHANNELS.get(color)
    if c is None or (depth, packing, filtering, interlaced) != (8, 0, 0, 0) or not 0 < h * w * c <= _MAX_BYTES:
        return None
    expected = h * (1 + w * c)
    inflate = zlib.decompressobj()
    try:
        raw = inflate.decompress(parts[1], expected + 1)
    except zlib.error:
        return None
    if len(raw) != expected or not inflate.eof or inflate.unused_data:
        return None
    rows = np.frombuffer(raw, np.uint8).reshape(h, 1 + w * c)
    filters, pixels = rows[:, 0], rows[:, 1:].reshape(h, w, c)
    if filters.max() > 2:
        return None
    if filters.any():
        pixels = pixels.copy()
        for y in np.flatnonzero(filters):
            if filters[y] == 1:  # Sub: the differences to the pixel on the left
                pixels[y] = np.cumsum(pixels[y], axis=0, dtype=np.uint8)
            elif y:  # Up: those to the pixel above
                pixels[y] += pixels[y - 1]
    return pixels if c == 1 else pixels[..., [2, 1, 0, 3][:c]]


def _bmp(content) -> np.ndarray | None:
    if len(content) < 54:
        return None
    start, head, w, h, planes, bits, packing = struct.unpack_from("<IIiiHHI", content, 10)
    stride = (3 * w + 3) // 4 * 4
    if (start, head, planes, bits, packing) != (54, 40, 1, 24, 0) or w <= 0 or not 0 < abs(h) * w * 3 <= _MAX_BYTES \
            or 54 + stride * abs(h) > len(content):
        return None
    rows = np.frombuffer(content, np.uint8, stride * abs(h), 54).reshape(abs(h), stride)
    return (rows if h < 0 else rows[::-1])[:, :3 * w].reshape(abs(h), w, 3)
