"""Lossless PNG encoding of one BGR frame (8-bit RGB, filter 0, zlib)."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack("!I", len(body)) + kind + body + struct.pack("!I", zlib.crc32(kind + body) & 0xFFFFFFFF)


def encode_png(bgr: np.ndarray, level: int = 1) -> bytes:
    """``uint8[h, w, 3]`` BGR (or ``[h, w]`` grey) to PNG bytes."""
    if bgr.ndim == 2:
        h, w = bgr.shape
        rows, color_type = bgr.reshape(h, w), 0
    else:
        h, w, _ = bgr.shape
        rows, color_type = np.ascontiguousarray(bgr[..., ::-1]).reshape(h, w * 3), 2
    raw = np.hstack([np.zeros((h, 1), np.uint8), rows]).tobytes()
    header = struct.pack("!IIBBBBB", w, h, 8, color_type, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(raw, level)) + _chunk(b"IEND", b"")
