"""Image files decoded by their content: plain ones by the library, others by Spark's image source."""

import os
import struct
import zlib

import numpy as np
import pytest

from backdrop.functions.images import decode_plain
from backdrop.functions.png import encode_png
from backdrop.sources import images as IM
from backdrop.streaming import jobs as J
from tests.conftest import png_bytes

RNG = np.random.default_rng(7)


def _chunk(kind, body):
    return struct.pack("!I", len(body)) + kind + body + struct.pack("!I", zlib.crc32(kind + body))


def _filtered_png(pixels, filters, extra=b"", color=None, interlaced=0):
    """A PNG whose rows carry the named filters; their bytes are differences as they stand."""
    h, w, c = pixels.shape
    raw = b"".join(bytes([f]) + pixels[y].tobytes() for y, f in enumerate(filters))
    head = struct.pack("!IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[c] if color is None else color, 0, 0, interlaced)
    packed = zlib.compress(raw)
    return (b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", head) + extra + _chunk(b"IDAT", packed[:9]) + _chunk(b"IDAT", packed[9:])
            + _chunk(b"IEND", b""))


def _bmp(pixels, top_down):
    h, w, _ = pixels.shape
    rows = [pixels[y].tobytes() + b"\0" * (-3 * w % 4) for y in range(h)]
    body = b"".join(rows if top_down else rows[::-1])
    return (b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54)
            + struct.pack("<IiiHHIIiiII", 40, w, -h if top_down else h, 1, 24, 0, len(body), 0, 0, 0, 0) + body)


def _noise(h, w, c):
    return RNG.integers(0, 256, (h, w, c), np.uint8)


def _files():
    """name -> (content, whether it is plain)"""
    files = {
        "grey.png": (png_bytes(_noise(5, 7, 1)[..., 0]), True),
        "rgb.png": (png_bytes(_noise(5, 7, 3)), True),
        "rgba.PNG": (png_bytes(_noise(4, 3, 4)), True),
        "ours.jpg": (encode_png(_noise(6, 2, 3)), True),
        "bmp_up.jpeg": (_bmp(_noise(3, 5, 3), False), True),
        "bmp_down.jpg": (_bmp(_noise(3, 6, 3), True), True),
        "paeth.png": (_filtered_png(_noise(4, 4, 3), [0, 4, 3, 1]), False),
        "pixel_size.png": (_filtered_png(_noise(2, 2, 3), [0, 1], _chunk(b"pHYs", struct.pack("!IIB", 1, 1, 0))), False),
        "transparent.png": (_filtered_png(_noise(2, 2, 3), [0, 0], _chunk(b"tRNS", b"\0\1\0\2\0\3")), False),
        "trailing.png": (png_bytes(_noise(2, 2, 3)) + b"more", False),
        "broken.jpg": (b"not an image", False),
    }
    for c in (1, 3, 4):
        files[f"filters_{c}.png"] = (_filtered_png(_noise(6, 5, c), [2, 1, 2, 2, 0, 1]), True)
    return files


def test_only_undamaged_plain_files_are_decoded():
    for name, (content, plain) in _files().items():
        assert (decode_plain(content) is not None) == plain, name
    whole = png_bytes(_noise(3, 3, 3))
    for at in range(8, len(whole)):  # any changed byte breaks a checksum, or the layout
        assert decode_plain(whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1:]) is None
        assert decode_plain(whole[:at]) is None
    bmp = _bmp(_noise(3, 3, 3), True)
    assert decode_plain(bmp[:-1]) is None and decode_plain(bmp[:20]) is None and decode_plain(b"") is None


@pytest.fixture()
def folder(tmp):
    for session in ("s1", "s 2"):
        os.makedirs(os.path.join(tmp, "in", session))
        for name, (content, _) in _files().items():
            with open(os.path.join(tmp, "in", session, name), "wb") as out:
                out.write(content)
    return os.path.join(tmp, "in")


def _rows(df):
    return sorted((r["origin"], r["session_id"], r["filename"], r["height"], r["width"], r["n_channels"], r["mode"],
                   bytes(r["data"] or b"")) for r in df.collect())


def test_every_kind_of_file_gives_the_row_of_the_image_source(spark, folder):
    by_source = IM._as_frames(IM._image_reader(spark, False).load(folder))
    assert _rows(IM.read_image_folder(spark, folder, number=False)) == _rows(by_source)


def test_plain_files_do_not_pass_the_image_source(spark, tmp):
    os.makedirs(os.path.join(tmp, "in", "s"))
    for i in range(3):
        with open(os.path.join(tmp, "in", "s", f"{i}.jpg"), "wb") as out:
            out.write(encode_png(_noise(2, 2, 3)))
    frames = IM.read_image_folder(spark, os.path.join(tmp, "in"), number=False)
    assert frames.count() == 3
    plan = frames._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "FileScan image" not in plan and "Scan image" not in plan


def test_landing_batches_hold_every_kind_of_file(spark, folder, tmp):
    files = IM.stream_image_files(spark, folder, max_files_per_trigger=5)
    out = os.path.join(tmp, "out")
    J.drain(J.write_batches(files, out, os.path.join(tmp, "ck"), each=IM.landed_frames))
    assert _rows(spark.read.parquet(out)) == _rows(IM._as_frames(IM._image_reader(spark, False).load(folder)))
