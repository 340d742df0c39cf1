import os
import struct
import sys
import tempfile
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from backdrop.config import checkpoint_dir, configure

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


# ---------------------------------------------------------------------------
# Image fixtures, written without any imaging library.

def png_bytes(pixels: np.ndarray) -> bytes:
    """PNG of uint8 [h, w] grey, [h, w, 3] RGB or [h, w, 4] RGBA (channel order as given)."""
    if pixels.ndim == 2:
        pixels = pixels[..., None]
    h, w, c = pixels.shape
    color_type = {1: 0, 3: 2, 4: 6}[c]
    raw = b"".join(b"\x00" + pixels[r].tobytes() for r in range(h))

    def chunk(kind, body):
        return struct.pack("!I", len(body)) + kind + body + struct.pack("!I", zlib.crc32(kind + body) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack("!IIBBBBB", w, h, 8, color_type, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def write_png(path, pixels):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(png_bytes(pixels))


def write_jpeg_via_jvm(spark, path, rgb: np.ndarray):
    """A JPEG written by the driver JVM's ImageIO (no Python codec needed)."""
    jvm = spark.sparkContext._jvm
    h, w, _ = rgb.shape
    img = jvm.java.awt.image.BufferedImage(w, h, jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
    for y in range(h):
        for x in range(w):
            r, g, b = (int(v) for v in rgb[y, x])
            img.setRGB(x, y, (r << 16) | (g << 8) | b)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    jvm.javax.imageio.ImageIO.write(img, "jpg", jvm.java.io.File(path))


RNG = np.random.default_rng(42)
A_RGB = RNG.integers(0, 256, (2, 3, 3), dtype=np.uint8)
G_GREY = RNG.integers(0, 256, (2, 3), dtype=np.uint8)
T_RGBA = RNG.integers(0, 256, (2, 3, 4), dtype=np.uint8)
ONE_RGB = np.array([[[10, 200, 30]]], dtype=np.uint8)
GREY192 = np.array([[[192, 192, 192], [10, 20, 30]], [[192, 192, 192], [200, 200, 200]]], dtype=np.uint8)
J_RGB = np.full((2, 3, 3), 128, dtype=np.uint8)

SESSION = "20240102_030405_abcdef01"
SESSION_NO_US = "plainsession"


@pytest.fixture(scope="session")
def image_root(spark):
    """FIXTURES.md §1.1: one session with every case, one without '_', one empty."""
    root = tempfile.mkdtemp(prefix="backdrop-images-")
    s = os.path.join(root, f"session_id={SESSION}")
    write_png(os.path.join(s, "a.png"), A_RGB)
    write_png(os.path.join(s, "g.png"), G_GREY)
    write_png(os.path.join(s, "t.PNG"), T_RGBA)
    write_jpeg_via_jvm(spark, os.path.join(s, "j.jpeg"), J_RGB)
    with open(os.path.join(s, "bad.jpg"), "wb") as fh:
        fh.write(b"this is not an image")
    with open(os.path.join(s, "note.txt"), "wb") as fh:
        fh.write(b"not an image either")
    open(os.path.join(s, "empty.png"), "wb").close()
    write_png(os.path.join(s, "one.png"), ONE_RGB)
    write_png(os.path.join(s, "grey192.png"), GREY192)
    write_png(os.path.join(root, f"session_id={SESSION_NO_US}", "x.png"), ONE_RGB)
    os.makedirs(os.path.join(root, "session_id=20240101_000000_00000000"))
    return root
