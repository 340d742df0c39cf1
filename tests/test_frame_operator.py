import numpy as np
import pytest

from backdrop import schemas
from backdrop.functions import pixels
from backdrop.functions.segmenters import FrameFunctionSegmenter, Segmenter, ThresholdSegmenter
from backdrop.operators import frames as FO

RNG = np.random.default_rng(7)
BGR = RNG.integers(0, 256, (3, 4, 3), dtype=np.uint8)
GREY = RNG.integers(0, 256, (3, 4), dtype=np.uint8)
BGRA = RNG.integers(0, 256, (3, 4, 4), dtype=np.uint8)


def frame(fid, h, w, c, mode, data):
    return ("s", fid, f"f{fid}.png", None, h, w, c, mode, None if data is None else bytearray(data))


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [
        frame(0, 3, 4, 3, schemas.MODE_BGR, BGR.tobytes()),
        frame(1, 3, 4, 1, schemas.MODE_GREY, GREY.tobytes()),
        frame(2, 3, 4, 4, schemas.MODE_BGRA, BGRA.tobytes()),
        frame(3, -1, -1, -1, schemas.MODE_INVALID, b""),
        frame(4, 3, 4, 3, schemas.MODE_BGR, None),
        frame(5, 3, 4, 3, schemas.MODE_BGR, BGR.tobytes()[:-1]),
        frame(6, 3, 4, 2, 99, b"\x00" * 24),
        frame(7, 1, 1, 3, schemas.MODE_BGR, b"\x01\x02\x03"),
        frame(8, None, 4, 3, None, BGR.tobytes()),
    ]
    return spark.createDataFrame(rows, schemas.FRAMES)


def test_statuses_and_bytes(mixed):
    got = {r["frame_id"]: r for r in FO.remove_backdrop(mixed, ThresholdSegmenter(128)).collect()}
    assert [got[i]["status"] for i in range(9)] == [
        "success", "success", "success", "unreadable", "unreadable", "error", "error", "success", "unreadable"]
    for fid, bgr in ((0, BGR), (1, np.repeat(GREY[..., None], 3, -1)), (2, BGRA[..., :3])):
        mask = pixels.luma_at_least(bgr[..., ::-1][None], 128).view(np.uint8)
        want, painted = pixels.composite(bgr[None], mask)
        assert bytes(got[fid]["data"]) == want.tobytes()
        assert got[fid]["painted"] == int(painted.sum())
        assert (got[fid]["n_channels"], got[fid]["mode"]) == (3, schemas.MODE_BGR)
    assert got[3]["data"] is None and got[3]["mode"] == schemas.MODE_INVALID and got[3]["painted"] is None
    assert "expected 3x4x3" in got[5]["message"]
    assert "unsupported image mode 99" in got[6]["message"]


class FailsOnBright(Segmenter):
    def __call__(self, rgb):
        if rgb.max() == 3:  # the 1x1 frame (1, 2, 3)
            raise RuntimeError("model failed")
        return np.zeros(rgb.shape[:3], np.uint8)


def test_failure_is_isolated_to_its_frame(mixed):
    got = {r["frame_id"]: r for r in FO.remove_backdrop(mixed, FailsOnBright()).collect()}
    assert got[7]["status"] == "error" and "model failed" in got[7]["message"] and got[7]["data"] is None
    assert got[0]["status"] == "success" and bytes(got[0]["data"]) == BGR.tobytes()


def test_per_frame_callable_and_polarity(mixed):
    seg = FrameFunctionSegmenter(lambda rgb: np.ones(rgb.shape[:2]))
    fg = {r["frame_id"]: r for r in FO.remove_backdrop(mixed, seg, mask_true="foreground").collect()}
    bg = {r["frame_id"]: r for r in FO.remove_backdrop(mixed, seg, bg_color=(1, 2, 3)).collect()}
    assert bytes(fg[0]["data"]) == BGR.tobytes() and fg[0]["painted"] == 0
    assert bytes(bg[0]["data"]) == bytes([3, 2, 1]) * 12 and bg[0]["painted"] == 12


def test_swap_normalise_and_recomposite(mixed, spark):
    from pyspark.sql import functions as F
    sw = {r["frame_id"]: r for r in FO.swap_channels(mixed).collect()}
    assert bytes(sw[0]["data"]) == BGR[..., ::-1].tobytes()
    nm = {r["frame_id"]: r for r in FO.normalise(mixed).collect()}
    assert bytes(nm[2]["data"]) == BGRA[..., :3].tobytes()
    done = FO.remove_backdrop(mixed.withColumn("original", F.col("data")), ThresholdSegmenter(128))
    back = {r["frame_id"]: r for r in FO.recomposite(done, "original").collect()}
    for fid in (0, 1, 2, 7):
        assert bytes(back[fid]["data"]) == bytes({r["frame_id"]: r for r in done.collect()}[fid]["data"])
    assert back[3]["status"] == "unreadable"


def test_large_var_types(spark, mixed):
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        got = {r["frame_id"]: r for r in FO.remove_backdrop(mixed, ThresholdSegmenter(128)).collect()}
        assert got[0]["status"] == "success" and got[3]["status"] == "unreadable"
    finally:
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")
