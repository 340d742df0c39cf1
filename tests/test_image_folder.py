import os

import numpy as np
from pyspark.sql import functions as F

from backdrop import schemas
from backdrop.functions.segmenters import ThresholdSegmenter
from backdrop.functions.pixels import composite, luma
from backdrop.operators import frames as FO
from backdrop.operators import summary as SUM
from backdrop.sinks import frames as SK
from backdrop.sources import images as IM
from backdrop.streaming import jobs as J

from tests.conftest import A_RGB, G_GREY, GREY192, ONE_RGB, SESSION, SESSION_NO_US, T_RGBA, write_png


def _by_name(df):
    return {r["filename"]: r for r in df.collect()}


def test_scan_filters_extensions_case_insensitively(spark, image_root):
    rows = _by_name(IM.read_image_folder(spark, image_root, SESSION))
    assert set(rows) == {"a.png", "g.png", "t.PNG", "j.jpeg", "bad.jpg", "empty.png", "one.png", "grey192.png"}
    assert all(r["session_id"] == SESSION for r in rows.values())


def test_decoded_modes_and_bytes(spark, image_root):
    rows = _by_name(IM.read_image_folder(spark, image_root, SESSION))
    a = rows["a.png"]
    assert (a["mode"], a["n_channels"], a["height"], a["width"]) == (schemas.MODE_BGR, 3, 2, 3)
    assert bytes(a["data"]) == A_RGB[..., ::-1].tobytes()  # stored BGR
    assert rows["g.png"]["mode"] == schemas.MODE_GREY and bytes(rows["g.png"]["data"]) == G_GREY.tobytes()
    assert rows["t.PNG"]["mode"] == schemas.MODE_BGRA
    assert rows["bad.jpg"]["mode"] == schemas.MODE_INVALID
    assert rows["j.jpeg"]["mode"] == schemas.MODE_BGR


def test_numbering_before_drop_leaves_gaps(spark, image_root):
    kept = IM.replay_folder(spark, image_root, SESSION).orderBy("frame_id").collect()
    names = sorted(["a.png", "g.png", "t.PNG", "j.jpeg", "bad.jpg", "empty.png", "one.png", "grey192.png"])
    expected = {n: i for i, n in enumerate(names)}  # codepoint order: upper case first
    assert [r["filename"] for r in kept] == [n for n in names if n not in ("bad.jpg", "empty.png")]
    assert all(r["frame_id"] == expected[r["filename"]] for r in kept)


def test_missing_folder_is_empty(spark, image_root):
    df = IM.read_image_folder(spark, os.path.join(image_root, "nope"))
    assert df.count() == 0 and df.schema == schemas.FRAMES


def test_whole_root_sessions_from_directory_names(spark, image_root):
    sessions = {r["session_id"] for r in IM.read_image_folder(spark, image_root).collect()}
    assert sessions == {SESSION, SESSION_NO_US}


def test_backdrop_removal_on_decoded_images(spark, image_root):
    frames = IM.read_image_folder(spark, image_root, SESSION)
    rows = _by_name(FO.remove_backdrop(frames, ThresholdSegmenter(100)))
    for name, rgb in (("a.png", A_RGB), ("one.png", ONE_RGB), ("grey192.png", GREY192),
                      ("g.png", np.repeat(G_GREY[..., None], 3, -1)), ("t.PNG", T_RGBA[..., :3])):
        bgr = rgb[..., ::-1][None]
        want, painted = composite(bgr, (luma(rgb[None]) >= 100).astype(np.uint8))
        r = rows[name]
        assert r["status"] == "success", name
        assert bytes(r["data"]) == want.tobytes(), name
        assert r["painted"] == int(painted.sum())
        assert (r["n_channels"], r["mode"]) == (3, schemas.MODE_BGR)
    assert rows["bad.jpg"]["status"] == "unreadable" and rows["bad.jpg"]["data"] is None
    assert rows["empty.png"]["status"] == "unreadable"
    assert rows["j.jpeg"]["status"] == "success" and rows["j.jpeg"]["painted"] == 6  # grey 128 >= 100
    j = _by_name(FO.normalise(frames))["j.jpeg"]  # JPEG: compare within a tolerance
    assert np.abs(np.frombuffer(j["data"], np.uint8).astype(int) - 128).max() <= 4


def test_png_export_round_trip(spark, image_root, tmp):
    frames = IM.read_image_folder(spark, image_root, SESSION)
    processed = FO.remove_backdrop(frames, ThresholdSegmenter(100))
    results = SK.export_png(processed, os.path.join(tmp, "out"), input_root=image_root)
    res = {r["filename"]: r for r in results.collect()}
    assert res["bad.jpg"]["status"] == "unreadable" and res["bad.jpg"]["output_path"] is None
    assert res["a.png"]["output_path"].endswith(f"{SESSION}/a.png")
    back = _by_name(IM.read_image_folder(spark, os.path.join(tmp, "out"), SESSION))
    orig = _by_name(processed)
    for name in ("a.png", "one.png", "grey192.png", "g.png"):
        assert bytes(back[name]["data"]) == bytes(orig[name]["data"]), name
    # A retry writes the same paths again.
    again = {r["filename"]: r for r in SK.export_png(processed, os.path.join(tmp, "out")).collect()}
    assert again["a.png"]["output_path"] == res["a.png"]["output_path"]


def test_session_history_counts_empty_and_skips_output_only(spark, image_root, tmp):
    out_root = os.path.join(tmp, "output")
    write_png(os.path.join(out_root, SESSION, "a.png"), A_RGB)
    write_png(os.path.join(out_root, "20990101_000000_ffffffff", "z.png"), A_RGB)  # output only
    hist = SUM.session_history(IM.list_files(spark, image_root), IM.list_files(spark, out_root),
                               image_root, out_root, sessions=IM.list_session_dirs(spark, image_root))
    rows = hist.collect()
    assert [r["session_id"] for r in rows] == sorted([SESSION, SESSION_NO_US, "20240101_000000_00000000"],
                                                     reverse=True)
    by = {r["session_id"]: r for r in rows}
    assert by[SESSION]["input_count"] == 8 and by[SESSION]["output_count"] == 1
    assert by[SESSION]["display_time"] == "02/01/2024 03:04:05"
    assert by["20240101_000000_00000000"]["input_count"] == 0
    assert by[SESSION_NO_US]["display_time"] == SESSION_NO_US


def test_batch_equals_stream_and_restart_adds_nothing(spark, image_root, tmp):
    # Streams never see zero-byte files, so compare with a batch that does not report them.
    batch = FO.remove_backdrop(IM.read_image_folder(spark, image_root, number=False, report_empty=False), "threshold")
    out, ck = os.path.join(tmp, "s-out"), os.path.join(tmp, "s-ck")
    J.drain(J.run_frame_stream(spark, image_root, out, ck, max_files_per_trigger=3))
    cols = ["session_id", "filename", "status", "painted"]
    got = spark.read.parquet(out).select(*cols)
    want = batch.select(*cols)
    assert sorted(got.collect()) == sorted(want.collect())
    J.drain(J.run_frame_stream(spark, image_root, out, ck))
    assert spark.read.parquet(out).count() == want.count()
    hexes = spark.read.parquet(out).select("filename", F.hex("data").alias("h")).collect()
    assert sorted(hexes) == sorted(batch.select("filename", F.hex("data").alias("h")).collect())


def test_stream_results_from_the_frames_table(spark, image_root, tmp):
    from backdrop.plans import batch as B
    out, ck = os.path.join(tmp, "r-out"), os.path.join(tmp, "r-ck")
    J.drain(J.run_frame_stream(spark, image_root, out, ck))
    res = B.stream_results(spark, out, image_root, "out")
    by = {r["filename"]: r for r in res.collect()}
    assert by["a.png"]["status"] == "success" and by["a.png"]["output_path"].endswith(f"{SESSION}/a.png")
    assert by["bad.jpg"]["status"] == "unreadable" and by["bad.jpg"]["output_path"] is None
    assert "data" not in res._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


class _FailsOnTinyFrames:
    """A segmenter that raises on 1x1 frames (stands in for a model crash)."""

    def __call__(self, rgb):
        import numpy as np
        if rgb.shape[1] * rgb.shape[2] == 1:
            raise RuntimeError("model crashed")
        return np.zeros(rgb.shape[:3], np.uint8)


def test_stream_survives_failing_frames(spark, image_root, tmp):
    from backdrop.functions.segmenters import Segmenter

    class Flaky(_FailsOnTinyFrames, Segmenter):
        pass

    out, ck = os.path.join(tmp, "t6-out"), os.path.join(tmp, "t6-ck")
    J.drain(J.run_frame_stream(spark, image_root, out, ck, max_files_per_trigger=2, segmenter=Flaky()))
    rows = {r["filename"]: r for r in spark.read.parquet(out).select("filename", "status", "message").collect()}
    assert rows["one.png"]["status"] == "error" and "model crashed" in rows["one.png"]["message"]
    assert rows["x.png"]["status"] == "error"  # the other 1x1 frame, in another session
    assert rows["a.png"]["status"] == "success" and rows["bad.jpg"]["status"] == "unreadable"
