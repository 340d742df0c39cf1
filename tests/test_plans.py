import os
import struct

import numpy as np

from backdrop.functions.pixels import composite, luma
from backdrop.operators import results as R
from backdrop.plans import batch as B
from backdrop.sources import images as IM
from backdrop.streaming import jobs as J

from tests.conftest import A_RGB, ONE_RGB, SESSION, png_bytes, write_png


def test_process_folder_png(spark, image_root, tmp):
    res = {r["filename"]: r for r in B.process_folder(spark, image_root, os.path.join(tmp, "out"), SESSION).collect()}
    assert res["a.png"]["status"] == "success" and os.path.exists(res["a.png"]["output_path"])
    assert res["bad.jpg"]["status"] == "unreadable" and res["bad.jpg"]["output_path"] is None
    assert res["empty.png"]["status"] == "unreadable"
    assert res["a.png"]["input_path"].endswith(f"{SESSION}/a.png")
    assert res["a.png"]["frame_id"] == sorted(res).index("a.png")


def test_process_folder_parquet(spark, image_root, tmp):
    out = os.path.join(tmp, "frames")
    res = B.process_folder(spark, image_root, out, SESSION, export="parquet")
    by = {r["filename"]: r for r in res.collect()}
    assert by["a.png"]["status"] == "success" and by["a.png"]["output_path"].endswith(f"/session_id={SESSION}")
    assert os.path.isdir(by["a.png"]["output_path"])
    stored = spark.read.parquet(out).where(f"filename = 'a.png'").first()
    want, _ = composite(A_RGB[..., ::-1][None], (luma(A_RGB[None]) >= 153).astype(np.uint8))
    assert bytes(stored["data"]) == want.tobytes()


def test_process_captures(spark, tmp):
    caps = os.path.join(tmp, "caps")
    os.makedirs(caps)
    recs = [("cam_0.png", 0, png_bytes(A_RGB)), ("cam_1.png", 1, b"garbage"), ("cam_2.png", 2, png_bytes(ONE_RGB))]
    blob = struct.pack("!I", 3) + b"".join(
        struct.pack("!I", len(n)) + n.encode() + struct.pack("!II", i, len(p)) + p for n, i, p in recs)
    with open(os.path.join(caps, "20240105_101010.bin"), "wb") as fh:
        fh.write(blob)
    res = {r["filename"]: r for r in B.process_captures(spark, caps, os.path.join(tmp, "landing"),
                                                        os.path.join(tmp, "out")).collect()}
    assert res["cam_0.png"]["status"] == "success" and res["cam_0.png"]["session_id"] == "20240105_101010"
    assert res["cam_1.png"]["status"] == "unreadable"
    assert res["cam_2.png"]["frame_id"] == 2


def test_live_replies_and_counts(spark, tmp):
    landing = os.path.join(tmp, "live")
    write_png(os.path.join(landing, "client1", "f0.png"), A_RGB)
    write_png(os.path.join(landing, "client1", "f1.png"), ONE_RGB)
    os.makedirs(os.path.join(landing, "client2"))
    with open(os.path.join(landing, "client2", "bad.jpg"), "wb") as fh:
        fh.write(b"broken")
    # Across micro-batches frames count in arrival (modification-time) order.
    for k, rel in enumerate(["client1/f0.png", "client1/f1.png", "client2/bad.jpg"]):
        os.utime(os.path.join(landing, rel), (1_700_000_000 + k, 1_700_000_000 + k))
    replies_out, counts_out = os.path.join(tmp, "replies"), os.path.join(tmp, "counts")
    latest_out = os.path.join(tmp, "latest")
    for q in B.run_live(spark, landing, replies_out, counts_out, max_files_per_trigger=2, latest_out=latest_out):
        J.drain(q)
    latest = {r["session_id"]: (r["filename"], r["status"]) for r in B.latest_results(spark, latest_out).collect()}
    assert latest == {"client1": ("f1.png", "success"), "client2": ("bad.jpg", "unreadable")}
    rep = {r["filename"]: r for r in spark.read.parquet(replies_out).collect()}
    assert rep["f0.png"]["status"] == "success" and rep["f0.png"]["data"] is not None
    assert rep["bad.jpg"]["status"] == "unreadable" and rep["bad.jpg"]["data"] is None
    counts = {(r["session_id"], r["filename"]): r["frame_count"] for r in spark.read.parquet(counts_out).collect()}
    assert counts[("client1", "f1.png")] == 2 and counts[("client2", "bad.jpg")] == 1
    # The receiver shows its own frame when the reply carries none.
    sent = spark.createDataFrame([("client2", "bad.jpg", b"own")], "session_id string, filename string, frame binary")
    shown = R.with_fallback(sent, spark.read.parquet(replies_out).withColumnRenamed("data", "reply"),
                            ["session_id", "filename"], "frame", "reply").first()
    assert shown["shown"] == bytearray(b"own") and shown["shown_from"] == "original"


def test_history_over_folders(spark, image_root, tmp):
    rows = B.history(spark, image_root, os.path.join(tmp, "none")).collect()
    assert {r["session_id"] for r in rows} >= {SESSION}
    assert all(r["output_count"] == 0 for r in rows)
    assert IM.list_files(spark, os.path.join(tmp, "none")).count() == 0


def test_compact_folder(spark, image_root, tmp):
    from backdrop.sinks import frames as SK
    table = os.path.join(tmp, "compact")
    B.compact_folder(spark, image_root, table)
    back = SK.read_frames(spark, table)
    direct = IM.read_image_folder(spark, image_root)
    cols = ["session_id", "frame_id", "filename", "mode", "data"]
    assert sorted(map(repr, back.select(*cols).collect())) == sorted(map(repr, direct.select(*cols).collect()))
    assert dict(back.dtypes)["session_id"] == "string"


def test_process_captures_bare_framing(spark, tmp):
    caps = os.path.join(tmp, "raw")
    os.makedirs(caps)
    payloads = [png_bytes(A_RGB), png_bytes(ONE_RGB)]
    blob = b"".join(struct.pack("!I", len(p)) + p for p in payloads) + struct.pack("!I", 0)
    with open(os.path.join(caps, "client7.raw"), "wb") as fh:
        fh.write(blob)
    res = sorted(B.process_captures(spark, caps, os.path.join(tmp, "landing"), os.path.join(tmp, "out"),
                                    framing="bare").collect(), key=lambda r: r["frame_id"])
    assert [(r["session_id"], r["filename"], r["frame_id"], r["status"]) for r in res] == [
        ("client7", "frame_0.jpg", 0, "success"), ("client7", "frame_1.jpg", 1, "success")]


def test_live_frames_are_ordered_by_their_number(spark, tmp):
    """Unpadded frame names: frame 11 is the latest, replies carry the frame number."""
    landing = os.path.join(tmp, "live-landing")
    for client in ("cam_a", "cam_b"):
        for n in range(12):
            write_png(os.path.join(landing, client, f"cam_{n}.png"), np.full((4, 4, 3), 20 * n, np.uint8))
    out = {k: os.path.join(tmp, k) for k in ("replies", "counts", "latest")}
    for q in B.run_live(spark, landing, out["replies"], out["counts"], os.path.join(tmp, "ck"), latest_out=out["latest"]):
        J.drain(q)
    latest = B.latest_results(spark, out["latest"]).collect()
    assert sorted((r["session_id"], r["filename"], r["frame_id"]) for r in latest) == [
        ("cam_a", "cam_11.png", 11), ("cam_b", "cam_11.png", 11)]
    replies = spark.read.parquet(out["replies"])
    assert sorted((r["session_id"], r["frame_id"]) for r in replies.select("session_id", "frame_id").distinct().collect()) == [
        (c, n) for c in ("cam_a", "cam_b") for n in range(12)]
    counts = spark.read.parquet(out["counts"]).where("session_id = 'cam_a'").collect()
    assert {r["frame_id"]: r["frame_count"] for r in counts} == {n: n + 1 for n in range(12)}


def test_folder_job_in_parquet_is_idempotent(spark, tmp):
    root, out = os.path.join(tmp, "in"), os.path.join(tmp, "frames")
    for s in ("s1", "s2"):
        write_png(os.path.join(root, s, "a.png"), np.full((4, 4, 3), 9, np.uint8))
    first = B.process_folder(spark, root, out, export="parquet").collect()
    again = B.process_folder(spark, root, out, "s1", export="parquet").collect()
    assert len(first) == 2 and [r["session_id"] for r in again] == ["s1"]
    assert spark.read.parquet(out).count() == 2 and os.path.isdir(again[0]["output_path"])
