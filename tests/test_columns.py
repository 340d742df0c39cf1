import re
from datetime import datetime

from pyspark.sql import functions as F

from backdrop.functions import columns as C


def test_image_name_predicate(spark):
    names = ["a.png", "B.JPG", "c.Jpeg", "d.jpe", "e.png.txt", "f.gif", "png", ".jpg"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = {r["f"]: r["ok"] for r in df.select("f", C.is_image_name("f").alias("ok")).collect()}
    assert got == {"a.png": True, "B.JPG": True, "c.Jpeg": True, "d.jpe": False, "e.png.txt": False,
                   "f.gif": False, "png": False, ".jpg": True}


def test_uint32_round_trip_and_end_marker(spark):
    df = spark.createDataFrame([(0,), (1,), (255,), (65536,), (C.END_MARKER,)], "v long")
    back = df.select("v", C.uint32_be(C.uint32_be_bytes("v")).alias("w"),
                     F.octet_length(C.uint32_be_bytes("v")).alias("n"))
    assert all(r["v"] == r["w"] and r["n"] == 4 for r in back.collect())
    raw = spark.createDataFrame([(bytearray(b"\x00\x00\x01\x00\xff\xff\xff\xff"),)], "b binary")
    r = raw.select(C.uint32_be("b", 1).alias("a"), C.uint32_be("b", 5).alias("e")).first()
    assert (r["a"], r["e"]) == (256, C.END_MARKER)


def test_utf8(spark):
    df = spark.createDataFrame([(bytearray("日本.png".encode()),), (bytearray(b"\xff\xfe"),)], "b binary")
    got = [r["t"] for r in df.select(C.utf8_text("b").alias("t")).collect()]
    assert got[0] == "日本.png" and got[1] is None


def test_session_ids(spark):
    sid = C.new_session_id(datetime(2024, 1, 2, 3, 4, 5), "abcdef01")
    assert sid == "20240102_030405_abcdef01" and re.fullmatch(r"\d{8}_\d{6}_[0-9a-f]{8}", C.new_session_id())
    assert re.fullmatch(r"\d{8}_\d{6}", C.new_session_id(unique=False))
    ids = [sid, "20240102_030405", "plain", "2024_x", "20241399_000000_ab"]
    df = spark.createDataFrame([(i,) for i in ids], "s string")
    got = {r["s"]: r["d"] for r in df.select("s", C.session_display_time("s").alias("d")).collect()}
    assert got == {sid: "02/01/2024 03:04:05", "20240102_030405": "02/01/2024 03:04:05", "plain": "plain",
                   "2024_x": "2024_x", "20241399_000000_ab": "20241399_000000_ab"}


def test_paths_payload_and_json(spark):
    df = spark.createDataFrame([("s1", 7, "f.png", bytearray(b"")), ("s2", 8, "g.jpg", None)],
                               "sid string, fid long, name string, p binary")
    r = df.select(C.session_path("/out/", "sid", "name").alias("p1"), C.frame_file_name("sid", "fid").alias("n"),
                  C.has_payload("p").alias("ok"), C.json_line("name").alias("j")).collect()
    assert (r[0]["p1"], r[0]["n"], r[0]["ok"], r[0]["j"]) == ("/out/s1/f.png", "s1_7.jpg", False, '{"name":"f.png"}')
    assert r[1]["ok"] is False


def test_stamps_ignore_the_session_time_zone(spark):
    """A wall time inside a daylight-saving gap keeps its digits."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("20240310_023000_ab",)], "s string")
        r = df.select(C.session_display_time("s").alias("d"),
                      C.stamp(F.expr("TIMESTAMP_NTZ'2024-03-10 02:30:00'")).alias("st")).first()
        assert (r["d"], r["st"]) == ("10/03/2024 02:30:00", "20240310_023000")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
