import os

from pyspark.sql import functions as F

from backdrop import schemas
from backdrop.operators import results as R
from backdrop.operators import sequence as SEQ
from backdrop.sinks import frames as SK


def test_write_results_round_trip(spark, tmp):
    rows = [("s", 0, "a.png", "in/s/a.png", "out/s/a.png", "success", None),
            ("s", 1, "b.jpg", "in/s/b.jpg", None, "unreadable", "frame could not be decoded")]
    res = spark.createDataFrame(rows, schemas.RESULTS)
    SK.write_results(res, os.path.join(tmp, "results"))
    assert sorted(spark.read.parquet(os.path.join(tmp, "results")).collect()) == sorted(res.collect())


def test_newest_first(spark):
    df = spark.createDataFrame([("20240101_000000",), ("20240301_000000",), ("plain",)], "session_id string")
    assert [r[0] for r in SEQ.newest_first(df).collect()] == ["plain", "20240301_000000", "20240101_000000"]


def test_first_n_by_announced_column(spark):
    rows = [("c1", i, 2) for i in range(5)] + [("c2", i, 4) for i in range(3)]
    df = spark.createDataFrame(rows, "capture string, seq long, announced long")
    kept = sorted((r["capture"], r["seq"]) for r in SEQ.first_n(df, "capture", ["seq"], F.col("announced")).collect())
    assert kept == [("c1", 0), ("c1", 1), ("c2", 0), ("c2", 1), ("c2", 2)]


def test_replies_pass_through_on_error(spark):
    from backdrop.operators import frames as FO

    def fragile(rgb):
        if rgb[0, 0, 0] == 7:
            raise ValueError("model failed")
        return rgb[..., 0] > 100

    rows = [("s", 0, "a.png", 1, 1, 1, 0, bytearray([200])), ("s", 1, "b.png", 1, 1, 1, 0, bytearray([7])),
            ("s", 2, "c.png", -1, -1, -1, -1, None), ("s", 3, "d.png", 1, 1, 1, 0, bytearray([5]))]
    df = spark.createDataFrame(rows, "session_id string, frame_id long, filename string, height int, width int, n_channels int, mode int, data binary")
    done = FO.remove_backdrop(df, fragile, pass_through=True)
    got = {r["frame_id"]: (r["status"], r["data"]) for r in SK.replies(done).collect()}
    assert got == {0: ("success", bytearray([192] * 3)), 1: ("error", bytearray([7])), 2: ("unreadable", None), 3: ("success", bytearray([5] * 3))}
    assert {r["frame_id"]: r["n_channels"] for r in done.collect()} == {0: 3, 1: 1, 2: -1, 3: 3}


def test_handle_unreadable_policies(spark):
    rows = [("s", 0, 16, bytearray(b"x")), ("s", 1, -1, bytearray(b"")), ("s", 2, 16, None)]
    df = spark.createDataFrame(rows, "session_id string, frame_id long, mode int, data binary")
    assert [r["frame_id"] for r in R.handle_unreadable(df, "drop").collect()] == [0]
    marked = {r["frame_id"]: r["status"] for r in R.handle_unreadable(df, "status").collect()}
    assert marked == {0: "success", 1: "unreadable", 2: "unreadable"}
