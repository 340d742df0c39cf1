import os
import time

import pytest
from pyspark.sql import functions as F

from backdrop.streaming import jobs as J
from backdrop.streaming import state as ST



@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    with J.state_partitions(spark, 2):
        yield


SCHEMA = "event_id long, client_id long, frame_id long"


def _land(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(folder, name))


def _run(spark, df, tmp, tag):
    out, ck = os.path.join(tmp, f"{tag}-out"), os.path.join(tmp, f"{tag}-ck")
    J.drain(J.write_stream(df, out, ck, partition_by=None))
    return out, ck


def test_counter_and_bounds_across_micro_batches(spark, tmp):
    landing = os.path.join(tmp, "landing")
    _land(spark, landing, [(1, 7, 1), (2, 7, 2), (3, 8, 3)], "b1")
    src = lambda: spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(landing)

    counted = ST.count_frames(src(), "client_id", ["event_id"])
    out, ck = _run(spark, counted, tmp, "count")
    _land(spark, landing, [(4, 7, 0xFFFFFFFF), (5, 7, 5), (6, 8, 6)], "b2")
    J.drain(J.write_stream(ST.count_frames(src(), "client_id", ["event_id"]), out, ck, partition_by=None))
    got = {r["event_id"]: r["frame_count"] for r in spark.read.parquet(out).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 3, 5: 4, 6: 2}

    bounded = ST.bound_frames(src(), "client_id", ["event_id"], limit=3, marker_col="frame_id")
    out2, _ = _run(spark, bounded, tmp, "bound")
    kept = sorted((r["event_id"], r["seq"]) for r in spark.read.parquet(out2).collect())
    # client 7 stops at its END marker (event 4); client 8 keeps both frames
    assert kept == [(1, 0), (2, 1), (3, 0), (6, 1)]


def test_latest_per_key_stream(spark, tmp):
    landing = os.path.join(tmp, "landing2")
    _land(spark, landing, [(1, 7, 1), (2, 7, 2), (3, 8, 3)], "b1")
    src = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(landing)
    last = ST.latest_per_key(src, "client_id", ["event_id"], ["frame_id"])
    q = last.writeStream.outputMode("complete").format("memory").queryName("latest_t") \
        .trigger(availableNow=True).start()
    J.drain(q)
    got = {r["client_id"]: (r["frame_id"], r["n_frames"]) for r in spark.table("latest_t").collect()}
    assert got == {7: (2, 2), 8: (3, 1)}
    assert spark.table("latest_t").where(F.col("n_frames") < 1).count() == 0


def test_processing_time_trigger_paces_micro_batches(spark, tmp):
    """T4: a processing-time trigger with maxFilesPerTrigger takes the landed
    files a few at a time; stopping and restarting resumes from the checkpoint."""
    landing = os.path.join(tmp, "paced")
    for k in range(4):
        _land(spark, landing, [(k, 1, k)], f"b{k}")
    src = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(landing)
    out, ck = os.path.join(tmp, "paced-out"), os.path.join(tmp, "paced-ck")
    q = J.write_stream(src, out, ck, trigger="200 milliseconds", partition_by=None)
    q.processAllAvailable()
    q.stop()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 4
    assert max(p["numInputRows"] for p in q.recentProgress) == 1
    _land(spark, landing, [(9, 1, 9)], "b9")
    J.drain(J.write_stream(src, out, ck, partition_by=None))
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 9]


EVENTS = "event_id long, client_id long, frame_id long, at timestamp, announced long"
START = 1_700_000_000


def land_events(spark, folder, rows, name):
    """(event_id, client_id, frame_id, second, announced) as one file."""
    df = spark.createDataFrame([(e, c, f, s, a) for e, c, f, s, a in rows], "event_id long, client_id long, frame_id long, s double, announced long")
    df.withColumn("at", F.timestamp_micros(((F.col("s") + START) * 1_000_000).cast("long"))).select("event_id", "client_id", "frame_id", "at", "announced") \
        .coalesce(1).write.mode("append").parquet(os.path.join(folder, name))


def arriving(spark, folder):
    return spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(folder)


END = 0xFFFFFFFF
FAR = 10_000_000


def test_event_order_results_do_not_depend_on_files(spark, tmp):
    """G4, O4, O5 over rows that arrive out of order, one file per micro-batch and a restart, with a NULL key and tied times."""
    rows = [(i, None if i % 5 == 0 else i % 3, END if i in (23, 31) else i, i // 2 * 1.0, None) for i in range(60)]
    landing = os.path.join(tmp, "late")
    parts = [[r for r in rows if lo <= (r[0] + r[0] * 7 % 10) < lo + 12] for lo in range(0, 72, 12)] + [[(999, None, 0, float(FAR), None)]]
    place = lambda tag: (os.path.join(tmp, f"{tag}-o"), os.path.join(tmp, f"{tag}-c"))
    twins = {"n": lambda df: ST.counted(df, "client_id", ["at", "event_id"], "at", "10 seconds"),
             "f": lambda df: ST.first_n(df, "client_id", ["at", "event_id"], 4, "at", "10 seconds"),
             "e": lambda df: ST.until_end(df, "client_id", ["at", "event_id"], "at", "10 seconds")}
    sizes = {}
    for half in (parts[:4], parts[4:]):
        for part in half:
            land_events(spark, landing, part, f"b{parts.index(part)}")
        for tag, twin in twins.items():
            out, ck = place(tag)
            J.drain(J.write_stream(twin(arriving(spark, landing)), out, ck, partition_by=None))
            sizes.setdefault(tag, []).append(spark.read.parquet(out).count())
    of = lambda key: [r for r in rows if r[1] == key]
    keys = {r[1] for r in rows}
    got = spark.read.parquet(place("n")[0]).collect()
    assert sorted((r["event_id"], r["frame_count"]) for r in got) == sorted((r[0], i + 1) for k in keys for i, r in enumerate(of(k)))
    assert 0 < sizes["n"][0] < sizes["n"][1] == 60  # emitted as the watermark goes on
    got = spark.read.parquet(place("f")[0]).collect()
    assert sorted((r["event_id"], r["seq"]) for r in got) == sorted((r[0], i) for k in keys for i, r in enumerate(of(k)[:4]))
    got = spark.read.parquet(place("e")[0]).collect()
    first = {k: min((r[0] for r in of(k) if r[2] == END), default=99) for k in keys}
    assert sorted(r["event_id"] for r in got) == [r[0] for r in rows if r[0] < first[r[1]]]


def test_latest_over_files_in_any_order(spark, tmp):
    rows = [(i, None if i % 5 == 0 else i % 3, i) for i in range(60)]
    landing = os.path.join(tmp, "shuffled")
    for k in range(8):
        _land(spark, landing, [r for r in rows if r[0] * 7 % 8 == k], f"b{k}")
    src = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(landing)
    last = ST.latest_per_key(src, "client_id", ["event_id"], ["event_id"])
    out, ck = os.path.join(tmp, "l-o"), os.path.join(tmp, "l-c")
    J.drain(J.write_batches(last, out, ck, mode="update"))
    got = J.newest_rows(spark, out, last.schema, "client_id").collect()
    of = lambda key: [r for r in rows if r[1] == key]
    assert {(r["client_id"], r["event_id"], r["n_frames"]) for r in got} == {(k, of(k)[-1][0], len(of(k))) for k in {r[1] for r in rows}}


def closed(spark, out):
    if not os.path.isdir(os.path.join(out, "_spark_metadata")):
        return {}
    rows = spark.read.schema("client_id long, announced long, received long, reason string, complete boolean").parquet(out).collect()
    assert len(rows) == len({r["client_id"] for r in rows})
    return {r["client_id"]: tuple(r)[1:] for r in rows}


def wait_for(done, seconds=100):
    deadline = time.time() + seconds
    while not done():
        assert time.time() < deadline
        time.sleep(0.5)


def test_sessions_close_in_event_order(spark, tmp):
    landing, out, ck = (os.path.join(tmp, x) for x in ("close", "close-o", "close-c"))
    rows = [(10 + i, 1, i, float(i), 3 if i == 0 else None) for i in range(5)]  # two beyond its announced count
    rows += [(20, 2, 0, 0.0, 9), (21, 2, END, 1.0, None), (22, 2, 2, 2.0, None)]
    rows += [(30, 3, 0, 0.0, 9), (31, 3, 1, 5.0, None), (32, 3, 2, 100.0, None)]  # silent too long, then late
    rows += [(40, 4, 0, 3.0, None), (41, 4, 1, 4.0, None)]  # never announced
    rows += [(50, 5, 0, 0.0, 0)]
    land_events(spark, landing, rows[1::2], "b0")
    land_events(spark, landing, rows[::2], "b1")
    land_events(spark, landing, [(99, None, 0, float(FAR), None)], "b2")
    made = ST.session_close(arriving(spark, landing), "client_id", ["at", "event_id"], "announced", "30 seconds", "at", "200 seconds")
    J.drain(J.write_stream(made, out, ck, partition_by=None))
    assert closed(spark, out) == {1: (3, 3, "complete", True), 2: (9, 1, "end marker", False), 3: (9, 2, "idle", False),
                                  4: (None, 2, "idle", True), 5: (0, 0, "complete", True)}


def test_sessions_close_by_the_clock(spark, tmp):
    landing, out, ck = (os.path.join(tmp, x) for x in ("clock", "clock-o", "clock-c"))
    land_events(spark, landing, [(1, 1, 0, 0.0, 2), (2, 2, 0, 0.0, 3)], "b0")
    made = ST.session_close(arriving(spark, landing), "client_id", ["at", "event_id"], "announced", "20 seconds", "at")
    query = J.write_stream(made, out, ck, trigger="500 milliseconds", partition_by=None)
    # (processAllAvailable never returns: the clock alone is reason for another micro-batch.)
    wait_for(lambda: sum(p["numInputRows"] for p in query.recentProgress) >= 2)
    land_events(spark, landing, [(3, 1, 1, 1.0, None)], "b1")
    wait_for(lambda: len(closed(spark, out)) == 2)
    query.stop()
    assert closed(spark, out) == {1: (2, 2, "complete", True), 2: (3, 1, "idle", False)}


def test_live_fallback_shows_the_original_for_late_and_absent_replies(spark, tmp):
    sent_dir, reply_dir, out, ck = (os.path.join(tmp, x) for x in ("sent", "replies", "o", "c"))
    sent = [(1, 7, 0, 0.0, None), (2, 7, 0, 1.0, None), (3, 7, 0, 2.0, None), (4, 7, 0, 3.0, None), (5, 7, 0, 4.0, None)]
    # 1 in time, twice; 2 late; 3 empty; 4 none; 5 exactly at the limit
    replies = [(1, 7, 0, 0.5, 8), (2, 7, 0, 7.0, 8), (3, 7, 0, 2.5, 0), (5, 7, 0, 9.0, 8)]
    land_events(spark, sent_dir, sent, "b0")
    land_events(spark, reply_dir, replies, "b0")
    land_events(spark, reply_dir, [(1, 7, 0, 0.9, 9)], "b1")
    for d in (sent_dir, reply_dir):
        land_events(spark, d, [(99, None, 0, float(FAR), None)], "b9")
    said = arriving(spark, reply_dir).select("event_id", F.col("at").alias("came"), F.repeat(F.lit("r"), F.col("announced").cast("int")).alias("reply"))
    made = ST.live_fallback(arriving(spark, sent_dir).withColumn("frame", F.lit("original")), said, "event_id", "at", "came", "frame", "reply",
                            "5 seconds", "1 minute")
    J.drain(J.write_stream(made, out, ck, partition_by=None))
    got = spark.read.parquet(out).where("event_id < 99").collect()
    assert sorted((r["event_id"], r["shown_from"], r["shown"]) for r in got) == [
        (1, "processed", "r" * 8), (2, "original", "original"), (3, "original", "original"), (4, "original", "original"), (5, "processed", "r" * 8)]


def test_keys_share_groups_of_state(spark, tmp):
    """State is kept by group, not by key; NULLs of other keys leave long ids exact."""
    big = 2**60
    rows = [(big + i, None if i % 7 == 0 else i % 300, None if i % 11 == 0 else END if i % 13 == 0 else big + i, float(i // 4), None) for i in range(900)]
    landing = os.path.join(tmp, "many")
    land_events(spark, landing, rows[::2], "b0")
    land_events(spark, landing, rows[1::2], "b1")
    land_events(spark, landing, [(None, None, None, float(FAR), None)], "b2")
    of: dict = {}
    for r in rows:
        of.setdefault(r[1], []).append(r)
    twins = {"n": lambda df: ST.counted(df, "client_id", ["at", "event_id"], "at", "1 hour", groups=2),
             "f": lambda df: ST.first_n(df, "client_id", ["at", "event_id"], 2, "at", "1 hour", groups=2),
             "e": lambda df: ST.until_end(df, "client_id", ["at", "event_id"], "at", "1 hour", groups=2),
             "s": lambda df: ST.session_close(df, "client_id", ["at", "event_id"], "announced", "30 days", "at", "1 hour", groups=2)}
    got = {}
    for tag, twin in twins.items():
        out, ck = os.path.join(tmp, f"{tag}-o"), os.path.join(tmp, f"{tag}-c")
        query = J.drain(J.write_stream(twin(arriving(spark, landing)), out, ck, partition_by=None))
        assert max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) <= 20
        got[tag] = spark.read.parquet(out).collect()
    assert sorted((r["event_id"], r["frame_count"]) for r in got["n"]) == sorted((r[0], i + 1) for k in of for i, r in enumerate(of[k]))
    assert sorted((r["event_id"], r["seq"]) for r in got["f"]) == sorted((r[0], i) for k in of for i, r in enumerate(of[k][:2]))
    ended = {k: next((i for i, r in enumerate(of[k]) if r[2] == END), len(of[k])) for k in of}
    assert sorted((r["event_id"], r["frame_id"] or 0) for r in got["e"]) == sorted((r[0], r[2] or 0) for k in of for r in of[k][: ended[k]])
    want = {k: (n, "end marker" if n < len(of[k]) else "idle") for k, n in ended.items()}
    assert {r["client_id"]: (r["received"], r["reason"]) for r in got["s"]} == want


def test_a_session_with_rows_ahead_is_not_idle(spark, tmp):
    """The session of the row that moves the watermark waits for that row; others of its group close."""
    landing, out, ck = (os.path.join(tmp, x) for x in ("ahead", "ahead-o", "ahead-c"))
    land_events(spark, landing, [(1, None, 1, 0.0, 9), (2, 5, 2, 1.0, 9)], "b0")
    land_events(spark, landing, [(99, None, 0, float(FAR), None)], "b1")
    made = ST.session_close(arriving(spark, landing), "client_id", ["at", "event_id"], "announced", "30 seconds", "at", "200 seconds", groups=1)
    J.drain(J.write_stream(made, out, ck, partition_by=None))
    assert closed(spark, out) == {5: (9, 1, "idle", False)}
