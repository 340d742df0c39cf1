import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from backdrop.operators import sequence as SEQ


@pytest.fixture(autouse=True)
def many_tasks(spark):
    """Small tables in as many tasks as large ones."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


@pytest.fixture(scope="module")
def skewed(spark):
    """Client 0 holds a third of all rows, with tied timestamps inside it."""
    rows = []
    base = dt.datetime(2024, 1, 1)
    for i in range(3000):
        client = 0 if i % 3 == 0 else 1 + i % 50
        rows.append((i, client, base + dt.timedelta(seconds=(i * 7919) % 5000 // 2), f"f{(i * 31) % 997:04d}_{i}"))
    return spark.createDataFrame(rows, "event_id long, client_id long, ts timestamp_ntz, name string")


def brute(df, by, order, start):
    return df.withColumn("want", F.row_number().over(Window.partitionBy(by).orderBy(*order)) + start - 1)


@pytest.mark.parametrize("order", [["ts", "event_id"], ["name", "event_id"], ["event_id"]])
def test_hot_keys_are_split_and_numbered_exactly(spark, skewed, order):
    got = SEQ.sequence_number(skewed, "client_id", order, name="seq", start=0)
    both = got.join(brute(skewed, "client_id", order, 0).select("event_id", "want"), "event_id")
    assert both.count() == 3000
    assert both.where(F.col("seq") != F.col("want")).count() == 0


def tasks_of(spark, df, by, order, where):
    """Rows of a key in each task that numbers it."""
    dealt = df.repartitionByRange(by, *order).where(where).groupBy(F.spark_partition_id()).count()
    return [r["count"] for r in dealt.collect()]


def test_rows_are_shuffled_once_and_no_window_takes_a_key(spark, skewed):
    got = SEQ.sequence_number(skewed, "client_id", ["ts", "event_id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    # What was dealt is stored; only counted runs meet a window.
    assert plan.count("Scan parquet") == 2 and "BroadcastHashJoin" in plan


def test_an_empty_table(spark, skewed):
    assert SEQ.sequence_number(skewed.limit(0), "client_id", ["ts"]).collect() == []


def test_first_n_and_frame_counter(spark, skewed):
    top = SEQ.first_n(skewed, "client_id", ["ts", "event_id"], 5)
    assert top.where("client_id = 0").count() == 5 and top.count() == 5 * 51
    cnt = SEQ.frame_counter(skewed, "client_id", ["ts", "event_id"])
    assert cnt.groupBy("client_id").agg(F.min("frame_count").alias("m")).where("m != 1").count() == 0


def test_take_until_end(spark):
    rows = [(1, "a", 0, 10), (1, "a", 1, 11), (1, "a", 2, 0xFFFFFFFF), (1, "a", 3, 12),
            (2, "b", 0, 5), (2, "b", 1, 6)]
    df = spark.createDataFrame(rows, "k long, s string, seq long, frame_id long")
    kept = sorted((r["k"], r["seq"]) for r in SEQ.take_until_end(df, "k", ["seq"]).collect())
    assert kept == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_latest_per_key(spark, skewed):
    last = {r["client_id"]: r for r in SEQ.latest_per_key(skewed, "client_id", ["ts", "event_id"],
                                                            ["event_id"]).collect()}
    want = brute(skewed.withColumn("neg", -F.col("event_id")), "client_id",
                 [F.col("ts").desc(), F.col("event_id").desc()], 1).where("want = 1").collect()
    assert {r["client_id"]: r["event_id"] for r in want} == {k: v["event_id"] for k, v in last.items()}


def test_string_splitters_number_exactly(spark, skewed):
    got = SEQ.sequence_number(skewed, "client_id", ["name", "event_id"], name="seq")
    both = got.join(brute(skewed, "client_id", ["name", "event_id"], 0).select("event_id", "want"), "event_id")
    assert both.where(F.col("seq") != F.col("want")).count() == 0


def test_attach_same_result_broadcast_or_shuffle(spark, skewed):
    from backdrop.operators import results as R
    ids = skewed.select("event_id", (F.col("event_id") * 2).alias("x"))
    a = R.attach(skewed, ids, "event_id")
    b = R.attach(skewed, ids, "event_id", max_broadcast_rows=0)
    assert sorted(a.collect()) == sorted(b.collect())
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()


def test_bunched_values_still_give_even_tasks(spark):
    """Half of a hot key's rows fall in a tenth of its value range."""
    rows = [(i, 0, (i % 2000) / 20000.0 if i < 2000 else 0.1 + (i - 2000) * 0.9 / 2000) for i in range(4000)]
    rows += [(10_000 + i, 1 + i % 7, float(i)) for i in range(700)]
    df = spark.createDataFrame(rows, "event_id long, client_id long, v double")
    sizes = tasks_of(spark, df, "client_id", ["v", "event_id"], "client_id = 0")
    assert len(sizes) >= 6 and max(sizes) < 1200
    got = SEQ.sequence_number(df, "client_id", ["v", "event_id"], name="seq")
    both = got.join(brute(df, "client_id", ["v", "event_id"], 0).select("event_id", "want"), "event_id")
    assert both.where(F.col("seq") != F.col("want")).count() == 0


@pytest.mark.parametrize("lead", ["ts", "name", "half"])
def test_a_hot_key_with_tied_leading_values_spreads(spark, lead):
    """A bulk import: every row of the hot key has the same time or name, or all but a few of them do."""
    ts = dt.datetime(2024, 1, 1)
    rows = [(i, 0, ts, "same", i if i < 150 else 9999) for i in range(3000)]
    rows += [(5000 + i, 1 + i % 5, ts + dt.timedelta(seconds=i), f"n{i}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "event_id long, client_id long, ts timestamp_ntz, name string, half long")
    sizes = tasks_of(spark, df, "client_id", [lead, "event_id"], "client_id = 0")
    assert len(sizes) >= 5 and max(sizes) < 1000
    got = SEQ.sequence_number(df, "client_id", [lead, "event_id"], name="seq")
    both = got.join(brute(df, "client_id", [lead, "event_id"], 0).select("event_id", "want"), "event_id")
    assert both.count() == 3500 and both.where(F.col("seq") != F.col("want")).count() == 0


def test_nulls_in_first_order_column_keep_their_place(spark):
    rows = [(i, 0, None if i % 4 == 0 else 5.0) for i in range(800)]
    df = spark.createDataFrame(rows, "event_id long, client_id long, v double")
    got = SEQ.sequence_number(df, "client_id", ["v", "event_id"], name="seq")
    both = got.join(brute(df, "client_id", ["v", "event_id"], 0).select("event_id", "want"), "event_id")
    assert both.where(F.col("seq") != F.col("want")).count() == 0


def test_first_n_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    out = SEQ.first_n(df, "k", ["v"], 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r["k"], r["v"], r["seq"]) for r in out.collect()) == sorted((k, k + 3 * i, i) for k in range(3) for i in range(5))


def test_null_key_and_many_string_splits_are_numbered_exactly(spark):
    """A NULL key is split like any other, and string splitters are not capped."""
    rows = [(None if i % 3 else "k", f"{(i * 7919) % 6000:05d}") for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, name string").repartition(5)
    got = SEQ.sequence_number(df, "k", ["name"]).collect()
    for key in (None, "k"):
        names = sorted(r[1] for r in rows if r[0] == key)
        assert sorted((r["seq"], r["name"]) for r in got if r["k"] == key) == list(enumerate(names))
    sizes = tasks_of(spark, df, "k", ["name"], "k is null")
    assert len(sizes) >= 4 and max(sizes) < 1600


def test_keys_of_every_kind(spark):
    """Keys of several columns, with NULL and NaN, whose runs cross batches and partitions."""
    rows = [(i, [None, float("nan"), 0.0, 1.5][i % 4], [None, "a", "b"][i // 4 % 3], {"x": i % 2}) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, f double, s string, m struct<x: long>")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = SEQ.sequence_number(df, ["f", "s", "m"], ["id"], start=1).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    seen = {}
    for r in sorted(got):
        key = (repr(r["f"]), r["s"], r["m"]["x"])
        seen[key] = seen.get(key, 0) + 1
        assert r["seq"] == seen[key]
    assert len(got) == 5000 and len(seen) == 12
