"""Many small files: what Spark does per file and per micro-batch stays bounded."""

import os

from pyspark.sql import functions as F

from backdrop.config import LISTING_TASKS, configure
from backdrop.plans import contract
from backdrop.sources import captures as CAP
from backdrop.streaming import jobs as J


def _captures(folder, n):
    os.makedirs(folder)
    for i in range(n):
        with open(os.path.join(folder, f"c{i}.bin"), "wb") as out:
            out.write(b"\0\0\0\1" + b"\0\0\0\1x" + i.to_bytes(4, "big") + b"\0\0\0\2ab")


def test_small_files_share_tasks_and_batches(spark, tmp):
    folder, n = os.path.join(tmp, "in"), 600
    _captures(folder, n)
    configure(spark)
    files = spark.read.format("binaryFile").load(folder)
    assert files.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) == LISTING_TASKS
    found = CAP.index_captures(files.select("path"), "session").groupBy((F.col("records") > 0).alias("records")).count()
    assert {tuple(r) for r in found.collect()} == {(True, n), (False, n)}


def test_micro_batches_grow_with_the_files(spark, tmp, monkeypatch):
    folder, n = os.path.join(tmp, "in"), 90
    _captures(folder, n)
    monkeypatch.setattr(contract, "CAPTURE_FILES_PER_TRIGGER", 2)
    most = contract._files_per_trigger(spark, folder)
    assert most == -(-n // contract.STREAM_BATCHES)
    records = CAP.read_captures(spark, folder, "session", streaming=True, max_files_per_trigger=most)
    query = J.drain(J.write_stream(records, os.path.join(tmp, "o"), os.path.join(tmp, "c"), partition_by=None))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) <= contract.STREAM_BATCHES
    got = spark.read.schema(records.schema).parquet(os.path.join(tmp, "o"))
    assert sorted(r["frame_id"] for r in got.where(F.col("seq").isNotNull()).collect()) == list(range(n))
    assert got.where("status = 'end' AND message = 'complete; 1 frames'").count() == n
