"""One transform for batch and streaming, run per micro-batch.

The reference processes a live stream one frame per Spark job and a batch
as one job; here both are the same DataFrame transform (T3). A stream is a
``readStream`` over a landing folder (S6); each micro-batch is one job over
many partitions (T1), bounded by ``maxFilesPerTrigger`` and paced by a
processing-time trigger (T4); ``availableNow`` drains what has landed and
stops (T5). A broken frame becomes a status row, never a failed batch (T6),
and the checkpoint makes a restart resume without duplicates.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from backdrop.config import checkpoint_dir
from backdrop.functions import pixels
from backdrop.operators import frames as FO
from backdrop.sources import images


def frame_transform(df: DataFrame, segmenter="threshold", bg_color=pixels.BG_COLOR,
                    cutoff: float = pixels.MASK_CUTOFF, mask_true: str = "background", pass_through: bool = False) -> DataFrame:
    """The shared transform; works unchanged on ``read`` and ``readStream`` frames."""
    return FO.remove_backdrop(df, segmenter, bg_color=bg_color, cutoff=cutoff, mask_true=mask_true, pass_through=pass_through)


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), f"{kind}-{uuid.uuid4().hex}")


@contextmanager
def state_partitions(spark: SparkSession, n: int):
    """Queries that are started inside keep their state in ``n`` partitions, for good: a checkpoint fixes their number.

    Every partition of a Python state operator costs a worker's start in every
    micro-batch, so small streams want few.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def write_stream(df: DataFrame, out: str, checkpoint: str, trigger="availableNow",
                 partition_by: str | None = "session_id", fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to files with Spark's exactly-once file sink."""
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _trigger(writer, trigger).start(out)


def write_batches(df: DataFrame, out: str, checkpoint: str, trigger="availableNow", each=None,
                  mode: str = "append") -> StreamingQuery:
    """Every micro-batch, put through ``each``, as its own folder
    ``<out>/stream_epoch=<n>``. A repeated micro-batch replaces its folder, so
    a restart adds nothing, and no folder that a reader sees is rewritten by
    another micro-batch."""
    def sink(batch, epoch):
        (each(batch) if each else batch).write.mode("overwrite").parquet(f"{out}/stream_epoch={epoch}")
    writer = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def read_batches(spark: SparkSession, out: str, schema) -> DataFrame:
    """All rows of :func:`write_batches`, with ``stream_epoch``."""
    schema = T.StructType([*schema.fields, T.StructField("stream_epoch", T.LongType())])
    if not images.path_exists(spark, out):  # no micro-batch yet
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)


def newest_rows(spark: SparkSession, out: str, schema, by) -> DataFrame:
    """The newest row per key of an aggregate written in update mode by
    :func:`write_batches` (only the keys of a micro-batch are in its folder)."""
    by = [by] if isinstance(by, str) else list(by)
    rest = [f.name for f in schema.fields if f.name not in by]
    newest = read_batches(spark, out, schema).groupBy(*by).agg(F.max_by(F.struct(*rest), "stream_epoch").alias("_new"))
    return newest.select(*by, *[F.col(f"_new.{c}").alias(c) for c in rest])


def run_frame_stream(spark: SparkSession, landing: str, out: str, checkpoint: str | None = None,
                     trigger="availableNow", max_files_per_trigger: int | None = None,
                     segmenter="threshold", **kw) -> StreamingQuery:
    """S6 + T1: frames landing in a folder -> backdrop removal -> parquet by session."""
    frames = images.stream_image_folder(spark, landing, max_files_per_trigger)
    processed = frame_transform(frames, segmenter, **kw)
    return write_stream(processed, out, checkpoint or scratch_path(spark, "frames-ckpt"), trigger)


def drain(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Block until an ``availableNow``/``once`` query has processed everything."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
