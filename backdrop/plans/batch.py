"""The reference's three entry points as Spark jobs.

* :func:`process_folder` - the batch folder job: scan a session folder,
  remove the backdrop of every frame in parallel, write the frames and
  return the result table. Nothing is collected; the driver sees no frame.
* :func:`process_captures`, :func:`stream_captures` - the finite session
  stream, recorded as capture files: decode, land payloads as image files,
  then the same job, for all files at once or as they arrive.
* :func:`run_live` - the live round trip as a stream: frames landing per
  client, processed per micro-batch, replies appended to a reply table,
  with a running frame counter per client.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from backdrop import schemas
from backdrop.functions import columns as C
from backdrop.operators import results as R
from backdrop.sinks import frames as SK
from backdrop.sources import captures as CAP
from backdrop.sources import images as IM
from backdrop.streaming import jobs as J


def process_folder(spark: SparkSession, input_root: str, output_root: str, session_id: str | None = None,
                   segmenter="threshold", export: str = "png", **kw) -> DataFrame:
    """U1 over a folder: returns the ``results`` rows (K3).

    ``export="png"`` writes ``<output_root>/<session>/<filename>``;
    ``"parquet"`` writes the frames table partitioned by
    session and returns result rows pointing at the session's directory. A
    repeated run replaces the sessions that it writes; result rows are those
    of this run's sessions only.
    """
    if export == "png":
        # Frames are numbered in the slim result table: pixels meet no join. The
        # numbers are stored, so results stay when the input folder goes.
        folder = input_root if session_id is None else IM.session_dir(spark, input_root, session_id)
        frames = IM.read_image_folder(spark, input_root, session_id, number=False)
        if folder is None or not IM.path_exists(spark, folder):
            return SK.export_png(J.frame_transform(frames, segmenter, **kw), output_root, input_root)
        numbers = IM.number_files(spark, folder, session_id).groupBy("session_id", "filename").agg(
            F.min("frame_id").alias("frame_id"))
        stored = J.scratch_path(spark, "numbers")
        numbers.write.parquet(stored)
        done = SK.export_png(J.frame_transform(frames, segmenter, **kw), output_root, input_root)
        numbers = spark.read.schema(numbers.schema).parquet(stored)
        return done.drop("frame_id").join(numbers, ["session_id", "filename"], "left").select(*done.columns)
    if export != "parquet":
        raise ValueError("export must be 'png' or 'parquet'")
    frames = IM.read_image_folder(spark, input_root, session_id)
    processed = J.frame_transform(frames, segmenter, **kw)
    SK.write_frames(processed, output_root, mode="overwrite", sessions_only=True)
    done = SK.read_frames(spark, output_root).join(frames.select("session_id").distinct(), "session_id", "left_semi")
    written = F.concat(F.lit(f"{output_root.rstrip('/')}/session_id="), F.col("session_id"))
    return R.result_rows(done, input_root, output_root).withColumn(
        "output_path", F.when(F.col("output_path").isNotNull(), written))


def compact_folder(spark: SparkSession, input_root: str, table: str, mode: str = "append") -> None:
    """Decode an image folder once into a parquet frames table (K1 layout).

    Many small image files cost listing and open time on every read; the
    table is read back with :func:`backdrop.sinks.frames.read_frames`.
    """
    SK.write_frames(IM.read_image_folder(spark, input_root), table, mode)


def capture_session(capture_col: str = "capture"):
    """Session id of a capture file: its name without the extension."""
    return F.regexp_replace(C.file_name(capture_col), r"\.[^.]*$", "")


def process_records(records: DataFrame, landing: str, output_root: str, segmenter="threshold", **kw) -> DataFrame:
    """K1 + K3 for decoded capture records: one result row per record, whatever became of it.

    The payloads are decoded once, by the action that lands them as images in
    a folder of this run and stores the slim record table. A frame is known by
    its session and its place in its capture, so equal, missing or odd names
    cost nothing: it lands, and is exported, under its place (``3-<capture>.png``,
    where the second part tells captures of one name apart).
    """
    spark = records.sparkSession
    run = f"{landing.rstrip('/')}/run-{uuid.uuid4().hex}"
    place = F.concat(F.col("seq").cast("string"), F.lit("-"), F.hex(F.xxhash64("capture")), F.lit(".png"))
    named = records.where(F.col("seq").isNotNull()).select(
        capture_session().alias("session_id"), "seq", F.coalesce("frame_id", "seq").alias("frame_id"),
        F.coalesce("filename", F.format_string("frame_%d.jpg", "seq")).alias("filename"), place.alias("place"),
        "payload", "status", "message")
    slim = SK.land_payloads(named, run, name_col="place").withColumn("place", C.file_name("path"))
    images = IM.read_image_folder(spark, run, number=False, report_empty=False)
    done = SK.export_png(J.frame_transform(images, segmenter, **kw), output_root, run).select(
        "session_id", F.col("filename").alias("place"), "output_path", F.col("status").alias("_status"),
        F.col("message").alias("_message"))
    landed = F.col("status") == schemas.SUCCESS
    return slim.join(done, ["session_id", "place"], "left").select(
        "session_id", "seq", "frame_id", "filename", F.col("path").alias("input_path"), "output_path",
        F.when(landed, F.coalesce("_status", F.lit(schemas.UNREADABLE))).otherwise(F.col("status")).alias("status"),
        F.when(landed, F.col("_message")).otherwise(F.col("message")).alias("message"))


def process_captures(spark: SparkSession, captures: str, landing: str, output_root: str, framing: str = "session",
                     segmenter="threshold", **kw) -> DataFrame:
    """S3/S4 -> K1 (T2): capture files decoded, landed, processed; see :func:`process_records`."""
    return process_records(CAP.read_captures(spark, captures, framing), landing, output_root, segmenter, **kw)


def stream_captures(spark: SparkSession, captures: str, landing: str, output_root: str, results_out: str,
                    checkpoint: str | None = None, framing: str = "session", trigger="availableNow",
                    max_files_per_trigger: int | None = None, segmenter="threshold", **kw) -> StreamingQuery:
    """The same job on captures as they land. Each micro-batch adds its
    result rows to ``results_out`` (:func:`capture_results` reads them)."""
    records = CAP.read_captures(spark, captures, framing, streaming=True, max_files_per_trigger=max_files_per_trigger)
    return J.write_batches(records, results_out, checkpoint or J.scratch_path(spark, "captures-ckpt"), trigger,
                           lambda batch: process_records(batch, landing, output_root, segmenter, **kw))


CAPTURE_RESULTS = T.StructType([schemas.RESULTS["session_id"], T.StructField("seq", T.LongType()),
                                *[f for f in schemas.RESULTS.fields if f.name != "session_id"]])


def capture_results(spark: SparkSession, results_out: str) -> DataFrame:
    """The result rows that :func:`stream_captures` has written so far."""
    return J.read_batches(spark, results_out, CAPTURE_RESULTS).drop("stream_epoch")


def run_live(spark: SparkSession, landing: str, replies_out: str, counts_out: str | None = None,
             checkpoint: str | None = None, trigger="availableNow", max_files_per_trigger: int | None = None,
             segmenter="threshold", latest_out: str | None = None, **kw) -> list[StreamingQuery]:
    """Entry 3: each client's frames land under ``<landing>/<client>/``.

    One query appends a reply per frame (K2: processed, passed through on
    error, NULL when undecodable), joinable on ``(session_id, frame_id)``:
    clients number their frames in the file name, and that number orders them. A second, light query keeps the running
    frame count per client (G4) in the state store; it lists files without
    reading them, so frame bytes never enter the state operator. A third
    (``latest_out``) keeps each client's latest result (O6): name and status,
    not the frame; every micro-batch adds the clients that it changed, and
    :func:`latest_results` reads the newest of each.
    """
    from backdrop.streaming import state as ST

    ck = checkpoint or J.scratch_path(spark, "live-ckpt")
    frames = IM.stream_image_folder(spark, landing, max_files_per_trigger).withColumn("frame_id", C.frame_number("filename"))
    replies = SK.replies(J.frame_transform(frames, segmenter, pass_through=True, **kw), "session_id")
    queries = [J.write_stream(replies, replies_out, os.path.join(ck, "replies"), trigger)]
    if counts_out is not None:
        names = IM.stream_file_names(spark, landing, max_files_per_trigger).withColumn("frame_id", C.frame_number("filename"))
        counted = ST.count_frames(names, "session_id", ["frame_id", "filename"], name="frame_count")
        queries.append(J.write_stream(counted, counts_out, os.path.join(ck, "counts"), trigger))
    if latest_out is not None:
        # Chained to the reply table (the file sink's committed files), so
        # frames are processed once. With availableNow the replies drain first.
        if trigger in ("availableNow", "once"):
            J.drain(queries[0])
        slim = spark.readStream.schema(replies.schema).parquet(replies_out).select("session_id", "frame_id", "filename", "status")
        latest = ST.latest_per_key(slim, "session_id", ["frame_id", "filename"], ["frame_id", "filename", "status"])
        queries.append(J.write_batches(latest, latest_out, os.path.join(ck, "latest"), trigger, mode="update"))
    return queries


LATEST = T.StructType([T.StructField("session_id", T.StringType()), T.StructField("frame_id", T.LongType()),
                       T.StructField("filename", T.StringType()), T.StructField("status", T.StringType()),
                       T.StructField("n_frames", T.LongType())])


def latest_results(spark: SparkSession, latest_out: str) -> DataFrame:
    """Each client's latest result as :func:`run_live` has written it so far."""
    return J.newest_rows(spark, latest_out, LATEST, "session_id")


def stream_results(spark: SparkSession, frames_out: str, input_root: str, output_root: str) -> DataFrame:
    """K3 for a frame stream: the result rows of everything it has written so
    far, read from its frames table (status and message are stored there;
    column pruning leaves the pixel column unread)."""
    return R.result_rows(SK.read_frames(spark, frames_out), input_root, output_root)


def history(spark: SparkSession, input_root: str, output_root: str) -> DataFrame:
    """Session history over folders (G1 + J1 + D2 + O3), empty sessions included."""
    from backdrop.operators import summary as SUM
    return SUM.session_history(IM.list_files(spark, input_root), IM.list_files(spark, output_root),
                               input_root, output_root, sessions=IM.list_session_dirs(spark, input_root))
