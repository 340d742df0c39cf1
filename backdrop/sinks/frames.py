"""K1, K2, K3: where processed frames and their results go.

* :func:`write_frames` is the main sink: parquet partitioned by session, any
  Hadoop file system, atomic per job through Spark's commit protocol.
* :func:`export_png` writes one lossless PNG per frame to
  ``<root>/<session_id>/<filename>``, :func:`land_payloads` the payloads of
  decoded captures. Both are one write job of the ``frame_files`` data source
  on any file system of :mod:`backdrop.storage` (:class:`FrameFiles`), which
  also stores a result row per input row; what is returned is that table, so
  no later action writes again.
* :func:`write_results` stores the result table (K3); nothing is collected.
* :func:`replies` shapes processed frames into the reply table of a live
  stream (K2): unreadable frames get a row with ``data`` NULL.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from backdrop import schemas, storage
from backdrop.config import checkpoint_dir
from backdrop.functions.png import encode_png

# What the file sink takes and what it stores for each row.
_FILES = T.StructType([
    T.StructField("session_id", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("frame_id", T.LongType()),
    T.StructField("filename", T.StringType()), T.StructField("name", T.StringType()), T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()), T.StructField("n_channels", T.IntegerType()), T.StructField("data", T.BinaryType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType())])
_OUTCOMES = T.StructType([
    T.StructField("session_id", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("frame_id", T.LongType()),
    T.StructField("filename", T.StringType()), T.StructField("output_path", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType())])


def write_frames(df: DataFrame, path: str, mode: str = "append", sessions_only: bool = False) -> None:
    """K1: frames as parquet, one directory per session. With ``sessions_only``
    an overwrite replaces the sessions of ``df`` and leaves others alone."""
    writer = df.write.mode(mode).partitionBy("session_id")
    if sessions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_frames(spark, path: str) -> DataFrame:
    """The frames table of :func:`write_frames`, with ``session_id`` kept as
    text (partition type inference would turn ``0012`` into ``12``)."""
    from pyspark.sql import types as T
    inferred = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == "session_id" else f for f in inferred.fields]
    return spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(path)


def write_results(results: DataFrame, path: str, mode: str = "append") -> None:
    """K3: the result table."""
    results.select(*schemas.RESULTS.fieldNames()).write.mode(mode).parquet(path)


@dataclass
class _TaskOutcome(WriterCommitMessage):
    """The hidden result file of a task, which names the files that it wrote."""
    outcomes: str


class _FrameFileWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.root = options["path"].rstrip("/")
        self.outcomes = options["outcomes"].rstrip("/")
        self.pixels = options["content"] == "pixels"
        self.staging = f"{self.root}/_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterable[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        attempt = TaskContext.get().taskAttemptId()
        staging = f"{self.staging}/{attempt}"
        staged: list[tuple[str, str]] = []  # staging name, target below the root
        moved: list[str] = []
        part = f"{self.outcomes}/_part-{attempt:08d}.parquet"
        schema = to_arrow_schema(_OUTCOMES)
        storage.make_dir(staging)
        storage.make_dir(self.outcomes)
        try:
            with storage.create_file(part) as out, pq.ParquetWriter(out, schema, compression="snappy") as table:
                for batch in iterator:
                    table.write_batch(self._stage(batch, staging, staged, schema))
            made = set()
            for source, target in staged:
                folder = target.rpartition("/")[0]
                if folder not in made:
                    storage.make_dir(f"{self.root}/{folder}")
                    made.add(folder)
                storage.move(source, f"{self.root}/{target}")
                moved.append(f"{self.root}/{target}")
        except BaseException:
            for target in moved:
                storage.delete(target)
            storage.delete(part)
            storage.delete(staging)
            raise
        storage.delete(staging)
        return _TaskOutcome(part)

    def _stage(self, batch: pa.RecordBatch, staging: str, staged: list, schema: pa.Schema) -> pa.RecordBatch:
        """Write a batch's files under staging names; its result rows."""
        column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
        sessions, names, status, message = (column[c].to_pylist() for c in ("session_id", "name", "status", "message"))
        targets: list[str | None] = []
        for i in range(batch.num_rows):
            target = None
            if status[i] is None or status[i] == schemas.SUCCESS:
                status[i] = schemas.SUCCESS
                try:
                    name = names[i].rsplit("/", 1)[-1]
                    target = f"{sessions[i]}/{name}"
                    if any(part in ("", ".", "..") for part in target.split("/")):
                        raise ValueError(f"no file can be called {target}")
                    data = column["data"][i].as_buffer()
                    if self.pixels:
                        data = encode_png(_three_channels(np.frombuffer(data, np.uint8).reshape(
                            *(column[c][i].as_py() for c in ("height", "width", "n_channels")))))
                    source = f"{staging}/{len(staged)}"
                    with storage.create_file(source) as out:
                        out.write(data)
                    staged.append((source, target))
                except Exception as exc:  # noqa: BLE001 - reported in the row
                    status[i], message[i], target = schemas.ERROR, f"{type(exc).__name__}: {exc}", None
            targets.append(target)
        text = pa.string()
        return pa.RecordBatch.from_arrays(
            [column["session_id"], column["seq"], column["frame_id"], column["filename"], pa.array(targets, text),
             pa.array(status, text), pa.array(message, text)], schema=schema)

    def commit(self, messages):
        for m in messages:
            if m is not None:
                storage.move(m.outcomes, m.outcomes.replace("/_part-", "/part-"))
        storage.delete(self.staging)

    def abort(self, messages):
        for m in messages:
            if m is not None and storage.size_of(m.outcomes) is not None:
                with storage.open_file(m.outcomes) as src:
                    for target in pq.read_table(src, columns=["output_path"])["output_path"].to_pylist():
                        if target is not None:
                            storage.delete(f"{self.root}/{target}")
        storage.delete(self.outcomes)
        storage.delete(self.staging)


class FrameFiles(DataSource):
    """A sink of one file per row: ``<path>/<session_id>/<name>``.

    A task writes its files under staging names, moves them when all are
    written and takes them back if it fails. Result rows stay in hidden files
    until the job commits, so a task that ran twice counts once. When the job
    fails, the files of its finished tasks are deleted, and with them what they
    replaced.
    """

    @classmethod
    def name(cls):
        return "frame_files"

    def schema(self):
        return _FILES

    def writer(self, schema, overwrite):
        return _FrameFileWriter(self.options)


def _three_channels(pixels: np.ndarray) -> np.ndarray:
    if pixels.shape[-1] == 1:
        return np.repeat(pixels, 3, axis=-1)
    return pixels[..., :3]


def _write_files(rows: DataFrame, root: str, content: str) -> DataFrame:
    """Run the file sink over ``rows`` (columns of ``_FILES`` by name, NULL where missing); the stored outcomes."""
    spark = rows.sparkSession
    spark.dataSource.register(FrameFiles)
    present = set(rows.columns)
    slim = rows.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in _FILES.fields])
    outcomes = f"{checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"
    slim.write.format("frame_files").mode("append").option("content", content).option(
        "outcomes", storage.resolve(spark, outcomes)).save(storage.resolve(spark, root))
    if not storage.list_dir(storage.resolve(spark, outcomes)):  # no task ran
        return spark.createDataFrame([], _OUTCOMES)
    below = F.concat(F.lit(f"{root.rstrip('/')}/"), "output_path")
    return spark.read.schema(_OUTCOMES).parquet(outcomes).withColumn("output_path", below)


def store_files(rows: DataFrame, root: str) -> DataFrame:
    """Write each row's ``data`` to ``<root>/<session_id>/<name>``, at once; the stored ``filename, output_path`` of each."""
    return _write_files(rows, root, "bytes").select("filename", "output_path")


def export_png(df: DataFrame, root: str, input_root: str | None = None) -> DataFrame:
    """K1 file export, run at once: returns the stored table of one ``results`` row per input row.

    The file holds PNG whatever its name says; readers go by the content.
    """
    done = _write_files(df.drop("name").withColumn("name", F.col("filename")), root, "pixels")
    came = F.concat_ws("/", F.lit(input_root.rstrip("/")), "session_id", "filename") if input_root else F.lit(None).cast("string")
    return done.withColumn("input_path", came).select(*schemas.RESULTS.fieldNames())


def replies(processed: DataFrame, key: str = "session_id") -> DataFrame:
    """K2: the reply to each sent frame.

    ``processed`` comes from the frame transform with ``pass_through``: the
    processed frame where processing succeeded, the frame as sent where it
    failed (the server's pass-through, P4). ``data`` is NULL when the frame could
    not be decoded (the zero-length reply), which the receiver answers by
    showing its own frame (:func:`backdrop.operators.results.with_fallback`).
    """
    data = F.when(F.col("status") != schemas.UNREADABLE, F.col("data"))
    return processed.select(key, "frame_id", "filename", data.alias("data"), "height", "width", "status", "message")


def land_payloads(records: DataFrame, root: str, session_col: str = "session_id", name_col: str = "filename") -> DataFrame:
    """Write each decoded capture payload (an encoded image) to
    ``<root>/<session>/<name_col>``, at once, so Spark's ``image`` source can
    decode it on the executors. Returns the stored table of ``session_id, seq,
    frame_id, filename, path, status, message``."""
    frame_id = F.col("frame_id") if "frame_id" in records.columns else F.lit(None)
    name = F.coalesce(F.col(name_col), F.concat(F.lit("frame_"), F.col("seq").cast("string"), F.lit(".jpg")))
    rows = records.select(F.col(session_col).alias("session_id"), "seq", frame_id.alias("frame_id"), "filename", name.alias("name"),
                          F.col("payload").alias("data"), "status", "message")
    return _write_files(rows, root, "bytes").withColumnRenamed("output_path", "path").select(
        "session_id", "seq", "frame_id", "filename", "path", "status", "message")
