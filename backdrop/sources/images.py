"""Image folders as frame rows.

Layout: ``<root>/<session_id>/<file>`` or ``<root>/session_id=<id>/<file>``.
Spark's ``image`` source decodes PNG and JPEG in the JVM, but generates its
row writer anew for every file (7 ms of a core, however small the file), so
:func:`decode_files` decodes plain PNG and BMP files itself, by content, and
leaves all others to that source. The extension test
is a case-insensitive glob pushed into the file listing (Spark's
``pathGlobFilter`` itself is case-sensitive), so other files are never
opened. Partition discovery is off (``recursiveFileLookup``) and files below a
session's own directory are left out, so a folder's frames are its direct
children; the session id is the parent directory name, kept as text.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backdrop import schemas, storage
from backdrop.config import checkpoint_dir
from backdrop.functions import columns as C
from backdrop.functions.images import decode_plain
from backdrop.operators import results as R
from backdrop.operators import sequence as SEQ
from backdrop.sinks import frames as SK


# Listings up to this many files are broadcast when numbers are joined to frames.
NUMBERING_BROADCAST_FILES = 1_000_000
# A batch of decoded frames is closed at so many rows or bytes of pixels.
_OUT_ROWS, _OUT_BYTES = 1024, 16 << 20

# The fixed schema of Spark's image source (streams must declare it).
IMAGE_SOURCE_SCHEMA = T.StructType([T.StructField("image", T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
]))])


BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Driver-side existence test through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _plain(path) -> Column:
    """A path or URI without its scheme and authority."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "")


def _below(spark: SparkSession, root: str, levels: int, path) -> Column:
    """True for files exactly ``levels`` path components below ``root``."""
    if any(c in root for c in "*?[{"):  # a glob: its matches lie at different depths
        return F.lit(True)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    depth = fs.makeQualified(p).toUri().getPath().rstrip("/").count("/") + levels
    return F.size(F.split(_plain(path), "/")) == depth + 1


def empty_frames(spark: SparkSession, schema=schemas.FRAMES) -> DataFrame:
    """The empty result of a missing folder or a session without frames."""
    return spark.createDataFrame([], schema)


def session_dir(spark: SparkSession, root: str, session_id: str) -> str | None:
    """``<root>/<id>`` or ``<root>/session_id=<id>``, whichever exists."""
    for name in (session_id, f"session_id={session_id}"):
        path = f"{root.rstrip('/')}/{name}"
        if path_exists(spark, path):
            return path
    return None


def _image_reader(spark: SparkSession, streaming: bool, max_files_per_trigger: int | None = None):
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("image").option("pathGlobFilter", C.IMAGE_GLOB).option("recursiveFileLookup", "true")
    if streaming:
        reader = reader.schema(IMAGE_SOURCE_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader


def _files_reader(spark: SparkSession, streaming: bool, max_files_per_trigger: int | None = None):
    """Image files as they are; a stream declares its schema."""
    reader = spark.readStream.schema(BINARY_FILE_SCHEMA) if streaming else spark.read
    reader = reader.format("binaryFile").option("pathGlobFilter", C.IMAGE_GLOB).option("recursiveFileLookup", "true")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader


def _contents(files: DataFrame) -> DataFrame:
    """``origin`` (as the image source writes it) and ``content`` of binary files."""
    # The image source writes local paths with an empty authority.
    return files.select(F.regexp_replace("_metadata.file_path", "^file:/(?=[^/])", "file:///").alias("origin"), "content")


_DECODED = T.StructType([schemas.FRAMES[c] for c in ("origin", "height", "width", "n_channels", "mode", "data")])
_CONTENTS = T.StructType([T.StructField("origin", T.StringType()), T.StructField("content", T.BinaryType())])


def _contents_of(batches):
    """(origin, bytes) of the rows of Arrow batches."""
    for batch in batches:
        origins, contents = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            yield origins[i].as_py(), contents[i].as_buffer().to_pybytes()


def _arrow_batches(rows, schema: T.StructType):
    """Rows as Arrow batches, each closed at ``_OUT_ROWS`` rows or ``_OUT_BYTES`` bytes of the last column."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow, out, size = to_arrow_schema(schema), [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    for row in rows:
        out.append(row)
        size += len(row[-1])
        if len(out) >= _OUT_ROWS or size >= _OUT_BYTES:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def decode_files(contents: DataFrame) -> DataFrame:
    """Frame rows of image files given as ``origin, content``, each file decoded by its content.

    Plain files are decoded in the tasks that read them. The others (JPEG, other
    kinds of PNG, broken files) are copied to a scratch folder at once, by one job,
    from which Spark's image source decodes them, so a file of any kind gives the
    row that the source gives for it.
    """
    spark = contents.sparkSession

    def decoded(batches):
        rows = ((origin, decode_plain(content)) for origin, content in _contents_of(batches))
        return _arrow_batches(((origin, *found) for origin, found in rows if found is not None), _DECODED)

    def others(batches):
        return _arrow_batches((row for row in _contents_of(batches) if decode_plain(row[1]) is None), _CONTENTS)

    rest = contents.mapInArrow(others, _CONTENTS)
    name = F.sha2("origin", 256)
    staging = f"{checkpoint_dir(spark).rstrip('/')}/images-{uuid.uuid4().hex}"
    staged = SK.store_files(rest.select(
        F.substring(name, 1, 2).alias("session_id"), F.col("origin").alias("filename"), F.concat(name, F.lit(".img")).alias("name"),
        F.col("content").alias("data")), staging)
    frames = contents.mapInArrow(decoded, _DECODED)
    n, lost = staged.agg(F.count(F.lit(1)), F.count_if(F.col("output_path").isNull())).first()
    if lost:
        raise RuntimeError(f"{lost} of {n} image files could not be copied to {staging}")
    if n:
        images = spark.read.format("image").option("recursiveFileLookup", "true").load(staging)
        names = staged.select(C.file_name("output_path").alias("name"), F.col("filename").alias("_came"))
        images = R.attach(images.select("image", C.file_name("image.origin").alias("name")), names, ["name"], "inner")
        frames = frames.unionByName(images.select(F.struct(F.col("_came").alias("origin"), *[
            f"image.{c}" for c in ("height", "width", "nChannels", "mode", "data")]).alias("image")).select(
                "image.origin", "image.height", "image.width", F.col("image.nChannels").alias("n_channels"), "image.mode", "image.data"))
    return frames


def _frame_rows(decoded: DataFrame, session_id: str | None = None) -> DataFrame:
    """Frames by the columns of :func:`decode_files`."""
    session = F.lit(session_id) if session_id is not None else C.parent_name("origin")
    return decoded.withColumns({
        "session_id": session, "frame_id": F.lit(None).cast("long"), "filename": C.file_name("origin"),
    }).select(*schemas.FRAMES.fieldNames()).where(C.is_image_name("filename"))


def _as_frames(images: DataFrame, session_id: str | None = None) -> DataFrame:
    origin = F.col("image.origin")
    session = F.lit(session_id) if session_id is not None else C.parent_name(origin)
    return images.select(
        session.alias("session_id"),
        F.lit(None).cast("long").alias("frame_id"),
        C.file_name(origin).alias("filename"),
        origin.alias("origin"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"),
    ).where(C.is_image_name("filename"))


def _zero_length_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of zero-byte files under ``path``; Spark's file sources skip them.

    The driver lists the top level (the session directories) and executors
    walk those directories in parallel, so the listing scales with the cluster.
    A file system that tasks cannot open is listed by the driver.
    """
    resolved = storage.resolve(spark, path)
    if not storage.reachable(resolved):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found, it = [], fs.listFiles(p, True)
        while it.hasNext():
            st = it.next()
            if st.getLen() == 0:
                found.append(st.getPath().toString())
        return spark.createDataFrame([(f,) for f in found], "path string")

    # Files are named as Spark lists them, below ``path``.
    named = lambda uri: storage.rebase(uri, resolved, path) if storage.scheme_of(path) != storage.scheme_of(resolved) else uri
    entries = storage.list_dir(resolved)
    tops = spark.createDataFrame([(named(e.uri),) for e in entries if not e.is_dir and e.size == 0], "path string")
    dirs = [(e.uri,) for e in entries if e.is_dir]
    if not dirs:
        return tops
    listing = spark.createDataFrame(dirs, "dir string").repartition(max(1, min(len(dirs), spark.sparkContext.defaultParallelism)))

    def walk(batches):
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = [named(e.uri) for e in storage.walk(folder) if e.size == 0]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["path"])

    return tops.unionByName(listing.mapInArrow(walk, "path string"))


def empty_image_files(spark: SparkSession, path: str, session_id: str | None = None,
                      zero_length: DataFrame | None = None) -> DataFrame:
    """Zero-byte image files, which Spark's file sources skip; the reference
    reports them as unreadable. A listing of file metadata only."""
    zl = zero_length if zero_length is not None else _zero_length_files(spark, path)
    rows = zl.withColumnRenamed("path", "origin")
    session = F.lit(session_id) if session_id is not None else C.parent_name("origin")
    return rows.select(
        session.alias("session_id"), F.lit(None).cast("long").alias("frame_id"),
        C.file_name("origin").alias("filename"), "origin",
        F.lit(-1).alias("height"), F.lit(-1).alias("width"), F.lit(-1).alias("n_channels"),
        F.lit(schemas.MODE_INVALID).alias("mode"), F.lit(None).cast("binary").alias("data"),
    ).where(C.is_image_name("filename"))


def read_image_folder(spark: SparkSession, root: str, session_id: str | None = None, number: bool = True,
                      on_unreadable: str = "status", report_empty: bool = True) -> DataFrame:
    """S1 (+ O1/O2): frames of one session folder, or of every session under ``root``.

    Frames are numbered per session in name order before unreadable ones are
    dropped (``on_unreadable="drop"``) or marked (``"status"``). Zero-byte
    files are reported as unreadable frames (``report_empty``).
    """
    path = root if session_id is None else session_dir(spark, root, session_id)
    if path is None or not path_exists(spark, path):
        return empty_frames(spark)
    levels = 2 if session_id is None else 1
    below = _below(spark, path, levels, "origin")
    if storage.reachable(storage.resolve(spark, checkpoint_dir(spark))):
        frames = _frame_rows(decode_files(_contents(_files_reader(spark, False).load(path)).where(below)), session_id)
    else:  # tasks cannot put files there
        frames = _as_frames(_image_reader(spark, False).load(path), session_id).where(below)
    zero_length = _zero_length_files(spark, path) if (report_empty or number) else None
    if report_empty:
        empty = empty_image_files(spark, path, session_id, zero_length)
        frames = frames.unionByName(empty.where(_below(spark, path, levels, "origin")))
    if number:
        # Number a content-free listing and join the numbers back on the file's
        # path. The listing is counted first (metadata only) and broadcast when
        # it is within the limit, so decoded frames are not shuffled.
        numbered = number_files(spark, path, session_id, zero_length).select("path", "frame_id")
        frames = R.attach(frames.drop("frame_id").withColumn("path", _plain("origin")), numbered, ["path"], "left",
                          max_broadcast_rows=NUMBERING_BROADCAST_FILES).select(*schemas.FRAMES.fieldNames())
    if on_unreadable == "drop":
        return R.handle_unreadable(frames, "drop")
    return frames


def number_files(spark: SparkSession, path: str, session_id: str | None = None,
                 zero_length: DataFrame | None = None) -> DataFrame:
    """O1 + O2 without pixels: ``session_id, filename, path, frame_id`` of every
    image file of a session folder (or of all sessions), by name."""
    names = _listing(spark, path, True, zero_length, 2 if session_id is None else 1)
    if session_id is not None:
        names = names.withColumn("session_id", F.lit(session_id))
    return SEQ.enumerate_frames(names, "session_id", ["filename", "path"], name="frame_id")


def replay_folder(spark: SparkSession, folder: str, session_id: str | None = None) -> DataFrame:
    """A folder replayed in name order, numbered from 0, unreadable frames
    skipped (their numbers leave gaps). ``frame_id`` carries the order; the
    frames themselves are not sorted (that would shuffle pixel bytes), a
    consumer that needs them in order sorts its own slim output."""
    return read_image_folder(spark, folder, session_id, number=True, on_unreadable="drop")


def stream_image_folder(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S6 (+ S2 pacing): frames as they land in ``landing``; one micro-batch
    takes at most ``max_files_per_trigger`` files. ``frame_id`` is assigned by
    the streaming counter (see :mod:`backdrop.streaming.state`)."""
    return _as_frames(_image_reader(spark, True, max_files_per_trigger).load(landing)).where(
        _below(spark, landing, 2, "origin"))


def stream_image_files(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S6 by micro-batches: ``origin, content`` of image files as they land, for :func:`landed_frames`."""
    return _contents(_files_reader(spark, True, max_files_per_trigger).load(landing)).where(
        _below(spark, landing, 2, "origin"))


def landed_frames(batch: DataFrame) -> DataFrame:
    """The frames of a micro-batch of :func:`stream_image_files`."""
    return _frame_rows(decode_files(batch))


def stream_file_names(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``session_id, filename`` of image files as they land; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA) \
        .option("pathGlobFilter", C.IMAGE_GLOB).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    files = reader.load(landing).where(_below(spark, landing, 2, "path"))
    return files.select(C.parent_name("path").alias("session_id"), C.file_name("path").alias("filename"))


def list_files(spark: SparkSession, root: str, images_only: bool = False,
               zero_length: DataFrame | None = None) -> DataFrame:
    """``session_id, filename`` of every file under ``root`` without reading contents
    (``binaryFile`` skips the ``content`` column when it is not selected)."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], "session_id string, filename string")
    return _listing(spark, root, images_only, zero_length, 2).select("session_id", "filename")


def _listing(spark: SparkSession, root: str, images_only: bool, zero_length: DataFrame | None, levels: int) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if images_only:
        reader = reader.option("pathGlobFilter", C.IMAGE_GLOB)
    zl = zero_length if zero_length is not None else _zero_length_files(spark, root)
    files = reader.load(root).select("path").unionByName(zl).where(_below(spark, root, levels, "path"))
    out = files.select(C.parent_name("path").alias("session_id"), C.file_name("path").alias("filename"), _plain("path").alias("path"))
    return out.where(C.is_image_name("filename")) if images_only else out


def list_session_dirs(spark: SparkSession, root: str) -> DataFrame:
    """Session directories under ``root``, including empty ones (file sources
    skip those). A driver-side listing of names only."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], "session_id string")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    names = [n[len("session_id="):] if n.startswith("session_id=") else n for n in names]
    return spark.createDataFrame([(n,) for n in names], "session_id string")
