"""Recorded frame captures decoded into rows.

Two framings, both big-endian (fixed values of the wire formats):

* ``session``: ``uint32 num_frames``, then per frame
  ``uint32 name_len | utf-8 name | uint32 frame_id | uint32 size | bytes[size]``;
  ``frame_id = 0xFFFFFFFF`` after a name ends the capture (its payload is
  not read).
* ``bare``: repeated ``uint32 size | bytes[size]``; ``size = 0`` ends it.

One capture file is one session. Every complete record is kept; a capture
that stops inside a record is flagged ``truncated`` instead of losing what
was received. A zero-size payload is no frame (``status='unreadable'``), an
invalid UTF-8 name is an ``error`` row.

Captures are read in two passes. The first reads headers only, seeking past
payloads, and finds byte ranges of whole records (:class:`Range`); the second
decodes ranges, each in whatever task it lands, so one capture is read by
many tasks and its length has no limit. The format has no sync marker, which
is why the first pass has to follow a capture's headers from its start; it
touches a few bytes of each record. :func:`read_captures` lists and reads any
file system of :mod:`backdrop.storage`; elsewhere it falls back to whole
files of Spark's ``binaryFile`` source (up to 2 GiB each).
:func:`follow_captures` reads captures that still grow: the driver lists them
to shared storage and holds nothing for each of them; how far one has been
read is state of the query's tasks.

Every capture ends with one trailer row (``seq`` NULL, ``status='end'``)
carrying the announced count, the reason it ended and the ``truncated``
flag, so a streaming decoder never has to hold a capture to flag it.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Generator, Iterable
from typing import Iterator, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.state import GroupStateTimeout

from backdrop import schemas, storage
from backdrop.config import checkpoint_dir

END_MARKER = 0xFFFFFFFF
# Big-endian layouts (plain format strings: this module may travel by value,
# and compiled struct objects cannot be pickled).
_U32 = "!I"
_U32x2 = "!II"
# A batch of decoded records is closed at so many rows or payload bytes.
_OUT_ROWS, _OUT_BYTES = 1024, 16 << 20
END_STATUS = "end"  # status of the capture-level trailer row
# Records are put together into ranges of about so many bytes; the header pass
# fetches so many bytes at once, which holds the headers of small records.
RANGE_BYTES = 8 << 20
HEADER_FETCH = 64 << 10
# The longest payload that fits a binary value.
PAYLOAD_MAX = (1 << 31) - (1 << 16)
PATTERNS = {"session": "*.bin", "bare": "*.raw"}


class _Reader:
    """Exact-length reads over bytes or a binary file object."""

    def __init__(self, src):
        if isinstance(src, (bytes, bytearray, memoryview)):
            self.buf, self.pos, self.f = memoryview(src), 0, None
        else:
            self.buf, self.pos, self.f = None, 0, src

    def read(self, n: int):
        """``n`` bytes, or None at a cut; ``left`` then has how many there were."""
        if self.f is not None:
            data = self.f.read(n)
            self.left = len(data)
            return data if len(data) == n else None
        self.left = len(self.buf) - self.pos
        if self.pos + n > len(self.buf):
            self.pos = len(self.buf)
            return None
        out = self.buf[self.pos:self.pos + n]
        self.pos += n
        return bytes(out)


def _row(capture, seq, filename, frame_id, payload, announced, status, message, truncated=False):
    return {"capture": capture, "seq": seq, "filename": filename, "frame_id": frame_id, "payload": payload,
            "announced": announced, "truncated": truncated, "status": status, "message": message}


def _named_row(capture, seq, raw_name, frame_id, payload, announced):
    """A record of the session framing: broken names and empty payloads are marked."""
    try:
        name, status, message = raw_name.decode("utf-8"), schemas.SUCCESS, None
    except UnicodeDecodeError as exc:
        name, status, message = raw_name.decode("utf-8", "replace"), schemas.ERROR, f"file name: {exc}"
    if status == schemas.SUCCESS and len(payload) == 0:
        status, message = schemas.UNREADABLE, "zero-size payload"
    return _row(capture, seq, name, frame_id, payload, announced, status, message)


def _trailer(capture, announced, received, reason, truncated):
    """The capture-level row closing every capture (``seq`` NULL)."""
    return _row(capture, None, None, None, None, announced, END_STATUS, f"{reason}; {received} frames", truncated)


def decode_session_capture(src, capture: str) -> Iterator[dict]:
    """Records of one session-framed capture (bytes or a binary file object),
    streamed, then one trailer row."""
    rd = _Reader(src)
    head = rd.read(4)
    if head is None:
        yield _trailer(capture, None, 0, "no header", True)
        return
    announced = struct.unpack(_U32, head)[0]
    received, reason, truncated = 0, "complete", False
    for seq in range(announced):
        raw = rd.read(4)
        raw_name = rd.read(struct.unpack(_U32, raw)[0]) if raw is not None else None
        header = rd.read(8) if raw_name is not None else None
        if header is None:
            reason, truncated = "cut inside a record header", True
            break
        frame_id, size = struct.unpack(_U32x2, header)
        if frame_id == END_MARKER:
            reason = "end marker"
            break
        payload = rd.read(size)
        if payload is None:
            reason, truncated = "cut inside a payload", True
            break
        received += 1
        yield _named_row(capture, seq, raw_name, frame_id, payload, announced)
    yield _trailer(capture, announced, received, reason, truncated)


def decode_bare_capture(src, capture: str) -> Iterator[dict]:
    """Records of one bare length-prefixed capture, then one trailer row."""
    rd = _Reader(src)
    seq, reason, truncated = 0, "ended without an end record", False
    while True:
        raw = rd.read(4)
        if raw is None:
            if rd.left:  # a clean end leaves nothing
                reason, truncated = "cut inside a size prefix", True
            break
        size = struct.unpack(_U32, raw)[0]
        if size == 0:
            reason = "complete"
            break
        payload = rd.read(size)
        if payload is None:
            reason, truncated = "cut inside a payload", True
            break
        yield _row(capture, seq, None, None, payload, None, schemas.SUCCESS, None)
        seq += 1
    yield _trailer(capture, None, seq, reason, truncated)


DECODERS = {"session": decode_session_capture, "bare": decode_bare_capture}


def _to_batch(rows: list) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(schemas.CAPTURE_RECORDS)
    cols = {f.name: [r[f.name] for r in rows] for f in schemas.CAPTURE_RECORDS.fields}
    return pa.RecordBatch.from_pydict(cols, schema=schema)


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row["payload"] or b"")
        if len(out) >= _OUT_ROWS or size >= _OUT_BYTES:
            yield _to_batch(out)
            out, size = [], 0
    if out:
        yield _to_batch(out)


# --------------------------------------------------------------------------
# Header pass: byte ranges of whole records.

class Place(NamedTuple):
    """Where a header pass stands in a capture: the next record's byte and number, and the announced count once it is known."""
    byte: int = 0
    seq: int = 0
    announced: int | None = None


class Range(NamedTuple):
    """Whole records of a capture that lie next to each other, or how it ended (``message``)."""
    capture: str
    uri: str
    offset: int
    length: int
    seq: int
    records: int
    announced: int | None
    message: str | None
    truncated: bool


_RANGES = T.StructType([
    T.StructField("capture", T.StringType()), T.StructField("uri", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("records", T.LongType()),
    T.StructField("announced", T.LongType()), T.StructField("message", T.StringType()), T.StructField("truncated", T.BooleanType())])


def _fetcher(src, size: int) -> Callable[[int, int], bytes]:
    """Reads (place, n) out of a seekable file by blocks of ``HEADER_FETCH`` bytes; fewer bytes at its end."""
    start, block = 0, b""

    def fetch(at: int, n: int) -> bytes:
        nonlocal start, block
        if not start <= at <= at + n <= start + len(block):
            src.seek(at)
            start, block = at, src.read(max(0, min(max(n, HEADER_FETCH), size - at)))
        return bytes(block[at - start : at - start + n])

    return fetch


# (byte, length) of each complete record, then (place, reason, truncated); the reason is None where a growing capture may go on.
_Scan = Generator[tuple[int, int], None, tuple[Place, str, bool]]


def _scan_session(fetch: Callable[[int, int], bytes], size: int, place: Place) -> _Scan:
    at, seq, announced = place
    if announced is None:
        head = fetch(0, 4)
        if len(head) < 4:
            return place, "no header", True
        announced, at = struct.unpack(_U32, head)[0], 4
    while seq < announced:
        raw = fetch(at, 4)
        name = struct.unpack(_U32, raw)[0] if len(raw) == 4 else 0
        header = fetch(at + 4 + name, 8) if len(raw) == 4 else b""
        if len(header) < 8:
            return Place(at, seq, announced), "cut inside a record header", True
        frame_id, length = struct.unpack(_U32x2, header)
        if frame_id == END_MARKER:
            return Place(at, seq, announced), "end marker", False
        end = at + 4 + name + 8 + length
        if end > size:
            return Place(at, seq, announced), "cut inside a payload", True
        yield at, end - at
        at, seq = end, seq + 1
    return Place(at, seq, announced), "complete", False


def _scan_bare(fetch: Callable[[int, int], bytes], size: int, place: Place) -> _Scan:
    at, seq, _ = place
    while True:
        raw = fetch(at, 4)
        if len(raw) < 4:
            return Place(at, seq), *(("cut inside a size prefix", True) if raw else ("ended without an end record", False))
        length = struct.unpack(_U32, raw)[0]
        if length == 0:
            return Place(at, seq), "complete", False
        if at + 4 + length > size:
            return Place(at, seq), "cut inside a payload", True
        yield at, 4 + length
        at, seq = at + 4 + length, seq + 1


_SCANS = {"session": _scan_session, "bare": _scan_bare}


def find_ranges(src, size: int, framing: str, capture: str, uri: str, place: Place = Place(),
                most: int | None = None) -> Generator[Range, None, Place]:
    """Ranges of the records from ``place`` on, of about ``RANGE_BYTES`` each, then the capture's end as a range without records.

    Reads headers only. Returns the place behind the last whole record.
    """
    most = most or RANGE_BYTES
    scan = _SCANS[framing](_fetcher(src, size), size, place)
    start, length, seq, records = 0, 0, place.seq, 0
    announced = place.announced
    while True:
        try:
            at, n = next(scan)
        except StopIteration as done:
            place, reason, truncated = done.value
            if records:
                yield Range(capture, uri, start, length, seq, records, place.announced, None, False)
            yield Range(capture, uri, place.byte, 0, place.seq, 0, place.announced, reason, truncated)
            return place
        if announced is None and framing == "session":
            announced = struct.unpack(_U32, _fetcher(src, size)(0, 4))[0]
        if records and length + n > most:
            yield Range(capture, uri, start, length, seq, records, announced, None, False)
            seq, records, length = seq + records, 0, 0
        start = start if records else at
        records, length = records + 1, length + n


def decode_range(src, part: Range, framing: str) -> Iterator[dict]:
    """The rows of one range of an open file: its records, or the trailer."""
    if part.message is not None:
        yield _trailer(part.capture, part.announced, part.seq, part.message, part.truncated)
        return
    src.seek(part.offset)
    for seq in range(part.seq, part.seq + part.records):
        raw_name, frame_id = b"", None
        if framing == "session":
            raw_name = src.read(struct.unpack(_U32, src.read(4))[0])
            frame_id, size = struct.unpack(_U32x2, src.read(8))
        else:
            size = struct.unpack(_U32, src.read(4))[0]
        if size > PAYLOAD_MAX:
            src.seek(src.tell() + size)
            yield _row(part.capture, seq, raw_name.decode("utf-8", "replace") if framing == "session" else None, frame_id, None, part.announced,
                       schemas.ERROR, f"a payload of {size} bytes")
            continue
        payload = src.read(size)
        if framing == "session":
            yield _named_row(part.capture, seq, raw_name, frame_id, payload, part.announced)
        else:
            yield _row(part.capture, seq, None, None, payload, None, schemas.SUCCESS, None)


def _decode_ranges(parts: Iterable[Range], framing: str) -> Iterator[dict]:
    """Rows of many ranges; neighbours of one file share its handle."""
    uri, src = None, None
    try:
        for part in parts:
            if part.message is None and part.uri != uri:
                if src is not None:
                    src.close()
                src, uri = storage.open_file(part.uri), part.uri
            yield from decode_range(src, part, framing)
    finally:
        if src is not None:
            src.close()


def decode_captures(df: DataFrame, framing: str = "session", content_col: str = "content",
                    name_col: str = "path") -> DataFrame:
    """Decode a DataFrame of whole captures (one binary value per capture)."""
    decode = DECODERS[framing]
    slim = df.select(F.col(name_col).alias("_name"), F.col(content_col).alias("_content"))

    def run(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            contents = batch.column(1)
            values = (contents[i].as_buffer() if contents[i].is_valid else b"" for i in range(len(names)))
            yield from _batches(row for name, value in zip(names, values)
                                for row in decode(memoryview(value) if value else b"", name))

    return slim.mapInArrow(run, schemas.CAPTURE_RECORDS)


def index_captures(files: DataFrame, framing: str = "session", root: str = "", resolved: str = "", range_bytes: int | None = None) -> DataFrame:
    """The ranges of capture files listed in ``path``, by the header pass; ``root`` as listed stands for ``resolved``."""
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(_RANGES)

        def found(path):
            uri = storage.rebase(path, root, resolved) if resolved else path
            with storage.open_file(uri) as src:
                yield from find_ranges(src, src.size(), framing, path, uri, most=range_bytes)

        # Few ranges a file: files share batches.
        rows: list[dict] = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for part in found(path):
                    rows.append(part._asdict())
                    if len(rows) == _OUT_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("path").mapInArrow(run, _RANGES)


def decode_indexed(ranges: DataFrame, framing: str = "session") -> DataFrame:
    """The records of :func:`index_captures`, and a trailer row per capture."""
    def run(batches):
        yield from _batches(_decode_ranges((Range(**row) for batch in batches for row in batch.to_pylist()), framing))

    return ranges.mapInArrow(run, schemas.CAPTURE_RECORDS)


def read_captures(spark: SparkSession, path: str, framing: str = "session", glob: str | None = None,
                  recursive: bool = True, streaming: bool = False,
                  max_files_per_trigger: int | None = None, range_bytes: int | None = None) -> DataFrame:
    """Decode every capture file under ``path`` (``*.bin`` for session, ``*.raw``
    for bare framing); with ``streaming`` each micro-batch decodes the
    captures that landed since the last one.

    Spark lists the files and finds their ranges in parallel; the ranges, not
    the payloads, are dealt evenly over ``spark.sql.shuffle.partitions`` tasks.
    """
    glob = glob or PATTERNS[framing]
    if streaming:
        from backdrop.sources.images import BINARY_FILE_SCHEMA
        reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    else:
        reader = spark.read.format("binaryFile")
    files = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(path)
    # What stands before a glob; Spark lists files below it under its qualified name.
    root = re.split(r"(?<=/)[^/]*[*?\[{]", path, maxsplit=1)[0]
    resolved = storage.resolve(spark, root)
    if not storage.reachable(resolved):
        return decode_captures(files.select("path", "content"), framing)
    ranges = index_captures(files, framing, root, resolved, range_bytes)
    return decode_indexed(ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), framing)


def frames_of(records: DataFrame) -> DataFrame:
    """Decoded frames only (no capture-level rows, no empty or broken payloads)."""
    return records.where(F.col("seq").isNotNull() & (F.col("status") == schemas.SUCCESS))


def capture_completeness(records: DataFrame) -> DataFrame:
    """G3 on captures: announced against received frames, and the truncation flag."""
    return records.groupBy("capture").agg(
        F.max("announced").alias("announced"),
        F.count("seq").alias("received"),
        F.count_if(F.col("status") == schemas.SUCCESS).alias("usable"),
        F.bool_or("truncated").alias("truncated"),
    ).withColumn("complete", F.coalesce(F.col("received") >= F.col("announced"), F.lit(True))
                 & ~F.col("truncated"))


# --------------------------------------------------------------------------
# The ``capture`` data source: a batch reader, and a stream that follows
# captures while they grow, with all that it knows of them on the driver.

class _Ranges(InputPartition):
    def __init__(self, parts: list):
        super().__init__(parts)
        self.parts = parts


def _packed(parts: Iterable[Range], budget: int) -> list[_Ranges]:
    """Ranges packed in order into partitions of about ``budget`` bytes."""
    out, current, size = [], [], 0
    for part in parts:
        if current and size + part.length > budget:
            out.append(_Ranges(current))
            current, size = [], 0
        current.append(part)
        size += part.length
    return [*out, _Ranges(current)] if current else out


class _CaptureFiles:
    """What both readers share: the options, and the files under the path."""

    def __init__(self, options):
        self.root = options.get("path")
        self.framing = options.get("framing", "session")
        self.pattern = options.get("pattern", PATTERNS[self.framing])
        self.partition_bytes = int(options.get("partitionBytes", 128 << 20))
        self.batch_bytes = int(options.get("bytesPerTrigger", 0))

    def files(self) -> list[tuple[str, int]]:
        """(URI, bytes) by name, from one listing; a growing file may be longer when it is opened."""
        size = storage.size_of(self.root)
        if size is not None:
            return [(self.root, size)]
        return sorted((e.uri, e.size) for e in storage.walk(self.root) if fnmatch.fnmatch(e.uri.rsplit("/", 1)[-1], self.pattern))

    def each_file(self) -> Iterator[tuple[str, int]]:
        """The same in no order, as they are found."""
        size = storage.size_of(self.root)
        if size is not None:
            yield self.root, size
            return
        for e in storage.scan(self.root):
            if fnmatch.fnmatch(e.uri.rsplit("/", 1)[-1], self.pattern):
                yield e.uri, e.size

    def rows(self, partition):
        return _batches(_decode_ranges(partition.parts, self.framing))


class _CaptureReader(_CaptureFiles, DataSourceReader):
    def partitions(self):
        def parts():
            for uri, size in self.files():
                with storage.open_file(uri) as src:
                    yield from find_ranges(src, size, self.framing, uri, uri)

        return _packed(parts(), self.partition_bytes)

    def read(self, partition):
        yield from self.rows(partition)


class _CaptureStreamReader(_CaptureFiles, DataSourceStreamReader):
    """An offset holds, for each capture, the byte behind its last whole record, that record's number and how it ended.

    A capture that stops inside a record may go on, so it has no trailer until
    it ends by its announced count, an END record or a size of 0; after that
    it isn't opened again. A restarted stream isn't told its checkpoint before
    it names an offset, so it reads the headers anew once, without the bound on
    a trigger's bytes: with it, it might name a place behind the checkpoint's.

    The ranges found on the way to an offset are kept until a micro-batch is
    planned from them, so headers are read once; a micro-batch that is planned
    anew after a restart reads them again.
    """

    def __init__(self, options):
        super().__init__(options)
        self.at: dict[str, dict] = {}
        self.found: dict[str, list[Range]] = {}  # found and not yet planned
        self.known = False  # whether ``at`` is where the query stands

    def initialOffset(self):
        self.known = True
        return {}

    def latestOffset(self):
        taken = 0
        for uri, size in self.files():
            was = self.at.get(uri)
            if was and (was["end"] or was["size"] == size):
                continue
            for now in self._follow(uri, size, was):
                taken += now["byte"] - (was["byte"] if was else 0)
                self.at[uri] = was = now
                if self.known and self.batch_bytes and taken >= self.batch_bytes:
                    return self._offset()
        return self._offset()

    def _offset(self):
        return {uri: {k: v for k, v in at.items() if k != "size"} for uri, at in self.at.items()}

    def _follow(self, uri, size, was):
        """Places behind each further range of a capture; the last knows whether it ended."""
        place = _place(was)
        with storage.open_file(uri) as src:
            for part in find_ranges(src, size, self.framing, uri, uri, place):
                ended = part.message is not None and _ended(part, self.framing)
                if part.message is None:
                    self.found.setdefault(uri, []).append(part)
                yield {"byte": part.offset + part.length, "seq": part.seq + part.records, "announced": -1 if part.announced is None else part.announced,
                       "end": part.message if ended else "", "size": size if part.message is not None else -1}

    def _ranges(self, uri: str, place: Place, to: int) -> Iterable[Range]:
        """The ranges from a place to a byte: those found, if they lie end to end between the two, or by a header pass."""
        found = self.found.pop(uri, [])
        kept = [p for p in found if p.offset >= to]
        if kept:
            self.found[uri] = kept
        found = [p for p in found if place.byte <= p.offset and p.offset + p.length <= to]
        first = 4 if place.byte == 0 and self.framing == "session" else place.byte
        ends = [first, *(p.offset + p.length for p in found)]
        if ends[-1] == to and ends[:-1] == [p.offset for p in found]:
            return found
        with storage.open_file(uri) as src:
            return [p for p in find_ranges(src, to, self.framing, uri, uri, place) if p.message is None]

    def partitions(self, start, end):
        def parts():
            for uri, to in sorted(end.items()):
                was = start.get(uri)
                if was == to:
                    continue
                place = _place(was)
                if to["byte"] > place.byte:
                    yield from self._ranges(uri, place, to["byte"])
                if to["end"]:
                    announced = None if to["announced"] < 0 else to["announced"]
                    yield Range(uri, uri, to["byte"], 0, to["seq"], 0, announced, to["end"], False)

        for uri, to in end.items():
            if uri not in self.at or self.at[uri]["byte"] < to["byte"]:
                self.at[uri] = {**to, "size": -1}
        self.known = True
        return _packed(parts(), self.partition_bytes)

    def read(self, partition):
        yield from self.rows(partition)


def _place(was: dict | None) -> Place:
    return Place(was["byte"], was["seq"], None if was["announced"] < 0 else was["announced"]) if was else Place()


def _ended(part: Range, framing: str) -> bool:
    """Whether a capture can't go on: a cut may, and so may a bare one without an end record."""
    return not part.truncated and part.message != "ended without an end record"


class CaptureDataSource(DataSource):
    """``spark.read`` or ``spark.readStream`` ``.format("capture").option("framing", ...).load(dir)``.

    Options: ``framing`` (``session``/``bare``), ``pattern`` (file glob),
    ``partitionBytes`` (default 128 MiB) and, for streams, ``bytesPerTrigger``.
    The driver lists the directory, reads the headers and, for a stream, names
    every capture in its offsets: for a few thousand captures.
    :func:`read_captures` and :func:`follow_captures` have the tasks do that.
    """

    @classmethod
    def name(cls):
        return "capture"

    def schema(self):
        return schemas.CAPTURE_RECORDS

    def reader(self, schema):
        return _CaptureReader(self.options)

    def streamReader(self, schema):
        return _CaptureStreamReader(self.options)


def register_capture_source(spark: SparkSession) -> None:
    spark.dataSource.register(CaptureDataSource)


def read_capture_files(spark: SparkSession, path: str, framing: str = "session") -> DataFrame:
    """The ``capture`` data source as a batch."""
    register_capture_source(spark)
    return spark.read.format("capture").option("framing", framing).load(storage.resolve(spark, path))


# --------------------------------------------------------------------------
# Growing captures in any number.

_LISTED = T.StructType([T.StructField("uri", T.StringType()), T.StructField("size", T.LongType())])
# A listing's files by hash of their URI: what is held at once of one listing, and at most so many tasks read it.
LISTING_BUCKETS = 32
# Rows of a bucket that the driver holds before it writes them; tasks are given about so many at least.
LISTED_ROWS = 4096
# Captures share the state of the stream by groups; a checkpoint fixes their number.
FOLLOW_GROUPS = 1024


class _Listing(NamedTuple):
    """Files with their sizes, as stored: the folder, the paths of each bucket's parts, and how many files there are."""
    folder: str
    parts: dict[int, list[str]]
    files: int


def _listed(parts: list[str]) -> Iterator[pa.RecordBatch]:
    for path in parts:
        with storage.open_file(path) as src, pa.ipc.open_stream(src) as batches:
            yield from batches


def _sizes(parts: list[str]) -> dict[str, int]:
    return {uri: size for batch in _listed(parts) for uri, size in zip(batch["uri"].to_pylist(), batch["size"].to_pylist())}


class _ListedFiles(InputPartition):
    """Buckets of a listing, each with its parts and those of the listing before it."""

    def __init__(self, buckets: list[tuple[list[str], list[str]]]):
        super().__init__(buckets)
        self.buckets = buckets


class _ListingStreamReader(_CaptureFiles, DataSourceStreamReader):
    """Rows of the files that are new, or of another size, since the listing before.

    A listing is stored in parts as it is made, below the option ``listings``, and an offset is a digest of what
    it holds: neither grows on the driver with the number of files. Listings live as long as the
    reader. A restarted one gives rows of all files, and a micro-batch
    that is run again after a restart has the files as they are by then; both are well,
    as :func:`_follow_listed` knows how far it has read a file. Whether a sink takes that
    micro-batch or has it already isn't known, so no later rows are left out for it.

    With ``bytesPerTrigger`` a listing has files grow by so many bytes in all
    since the one before, a file perhaps by a part of a record. A restarted stream takes its first listing whole.
    """

    def __init__(self, options):
        super().__init__(options)
        self.folder = f"{options.get('listings').rstrip('/')}/{uuid.uuid4().hex}"
        self.listings: dict[str, _Listing] = {}
        self.again: dict[str, _Listing] = {}  # for micro-batches that are run again
        self.last: str | None = None  # the listing named last; "" before the first one of a new stream

    def initialOffset(self):
        self.last = ""
        return {}

    def latestOffset(self):
        name, listing = self._store(self.each_file())
        if self.batch_bytes and self.last is not None:
            whole = listing
            name, listing = self._store(self._bounded(whole))
            storage.delete(whole.folder)
        if name in self.listings:
            storage.delete(listing.folder)
        else:
            self.listings[name] = listing
        self.last = name
        return {"listing": name} if listing.files else {}

    def _store(self, files: Iterable[tuple[str, int]]) -> tuple[str, _Listing]:
        listing = _Listing(f"{self.folder}/{uuid.uuid4().hex}", {}, 0)
        storage.make_dir(listing.folder)
        held: dict[int, list[dict]] = {}
        digest = n = 0
        for uri, size in files:
            # A sum, as files come in no order.
            digest += int.from_bytes(hashlib.blake2b(f"{uri}\0{size}".encode(), digest_size=16).digest(), "big")
            n += 1
            bucket = zlib.crc32(uri.encode()) % LISTING_BUCKETS
            rows = held.setdefault(bucket, [])
            rows.append({"uri": uri, "size": size})
            if len(rows) == LISTED_ROWS:
                self._write(listing, bucket, held.pop(bucket))
        for bucket, rows in held.items():
            self._write(listing, bucket, rows)
        return f"{digest % (1 << 128):032x}", listing._replace(files=n)

    def _write(self, listing: _Listing, bucket: int, rows: list[dict]) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema
        parts = listing.parts.setdefault(bucket, [])
        parts.append(f"{listing.folder}/{bucket}-{len(parts)}")
        batch = pa.RecordBatch.from_pylist(rows, to_arrow_schema(_LISTED))
        with storage.create_file(parts[-1]) as out, pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(batch)

    def _bounded(self, whole: _Listing) -> Iterator[tuple[str, int]]:
        left = self.batch_bytes
        for bucket, parts in whole.parts.items():
            was = _sizes(self._parts(self.last, bucket))
            for uri, size in _sizes(parts).items():
                before = was.get(uri, 0)
                grown = min(max(size - before, 0), left)
                left -= grown
                if grown or size <= before or uri in was:
                    yield uri, min(size, before + grown)

    def _parts(self, name: str | None, bucket: int) -> list[str]:
        return self.listings[name].parts.get(bucket, []) if name in self.listings else []

    def partitions(self, start, end):
        name = end.get("listing")
        if name is None or start == end:  # a restarted stream asks for no rows first
            return []
        if name not in self.listings and name not in self.again:
            self.again[name] = self._store(self.each_file())[1]
        listing = self.listings.get(name) or self.again[name]
        buckets = [(parts, self._parts(start.get("listing"), bucket)) for bucket, parts in sorted(listing.parts.items())]
        tasks = max(1, min(len(buckets), listing.files // LISTED_ROWS))
        return [_ListedFiles(buckets[i::tasks]) for i in range(tasks)]

    def read(self, partition):
        for parts, before in partition.buckets:
            was = _sizes(before)
            for batch in _listed(parts):
                yield batch.filter(pa.array([was.get(uri) != size for uri, size in zip(batch["uri"].to_pylist(), batch["size"].to_pylist())]))

    def commit(self, end):
        for listings in (self.listings, self.again):
            for name in [x for x in listings if x not in (end.get("listing"), self.last)]:
                storage.delete(listings.pop(name).folder)

    def stop(self):
        storage.delete(self.folder)


class CaptureListing(DataSource):
    """A stream of the files under a folder, each again when it has grown; for :func:`follow_captures`."""

    @classmethod
    def name(cls):
        return "capture_listing"

    def schema(self):
        return _LISTED

    def streamReader(self, schema):
        return _ListingStreamReader(self.options)


# What a group of captures has in state, by URI: the place behind the last whole record, whether the capture ended, and its size when it was looked at.
_FOLLOWED = pa.schema([("uri", pa.string()), ("byte", pa.int64()), ("seq", pa.int64()), ("announced", pa.int64()), ("ended", pa.bool_()), ("size", pa.int64())])


def _follow_listed(files: DataFrame, framing: str) -> DataFrame:
    """The ranges of whole records, and the ends, that listed captures have beyond what was found before."""
    def step(_, chunks, state):
        import pandas as pd

        at: dict[str, dict] = {}
        if state.exists:
            with pa.ipc.open_stream(pa.py_buffer(bytes(state.get[0]))) as batches:
                at = {row["uri"]: row for batch in batches for row in batch.to_pylist()}
        found: list[Range] = []
        for uri, size in sorted((uri, int(size)) for chunk in chunks for uri, size in zip(chunk["uri"], chunk["size"])):
            was = at.get(uri)
            if was and (was["ended"] or size <= was["size"]):
                continue
            place = Place(was["byte"], was["seq"], was["announced"]) if was else Place()
            with storage.open_file(uri) as src:
                *ranges, end = find_ranges(src, size, framing, uri, uri, place)
            ended = _ended(end, framing)
            found += [*ranges, end] if ended else ranges
            at[uri] = {"uri": uri, "byte": end.offset, "seq": end.seq, "announced": end.announced, "ended": ended, "size": size}
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _FOLLOWED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(pa.RecordBatch.from_pylist(list(at.values()), _FOLLOWED))
        state.update((out.getvalue().to_pybytes(),))
        for i in range(0, len(found), _OUT_ROWS):
            # Objects: pandas would make floats of counts beside a None.
            yield pd.DataFrame(found[i : i + _OUT_ROWS], columns=_RANGES.fieldNames(), dtype=object).drop(columns="capture")

    group = F.pmod(F.xxhash64("uri"), F.lit(FOLLOW_GROUPS)).cast("int")
    grouped = files.withColumn("captures", group).groupBy("captures")
    ranges = grouped.applyInPandasWithState(step, T.StructType(_RANGES.fields[1:]), "followed binary", "append", GroupStateTimeout.NoTimeout)
    # The projection also makes rows that a shuffle can take, which the operator's own are not.
    return ranges.select(F.col("uri").alias("capture"), *ranges.columns)


def follow_captures(spark: SparkSession, path: str, framing: str = "session", bytes_per_trigger: int | None = None) -> DataFrame:
    """The records of captures under ``path`` as they are appended to, each once, also over restarts.

    The driver lists the files, to a scratch folder under ``spark.checkpoint.dir``; tasks read the headers and
    keep in state how far each capture has been read, and the ranges that they find are dealt evenly over
    ``spark.sql.shuffle.partitions`` tasks. A capture that stops inside a record may go on, so it has no trailer
    until it ends by its announced count, an END record or a size of 0; after that it isn't opened again.

    The stream is one of append mode, and a checkpoint fixes its state's partitions.
    """
    spark.dataSource.register(CaptureListing)
    listings = storage.resolve(spark, f"{checkpoint_dir(spark).rstrip('/')}/listings-{uuid.uuid4().hex}")
    reader = spark.readStream.format("capture_listing").option("framing", framing).option("listings", listings)
    if bytes_per_trigger:
        reader = reader.option("bytesPerTrigger", int(bytes_per_trigger))
    ranges = _follow_listed(reader.load(storage.resolve(spark, path)), framing)
    return decode_indexed(ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), framing)
