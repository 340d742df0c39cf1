"""Frame-model views over the driver's tables.

The reference ships no data, so the frame model is mapped onto the
driver-generated tables (see FIXTURES.md):

* ``embeddings`` -> **frames**: 64 values per row become an 8x8 grey frame or
  a 4x4 BGRA frame; pixel ``floor((x + 1) * 127.5)``; ``label`` is the
  session, ``vec_id`` the frame id.
* ``documents`` -> **files**: ``source`` is the session, the file name is
  ``<source>_<doc_id><ext>`` with ``ext`` chosen by ``doc_id % 5``; a payload
  under 200 characters does not decode.
* ``conversations`` -> **turns**: user turn = frame sent, assistant turn =
  frame returned, ``conv_id`` = session.
* ``events`` -> **log**: ``user_id`` = client, ``(ts, event_id)`` = order,
  ``event_type = 'error'`` = failed frame.

Everything is a projection Catalyst can prune and push filters through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backdrop import schemas
from backdrop.functions import columns as C

# Fixed values of the view mapping (FIXTURES.md).
FILE_EXTENSIONS = (".png", ".JPG", ".jpeg", ".txt", ".gif")
UNREADABLE_BELOW_CHARS = 200
SESSION_EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pixel_of(x) -> F.Column:
    """``floor((x + 1) * 127.5)`` clamped to a byte."""
    v = F.floor((x.cast("double") + F.lit(1.0)) * F.lit(127.5)).cast("int")
    return F.least(F.greatest(v, F.lit(0)), F.lit(255))


def pixel_bytes(values: F.Column) -> F.Column:
    """An array of floats as frame bytes, built in the JVM."""
    return F.unhex(F.array_join(F.transform(values, lambda x: F.lpad(F.hex(pixel_of(x)), 2, "0")), ""))


def frames(embeddings: DataFrame, layout: str = "grey") -> DataFrame:
    """Frames view: ``grey`` = 8x8x1 (mode 0), ``bgra`` = 4x4x4 (mode 24)."""
    h, w, c, mode = {"grey": (8, 8, 1, schemas.MODE_GREY), "bgra": (4, 4, 4, schemas.MODE_BGRA)}[layout]
    session = F.col("label").cast("string")
    name = F.format_string("frame_%d.png", F.col("vec_id"))
    return embeddings.select(
        session.alias("session_id"),
        F.col("vec_id").alias("frame_id"),
        name.alias("filename"),
        F.concat_ws("/", F.lit("embeddings"), session, name).alias("origin"),
        F.lit(h).alias("height"),
        F.lit(w).alias("width"),
        F.lit(c).alias("n_channels"),
        F.lit(mode).alias("mode"),
        pixel_bytes(F.col("embedding")).alias("data"),
    )


def files(documents: DataFrame) -> DataFrame:
    """Files view: one row per document, named like a folder entry."""
    ext = F.element_at(F.array(*[F.lit(e) for e in FILE_EXTENSIONS]), (F.col("doc_id") % 5 + 1).cast("int"))
    filename = F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), ext)
    readable = F.col("n_chars") >= UNREADABLE_BELOW_CHARS
    return documents.select(
        F.col("source").alias("session_id"),
        F.col("doc_id"),
        filename.alias("filename"),
        F.when(readable, F.lit(schemas.MODE_BGR)).otherwise(F.lit(schemas.MODE_INVALID)).alias("mode"),
        F.col("n_chars").alias("size"),
    )


def session_of_conversation(conv_id: str = "conv_id") -> F.Column:
    """A D1-style id for a conversation: hourly stamp + 8 hex digits."""
    ts = F.expr(f"timestampadd(HOUR, {conv_id}, TIMESTAMP_NTZ'{SESSION_EPOCH}')")
    return F.concat(C.stamp(ts), F.lit("_"), F.format_string("%08x", F.col(conv_id)))


def turns(conversations: DataFrame) -> DataFrame:
    """Turns view: frames sent (user) and returned (assistant) per session."""
    return conversations.select(
        session_of_conversation("conv_id").alias("session_id"),
        F.col("conv_id"),
        F.col("turn"),
        F.col("role"),
        F.col("text"),
    )


def log(events: DataFrame) -> DataFrame:
    """Log view: one processed frame per event; signups carry a bare id."""
    session = F.when(F.col("event_type") == "signup", F.concat(F.lit("user"), F.col("user_id").cast("string"))) \
        .otherwise(F.concat(C.stamp(F.col("ts")), F.lit("_"), F.format_string("%08x", F.col("event_id"))))
    status = F.when(F.col("event_type") == "error", F.lit(schemas.ERROR)).otherwise(F.lit(schemas.SUCCESS))
    return events.select(
        F.col("event_id"),
        F.col("ts"),
        F.col("user_id").alias("client_id"),
        F.col("event_type"),
        F.col("value"),
        F.col("props"),
        session.alias("session_id"),
        status.alias("status"),
    )
