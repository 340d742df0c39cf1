"""The three table schemas every job shares."""

from pyspark.sql import types as T

# Status values of a result row.
SUCCESS = "success"
UNREADABLE = "unreadable"
ERROR = "error"

# OpenCV type codes used by Spark's image source.
MODE_GREY = 0   # CV_8UC1
MODE_BGR = 16   # CV_8UC3
MODE_BGRA = 24  # CV_8UC4
MODE_INVALID = -1

FRAMES = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("frame_id", T.LongType()),
    T.StructField("filename", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("n_channels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("data", T.BinaryType()),  # row-major, interleaved, BGR order
])

RESULTS = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("frame_id", T.LongType()),
    T.StructField("filename", T.StringType()),
    T.StructField("input_path", T.StringType()),
    T.StructField("output_path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
])

SESSIONS = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("display_time", T.StringType()),
    T.StructField("input_count", T.LongType()),
    T.StructField("output_count", T.LongType()),
    T.StructField("input_path", T.StringType()),
    T.StructField("output_path", T.StringType()),
])

# Decoded capture records (both framings; `filename`/`frame_id` are NULL for
# the bare framing, which carries sizes only).
CAPTURE_RECORDS = T.StructType([
    T.StructField("capture", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("filename", T.StringType()),
    T.StructField("frame_id", T.LongType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("announced", T.LongType()),
    T.StructField("truncated", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
])

MESSAGES = T.StructType([T.StructField("message", T.StringType())])
