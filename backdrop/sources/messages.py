"""JSON-lines message feeds (``{"message": ...}`` per line).

Read as text and parsed with ``from_json``, so a line that is not JSON gives
a NULL message instead of failing the job. The same function serves files
(``spark.read``), landing folders (``readStream``) and, for a live feed,
Spark's socket source, which also yields a ``value`` text column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backdrop import schemas


def parse_json_lines(df: DataFrame, line_col: str = "value", schema=schemas.MESSAGES) -> DataFrame:
    parsed = F.from_json(F.col(line_col), schema, {"mode": "PERMISSIVE"})
    return df.withColumn("_msg", parsed).select(
        *[c for c in df.columns], *[F.col(f"_msg.{f.name}").alias(f.name) for f in schema.fields])


def read_messages(spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None,
                  schema=schemas.MESSAGES) -> DataFrame:
    """Lines of every file under ``path`` with their parsed fields; blank lines are skipped."""
    if streaming:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        lines = reader.load(path)
    else:
        lines = spark.read.format("text").load(path)
    lines = lines.where(F.length(F.trim(F.col("value"))) > 0)
    return parse_json_lines(lines, "value", schema)


def encode_messages(df: DataFrame, cols=("message",)) -> DataFrame:
    """One JSON object per row, ready for ``write.text``."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))
