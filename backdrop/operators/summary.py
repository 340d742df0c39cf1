"""Aggregations over files, results and sessions.

All of them are plain aggregates with partial (map-side) aggregation, so a
session holding a large share of the rows is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backdrop import schemas
from backdrop.functions import columns as C


def image_counts(files: DataFrame, session_col: str = "session_id", name_col: str = "filename",
                 alias: str = "image_count") -> DataFrame:
    """G1: image files (P1) per session. Never reads file contents."""
    return files.groupBy(session_col).agg(F.count_if(C.is_image_name(name_col)).alias(alias))


def status_summary(results: DataFrame, by=None) -> DataFrame:
    """Successes out of all frames, overall or per key."""
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    n_ok = F.count_if(F.col("status") == schemas.SUCCESS)
    n_all = F.count(F.lit(1))
    return results.groupBy(*by).agg(n_ok.alias("n_success"), n_all.alias("n_total"),
                                    (n_ok / n_all).alias("success_ratio"))


def completeness(received: DataFrame, announced: DataFrame, by="session_id",
                 announced_col: str = "announced") -> DataFrame:
    """Frames received (or processed) against frames announced, per session.

    ``announced`` has one row per session; sessions announced but never
    received count 0.
    """
    by = [by] if isinstance(by, str) else list(by)
    got = received.groupBy(*by).agg(F.count(F.lit(1)).alias("received"))
    out = announced.select(*by, F.col(announced_col).alias("announced")).join(got, by, "left")
    out = out.withColumn("received", F.coalesce(F.col("received"), F.lit(0)))
    return out.withColumn("missing", F.greatest(F.col("announced") - F.col("received"), F.lit(0))) \
        .withColumn("complete", F.col("received") >= F.col("announced"))


def session_history(inputs: DataFrame, outputs: DataFrame, input_root: str, output_root: str,
                    sessions: DataFrame | None = None) -> DataFrame:
    """J1 + G1 + D2 + O3: one row per input session, newest first.

    ``inputs``/``outputs`` have ``session_id, filename`` per file; ``sessions``
    (optional) lists the input session directories, so empty ones count 0.
    Sessions that only exist on the output side are left out. Both sides are
    reduced to one row per session before the join.
    """
    n_in = image_counts(inputs, alias="input_count")
    if sessions is not None:
        n_in = sessions.select("session_id").distinct().join(n_in, "session_id", "left") \
            .withColumn("input_count", F.coalesce(F.col("input_count"), F.lit(0)))
    n_out = image_counts(outputs, alias="output_count")
    out = n_in.join(n_out, "session_id", "left")
    return out.select(
        "session_id",
        C.session_started_at("session_id").alias("started_at"),
        C.session_display_time("session_id").alias("display_time"),
        F.col("input_count").cast("long").alias("input_count"),
        F.coalesce(F.col("output_count"), F.lit(0)).cast("long").alias("output_count"),
        C.session_path(input_root, "session_id").alias("input_path"),
        C.session_path(output_root, "session_id").alias("output_path"),
    ).orderBy(F.col("session_id").desc())
