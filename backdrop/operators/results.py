"""Result rows, unreadable frames and the pass-through fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backdrop import schemas
from backdrop.functions import columns as C


def readable(mode_col: str = "mode", data_col: str | None = "data"):
    """A frame is readable when the decoder gave it a mode and bytes."""
    cond = F.coalesce(F.col(mode_col) != schemas.MODE_INVALID, F.lit(False))
    if data_col is not None:
        cond = cond & C.has_payload(data_col)
    return cond


def handle_unreadable(df: DataFrame, on_unreadable: str = "status", data_col: str | None = "data") -> DataFrame:
    """``"drop"`` removes unreadable frames before any Python step (the
    camera side's skip); ``"status"`` keeps them, marked, for the result table."""
    if on_unreadable == "drop":
        return df.where(readable(data_col=data_col))
    if on_unreadable != "status":
        raise ValueError("on_unreadable must be 'status' or 'drop'")
    ok = readable(data_col=data_col)
    return df.withColumn("status", F.when(ok, F.lit(schemas.SUCCESS)).otherwise(F.lit(schemas.UNREADABLE))) \
        .withColumn("message", F.when(ok, F.lit(None).cast("string")).otherwise(F.lit("frame could not be decoded")))


def result_rows(processed: DataFrame, input_root: str, output_root: str) -> DataFrame:
    """K3 + P3: one ``results`` row per frame; output path only on success."""
    ok = F.col("status") == schemas.SUCCESS
    return processed.select(
        "session_id",
        F.col("frame_id").cast("long").alias("frame_id"),
        "filename",
        C.session_path(input_root, "session_id", "filename").alias("input_path"),
        F.when(ok, C.session_path(output_root, "session_id", "filename")).alias("output_path"),
        "status",
        "message",
    )


def with_fallback(sent: DataFrame, replies: DataFrame, keys, value_col: str, reply_col: str,
                  out_col: str = "shown") -> DataFrame:
    """Show the reply when there is a usable one (present, non-empty),
    otherwise the original. Left join on the frame key, which is unique per
    row, so no key is hot."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return shown(sent.join(replies.select(*keys, reply_col), keys, "left"), value_col, reply_col, out_col)


def shown(joined: DataFrame, value_col: str, reply_col: str, out_col: str = "shown") -> DataFrame:
    """What a viewer sees of a frame beside its reply, and where that is from."""
    usable = F.coalesce(F.length(F.col(reply_col)) > 0, F.lit(False))
    return joined.withColumn(out_col, F.when(usable, F.col(reply_col)).otherwise(F.col(value_col))) \
        .withColumn("shown_from", F.when(usable, F.lit("processed")).otherwise(F.lit("original")))


# Slim tables up to this many rows are broadcast when joined to frames.
ATTACH_BROADCAST_ROWS = 1_000_000


def attach(frames: DataFrame, table: DataFrame, keys, how: str = "left",
           max_broadcast_rows: int = ATTACH_BROADCAST_ROWS) -> DataFrame:
    """Join a slim per-frame table (ids, statuses) to frame rows.

    The table is counted (an action on slim columns) and broadcast when it
    is within the limit, so the frame bytes are never shuffled; beyond it
    the join is a shuffle join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if table.count() <= max_broadcast_rows:
        table = F.broadcast(table)
    return frames.join(table, keys, how)
