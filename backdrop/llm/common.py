"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import sys
import time
import types
import uuid
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from backdrop.config import checkpoint_dir

# Arrow batches handed to Python are cut at this many bytes, so that a batch
# of very long texts stays small whatever its number of rows.
ARROW_BYTES = 16 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by bytes unless the session chose a smaller bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now in (None, "-1", "-1b", "67108864b", "67108864"):
        spark.conf.set(key, str(ARROW_BYTES))


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared folder and read back.

    The table cuts the lineage: a lost executor costs no recomputation of what
    went into it, and non-deterministic row numbers are fixed by it.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


Made = TypeVar("Made")


def kept_by_worker(key: object, make: Callable[[], Made]) -> Made:
    """What ``make`` gives, kept by this Python worker from task to task.

    Worker processes are reused, but functions come to them by value, and
    their modules' variables with them. For what is costly to build and of
    bounded size only.
    """
    kept = sys.modules.setdefault("_backdrop_kept", types.ModuleType("_backdrop_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs, which it does once the driver has collected their plans as garbage.

    The first round lets go of what Python held, the second of what that held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def fold(id_col: Column, mod: int) -> Column:
    """``crc32(id as text) mod`` n; a NULL id counts as the empty string."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def arrow_type(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def texts_of(column: pa.Array) -> list[str]:
    """The texts of an Arrow column; NULL counts as the empty text."""
    return [t or "" for t in column.to_pylist()]


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and text are named in ``kept`` (doc_id, sha), with all their columns.

    ``sha`` leads the lower-case SHA-256 of the text, in 32 digits at least.
    Rows that repeat both id and text are one document: one of them stays.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    the_id, the_text = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    # One plain key, so that the join and the last step share a shuffle.
    key = lambda i, sha: F.concat(F.substring(sha, 1, 32), F.coalesce(F.concat(F.lit("="), i.cast("string")), F.lit("")))
    rows = rows.withColumn("_key", key(the_id, F.sha2(F.coalesce(the_text, F.lit("")), 256)))
    kept = kept.select(key(F.col("doc_id"), F.col("sha")).alias("_key"))
    return rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key").toDF(*docs.columns)
