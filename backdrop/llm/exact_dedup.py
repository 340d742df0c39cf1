"""Exact duplicates by content sort.

Rows are range-partitioned by (first bytes of the text, its digest, id) at
splitters that Spark samples from these keys, and each partition is sorted
externally by (first bytes, digest, whole text, id). Equal texts are then
neighbours, in one partition or in adjacent ones: since the id belongs to the
sort key, a group of copies of any size is split between partitions like any
other rows. Each partition compares neighbouring texts in full; groups that
touch an edge of a partition (at most two a partition) are put together
afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from backdrop.llm.common import arrow_type, bounded_batches, documents, keep_rows, stored, texts_of

# Bytes of the text that lead the sort key; the digest and the text itself follow.
PREFIX_BYTES = 64


def _runs(id_type: pa.DataType) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of equal neighbouring texts: a row for each input row, with its run's last id and size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        out: dict[str, list] = {k: [] for k in ("doc_id", "sha", "run_id", "run_size", "last", "edge")}
        ids: list = []
        text, sha, first = None, None, True

        def close(last_of_all: bool) -> None:
            n = len(ids)
            out["doc_id"] += ids
            out["sha"] += [sha] * n
            out["run_id"] += [ids[-1]] * n
            out["run_size"] += [n] * n
            out["last"] += [False] * (n - 1) + [True]
            out["edge"] += [first or last_of_all] * n

        def batch() -> pa.RecordBatch:
            n = len(out["sha"])
            made = pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], id_type), pa.array(out["sha"], pa.string()), pa.array(out["run_id"], id_type),
                 pa.array(out["run_size"], pa.int64()), pa.array(out["last"], pa.bool_()),
                 pa.array(out["edge"], pa.bool_()), pa.array([pid] * n, pa.int32())],
                ["doc_id", "sha", "run_id", "run_size", "last", "edge", "pid"])
            for rows in out.values():
                rows.clear()
            return made

        for b in batches:
            for i, t, s in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2).to_pylist(), strict=True):
                if text is not None and t != text:
                    close(False)
                    first, ids = False, []
                ids.append(i)
                text, sha = t, s
            if out["sha"]:
                yield batch()
        if text is not None:
            close(True)
            yield batch()

    return run


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 normalise: Callable | None = None, keep: str = "smallest") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are; ``normalise`` maps the
    text column to them (default: no change). NULL counts as the empty text.
    ``keep`` names which id of a group stays, ``smallest`` or ``largest``; a
    NULL id comes after all others in that choice. Of rows that repeat both
    text and id, one is kept. Other columns are left out; an empty table gives
    no rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.coalesce(normalise(text), F.lit("")) if normalise else text
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # The id that stays is the last of its run.
    order = F.col("doc_id").asc_nulls_first() if keep == "largest" else F.col("doc_id").desc_nulls_first()
    rows = rows.select("doc_id", "text", F.sha2("text", 256).alias("sha"),
                       F.substring(F.col("text").cast("binary"), 1, PREFIX_BYTES).alias("head"))
    dealt = rows.repartitionByRange("head", "sha", order).sortWithinPartitions("head", "sha", "text", order)
    kind = docs.schema[id_col].dataType
    schema = StructType([StructField("doc_id", kind), StructField("sha", StringType()), StructField("run_id", kind),
                         StructField("run_size", LongType()), StructField("last", BooleanType()),
                         StructField("edge", BooleanType()), StructField("pid", IntegerType())])
    runs = stored(spark, dealt.select("doc_id", "text", "sha").mapInArrow(_runs(arrow_type(kind)), schema), "runs")
    # At most two rows a partition: the runs at its edges.
    edges = runs.where("edge and last").groupBy("sha").agg(
        F.sum("run_size").alias("whole_size"), F.max("pid").alias("end_pid"), F.max_by("run_id", "pid").alias("end_id"))
    edges = edges.withColumnRenamed("sha", "edge_sha")
    joined = runs.join(F.broadcast(edges), F.col("edge") & (F.col("sha") == F.col("edge_sha")), "left")
    whole = F.col("edge_sha").isNotNull()
    return joined.select(
        "doc_id", F.when(whole, F.col("end_id")).otherwise(F.col("run_id")).alias("keep_id"),
        F.coalesce("whole_size", "run_size").alias("group_size"),
        (F.col("last") & (~whole | (F.col("pid") == F.col("end_pid")))).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat both id and text are one document: one of them stays.
    """
    kept = exact_groups(docs, id_col, text_col, keep=keep).where("kept").select("doc_id", F.col("text_sha256").alias("sha"))
    return keep_rows(docs, kept, id_col, text_col)


def op10_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents; the largest id of a group stays."""
    return exact_groups(documents(spark, sf_dir), keep="largest")


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
