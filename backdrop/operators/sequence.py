"""Order-based operators: numbering, first-N, take-while, latest, newest-first.

Numbering per session is a window function, and a window puts a whole
partition key into one task. A session may hold a large share of all rows, so
:func:`sequence_number` works by ranges instead: rows are range-partitioned
by the key *and* all order columns, so Spark's sampled splitters cut a large
session wherever its order allows, NULL or tied leading columns included.
Every partition numbers its own runs of equal keys; counted runs give the
first run of each partition its offset. Rows are shuffled once, and no size
decides between two plans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backdrop.config import stored
from backdrop.functions.columns import END_MARKER

_PART, _LOCAL, _LEADS = "_part", "_local", "_leads"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _differ(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two columns differ; NULL equals NULL and NaN equals NaN, as in a grouping."""
    if pa.types.is_nested(a.type):
        return np.array([x != y for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], bool)
    unlike = pc.fill_null(pc.not_equal(a, b), False)
    if pa.types.is_floating(a.type):
        unlike = pc.and_(unlike, pc.invert(pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False)))
    one_null = pc.xor(pc.is_null(a), pc.is_null(b))
    return pc.or_(unlike, one_null).to_numpy(zero_copy_only=False)


def _number_runs(keys: list[int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the partition, the 0-based place in the run of equal keys, and whether that run leads the partition."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last: pa.RecordBatch | None = None
        count, leads = 0, True
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            new = np.zeros(n, bool)
            for k in keys:
                column = b.column(k)
                new[1:] |= _differ(column[:-1], column[1:])
                if last is not None:
                    new[0] |= _differ(last.column(k), column[:1])[0]
            at = np.arange(n)
            begin = np.maximum.accumulate(np.where(new, at, -1))
            local = np.where(begin < 0, at + count, at - begin)
            lead = (begin < 0) & leads
            last, count, leads = b.slice(n - 1), int(local[-1]) + 1, bool(lead[-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(local.astype(np.int64)), pa.array(lead)],
                [*b.schema.names, _PART, _LOCAL, _LEADS])

    return run


def sequence_number(df: DataFrame, by, order, name: str = "seq", start: int = 0) -> DataFrame:
    """Number rows per ``by`` key in ``order`` (ascending, NULLs first), from ``start``.

    ``order`` should end in a unique tie-breaker, as with any row_number;
    rows that tie on all of it are numbered in one task. The dealt rows are
    stored, as the numbers depend on how they were dealt.
    """
    by, order = _names(by), _names(order)
    dealt = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    schema = T.StructType([*df.schema.fields, T.StructField(_PART, T.IntegerType()), T.StructField(_LOCAL, T.LongType()),
                           T.StructField(_LEADS, T.BooleanType())])
    rows = stored(dealt.mapInArrow(_number_runs([df.columns.index(c) for c in by]), schema), "numbered")
    before = F.sum("count").over(Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    # Only the run that leads a partition goes on from earlier ones: at most one row a partition.
    offsets = rows.groupBy(*by, _PART).count().withColumn("_off", before).where("_off > 0").select(F.col(_PART).alias("_p"), "_off")
    placed = rows.join(F.broadcast(offsets), (F.col(_PART) == F.col("_p")) & F.col(_LEADS), "left")
    return placed.withColumn(name, F.col(_LOCAL) + F.coalesce(F.col("_off"), F.lit(0)) + F.lit(start)) \
        .drop(_PART, _LOCAL, _LEADS, "_p", "_off")


def enumerate_frames(df: DataFrame, by="session_id", order=("filename",), name: str = "frame_id",
                     start: int = 0) -> DataFrame:
    """O1 + O2: zero-based position in name order (binary collation) per session.

    Number *before* dropping unreadable frames, so that they leave gaps, as
    the folder replay does.
    """
    return sequence_number(df, by, list(order), name=name, start=start)


# Largest ``n`` that is left to one task a key.
FIRST_N_WINDOW = 1_000_000


def first_n(df: DataFrame, by, order, n, seq: str = "seq") -> DataFrame:
    """The first ``n`` rows per key; ``n`` is an int or a column (e.g. the announced count).

    For an int a plain window will do: its group limit keeps at most ``n``
    rows of a key in every task before the shuffle, so no key is hot.
    """
    if not isinstance(n, Column) and seq not in df.columns and int(n) <= FIRST_N_WINDOW:
        ranked = F.row_number().over(Window.partitionBy(*_names(by)).orderBy(*_names(order)))
        return df.withColumn(seq, ranked.cast("long")).where(F.col(seq) <= int(n)).withColumn(seq, F.col(seq) - 1)
    numbered = df if seq in df.columns else sequence_number(df, by, order, name=seq, start=0)
    limit = n if isinstance(n, Column) else F.lit(int(n))
    return numbered.where(F.col(seq) < limit)


def take_until_end(df: DataFrame, by, order, marker_col: str = "frame_id", end_value: int = END_MARKER) -> DataFrame:
    """Rows before the first END marker of each key (the marker itself is dropped).

    The first marker's position is a per-key aggregate joined back, not a
    window, so a hot key does not end up in one task.
    """
    by, order = _names(by), _names(order)
    pos = F.struct(*[F.col(c) for c in order])
    first_end = df.where(F.col(marker_col) == F.lit(end_value)).groupBy(*by).agg(F.min(pos).alias("_end"))
    joined = df.join(first_end, by, "left")
    return joined.where(F.col("_end").isNull() | (pos < F.col("_end"))).drop("_end")


def latest_per_key(df: DataFrame, by, order, values, extra=()) -> DataFrame:
    """The value columns of the last row per key, by ``order``.

    ``max_by`` is an aggregate with partial aggregation, so hot keys are
    reduced on the map side.
    """
    by, order, values = _names(by), _names(order), _names(values)
    best = F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(o) for o in order])).alias("_last")
    extra = list(extra)
    out = df.groupBy(*by).agg(best, *extra)
    return out.select(*by, *[F.col(f"_last.{v}").alias(v) for v in values], *[c for c in out.columns
                                                                               if c not in by and c != "_last"])


def frame_counter(df: DataFrame, by, order, name: str = "frame_count") -> DataFrame:
    """Running count of frames per client (1-based)."""
    return sequence_number(df, by, order, name=name, start=1)


def newest_first(df: DataFrame, col: str = "session_id") -> DataFrame:
    """O3: sessions newest first, i.e. descending by id text."""
    return df.orderBy(F.col(col).desc())
