"""G3, G4, O4, O5, O6 and P4 on streams.

Two orders are on offer, and they are named:

* **Event order** (:func:`counted`, :func:`first_n`, :func:`until_end`,
  :func:`session_close`): the order columns decide, however rows are dealt to
  files and micro-batches, as long as none is later than the stated delay.
  A key's rows wait in state until the watermark has passed them and are
  then taken in order: each is emitted once, and nothing that was emitted is
  read again. Keys share state by groups (``groups=``, ``STATE_GROUPS``): a
  group holds its keys' rows of one delay, and an event-time timer at the
  earliest of them. More groups hold fewer keys each; a checkpoint fixes
  their number.
* **Arrival order** (:func:`count_frames`, :func:`bound_frames`): the live
  counter of a client. A row that arrives later gets a later number; within a
  micro-batch rows are taken in their order columns. The state operator holds
  one key's rows of one micro-batch, so only keys, order columns and ids should
  pass through it, from a source that limits the rows of a micro-batch.

The event-order operators need Spark's RocksDB state store
(:func:`use_rocksdb`).
"""

from __future__ import annotations

import pickle
import warnings
from collections.abc import Callable
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from backdrop.functions.columns import END_MARKER
from backdrop.operators import results as R

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# PySpark's grouped-state serializer concatenates empty chunks, which newer
# pandas reports as a FutureWarning once per group; it does not affect results.
warnings.filterwarnings("ignore", category=FutureWarning, module=r"pyspark\.sql\.pandas\.serializers")


def _names(cols):
    return [cols] if isinstance(cols, str) else list(cols)


def _sorted_group(pdfs: Iterator[pd.DataFrame], order) -> pd.DataFrame:
    pdf = pd.concat(list(pdfs), ignore_index=True)
    return pdf.sort_values(order, kind="stable").reset_index(drop=True)


def count_frames(df: DataFrame, by, order, name: str = "frame_count") -> DataFrame:
    """Running frame counter per key (1-based) across micro-batches."""
    by, order = _names(by), _names(order)
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(name, T.LongType())])
    state_schema = "count long"

    def step(key, pdfs, state):
        seen = state.get[0] if state.exists else 0
        pdf = _sorted_group(pdfs, order)
        pdf[name] = range(seen + 1, seen + 1 + len(pdf))
        state.update((seen + len(pdf),))
        yield pdf

    return df.groupBy(*by).applyInPandasWithState(step, out_schema, state_schema, "append",
                                                  GroupStateTimeout.NoTimeout)


def bound_frames(df: DataFrame, by, order, limit: int | None = None, marker_col: str | None = None,
                 end_value: int = END_MARKER, name: str = "seq") -> DataFrame:
    """O4 + O5: per key, stop after ``limit`` frames and/or at the first END
    marker in ``marker_col`` (the marker row is not emitted). Adds the 0-based
    position ``name``."""
    by, order = _names(by), _names(order)
    out_schema = T.StructType(list(df.schema.fields) + [T.StructField(name, T.LongType())])

    def step(key, pdfs, state):
        seen, ended = state.get if state.exists else (0, False)
        pdf = _sorted_group(pdfs, order)
        if ended or len(pdf) == 0:
            return
        stop = len(pdf)
        if marker_col is not None:
            hits = (pdf[marker_col] == end_value).to_numpy().nonzero()[0]
            if len(hits):
                stop, ended = int(hits[0]), True
        if limit is not None and seen + stop >= limit:
            stop, ended = max(limit - seen, 0), True
        out = pdf.iloc[:stop].copy()
        out[name] = range(seen, seen + len(out))
        state.update((seen + len(out), ended))
        if len(out):
            yield out

    return df.groupBy(*by).applyInPandasWithState(step, out_schema, "seen long, ended boolean", "append",
                                                  GroupStateTimeout.NoTimeout)


def use_rocksdb(spark: SparkSession) -> None:
    """Let the queries that the session starts from now on keep their state in RocksDB, unless it chose a provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)


# The time of a row in microseconds, beside its own columns (pandas renames names that begin with an underscore).
_AT = "at_micros"
# The key as text: NULL keys, and keys of any type, come to pandas alike.
_KEY = "state_key"
# Keys are dealt by hash to so many groups, which are what Spark keeps state for: every group, not every key, costs calls
# to the state store in a micro-batch. A checkpoint fixes the number.
_GROUP = "state_group"
STATE_GROUPS = 512
# Tells the NULLs of a long column, which pandas would hold as inexact floats.
_NULL = "null_of_"


class _Keys:
    """What a group remembers: the state of its keys, keys that are done, and when each of the others idles (microseconds)."""

    def __init__(self, states: dict, done: set, until: dict) -> None:
        self.states, self.done, self.until = states, done, until

    def finish(self, key: str) -> None:
        self.done.add(key)
        self.states.pop(key, None)
        self.until.pop(key, None)


class _Runs:
    """Rows sorted by key: the keys, and where each one's rows start and end."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.of_row, keys = pd.factorize(rows[_KEY])
        self.keys = keys.tolist()
        self.sizes = np.bincount(self.of_row, minlength=len(self.keys))
        self.ends = self.sizes.cumsum()
        self.starts = self.ends - self.sizes


# Takes rows in order, their runs and the group's keys, whose states it changes, to the rows to emit.
_Take = Callable[[pd.DataFrame, _Runs, _Keys], pd.DataFrame]


class _InOrder(StatefulProcessor):
    """Rows of a group of keys, each key's in event order, as the watermark passes them; or in arrival order, by the clock.

    With ``idle_us``, ``idle`` gives the rows of the states of keys that had no rows for so long.
    """

    def __init__(self, order: list[str], take: _Take, by_event_time: bool, longs: list[str], idle: Callable | None = None,
                 idle_us: int | None = None) -> None:
        self.order, self.take, self.by_event_time, self.longs = order, take, by_event_time, longs
        self.idle, self.idle_us = idle, idle_us

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.kept = handle.getValueState("kept", "keys binary")

    def handleInputRows(self, key, rows, timerValues):
        known = self._known()
        came = self._exact(pd.concat(list(rows), ignore_index=True))
        came = came[~came[_KEY].isin(known.done)]
        if not self.by_event_time:
            now = timerValues.getCurrentProcessingTimeInMs()
            if len(came):
                yield from self._release(came, known, now * 1000)
                self._keep(known)
                self._wait(known, None)
            return
        came = came[came[_AT].notna()]
        if len(came):
            # As bytes, which keep every column type as it is.
            self.waiting.appendValue((pickle.dumps(came),))
            first = _millis(came[_AT].min())
            if not any(t <= first for t in self.handle.listTimers()):
                self._wait_until(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        known = self._known()
        now = timerValues.getCurrentWatermarkInMs() if self.by_event_time else timerValues.getCurrentProcessingTimeInMs()
        chunks = [pickle.loads(bytes(c)) for (c,) in self.waiting.get()]
        rest = None
        if chunks:
            rows = pd.concat(chunks, ignore_index=True)
            ripe = rows[_AT] <= now * 1000
            if ripe.any():
                came = rows[ripe]
                yield from self._release(came[~came[_KEY].isin(known.done)], known, None)
            rest = rows[~ripe]
            rest = rest[~rest[_KEY].isin(known.done)]
        # A key with rows ahead of the watermark is looked at when they are due.
        ahead = set() if rest is None else set(rest[_KEY])
        idle = [k for k, t in known.until.items() if _millis(t) <= now and k not in ahead]
        if idle:
            yield self.idle([known.states[k] for k in idle])
            for k in idle:
                known.finish(k)
        if chunks:
            self.waiting.clear()
            if len(rest):
                self.waiting.appendValue((pickle.dumps(rest),))
        self._keep(known)
        self._wait(known, rest)

    def close(self) -> None:
        pass

    def _exact(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Long columns with their NULLs, all digits kept."""
        for c in self.longs:
            rows[c] = pd.arrays.IntegerArray(rows[c].to_numpy(np.int64), rows.pop(_NULL + c).to_numpy(bool))
        return rows

    def _known(self) -> _Keys:
        if not self.kept.exists():
            return _Keys({}, set(), {})
        return _Keys(*pickle.loads(bytes(self.kept.get()[0])))

    def _keep(self, known: _Keys) -> None:
        self.kept.update((pickle.dumps((known.states, known.done, known.until)),))

    def _release(self, rows: pd.DataFrame, known: _Keys, now_us: int | None) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        rows = rows.sort_values([_KEY, *self.order], kind="stable", na_position="first").reset_index(drop=True)
        runs = _Runs(rows)
        out = self.take(rows, runs, known)
        if self.idle_us is not None:
            last = np.maximum.reduceat(rows[_AT].to_numpy(np.int64), runs.starts).tolist() if now_us is None else [now_us] * len(runs.keys)
            known.until.update((k, t + self.idle_us) for k, t in zip(runs.keys, last) if k not in known.done)
        if len(out):
            yield out.drop(columns=[_AT, _KEY, _GROUP], errors="ignore")

    def _wait(self, known: _Keys, rest: pd.DataFrame | None) -> None:
        ahead = set() if rest is None else set(rest[_KEY])
        times = [t for k, t in known.until.items() if k not in ahead] + ([rest[_AT].min()] if ahead else [])
        if times:
            self._wait_until(_millis(min(times)))

    def _wait_until(self, at: int) -> None:
        """The group's only timer."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(at)


def _millis(micros) -> int:
    """The first millisecond by which a time has passed."""
    return -(-int(micros) // 1000)


def _interval_us(text: str) -> int:
    return int(pd.Timedelta(text).total_seconds() * 1_000_000)


def _in_order(df: DataFrame, by, order, time_col: str, delay: str | None, take: _Take, schema: T.StructType, groups: int | None,
              idle: Callable | None = None, idle_us: int | None = None) -> DataFrame:
    use_rocksdb(df.sparkSession)
    kind = df.schema[time_col].dataType
    at = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{time_col}`)") if isinstance(
        kind, T.TimestampNTZType) else F.unix_micros(F.col(time_col))
    key = F.to_json(F.array(*[F.col(c).cast("string") for c in _names(by)]))
    source = (df if delay is None else df.withWatermark(time_col, delay)).withColumns(
        {_AT: at, _KEY: key, _GROUP: F.pmod(F.xxhash64(key), F.lit(groups or STATE_GROUPS)).cast("int")})
    longs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType)]
    source = source.withColumns({_NULL + c: F.col(c).isNull() for c in longs}).withColumns({c: F.coalesce(c, F.lit(0)) for c in longs})
    processor = _InOrder(_names(order), take, delay is not None, longs, idle, idle_us)
    return source.groupBy(_GROUP).transformWithStateInPandas(
        processor, schema, "Append", "ProcessingTime" if delay is None else "EventTime")


def _numbered(runs: _Runs, known: _Keys) -> np.ndarray:
    """How many rows of its key come before each row, with those that its state has counted."""
    seen = np.array([known.states.get(k, 0) for k in runs.keys], dtype=np.int64)
    known.states.update(zip(runs.keys, (seen + runs.sizes).tolist()))
    return np.arange(len(runs.of_row)) + (seen - runs.starts)[runs.of_row]


def _is_mark(rows: pd.DataFrame, marker_col: str, end_value: int) -> np.ndarray:
    return (rows[marker_col] == end_value).fillna(False).to_numpy(bool)


def counted(df: DataFrame, by, order, time_col: str, delay: str, name: str = "frame_count", groups: int | None = None) -> DataFrame:
    """G4 in event order: the rows of the stream ``df``, numbered from 1 per key, each once the watermark has passed it.

    Rows later than ``delay`` behind the latest ``time_col`` are dropped, as
    are rows without a time.
    """
    def take(rows, runs, known):
        rows[name] = _numbered(runs, known) + 1
        return rows

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])
    return _in_order(df, by, order, time_col, delay, take, schema, groups)


def first_n(df: DataFrame, by, order, n: int, time_col: str, delay: str, seq: str = "seq", groups: int | None = None) -> DataFrame:
    """O4 in event order: the first ``n`` rows per key, numbered from 0; a key that has them keeps no more rows."""
    def take(rows, runs, known):
        rows[seq] = _numbered(runs, known)
        for k in runs.keys:
            if known.states[k] >= n:
                known.finish(k)
        return rows[rows[seq] < n]

    schema = T.StructType([*df.schema.fields, T.StructField(seq, T.LongType())])
    return _in_order(df, by, order, time_col, delay, take, schema, groups)


def until_end(df: DataFrame, by, order, time_col: str, delay: str, marker_col: str = "frame_id", end_value: int = END_MARKER,
              groups: int | None = None) -> DataFrame:
    """O5 in event order: the rows before each key's first END marker; a key that has ended keeps no more rows."""
    def take(rows, runs, known):
        marks = np.concatenate([[0], _is_mark(rows, marker_col, end_value).cumsum()])  # up to each row
        ended = marks[1:] > marks[runs.starts][runs.of_row]
        for i in (marks[runs.ends] > marks[runs.starts]).nonzero()[0]:
            known.finish(runs.keys[i])
        return rows[~ended]

    return _in_order(df, by, order, time_col, delay, take, df.schema, groups)


def session_close(df: DataFrame, by: str, order, announced_col: str, idle: str, time_col: str, delay: str | None = None,
                  marker_col: str = "frame_id", end_value: int = END_MARKER, groups: int | None = None) -> DataFrame:
    """G3 on a live stream: one row per session when it closes: ``by``, announced, received, reason, complete.

    A session closes at its announced count (``complete``), at an END record
    (``end marker``), or when no record came for ``idle`` (``idle``); what comes
    later is ignored. With a ``delay``, records are taken in event order and
    idle time is event time, so the result doesn't depend on micro-batches;
    without, they are taken in arrival order and idle time is the clock's.
    ``announced_col`` is taken from the first record that has it.
    """
    schema = T.StructType([df.schema[by], T.StructField("announced", T.LongType()), T.StructField("received", T.LongType()),
                           T.StructField("reason", T.StringType()), T.StructField("complete", T.BooleanType())])
    idle_us = _interval_us(idle)

    def closed(rows):
        """``rows``: (key, announced, received, reason)."""
        out = pd.DataFrame([(*r, r[1] is None or r[2] >= r[1]) for r in rows], columns=schema.fieldNames(), dtype=object)
        return out.astype({"announced": "Int64", "received": "int64", "complete": "bool"})

    def take(rows, runs, known):
        at, labels = rows[_AT].to_numpy(), rows[by]
        told = rows[announced_col].notna().to_numpy()
        marks = _is_mark(rows, marker_col, end_value)
        done = []
        for key, start, end in zip(runs.keys, runs.starts.tolist(), runs.ends.tolist()):
            label = None if pd.isna(labels.iloc[start]) else labels.iloc[start]
            _, announced, received, last = known.states.get(key) or (label, None, 0, None)
            idled = False
            if delay is not None:
                times = at[start:end]
                gaps = (np.diff(times, prepend=times[0] if last is None else last) > idle_us).nonzero()[0]
                last = int(times[-1])
                if len(gaps):
                    end, idled = start + int(gaps[0]), True
            first = told[start:end].nonzero()[0]
            if announced is None and len(first):
                announced = int(rows[announced_col].iloc[start + first[0]])
            ends = marks[start:end].nonzero()[0]
            received += int(ends[0]) if len(ends) else end - start
            if announced is not None and received >= announced:
                done.append((key, (label, announced, announced, "complete")))
            elif len(ends):
                done.append((key, (label, announced, received, "end marker")))
            elif idled:
                done.append((key, (label, announced, received, "idle")))
            else:
                known.states[key] = (label, announced, received, last)
        for key, _ in done:
            known.finish(key)
        return closed([r for _, r in done])

    def idle_rows(states):
        return closed([(*state[:3], "idle") for state in states])

    slim = df.select(by, *dict.fromkeys([*_names(order), time_col, announced_col, marker_col]))
    return _in_order(slim, by, order, time_col, delay, take, schema, groups, idle_rows, idle_us)


def live_fallback(sent: DataFrame, replies: DataFrame, keys, sent_time: str, reply_time: str, value_col: str, reply_col: str,
                  limit: str, delay: str, out_col: str = "shown") -> DataFrame:
    """P4 on a live stream: every sent frame once, with what its viewer sees.

    That is the reply, if a usable one came within ``limit`` after the frame
    was sent, and the frame itself otherwise: an absent, late or empty reply
    shows the original once the watermarks have passed the limit. Both streams
    may be out of order by ``delay``. Of replies that repeat a key the first to
    arrive counts. The result has the columns of ``sent``, ``out_col`` and
    ``shown_from``.
    """
    keys = _names(keys)
    names = {k: f"_reply_{k}" for k in keys}
    came = replies.select(*keys, F.col(reply_time).alias("_reply_at"), F.col(reply_col).alias("_reply")).withWatermark("_reply_at", delay) \
        .dropDuplicatesWithinWatermark(keys).withColumnsRenamed(names)
    out = sent.withWatermark(sent_time, delay)
    # The bounds let Spark drop both sides' state.
    on_time = (F.col("_reply_at") >= F.col(sent_time)) & (F.col("_reply_at") <= F.col(sent_time) + F.expr(f"INTERVAL {limit}"))
    same = [F.col(k) == F.col(v) for k, v in names.items()]
    joined = out.join(came, on=[*same, on_time], how="leftOuter")
    return R.shown(joined, value_col, "_reply", out_col).drop("_reply", "_reply_at", *names.values())


def latest_per_key(df: DataFrame, by, order, values) -> DataFrame:
    """O6 on a stream: a ``max_by`` aggregate, to be written in update mode
    (:func:`backdrop.streaming.jobs.write_batches`, ``newest_rows``)."""
    by, order, values = _names(by), _names(order), _names(values)
    best = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    return df.groupBy(*by).agg(best, F.count(F.lit(1)).alias("n_frames")) \
        .select(*by, *[F.col(f"_last.{v}").alias(v) for v in values], "n_frames")
