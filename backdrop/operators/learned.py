"""A backdrop learned from a session's own frames.

A camera that stands still shows its backdrop most of the time, so the median
of a pixel over a session's frames is the backdrop there. Medians are exact
and found without moving frames: every task counts, for each session and
shape that it holds, how often each value of each pixel has which upper four
bits; the counts of all tasks are added up, which names the upper four bits
of the median; a second pass over the frames counts the lower four bits among
the values that share them. Counts are cut into tiles, so one session is
merged by many tasks, and merged in two rounds of streams, so no task holds
more than a tile's sums.

The learned backdrops are files, one per session and shape, that a task opens
for the sessions that it meets: neither pass, nor the segmentation, joins or
shuffles frames.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backdrop import storage
from backdrop.config import stored
from backdrop.functions import pixels
from backdrop.operators import frames as FO
from backdrop.sinks import frames as SK

# Values (pixels x 3) of a tile of counts.
TILE = 1 << 14
# Bytes of counts that a task holds before it passes them on, and of learned backdrops that it keeps.
HELD_BYTES = 256 << 20
KEPT_BYTES = 128 << 20
# First round of merging: this many streams a tile.
SALTS = 64
# A pixel differs from the backdrop if a channel differs by more.
TOLERANCE = 24

_COUNTS = T.StructType([T.StructField("model", T.StringType()), T.StructField("tile", T.IntegerType()), T.StructField("counts", T.BinaryType())])


def _model_name(session, shape: tuple[int, int]) -> str:
    """The file of a session's backdrop; sessions may be called anything."""
    return f"{'null' if session is None else 's' + str(session).encode().hex()}-{shape[0]}x{shape[1]}"


def _pack(counts: np.ndarray) -> bytes:
    return pa.compress(counts.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[4:], int.from_bytes(data[:4], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<u4").reshape(-1, 16).astype(np.int64)


def _rows(tiles: list[tuple[str, int, np.ndarray]]) -> pa.RecordBatch:
    packed = [(c.size * 4).to_bytes(4, "little") + _pack(c) for _, _, c in tiles]
    return pa.RecordBatch.from_arrays([pa.array([m for m, _, _ in tiles], pa.string()), pa.array([t for _, t, _ in tiles], pa.int32()),
                                       pa.array(packed, pa.binary())], ["model", "tile", "counts"])


class _Models:
    """Learned arrays of one folder by name; those used last are kept."""

    def __init__(self, root: str, most: int = KEPT_BYTES) -> None:
        self.root, self.most, self.held = root, most, 0
        self.kept: OrderedDict[str, np.ndarray] = OrderedDict()

    def get(self, name: str) -> np.ndarray:
        if name in self.kept:
            self.kept.move_to_end(name)
            return self.kept[name]
        with storage.open_file(f"{self.root}/models/{name}") as src:
            made = np.frombuffer(src.read(), np.uint8)
        self.kept[name] = made
        self.held += made.nbytes
        while self.held > self.most and len(self.kept) > 1:
            self.held -= self.kept.popitem(last=False)[1].nbytes
        return made


def _count(upper: str | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the upper four bits, or of the lower ones where the upper are those of ``upper``'s models."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = None if upper is None else _Models(upper)
        held: dict[str, np.ndarray] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for model, counts in held.items():
                yield _rows([(model, t, counts[t * TILE : (t + 1) * TILE]) for t in range(-(-len(counts) // TILE))])
            held.clear()

        for batch in batches:
            found = FO.readable_stacks(batch)
            keys = batch.column(batch.schema.get_field_index("session_id")).to_pylist()
            for (h, w), idx, stack in found:
                flat = stack.reshape(len(idx), -1)
                for key in dict.fromkeys(keys[i] for i in idx):
                    name = _model_name(key, (h, w))
                    if name not in held:
                        if held and (sum(c.nbytes for c in held.values()) + flat.shape[1] * 64 > HELD_BYTES):
                            yield from passed_on()
                        held[name] = np.zeros((flat.shape[1], 16), np.uint32)
                    counts, at = held[name], np.arange(flat.shape[1])
                    for k in (k for k, i in enumerate(idx) if keys[i] == key):
                        if models is None:
                            counts[at, flat[k] >> 4] += 1
                        else:
                            same = np.flatnonzero(flat[k] >> 4 == models.get(name) >> 4)
                            counts[same, flat[k][same] & 15] += 1
        yield from passed_on()

    return run


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbouring rows of one model and tile."""
    name, total = None, None
    for batch in batches:
        for model, tile, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if name == (model, tile):
                total = total + _unpack(data)
                continue
            if name is not None:
                yield _rows([(*name, total)])
            name, total = (model, tile), _unpack(data)
    if name is not None:
        yield _rows([(*name, total)])


def _merged(partial: DataFrame) -> DataFrame:
    n = int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = partial.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    once = salted.repartition(n, "model", "tile", "salt").sortWithinPartitions("model", "tile", "salt").select(
        "model", "tile", "counts").mapInArrow(_add_up, _COUNTS)
    return once.repartition(n, "model", "tile").sortWithinPartitions("model", "tile").mapInArrow(_add_up, _COUNTS)


def _nibbles(counts: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first value by which ``rank`` rows are counted, and the rows below it."""
    upto = counts.cumsum(1)
    value = (upto < rank[:, None]).sum(1)
    at = np.arange(len(counts))
    return value.astype(np.uint8), upto[at, value] - counts[at, value]


def _upper(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles of (upper four bits of the median in a byte's upper half), and the rank that is left for the lower ones."""
    for batch in batches:
        for model, tile, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            counts = _unpack(data)
            rank = (counts.sum(1) + 1) // 2
            value, below = _nibbles(counts, rank)
            yield pa.RecordBatch.from_arrays(
                [pa.array([model]), pa.array([tile], pa.int32()), pa.array([(value << 4).tobytes()], pa.binary()),
                 pa.array([(rank - below).astype("<i8").tobytes()], pa.binary())], ["model", "tile", "value", "rank"])


def _lower(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for model, tile, data, value, rank in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            low, _ = _nibbles(_unpack(data), np.frombuffer(rank, "<i8"))
            yield pa.RecordBatch.from_arrays([pa.array([model]), pa.array([tile], pa.int32()),
                                              pa.array([(np.frombuffer(value, np.uint8) | low).tobytes()], pa.binary())], ["model", "tile", "value"])


def _to_files(tiles: DataFrame, root: str) -> None:
    """One file per model: its tiles in order. A model has as many as its frames' size asks for."""
    whole = F.aggregate(F.array_sort(F.collect_list(F.struct("tile", "value"))), F.expr("X''"), lambda acc, t: F.concat(acc, t["value"]))
    files = tiles.groupBy("model").agg(whole.alias("payload")).select(
        F.lit("models").alias("session_id"), F.lit(0).alias("seq"), F.col("model").alias("filename"), "payload",
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("message"))
    SK.land_payloads(files, root)


def learn_backdrops(frames: DataFrame, root: str) -> str:
    """Learn the backdrop of every session of ``frames`` into files under ``root``; what :func:`remove_learned_backdrop` takes.

    The backdrop is the lower median of each pixel and channel over the
    session's readable frames of one size. Unreadable frames are left out;
    frames without a session are a session.
    """
    spark = frames.sparkSession
    resolved = storage.resolve(spark, root)
    slim = frames.select("session_id", "height", "width", "n_channels", "mode", "data")
    upper = stored(_merged(slim.mapInArrow(_count(None), _COUNTS)).mapInArrow(_upper, "model string, tile int, value binary, rank binary"), "upper")
    _to_files(upper.select("model", "tile", "value"), f"{root}/upper")
    counted = _merged(slim.mapInArrow(_count(f"{resolved}/upper"), _COUNTS))
    lower = counted.join(upper, ["model", "tile"]).mapInArrow(_lower, "model string, tile int, value binary")
    _to_files(lower, f"{root}/backdrop")
    return f"{resolved}/backdrop"


def remove_learned_backdrop(frames: DataFrame, backdrops: str, tolerance: int = TOLERANCE, bg_color=pixels.BG_COLOR) -> DataFrame:
    """A3 + A4 with learned backdrops: pixels that differ from their session's backdrop by at most ``tolerance`` in
    every channel are painted. A frame of a session or size that was not learned is an error row. Adds ``painted``."""
    bg = tuple(int(v) for v in bg_color)
    models: list[_Models] = []

    def kernel(bgr, keys):
        if not models:
            models.append(_Models(backdrops))
        shape = bgr.shape[1:]
        learned = np.stack([models[0].get(_model_name(k, shape[:2])).reshape(shape) for k in keys])
        near = np.maximum(bgr, learned) - np.minimum(bgr, learned) <= tolerance
        out, painted = pixels.composite(bgr, near.all(-1), bg)
        return out, {"painted": painted.reshape(len(out), -1).sum(axis=1)}

    return FO.map_frames(frames, kernel, extra=("painted",), key_col="session_id")
