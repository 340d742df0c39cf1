"""Pixel operators: one ``mapInArrow`` family over frame rows.

Rows of equal shape inside an Arrow batch are stacked into one
``uint8[n, h, w, c]`` array, so the NumPy work is vectorised across frames
as well as pixels. Unreadable and failing frames never stop a batch: they
come out with ``status`` and ``message`` set and ``data`` NULL, and a
failure inside a stacked call is retried frame by frame to isolate it.

Catalyst cannot see inside these operators: filter and project before
calling them.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from backdrop import schemas
from backdrop.functions import pixels
from backdrop.functions.segmenters import make_segmenter

# A kernel maps a BGR stack uint8[n,h,w,3] (plus, optionally, a second stack)
# to (out uint8[n,h,w,c_out], {extra column: int64[n]}).
Kernel = Callable[..., tuple]

_MAX_BATCH_BYTES = 1 << 29  # grey input triples in size; output offsets stay within int32


def _binary_parts(arr: pa.Array):
    """Offsets and value bytes of a (large) binary Arrow array, zero-copy."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    off_type = np.int64 if pa.types.is_large_binary(arr.type) else np.int32
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], dtype=off_type)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    values = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return offsets, values


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An int column as NumPy; with NULLs as objects (None), never NaN floats."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        return np.array(col.to_pylist(), dtype=object)
    return col.to_numpy(zero_copy_only=False)


def _build_binary(chunks: list, valid: np.ndarray, large: bool = False) -> pa.Array:
    sizes = np.array([0 if c is None else c.size for c in chunks], dtype=np.int64)
    offsets = np.zeros(len(chunks) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    values = np.empty(int(offsets[-1]), dtype=np.uint8)
    for i, c in enumerate(chunks):
        if c is not None:
            values[offsets[i]:offsets[i + 1]] = c.reshape(-1)
    validity = pa.py_buffer(np.packbits(valid.astype(np.uint8), bitorder="little"))
    kind, off = (pa.large_binary(), offsets) if large else (pa.binary(), offsets.astype(np.int32))
    return pa.Array.from_buffers(kind, len(chunks), [validity, pa.py_buffer(off), pa.py_buffer(values)],
                                 null_count=int((~valid).sum()))


def _arrow_schema(out_schema: T.StructType, batch: pa.RecordBatch) -> pa.Schema:
    """The output Arrow schema, taking each column's Arrow type from the
    input batch where it exists (so large/regular binary and strings follow
    the session's setting)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    default = to_arrow_schema(out_schema)
    large = pa.types.is_large_binary(batch.schema.field("data").type)
    fields = []
    for f in default:
        idx = batch.schema.get_field_index(f.name)
        if idx >= 0 and f.name not in ("status", "message", "n_channels", "mode"):
            fields.append(pa.field(f.name, batch.schema.field(idx).type))
        elif pa.types.is_binary(f.type) and large:
            fields.append(pa.field(f.name, pa.large_binary()))
        elif pa.types.is_string(f.type) and pa.types.is_large_string(
                batch.schema.field("filename").type if batch.schema.get_field_index("filename") >= 0 else pa.string()):
            fields.append(pa.field(f.name, pa.large_string()))
        else:
            fields.append(f)
    return pa.schema(fields)


_MODE_OF_CHANNELS = {1: schemas.MODE_GREY, 3: schemas.MODE_BGR, 4: schemas.MODE_BGRA}


def _channels_from_size(size: int, h, w):
    if h is None or w is None or int(h) <= 0 or int(w) <= 0 or size % (int(h) * int(w)):
        return None
    return size // (int(h) * int(w))


class _FrameBatch:
    """Shape checks and stacking for one Arrow batch of frame rows."""

    def __init__(self, batch: pa.RecordBatch, data_col: str = "data", infer_channels: bool = False):
        self.n = batch.num_rows
        self.h = _column(batch, "height")
        self.w = _column(batch, "width")
        self.c = _column(batch, "n_channels")
        self.mode = _column(batch, "mode")
        data = batch.column(batch.schema.get_field_index(data_col))
        self.offsets, self.values = _binary_parts(data)
        self.is_null = np.asarray(data.is_null().to_numpy(zero_copy_only=False), dtype=bool)
        if infer_channels:  # a second frame column of the same size: channels from its length
            self.c = np.array([_channels_from_size(int(self.offsets[i + 1] - self.offsets[i]), self.h[i], self.w[i])
                               for i in range(self.n)], dtype=object)
            self.mode = np.array([_MODE_OF_CHANNELS.get(c, schemas.MODE_INVALID) for c in self.c], dtype=object)
        self.status = np.array([schemas.SUCCESS] * self.n, dtype=object)
        self.message = np.array([None] * self.n, dtype=object)
        self._check()

    def _check(self):
        for i in range(self.n):
            size = int(self.offsets[i + 1] - self.offsets[i])
            mode, h, w, c = self.mode[i], self.h[i], self.w[i], self.c[i]
            if (self.is_null[i] or size == 0 or mode is None or int(mode) == schemas.MODE_INVALID
                    or h is None or w is None or int(h) <= 0 or int(w) <= 0):
                self.status[i], self.message[i] = schemas.UNREADABLE, "frame could not be decoded"
            elif pixels.channels_of_mode(mode) is None:
                self.status[i], self.message[i] = schemas.ERROR, f"unsupported image mode {int(mode)}"
            elif c is None or int(c) != pixels.channels_of_mode(mode) or size != int(h) * int(w) * int(c):
                self.status[i], self.message[i] = schemas.ERROR, (
                    f"data has {size} bytes, expected {h}x{w}x{c}")

    def groups(self):
        """Row indices of readable frames, grouped by shape."""
        ok = np.flatnonzero(self.status == schemas.SUCCESS)
        by_shape: dict = {}
        for i in ok:
            by_shape.setdefault((int(self.h[i]), int(self.w[i]), int(self.c[i])), []).append(i)
        return [(shape, np.asarray(idx)) for shape, idx in by_shape.items()]

    def stack(self, shape, idx) -> np.ndarray:
        h, w, c = shape
        size = h * w * c
        starts = self.offsets[idx]
        if len(idx) > 1 and np.all(np.diff(starts) == size):  # contiguous run: a view
            flat = self.values[starts[0]: starts[0] + size * len(idx)]
        else:
            flat = np.concatenate([self.values[s: s + size] for s in starts])
        return flat.reshape(len(idx), h, w, c)

    def fail(self, i, exc: Exception):
        self.status[i], self.message[i] = schemas.ERROR, f"{type(exc).__name__}: {exc}"


def _run_kernel(fb: _FrameBatch, kernel: Kernel, extra_names, second: _FrameBatch | None, keys: list | None = None):
    out_chunks: list = [None] * fb.n
    extras = {name: np.zeros(fb.n, dtype=np.int64) for name in extra_names}
    extra_valid = np.zeros(fb.n, dtype=bool)
    if second is not None:  # both inputs must be readable and of one shape
        for i in range(fb.n):
            if fb.status[i] == schemas.SUCCESS and second.status[i] != schemas.SUCCESS:
                fb.status[i], fb.message[i] = second.status[i], f"second input: {second.message[i]}"
            elif fb.status[i] == schemas.SUCCESS and (fb.h[i], fb.w[i]) != (second.h[i], second.w[i]):
                fb.fail(i, ValueError("inputs differ in size"))

    def apply(shape, idx):
        args = [pixels.to_bgr(fb.stack(shape, idx))]
        if second is not None:
            args.append(np.concatenate([pixels.to_bgr(second.stack((shape[0], shape[1], int(second.c[i])), [i]))
                                        for i in idx]))
        if keys is not None:
            args.append([keys[i] for i in idx])
        out, ext = kernel(*args)
        for k, i in enumerate(idx):
            out_chunks[i] = out[k]
            for name in extra_names:
                extras[name][i] = ext[name][k]
            extra_valid[i] = True

    for shape, idx in fb.groups():
        try:
            apply(shape, idx)
        except Exception:  # isolate the failing frame
            for i in idx:
                try:
                    apply(shape, np.asarray([i]))
                except Exception as exc:  # noqa: BLE001 - reported in the row
                    fb.fail(i, exc)
                    out_chunks[i] = None
    valid = np.array([c is not None for c in out_chunks], dtype=bool)
    return out_chunks, valid, extras, extra_valid


def readable_stacks(batch: pa.RecordBatch) -> list[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
    """(height, width), row numbers and BGR stack of the readable frames of a batch, by shape."""
    fb = _FrameBatch(batch)
    return [(shape[:2], idx, pixels.to_bgr(fb.stack(shape, idx))) for shape, idx in fb.groups()]


def _replace(batch: pa.RecordBatch, schema: pa.Schema, new_cols: dict) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        if field.name in new_cols:
            arrays.append(new_cols[field.name])
        else:
            arrays.append(batch.column(batch.schema.get_field_index(field.name)))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _split(batch: pa.RecordBatch, data_col: str):
    """Keep each processed slice below 1 GiB so int32 offsets never overflow."""
    data = batch.column(batch.schema.get_field_index(data_col))
    if batch.num_rows <= 1 or data.nbytes <= _MAX_BATCH_BYTES:
        yield batch
        return
    half = batch.num_rows // 2
    yield from _split(batch.slice(0, half), data_col)
    yield from _split(batch.slice(half), data_col)


def map_frames(df: DataFrame, kernel: Kernel, *, extra: tuple = (), out_col: str = "data",
               second_col: str | None = None, key_col: str | None = None, pass_through: bool = False,
               out_channels: int = 3, out_mode: int = schemas.MODE_BGR) -> DataFrame:
    """Run ``kernel`` over every readable frame of ``df``.

    With ``key_col`` the kernel also gets the list of the frames' values of
    that column. With ``pass_through`` a frame whose kernel failed keeps its
    data as it came, beside its ``error`` status.

    Output: the input columns with ``out_col`` holding the kernel's frame
    (``n_channels``/``mode`` updated when ``out_col`` is ``data``), plus
    ``status``, ``message`` and one bigint column per name in ``extra``.
    """
    fields = [f for f in df.schema.fields if f.name not in ("status", "message", *extra)]
    names = [f.name for f in fields]
    if out_col not in names:
        fields.append(T.StructField(out_col, T.BinaryType()))
    fields += [T.StructField("status", T.StringType()), T.StructField("message", T.StringType())]
    fields += [T.StructField(name, T.LongType()) for name in extra]
    out_schema = T.StructType(fields)
    replaces_data = out_col == "data"

    def run(batches):
        arrow_schema = None
        for whole in batches:
            for batch in _split(whole, "data"):
                if arrow_schema is None:
                    arrow_schema = _arrow_schema(out_schema, batch)
                fb = _FrameBatch(batch)
                second = _FrameBatch(batch, second_col, infer_channels=True) if second_col else None
                keys = batch.column(batch.schema.get_field_index(key_col)).to_pylist() if key_col else None
                chunks, valid, extras, extra_valid = _run_kernel(fb, kernel, extra, second, keys)
                filled = valid
                if pass_through:
                    for i in np.flatnonzero((fb.status == schemas.ERROR) & ~fb.is_null):
                        chunks[i] = fb.values[fb.offsets[i]:fb.offsets[i + 1]]
                    filled = np.array([c is not None for c in chunks], dtype=bool)
                text = arrow_schema.field("status").type
                cols = {
                    out_col: _build_binary(chunks, filled, pa.types.is_large_binary(arrow_schema.field(out_col).type)),
                    "status": pa.array(fb.status.tolist(), text),
                    "message": pa.array(fb.message.tolist(), text),
                }
                for name in extra:
                    cols[name] = pa.array(extras[name], pa.int64(), mask=~extra_valid)
                if replaces_data:  # readable rows become BGR; others keep what they had
                    keep = pa.array(valid)
                    for name, value in (("n_channels", out_channels), ("mode", out_mode)):
                        before = batch.column(batch.schema.get_field_index(name)).cast(pa.int32())
                        cols[name] = pc.if_else(keep, pa.scalar(value, pa.int32()), before)
                yield _replace(batch, arrow_schema, cols)

    return df.mapInArrow(run, out_schema)


# --------------------------------------------------------------------------
# The operators of the inventory. A step maps the frames as they are now, and
# as they came, to new frames and extra columns; steps run one after another
# in one pass, so a frame is read and assembled once however many there are.


@dataclass(frozen=True)
class Step:
    kernel: Callable[[np.ndarray, np.ndarray], tuple]
    extra: tuple = ()
    channels: int = 3


def chain(df: DataFrame, *steps: Step, out_col: str = "data", pass_through: bool = False) -> DataFrame:
    """All ``steps`` over every readable frame; one Python pass, one pixel column."""
    names = tuple(dict.fromkeys(name for step in steps for name in step.extra))

    def kernel(bgr):
        now, extras = bgr, {}
        for step in steps:
            now, made = step.kernel(now, bgr)
            extras |= made
        return now, extras

    channels = steps[-1].channels
    return map_frames(df, kernel, extra=names, out_col=out_col, pass_through=pass_through, out_channels=channels,
                      out_mode=_MODE_OF_CHANNELS[channels])


def removing(segmenter="threshold", bg_color=pixels.BG_COLOR, cutoff: float = pixels.MASK_CUTOFF, mask_true: str = "background") -> Step:
    """A3 + A4: segment each frame and paint its backdrop; ``painted`` counts the pixels."""
    seg = make_segmenter(segmenter)
    bg = tuple(int(v) for v in bg_color)
    if mask_true not in ("background", "foreground"):
        raise ValueError("mask_true must be 'background' or 'foreground'")

    def kernel(now, _):
        out, painted = pixels.composite(now, seg(pixels.swap_rb(now)), bg, cutoff, mask_true)
        return out, {"painted": painted.reshape(len(out), -1).sum(axis=1)}

    return Step(kernel, ("painted",))


def recompositing(bg_color=pixels.BG_COLOR) -> Step:
    """A5: the backdrop colour where the frame shows it exactly, the frame as it came elsewhere; ``sentinel_px`` counts the pixels."""
    bg = tuple(int(v) for v in bg_color)

    def kernel(now, came):
        out, is_bg = pixels.recomposite(came, now, bg)
        return out, {"sentinel_px": is_bg.reshape(len(out), -1).sum(axis=1)}

    return Step(kernel, ("sentinel_px",))


def masking(bg_color=pixels.BG_COLOR) -> Step:
    """A5: one byte per pixel, 1 where the frame shows the backdrop colour; ``sentinel_px`` counts them."""
    bg = tuple(int(v) for v in bg_color)

    def kernel(now, _):
        m = pixels.sentinel_mask(now, bg)
        return m.view(np.uint8), {"sentinel_px": m.reshape(len(m), -1).sum(axis=1)}

    return Step(kernel, ("sentinel_px",), channels=1)


def normalise(df: DataFrame) -> DataFrame:
    """A1: every readable frame as 3-channel BGR (grey x3, alpha dropped)."""
    return map_frames(df, lambda bgr: (bgr, {}))


def swap_channels(df: DataFrame, out_col: str = "data") -> DataFrame:
    """A2: BGR <-> RGB; grey and alpha frames are normalised first."""
    return map_frames(df, lambda bgr: (np.ascontiguousarray(pixels.swap_rb(bgr)), {}), out_col=out_col)


def remove_backdrop(df: DataFrame, segmenter="threshold", bg_color=pixels.BG_COLOR,
                    cutoff: float = pixels.MASK_CUTOFF, mask_true: str = "background", pass_through: bool = False) -> DataFrame:
    """A1 + A3 + A4 (U1/U3): segment each frame and paint its backdrop.

    ``segmenter`` is a :class:`~backdrop.functions.segmenters.Segmenter`, a
    registered name (``"threshold"``, ``"key_color"``) or a per-frame
    callable ``uint8[h, w, 3] (RGB) -> mask[h, w]``. Adds ``painted``, the
    number of pixels replaced.
    """
    return chain(df, removing(segmenter, bg_color, cutoff, mask_true), pass_through=pass_through)


def recomposite(df: DataFrame, original_col: str = "original", bg_color=pixels.BG_COLOR) -> DataFrame:
    """A5 on finished frames: backdrop colour wherever the processed ``data`` shows it exactly,
    the frame in ``original_col`` elsewhere. Adds ``sentinel_px``. Where the frames are processed
    by the same job, :func:`chain` needs no second pixel column."""
    bg = tuple(int(v) for v in bg_color)

    def kernel(processed, original):
        out, is_bg = pixels.recomposite(original, processed, bg)
        return out, {"sentinel_px": is_bg.reshape(len(out), -1).sum(axis=1)}

    return map_frames(df, kernel, extra=("sentinel_px",), second_col=original_col)


def backdrop_mask(df: DataFrame, bg_color=pixels.BG_COLOR, out_col: str = "mask") -> DataFrame:
    """A5 on its own: recover the backdrop mask of a finished frame, one byte
    per pixel (1 where all three channels equal the backdrop colour; a true
    grey pixel of that colour is a false positive). Adds ``sentinel_px``."""
    return chain(df, masking(bg_color), out_col=out_col)
