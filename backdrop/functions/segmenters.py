"""Pluggable segmenters: ``rgb uint8[n, h, w, 3] -> mask[n, h, w]``.

The mask is compared with the cut-off by the compositing step; a category
mask (0 = person, 1 = backdrop, as a selfie model emits) and a confidence
mask both fit. A segmenter is created on the driver, pickled into the
Python workers once per task and may cache heavy state per worker process.
"""

from __future__ import annotations

import numpy as np

from backdrop.functions.pixels import luma_at_least


class Segmenter:
    """Base class; subclasses implement ``__call__`` on a stack of frames."""

    def __call__(self, rgb: np.ndarray) -> np.ndarray:  # pragma: no cover - interface
        raise NotImplementedError

    def per_frame(self, rgb_frame: np.ndarray) -> np.ndarray:
        return self(rgb_frame[None])[0]


class ThresholdSegmenter(Segmenter):
    """Category 1 where the luma is at least ``level``; a bright-backdrop stand-in."""

    def __init__(self, level: int = 153):
        self.level = int(level)

    def __call__(self, rgb):
        return luma_at_least(rgb, self.level).view(np.uint8)


class KeyColorSegmenter(Segmenter):
    """Chroma key: category 1 where every channel is within ``tolerance`` of ``key_rgb``."""

    def __init__(self, key_rgb=(0, 255, 0), tolerance: int = 40):
        self.key = np.asarray(key_rgb, dtype=np.int16)
        self.tolerance = int(tolerance)

    def __call__(self, rgb):
        diff = np.abs(rgb.astype(np.int16) - self.key)
        return np.all(diff <= self.tolerance, axis=-1).astype(np.uint8)


class FrameFunctionSegmenter(Segmenter):
    """Wraps a per-frame callable ``uint8[h, w, 3] -> mask[h, w]`` (e.g. a model runtime)."""

    def __init__(self, fn):
        self.fn = fn

    def __call__(self, rgb):
        return np.stack([np.asarray(self.fn(f)) for f in rgb]) if len(rgb) else np.zeros(rgb.shape[:3])


class OnnxSegmenter(Segmenter):
    """An ONNX model taking ``float32[n, h, w, 3]`` in 0..1 and returning a mask.

    The model bytes travel in a Spark broadcast variable and the inference
    session is built once per Python worker process.
    """

    def __init__(self, model_broadcast, input_name: str | None = None, output_index: int = 0,
                 channel_axis_last: bool = True):
        self.model = model_broadcast
        self.input_name = input_name
        self.output_index = output_index
        self.channel_axis_last = channel_axis_last

    def _session(self):
        # One inference session per Python worker process and model. The cache
        # lives in ``sys`` because this class itself travels by value.
        import sys
        cache = sys.__dict__.setdefault("_backdrop_onnx_sessions", {})
        key = getattr(self.model, "_jbroadcast", None)
        key = id(self.model) if key is None else key.id()
        sess = cache.get(key)
        if sess is None:
            try:
                import onnxruntime as ort
            except ImportError as exc:  # pragma: no cover - optional dependency
                raise RuntimeError("onnxruntime is not available") from exc
            sess = ort.InferenceSession(self.model.value, providers=["CPUExecutionProvider"])
            cache[key] = sess
        return sess

    def __call__(self, rgb):
        sess = self._session()
        x = rgb.astype(np.float32) / 255.0
        if not self.channel_axis_last:
            x = np.transpose(x, (0, 3, 1, 2))
        name = self.input_name or sess.get_inputs()[0].name
        out = np.asarray(sess.run(None, {name: x})[self.output_index])
        if out.ndim == 4:  # (n, h, w, 1) or (n, 1, h, w)
            out = out[..., 0] if out.shape[-1] == 1 else out[:, 0]
        return out


SEGMENTERS = {
    "threshold": ThresholdSegmenter,
    "key_color": KeyColorSegmenter,
}


def make_segmenter(spec) -> Segmenter:
    if isinstance(spec, Segmenter):
        return spec
    if callable(spec):
        return FrameFunctionSegmenter(spec)
    if isinstance(spec, str):
        return SEGMENTERS[spec]()
    raise TypeError(f"cannot build a segmenter from {spec!r}")
