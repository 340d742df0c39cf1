"""The ONNX segmenter path with a tiny model encoded here by hand (the
``onnx`` package is not installed): mask = mean of the three channels."""

import numpy as np
import pytest

from backdrop import schemas
from backdrop.functions import pixels
from backdrop.functions.segmenters import OnnxSegmenter
from backdrop.operators import frames as FO

ort = pytest.importorskip("onnxruntime")


def _varint(n):
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        out.append(b | (0x80 if n else 0))
        if not n:
            return bytes(out)


def _key(field, wire):
    return _varint(field << 3 | wire)


def _int(field, v):
    return _key(field, 0) + _varint(v)


def _msg(field, body: bytes):
    return _key(field, 2) + _varint(len(body)) + body


def _str(field, s):
    return _msg(field, s.encode())


def _tensor_value(name, dims):
    shape = b"".join(_msg(1, _str(2, d) if isinstance(d, str) else _int(1, d)) for d in dims)
    tensor = _int(1, 1) + _msg(2, shape)  # elem_type FLOAT
    return _str(1, name) + _msg(2, _msg(1, tensor))


def channel_mean_model() -> bytes:
    attrs = _msg(5, _str(1, "axes") + _int(8, 3) + _int(20, 7)) + _msg(5, _str(1, "keepdims") + _int(3, 0) + _int(20, 2))
    node = _str(1, "X") + _str(2, "Y") + _str(3, "mean") + _str(4, "ReduceMean") + attrs
    graph = (_msg(1, node) + _str(2, "g") + _msg(11, _tensor_value("X", ["n", "h", "w", 3]))
             + _msg(12, _tensor_value("Y", ["n", "h", "w"])))
    return _int(1, 7) + _msg(8, _str(1, "") + _int(2, 13)) + _msg(7, graph)


def test_model_runs_locally():
    sess = ort.InferenceSession(channel_mean_model(), providers=["CPUExecutionProvider"])
    x = np.random.default_rng(0).random((2, 3, 4, 3), dtype=np.float32)
    (y,) = sess.run(None, {"X": x})
    assert np.allclose(y, x.mean(-1), atol=1e-6)


def test_onnx_segmenter_in_spark(spark):
    rng = np.random.default_rng(3)
    bgr = rng.integers(0, 256, (4, 5, 3), dtype=np.uint8)
    rows = [("s", 0, "f.png", None, 4, 5, 3, schemas.MODE_BGR, bytearray(bgr.tobytes()))]
    df = spark.createDataFrame(rows, schemas.FRAMES)
    seg = OnnxSegmenter(spark.sparkContext.broadcast(channel_mean_model()))
    got = FO.remove_backdrop(df, seg).first()
    mean = (bgr.astype(np.float32) / np.float32(255)).mean(-1)
    assert np.all(np.abs(mean - 0.2) > 1e-4)  # no pixel sits on the cut-off
    want, painted = pixels.composite(bgr[None], mean[None])
    assert got["status"] == "success" and bytes(got["data"]) == want.tobytes()
    assert got["painted"] == int(painted.sum())
