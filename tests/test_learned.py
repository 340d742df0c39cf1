import numpy as np
import pytest
from pyspark.sql import functions as F

from backdrop import schemas
from backdrop.operators import learned as LB

FIELDS = "session_id string, frame_id long, height int, width int, n_channels int, mode int, data binary"


def rows_of(rng):
    rows = []
    for session, n in (("a", 31), ("b", 8), (None, 5), ("od/d ü", 1)):
        still = rng.integers(0, 256, (6, 5, 3))
        for i in range(n):
            frame = np.clip(still + rng.integers(-3, 4, still.shape), 0, 255)
            if i % 4 == 1:
                frame[1:3, 1:4] = rng.integers(0, 256, (2, 3, 3))  # someone passes
            rows.append((session, i, 6, 5, 3, schemas.MODE_BGR, frame.astype(np.uint8).tobytes()))
    rows += [("a", 100 + i, 2, 2, 1, schemas.MODE_GREY, bytes([i, 2 * i, 255 - i, 7])) for i in range(10)]
    return rows + [("a", 200, None, None, None, None, None), ("a", 201, 6, 5, 3, schemas.MODE_BGR, b"short")]


def median(stack):
    return np.sort(stack, axis=0)[(len(stack) + 1) // 2 - 1]


@pytest.mark.parametrize("held", [1, 1 << 28])
def test_medians_are_exact(spark, tmp, monkeypatch, held):
    """Over several tasks, sessions, tiles and merge rounds; odd names, a NULL session, broken frames."""
    monkeypatch.setattr(LB, "TILE", 20)
    monkeypatch.setattr(LB, "HELD_BYTES", held)
    monkeypatch.setattr(LB, "SALTS", 3)
    rows = rows_of(np.random.default_rng(0))
    frames = spark.createDataFrame(rows, FIELDS).repartition(5)
    root = LB.learn_backdrops(frames, f"{tmp}/learned")
    models = LB._Models(root, 1)
    want = {}
    for s, _, h, w, c, _, data in rows:
        if data not in (None, b"short"):
            frame = np.frombuffer(data, np.uint8).reshape(h, w, c)
            want.setdefault((s, (h, w)), []).append(np.repeat(frame, 3, -1) if c == 1 else frame)
    for (session, shape), stack in want.items():
        assert np.array_equal(models.get(LB._model_name(session, shape)).reshape(*shape, 3), median(np.stack(stack)))

    out = {(r["session_id"], r["frame_id"]): r for r in LB.remove_learned_backdrop(frames, root, 10).collect()}
    for s, i, h, w, c, _, data in rows:
        r = out[s, i]
        if data in (None, b"short"):
            assert r["status"] != "success" and r["data"] is None
            continue
        frame = np.frombuffer(data, np.uint8).reshape(h, w, c).repeat(3 // c, -1).astype(int)
        near = (abs(frame - median(np.stack(want[s, (h, w)])).astype(int)) <= 10).all(-1)
        frame[near] = 192
        assert r["painted"] == near.sum() and r["data"] == frame.astype(np.uint8).tobytes()


def test_a_session_that_was_not_learned_is_an_error(spark, tmp):
    frames = spark.createDataFrame(rows_of(np.random.default_rng(1)), FIELDS)
    root = LB.learn_backdrops(frames.where("session_id = 'b'"), f"{tmp}/learned")
    got = LB.remove_learned_backdrop(frames.where("session_id in ('a', 'b') and frame_id < 100"), root).groupBy("session_id", "status").count().collect()
    assert {(r["session_id"], r["status"]): r["count"] for r in got} == {("a", "error"): 31, ("b", "success"): 8}


def test_no_frames(spark, tmp):
    frames = spark.createDataFrame(rows_of(np.random.default_rng(1)), FIELDS).limit(0)
    assert LB.remove_learned_backdrop(frames, LB.learn_backdrops(frames, f"{tmp}/learned")).where(F.lit(True)).count() == 0
