import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra.numpy import arrays

from backdrop.functions import pixels
from backdrop.functions.segmenters import KeyColorSegmenter, ThresholdSegmenter

frames = arrays(np.uint8, st.tuples(st.integers(1, 3), st.integers(1, 6), st.integers(1, 6), st.just(3)))


def brute_composite(bgr, mask, bg_rgb, cutoff, mask_true):
    out = bgr.copy()
    n, h, w, _ = bgr.shape
    for i in range(n):
        for y in range(h):
            for x in range(w):
                hit = float(mask[i, y, x]) > cutoff
                if (hit and mask_true == "background") or (not hit and mask_true == "foreground"):
                    out[i, y, x] = bg_rgb[::-1]
    return out


@settings(max_examples=50, deadline=None)
@given(frames, st.floats(-1, 1), st.sampled_from(["background", "foreground"]))
def test_composite_matches_brute_force(stack, cutoff, mask_true):
    rng = np.random.default_rng(stack.size)
    mask = rng.uniform(-1, 1, stack.shape[:3]).astype(np.float32)
    out, painted = pixels.composite(stack, mask, (192, 192, 192), cutoff, mask_true)
    assert np.array_equal(out, brute_composite(stack, mask, (192, 192, 192), cutoff, mask_true))
    assert painted.shape == stack.shape[:3]


@settings(max_examples=50, deadline=None)
@given(frames)
def test_polarities_cover_each_pixel_once(stack):
    mask = (stack[..., 0] > 100).astype(np.uint8)
    _, p1 = pixels.composite(stack, mask, mask_true="background")
    _, p2 = pixels.composite(stack, mask, mask_true="foreground")
    assert np.all(p1 ^ p2)


@settings(max_examples=50, deadline=None)
@given(frames)
def test_swap_twice_is_identity(stack):
    assert np.array_equal(pixels.swap_rb(pixels.swap_rb(stack)), stack)


@settings(max_examples=100, deadline=None)
@given(frames)
def test_recomposite_after_composite_is_identity(stack):
    mask = (pixels.luma(pixels.swap_rb(stack)) > 120).astype(np.uint8)
    once, _ = pixels.composite(stack, mask)
    again, _ = pixels.recomposite(stack, once)
    assert np.array_equal(once, again)


def test_sentinel_mask_counts_true_grey_as_backdrop():
    frame = np.array([[[192, 192, 192], [192, 192, 191]]], dtype=np.uint8)[None]
    assert pixels.sentinel_mask(frame).tolist() == [[[True, False]]]


def test_luma_is_exact_for_grey():
    v = np.arange(256, dtype=np.uint8)
    rgb = np.stack([v, v, v], -1)
    assert np.array_equal(pixels.luma(rgb), v.astype(np.int32))


def test_to_bgr_channel_rules():
    grey = np.arange(6, dtype=np.uint8).reshape(1, 2, 3, 1)
    assert pixels.to_bgr(grey).shape == (1, 2, 3, 3)
    assert np.all(pixels.to_bgr(grey)[..., 0] == grey[..., 0])
    bgra = np.arange(24, dtype=np.uint8).reshape(1, 2, 3, 4)
    assert np.array_equal(pixels.to_bgr(bgra), bgra[..., :3])


def test_segmenters():
    rgb = np.array([[[0, 255, 0], [250, 250, 250], [10, 10, 10]]], dtype=np.uint8)[None]
    assert KeyColorSegmenter((0, 255, 0), 10)(rgb).tolist() == [[[1, 0, 0]]]
    assert ThresholdSegmenter(153)(rgb).tolist() == [[[0, 1, 0]]]
