"""NumPy kernels over stacks of frames.

Every kernel takes ``uint8[n, h, w, c]`` arrays so that a whole Arrow batch
of same-shaped frames is processed with one vectorised call. Frames are BGR
in storage; the segmenter sees RGB, as the reference's model does.
"""

from __future__ import annotations

import math

import numpy as np

from backdrop import schemas

# Fixed values shared with the reference: the backdrop colour (RGB) and the
# mask cut-off of the compositing step.
BG_COLOR = (192, 192, 192)
MASK_CUTOFF = 0.2

_CHANNELS_OF_MODE = {schemas.MODE_GREY: 1, schemas.MODE_BGR: 3, schemas.MODE_BGRA: 4}


def channels_of_mode(mode: int) -> int | None:
    return _CHANNELS_OF_MODE.get(int(mode))


def to_bgr(stack: np.ndarray) -> np.ndarray:
    """Force three colour channels: grey is repeated, alpha is dropped."""
    c = stack.shape[-1]
    if c == 3:
        return stack
    if c == 1:  # a read-only view; copies happen only where bytes are written
        return np.broadcast_to(stack, stack.shape[:-1] + (3,))
    if c == 4:
        return stack[..., :3]
    raise ValueError(f"unsupported channel count {c}")


def swap_rb(stack: np.ndarray) -> np.ndarray:
    """BGR <-> RGB (a view; copy when bytes are needed)."""
    return stack[..., ::-1]


def composite(bgr: np.ndarray, mask: np.ndarray, bg_rgb=BG_COLOR, cutoff: float = MASK_CUTOFF,
              mask_true: str = "background") -> tuple[np.ndarray, np.ndarray]:
    """Replace the backdrop.

    ``mask_true="background"`` paints pixels whose mask exceeds ``cutoff``
    (what the reference's code does); ``"foreground"`` keeps them and paints
    the rest (what its documentation describes). Returns the new BGR stack
    and the per-pixel boolean of painted pixels.
    """
    if mask_true not in ("background", "foreground"):
        raise ValueError("mask_true must be 'background' or 'foreground'")
    mask = np.asarray(mask)
    if mask.dtype.kind in "biu":  # category mask: x > cutoff  <=>  x >= floor(cutoff) + 1, in its own type
        level = math.floor(cutoff) + 1
        m = mask.view(np.uint8) if mask.dtype.kind == "b" else mask
        info = np.iinfo(m.dtype)
        hit = np.ones(m.shape, bool) if level <= info.min else (
            np.zeros(m.shape, bool) if level > info.max else m >= m.dtype.type(level))
    else:
        hit = mask.astype(np.float64, copy=False) > cutoff
    painted = hit if mask_true == "background" else ~hit
    out = np.array(bgr, dtype=np.uint8, order="C", copy=True)
    np.copyto(_as_pixels(out), _pixel(bg_rgb), where=painted)
    return out, painted


def sentinel_mask(bgr: np.ndarray, bg_rgb=BG_COLOR) -> np.ndarray:
    """Pixels whose three channels all equal the backdrop colour."""
    bg_bgr = np.asarray(bg_rgb, dtype=np.uint8)[::-1]
    return np.all(bgr == bg_bgr, axis=-1)


def recomposite(original_bgr: np.ndarray, processed_bgr: np.ndarray, bg_rgb=BG_COLOR) -> tuple[np.ndarray, np.ndarray]:
    """Backdrop colour where the processed frame shows it, original elsewhere."""
    is_bg = sentinel_mask(processed_bgr, bg_rgb)
    out = np.array(original_bgr, dtype=np.uint8, order="C", copy=True)
    np.copyto(_as_pixels(out), _pixel(bg_rgb), where=is_bg)
    return out, is_bg


def _as_pixels(bgr: np.ndarray) -> np.ndarray:
    """A C-contiguous ``uint8[..., 3]`` viewed as one 3-byte item per pixel."""
    return bgr.view(np.dtype("V3")).reshape(bgr.shape[:-1])


def _pixel(bg_rgb) -> np.ndarray:
    """The backdrop colour as one 3-byte BGR item."""
    return np.asarray(bg_rgb, dtype=np.uint8)[::-1].copy().view(np.dtype("V3"))[0]


def luma_x1000(rgb: np.ndarray) -> np.ndarray:
    """``299 R + 587 G + 114 B`` in int32 (BT.601 weights, scaled by 1000)."""
    acc = np.multiply(rgb[..., 0], np.int32(299), dtype=np.int32)
    acc += np.multiply(rgb[..., 1], np.int32(587), dtype=np.int32)
    acc += np.multiply(rgb[..., 2], np.int32(114), dtype=np.int32)
    return acc


def luma(rgb: np.ndarray) -> np.ndarray:
    """Integer BT.601 luma, rounded; exact for grey pixels (weights sum to 1000)."""
    return (luma_x1000(rgb) + 500) // 1000


def luma_at_least(rgb: np.ndarray, level: int) -> np.ndarray:
    """``luma(rgb) >= level`` without the division."""
    return luma_x1000(rgb) >= np.int32(1000 * int(level) - 500)
