"""Kernels on raw frames (numpy arrays); codecs are not available here."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_depth(depth: np.ndarray, low: float, high: float) -> np.ndarray:
    """Depth clipped, scaled to 0..255 by its own range, in three channels."""
    d = np.clip(depth.astype(float), low, high)
    scaled = (d - d.min()) / (d.max() - d.min() + 1e-9) * 255
    return np.repeat(scaled.astype(np.uint8)[..., None], 3, axis=-1)


def _blobs(mask: np.ndarray) -> np.ndarray:
    """Labels of 4-connected regions, by merging row runs."""
    labels, parent = np.zeros(mask.shape, int), [0]

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for y in range(mask.shape[0]):
        edge = np.flatnonzero(np.diff(np.r_[0, mask[y].astype(int), 0]))
        for a, b in zip(edge[::2], edge[1::2]):
            above = np.unique(labels[y - 1, a:b]) if y else np.zeros(1, int)
            above = [root(x) for x in above if x]
            k = min(above) if above else len(parent)
            if not above:
                parent.append(k)
            for x in above:
                parent[x] = k
            labels[y, a:b] = k
    return np.array([root(i) for i in range(len(parent))])[labels]


def denoise_depth(depth: np.ndarray, bright: int = 10_000, most: int = 1_000, ring: int = 3) -> np.ndarray:
    """Bright blobs of at most ``most`` pixels replaced by the mean of the ring around them (or the median of the frame)."""
    out, hot = depth.astype(float).copy(), depth >= bright
    labels = _blobs(hot)
    for k in np.unique(labels[labels > 0]):
        blob = labels == k
        if blob.sum() > most:
            continue
        ys, xs = np.nonzero(blob)
        y0, y1, x0, x1 = max(ys.min() - ring, 0), ys.max() + ring + 1, max(xs.min() - ring, 0), xs.max() + ring + 1
        around = depth[y0:y1, x0:x1][~hot[y0:y1, x0:x1]]
        calm = depth[~hot]
        out[blob] = around.mean() if around.size else np.median(calm) if calm.size else 0
    return out.astype(depth.dtype)


def denoise_frames(height: int, width: int, bright: int = 10_000, most: int = 1_000, ring: int = 3):
    """A pandas UDF of :func:`denoise_depth` for depth frames held as arrays, row by row; null for another size."""

    @F.pandas_udf("array<bigint>")
    def run(frames: pd.Series) -> pd.Series:
        fit = [f is not None and len(f) == height * width for f in frames]
        return pd.Series([denoise_depth(np.asarray(f, np.int64).reshape(height, width), bright, most, ring).ravel() if ok else None for f, ok in zip(frames, fit)])

    return run


def rotate_180(pixels: Column, channels: int = 1) -> Column:
    """A frame held as an array, channels innermost, turned by half a turn."""
    if channels == 1:
        return F.reverse(pixels)
    n = F.call_function("div", F.size(pixels), F.lit(channels))
    return F.flatten(F.transform(F.sequence(n - 1, F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")), lambda i: F.slice(pixels, (i * channels + 1).cast("int"), F.lit(channels))))


def resize(pixels: Column, size: tuple[int, int], new: tuple[int, int], channels: int = 1) -> Column:
    """A frame held as an array of (height, width) in another size, every pixel taken from the place it falls on."""
    (h, w), (nh, nw) = size, new
    i = lambda k: F.call_function("div", k, F.lit(channels))
    row = lambda k: F.call_function("div", F.call_function("div", i(k), F.lit(nw)) * h, F.lit(nh))
    col = lambda k: F.call_function("div", (i(k) % nw) * w, F.lit(nw))
    return F.transform(F.sequence(F.lit(0), F.lit(nh * nw * channels - 1)), lambda k: F.get(pixels, ((row(k) * w + col(k)) * channels + k % channels).cast("int")))


def still_prefix(moved: np.ndarray, threshold: float, ratio: float, shortest: int) -> int:
    """Longest prefix of frame differences, from ``shortest`` on, of which at least ``ratio`` are at most the threshold; 0 if none."""
    calm = np.cumsum(np.asarray(moved) <= threshold)
    n = np.arange(1, len(calm) + 1)
    good = np.flatnonzero((calm >= ratio * n) & (n >= shortest))
    return int(n[good[-1]]) if len(good) else 0
