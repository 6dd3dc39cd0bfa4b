"""Kernels over grey images for the operations that need a pixel's neighbours, and chains of them as a Column.

An operation takes (image, mask, options) in float64 and returns an image of that shape. The mask marks the
pixels that statistics are taken from; without one, or with an empty one, all finite pixels count. Values that
aren't finite become 0 first. ``image_steps`` runs a chain over arrays in Arrow batches, a row an image. Spark closes
a batch at 64 MB (spark.sql.execution.arrow.maxBytesPerBatch) or 10,000 rows, so a task holds one batch and an image's
neighbourhoods, a row over the limit alone. Operations on single values alone also exist as Columns in ``arrays``.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column
from pyspark.sql import functions as F

OPERATIONS: dict = {}


def operation(*names: str):
    def add(f):
        OPERATIONS.update(dict.fromkeys(names, f))
        return f

    return add


def odd(value) -> int:
    return max(1, int(value)) | 1


# ---- statistics ------------------------------------------------------------------------------------


def sampled(image: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """The values that statistics are taken from."""
    if mask is not None and mask.any():
        return image[mask]
    return image[np.isfinite(image)]


def percentile_window(image: np.ndarray, ends, mask: np.ndarray | None) -> tuple[float, float]:
    """Values at two percentiles (both in 0..1 are shares); an empty range opens to the extremes, then to 1."""
    values = sampled(image, mask)
    if not values.size:
        return 0.0, 1.0
    at = np.asarray(ends, dtype=float)
    if at.shape != (2,):
        raise ValueError("a window has two percentiles")
    lo, hi = np.percentile(values, at * 100 if (at >= 0).all() and (at <= 1).all() else at)
    if not hi > lo:
        lo, hi = values.min(), values.max()
    return float(lo), float(hi if hi > lo else lo + 1)


def to_window(image: np.ndarray, ends, mask: np.ndarray | None) -> np.ndarray:
    lo, hi = percentile_window(image, ends, mask)
    return (image.clip(lo, hi) - lo) / max(hi - lo, 1e-12)


def unit(image: np.ndarray) -> np.ndarray:
    """As it is where it lies in 0..1, else between its 1st and 99th percentile."""
    inside = image.size and image.min() >= 0 and image.max() <= 1
    return image if inside else to_window(image, (1, 99), None)


def spread(image: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """To 0..1 by the extremes of the sampled values; zeros where they are equal."""
    values = sampled(image, mask)
    if not values.size or values.max() <= values.min():
        return np.zeros_like(image)
    return (image - values.min()) / (values.max() - values.min())


# ---- values ----------------------------------------------------------------------------------------


@operation("percentile_normalize")
def _percentile(image, mask, o):
    return to_window(image, o.get("percentiles", (1, 99)), mask)


@operation("aggressive_upper_percentile_normalize")
def _upper(image, mask, o):
    return to_window(image, o.get("percentiles", (70, 100)), mask)


@operation("percentile_clip_only")
def _clip(image, mask, o):
    return image.clip(*percentile_window(image, o.get("percentiles", (1, 99)), mask))


@operation("zscore_clip")
def _zscore(image, mask, o):
    values, limit = sampled(image, mask), max(float(o.get("z_limit", 3)), 1e-6)
    z = (image - values.mean()) / max(values.std(), 1e-12)
    return z.clip(-limit, limit) / (2 * limit) + 0.5


@operation("standardize_to_target")
def _standardize(image, mask, o):
    values = sampled(image, mask)
    lo, hi = percentile_window(values, o.get("stat_percentiles", (1, 99)), None)
    inner = values[(values >= lo) & (values <= hi)]
    inner = inner if inner.size > 1 else values
    gain = max(float(o.get("target_std", 0.2)), 1e-8) / max(inner.std(), 1e-8)
    out = (image - inner.mean()) * gain + float(o.get("target_mean", 0.5))
    return out.clip(0, 1) if o.get("clip_output", True) else out


@operation("gamma")
def _gamma(image, mask, o):
    return spread(image, mask).clip(0, 1) ** max(float(o.get("gamma", 1)), 1e-6)


@operation("log")
def _log(image, mask, o):
    gain = float(o.get("gain", 5))
    return np.log1p(gain * spread(image, mask).clip(0, 1)) / np.log1p(gain)


@operation("invert")
def _invert(image, mask, o):
    return 1 - spread(image, mask)


@operation("mask_outside_breast", "artifact_cleanup")
def _outside(image, mask, o):
    return np.where(foreground(image) if mask is None else mask, image, float(o.get("outside_value", 0)))


@operation("pectoral_suppression")
def _corner(image, mask, o):
    """A triangle in an upper corner set to one value: its rows shorten evenly from the top."""
    h, w = image.shape
    wide = min(w, max(1, round(w * float(o.get("width_fraction", 0.33)))))
    high = min(h, max(1, round(h * float(o.get("height_fraction", 0.45)))))
    y = np.arange(h)[:, None]
    x = np.arange(w)[None, :] if str(o.get("side", "left")).strip().lower() != "right" else np.arange(w)[None, ::-1]
    extent = np.rint(wide * (1 - y / max(high - 1, 1)))
    return np.where((y < high) & (x < extent), float(o.get("fill_value", 0)), image)


# ---- equalisation ----------------------------------------------------------------------------------


def rank_mapping(values: np.ndarray, limit: float | None):
    """(levels, places in 0..1) by the cumulated counts, each cut at ``limit`` means and the excess dealt evenly; None if flat."""
    levels, counts = np.unique(values, return_counts=True)
    if levels.size < 2:
        return None
    weight = counts.astype(float)
    if limit is not None:
        most = max(1.0, limit * weight.mean())
        weight = weight.clip(max=most) + (weight - most).clip(min=0).sum() / weight.size
    summed = weight.cumsum()
    return levels, ((summed - summed[0]) / (summed[-1] - summed[0])).clip(0, 1)


@operation("hist_equalize")
def _equalize(image, mask, o):
    base = unit(image)
    mapping = rank_mapping(base if mask is None else base[mask], None)
    out = base if mapping is None else np.interp(base, *mapping)
    return out if mask is None else np.where(mask, out, base)


@operation("clahe")
def _tiles(image, mask, o):
    """Each tile has its own mapping; a pixel mixes its neighbours' mappings by its distance from their centres."""
    base, tiles = unit(image).clip(0, 1), int(o.get("tile_grid_size", 8))
    edges = [np.linspace(0, n, max(1, min(tiles, n)) + 1).astype(int) for n in base.shape]
    shares = []
    for n, e in zip(base.shape, edges):
        centres = (e[:-1] + e[1:] - 1) / 2
        shares.append([np.interp(np.arange(n), centres, one) for one in np.eye(len(centres))])
    out = np.zeros_like(base)
    for ty, wy in enumerate(shares[0]):
        rows = np.flatnonzero(wy)
        for tx, wx in enumerate(shares[1]):
            cols = np.flatnonzero(wx)
            tile = (slice(*edges[0][ty : ty + 2]), slice(*edges[1][tx : tx + 2]))
            inside = base[tile] if mask is None or not mask[tile].any() else base[tile][mask[tile]]
            mapping = rank_mapping(inside, max(float(o.get("clip_limit", 2)), 0.0))
            part = np.ix_(rows, cols)
            near = base[part]
            out[part] += wy[rows][:, None] * wx[cols] * (near if mapping is None else np.interp(near, *mapping))
    return out if mask is None else np.where(mask, out, base)


# ---- neighbourhoods --------------------------------------------------------------------------------


def around(image: np.ndarray, high: int, wide: int, mode: str = "reflect", **fill) -> np.ndarray:
    """Every pixel's neighbourhood as the last two axes; ``reflect`` doesn't repeat the edge."""
    padded = np.pad(image, ((high // 2,) * 2, (wide // 2,) * 2), mode, **fill)
    return sliding_window_view(padded, (high, wide))


def separable(image: np.ndarray, down: np.ndarray, across: np.ndarray) -> np.ndarray:
    return around(around(image, len(down), 1)[..., 0] @ down, 1, len(across))[..., 0, :] @ across


def binomial(k: int) -> np.ndarray:
    row = np.ones(1)
    for _ in range(k - 1):
        row = np.convolve(row, (1.0, 1.0))
    return row


def blur(image: np.ndarray, sigma: float, k: int | None = None) -> np.ndarray:
    """Gaussian; a size that isn't given reaches four sigmas, a sigma that isn't positive follows from the size."""
    k = odd(round(sigma * 8 + 1)) if k is None else k
    sigma = sigma if sigma > 0 else 0.3 * ((k - 1) * 0.5 - 1) + 0.8
    row = np.exp(-((np.arange(k) - k // 2) ** 2) / (2 * sigma * sigma))
    row /= row.sum()
    return separable(image, row, row)


@operation("gaussian_blur")
def _blur(image, mask, o):
    return blur(image, float(o.get("sigma", 1)), odd(o.get("ksize", 5)))


@operation("median_blur")
def _median(image, mask, o):
    k = odd(o.get("ksize", 3))
    return np.median(around(image, k, k, "edge"), axis=(2, 3))


@operation("bilateral_filter")
def _bilateral(image, mask, o):
    """Mean of the disc around a pixel, weighted by distance and by difference in value."""
    radius = max(1, int(o.get("diameter", 5)) // 2)
    colour, space = (2 * float(o.get(n, d)) ** 2 for n, d in (("sigma_color", 0.05), ("sigma_space", 5)))
    near = around(image, 2 * radius + 1, 2 * radius + 1)
    total, weights = np.zeros_like(image), np.zeros_like(image)
    for dy in range(-radius, radius + 1):
        for dx in range(-radius, radius + 1):
            if dy * dy + dx * dx <= radius * radius:
                value = near[..., dy + radius, dx + radius]
                weight = np.exp(-((value - image) ** 2) / colour - (dy * dy + dx * dx) / space)
                total, weights = total + weight * value, weights + weight
    return total / weights


@operation("wiener_filter")
def _wiener(image, mask, o):
    """Adaptive mean: the local one where the local variance is under the noise (its mean, if none is given)."""
    k = odd(o.get("ksize", 7))
    mean, square = (around(x, k, k, "constant").mean(axis=(2, 3)) for x in (image, image * image))
    variance = square - mean * mean
    noise = variance.mean() if o.get("noise") in (None, "") else float(o["noise"])
    gain = 1 - noise / np.where(variance > 0, variance, 1)
    return np.where(variance <= noise, mean, mean + (image - mean) * gain)


@operation("local_detail")
def _detail(image, mask, o):
    return to_window(image - blur(image, float(o.get("sigma", 1))), o.get("percentiles", (1, 99)), mask)


@operation("unsharp_mask")
def _unsharp(image, mask, o):
    return image + float(o.get("amount", 1.5)) * (image - blur(image, float(o.get("sigma", 2))))


@operation("sharpen")
def _sharpen(image, mask, o):
    amount = float(o.get("amount", 1))
    near = around(image, 3, 3)
    cross = near[..., 0, 1] + near[..., 1, 0] + near[..., 1, 2] + near[..., 2, 1]
    return ((4 + amount) * image - cross) / max(amount, 1e-6)


def derivative(image: np.ndarray, k: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed derivatives across and down, of a size of three at least."""
    k = max(k, 3)
    step = np.convolve(binomial(k - 2), (-1.0, 0.0, 1.0) if times == 1 else (1.0, -2.0, 1.0))
    return separable(image, binomial(k), step), separable(image, step, binomial(k))


@operation("sobel_gradient")
def _sobel(image, mask, o):
    return to_window(np.hypot(*derivative(image, odd(o.get("ksize", 3)), 1)), o.get("percentiles", (1, 99)), mask)


@operation("laplacian")
def _laplacian(image, mask, o):
    k = odd(o.get("ksize", 3))
    if k == 1:
        near = around(image, 3, 3)
        second = near[..., 0, 1] + near[..., 1, 0] + near[..., 1, 2] + near[..., 2, 1] - 4 * image
    else:
        second = sum(derivative(image, k, 2))
    return to_window(abs(second), o.get("percentiles", (1, 99)), mask)


def footprint(o) -> np.ndarray:
    """A disc, or a square, as booleans; the disc's row at distance d reaches round(sqrt(r*r - d*d))."""
    k = odd(o.get("kernel_size", o.get("ksize", 9)))
    if str(o.get("kernel_shape", "ellipse")).strip().lower() != "ellipse":
        return np.ones((k, k), bool)
    d = np.arange(k) - k // 2
    return abs(d)[None, :] <= np.rint(np.sqrt((k // 2) ** 2 - d * d))[:, None]


def extreme(image: np.ndarray, shape: np.ndarray, highest: bool) -> np.ndarray:
    """The largest or smallest value under the footprint; outside the image there is none."""
    empty = -np.inf if highest else np.inf
    near = around(image, *shape.shape, "constant", constant_values=empty)
    out = np.full_like(image, empty)
    for y, x in np.argwhere(shape):
        out = (np.maximum if highest else np.minimum)(out, near[..., y, x])
    return out


def opened(image, o):
    return extreme(extreme(image, footprint(o), False), footprint(o), True)


def closed(image, o):
    return extreme(extreme(image, footprint(o), True), footprint(o), False)


@operation("morphological_open")
def _open(image, mask, o):
    return opened(image, o)


@operation("morphological_close")
def _close(image, mask, o):
    return closed(image, o)


@operation("white_tophat", "tophat")
def _white(image, mask, o):
    return to_window(image - opened(image, o), o.get("percentiles", (1, 99)), mask)


@operation("blackhat")
def _black(image, mask, o):
    return to_window(closed(image, o) - image, o.get("percentiles", (1, 99)), mask)


# ---- masks -----------------------------------------------------------------------------------------


def components(mask: np.ndarray) -> np.ndarray:
    """Labels from 1 of the regions that touch by sides or corners, 0 elsewhere; runs of rows are joined, not pixels."""
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    (row, start), end = np.nonzero(edge == 1), np.nonzero(edge == -1)[1]
    parent = np.arange(len(row))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    first = np.searchsorted(row, np.arange(mask.shape[0] + 1))
    for y in range(1, mask.shape[0]):
        above, here = first[y - 1], first[y]
        while above < first[y] and here < first[y + 1]:
            if start[above] <= end[here] and start[here] <= end[above]:
                a, b = root(above), root(here)
                parent[max(a, b)] = min(a, b)
            if end[above] < end[here]:
                above += 1
            else:
                here += 1
    label = np.unique([root(k) for k in range(len(row))], return_inverse=True)[1] + 1
    out = np.zeros(mask.shape, np.int64)
    for y, a, b, k in zip(row, start, end, label):
        out[y, a:b] = k
    return out


def foreground(image: np.ndarray) -> np.ndarray:
    """Pixels above the background's median by a margin for its noise, without specks under a thousandth of the image."""
    finite = np.isfinite(image)
    if not finite.any():
        return finite
    rim = max(8, round(min(image.shape) * 0.03))
    border = np.concatenate([part.ravel() for part in (image[:rim], image[-rim:], image[:, :rim], image[:, -rim:])])
    border = border[np.isfinite(border)]
    back = border if border.size >= 64 else image[finite]
    middle = np.median(back)
    low, high = np.percentile(image[finite], (1, 99.5))
    span = max(high - low, 1e-6)
    floor = max(middle + max(6 * 1.4826 * np.median(abs(back - middle)), 0.025 * span, 1e-6), low + 0.015 * span)
    mask = without_specks(finite & (image > floor))
    return mask if mask.any() else without_specks(finite & (image > image[finite].min()))


def without_specks(mask: np.ndarray, least_share: float = 0.001) -> np.ndarray:
    """The largest region and all that hold the least share of the image."""
    label = components(mask)
    area = np.bincount(label.ravel())[1:]
    keep = area >= max(1, round(mask.size * least_share))
    if area.size:
        keep[area.argmax()] = True
    return np.concatenate([[False], keep])[label]


def mask_quality(mask: np.ndarray) -> dict:
    """Size, bounds (half open), regions, touched sides and what is odd about a mask; an empty one has no bounds."""
    pixels, areas = int(mask.sum()), np.bincount(components(mask).ravel())[1:]
    share = pixels / mask.size if mask.size else 0.0
    ys, xs = (np.flatnonzero(mask.any(axis=a)) for a in (1, 0))
    odd_signs = {
        "empty_mask": not pixels,
        "mask_covers_less_than_5_percent": pixels and share < 0.05,
        "mask_covers_more_than_95_percent": share > 0.95,
        "mask_has_multiple_components": areas.size > 1,
    }
    return {
        "mask_pixels": pixels,
        "mask_fraction": share,
        "bbox": [int(v) for v in (xs[0], ys[0], xs[-1] + 1, ys[-1] + 1)] if pixels else None,
        "component_count": int(areas.size),
        "largest_component_pixels": int(areas.max(initial=0)),
        **{f"touches_{n}": bool(mask.size and side.any()) for n, side in zip(("top", "bottom", "left", "right"), (mask[:1], mask[-1:], mask[:, :1], mask[:, -1:]))},
        "quality_flags": [name for name, found in odd_signs.items() if found],
    }


MASK_QUALITY = "mask_pixels long, mask_fraction double, bbox array<long>, component_count long, largest_component_pixels long, touches_top boolean, touches_bottom boolean, touches_left boolean, touches_right boolean, quality_flags array<string>"


# ---- columns ---------------------------------------------------------------------------------------


def run_steps(image: np.ndarray, steps: list, mask: np.ndarray | None = None) -> np.ndarray:
    """The steps (name, options) in turn; an unknown name leaves the image."""
    for name, options in steps:
        image = np.nan_to_num(image, nan=0.0, posinf=0.0, neginf=0.0)
        if image.size and name in OPERATIONS:
            image = OPERATIONS[name](image, mask, options)
    return image


def image_steps(pixels: Column, width: Column, steps: list[tuple[str, dict]]) -> Column:
    """Rows of pixels of a width after the steps, as array<double>; null, or a size that the width doesn't divide, gives null."""
    chain = json.loads(json.dumps(steps))

    @F.pandas_udf("array<double>")
    def over(values: pd.Series, widths: pd.Series) -> pd.Series:
        def one(v, w):
            if v is None or pd.isna(w) or w < 1 or len(v) % int(w):
                return None
            return run_steps(np.asarray(v, dtype=float).reshape(-1, int(w)), chain).ravel()

        return pd.Series([one(v, w) for v, w in zip(values, widths)], dtype=object)

    return over(pixels, width)


def mask_metrics(mask: Column, width: Column) -> Column:
    """struct of ``mask_quality`` for arrays of booleans."""

    @F.pandas_udf(MASK_QUALITY)
    def over(values: pd.Series, widths: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([mask_quality(np.asarray(v, dtype=bool).reshape(-1, int(w))) for v, w in zip(values, widths)])

    return over(mask, width)
