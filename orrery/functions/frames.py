"""Images to other sizes, masks by several methods, and colour channels from chains of operations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.functions import pixels as P


def overlaps(size: int, to: int) -> np.ndarray:
    """(to, size): the share of each old place in each new one, by how far their intervals overlap."""
    edges, ends = np.arange(size + 1), np.arange(to + 1) * (size / to)
    covered = np.minimum(ends[1:, None], edges[None, 1:]) - np.maximum(ends[:-1, None], edges[None, :-1])
    return covered.clip(min=0) * (to / size)


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Every new pixel is the mean of the area that it covers."""
    return overlaps(image.shape[0], height) @ image @ overlaps(image.shape[1], width).T


def on_canvas(image: np.ndarray, height: int, width: int, pad: float = 0.0, centred: bool = False) -> np.ndarray:
    """The image on a canvas, in its upper left corner or its middle (the odd pixel right and below); a larger image is an error."""
    spare = height - image.shape[0], width - image.shape[1]
    if min(spare) < 0:
        raise ValueError(f"an image of {image.shape} doesn't fit a canvas of {(height, width)}")
    first = [s // 2 if centred else 0 for s in spare]
    return np.pad(image, [(f, s - f) for f, s in zip(first, spare)], constant_values=pad)


def fit_on_canvas(image: np.ndarray, height: int, width: int, pad: float = 0.0, centred: bool = False) -> np.ndarray:
    """Resized by area to the largest size of the same shape that fits, the rest padded."""
    scale = min(height / image.shape[0], width / image.shape[1])
    size = [max(1, min(most, round(n * scale))) for most, n in zip((height, width), image.shape)]
    return on_canvas(area_resize(image, *size), height, width, pad, centred)


# ---- masks -----------------------------------------------------------------------------------------


def otsu_level(levels: np.ndarray) -> int:
    """The first of 256 levels that splits the values into the two classes furthest apart."""
    count = np.bincount(levels.ravel(), minlength=256).astype(float)
    below, mass = count.cumsum(), (count * np.arange(256)).cumsum()
    above = below[-1] - below
    both = (below > 0) & (above > 0)
    apart = np.zeros(256)
    apart[both] = below[both] * above[both] * (mass[both] / below[both] - (mass[-1] - mass[both]) / above[both]) ** 2
    return int(apart.argmax())


def mask_by(image: np.ndarray, method: str) -> np.ndarray:
    """The largest region above a threshold: ``robust`` (background noise), ``otsu`` or ``percentile`` (a share of the range)."""
    finite = np.isfinite(image)
    if not finite.any():
        return finite
    low, high = np.percentile(image[finite], (1, 99.5))
    if method == "robust":
        mask = P.foreground(image)
    elif method == "otsu":
        if high <= low:
            low, high = image[finite].min(), image[finite].max()
        share = np.where(finite, image - low, 0) / (high - low if high > low else 1)
        levels = np.rint(share.clip(0, 1) * 255).astype(int)
        mask = finite & (levels > otsu_level(levels))
    elif method == "percentile":
        mask = finite & (image > max(low + 0.02 * (high - low), low + 1e-6))
    else:
        raise ValueError(f"no method {method!r} for masks")
    label = P.components(mask)
    area = np.bincount(label.ravel())[1:]
    return label == area.argmax() + 1 if area.size else mask


# ---- columns ---------------------------------------------------------------------------------------


def resized(pixels: Column, width: Column, to_height: int, to_width: int, mode: str = "stretch", pad: float = 0.0) -> Column:
    """Arrays of another size as array<double>: ``stretch``, ``fit_pad`` (upper left), ``letterbox`` (middle) or ``pad`` alone."""
    how = {
        "stretch": lambda image: area_resize(image, to_height, to_width),
        "fit_pad": lambda image: fit_on_canvas(image, to_height, to_width, pad),
        "letterbox": lambda image: fit_on_canvas(image, to_height, to_width, pad, True),
        "pad": lambda image: on_canvas(image, to_height, to_width, pad),
    }[mode]

    @F.pandas_udf("array<double>")
    def over(values: pd.Series, widths: pd.Series) -> pd.Series:
        def one(v, w):
            if v is None or pd.isna(w) or w < 1 or not len(v) or len(v) % int(w):
                return None
            return how(np.asarray(v, dtype=float).reshape(-1, int(w))).ravel()

        return pd.Series([one(v, w) for v, w in zip(values, widths)], dtype=object)

    return over(pixels, width)


def channels(sources: dict[str, Column], width: Column, plan: dict[str, tuple[str, list]], default: str) -> Column:
    """struct with an array a channel: (source, steps) by channel; a missing source is replaced by the default one, ``fallback`` tells which."""
    parts, fell = [], []
    for name, (source, steps) in plan.items():
        value = F.coalesce(sources[source], sources[default]) if source in sources else sources[default]
        parts.append((P.image_steps(value, width, steps) if steps else value.cast("array<double>")).alias(name))
        fell.append(F.when(sources[source].isNull() if source in sources else F.lit(True), F.lit(name)))
    return F.struct(*parts, F.array_compact(F.array(*fell)).alias("fallback"))
