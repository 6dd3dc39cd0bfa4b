"""Boxes, windows and grids as Column expressions. Boxes are (x0, y0, x1, y1) without a +1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.scalar import half_up, round_up


def origins(length: Column, size: int, stride: int, policy: str = "edge_align") -> Column:
    """Window origins along an axis. edge_align adds one flush with the end; regular_stride_pad one more stride."""
    if size <= 0 or stride <= 0:
        raise ValueError("size and stride must be positive")
    policy = {"pad": "regular_stride_pad"}.get(policy, policy)
    base = F.sequence(F.lit(0).cast("long"), F.greatest(length - size, F.lit(0)).cast("long"), F.lit(stride).cast("long"))
    last = F.element_at(base, -1)
    if policy == "edge_align":
        tail = F.when((length > size) & (last != length - size), F.array((length - size).cast("long")))
    elif policy == "regular_stride_pad":
        tail = F.when((length > size) & (last + size < length) & (last + stride < length), F.array(last + stride))
    else:
        raise ValueError(f"unknown edge policy {policy}")
    return F.concat(base, F.coalesce(tail, F.array().cast("array<bigint>")))


def grid(df: DataFrame, width: str, height: str, size: int, stride: int, policy: str = "edge_align") -> DataFrame:
    """A row a window: x0, y0, x1, y1; narrow, no shuffle."""
    out = df.withColumn("y0", F.explode(origins(F.col(height), size, stride, policy)))
    out = out.withColumn("x0", F.explode(origins(F.col(width), size, stride, policy)))
    return out.withColumn("x1", F.col("x0") + size).withColumn("y1", F.col("y0") + size)


def overlap(b: list[Column], w: list[Column]) -> list[Column]:
    """Intersection corners of two boxes; inverted where they don't meet."""
    return [F.greatest(b[0], w[0]), F.greatest(b[1], w[1]), F.least(b[2], w[2]), F.least(b[3], w[3])]


def area(b: list[Column]) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0)) * F.greatest(b[3] - b[1], F.lit(0))


def visible_fraction(b: list[Column], w: list[Column]) -> Column:
    """Share of box b inside window w; a box without area counts as 0."""
    return area(overlap(b, w)).cast("double") / F.greatest(area(b).cast("double"), F.lit(1e-12))


def inside(b: list[Column], w: list[Column], margin: float = 0.0) -> Column:
    return (b[0] >= w[0] + margin) & (b[1] >= w[1] + margin) & (b[2] <= w[2] - margin) & (b[3] <= w[3] - margin)


def window_padding(w: list[Column], width: Column, height: Column) -> list[Column]:
    """left, top, right, bottom padding of a window that may pass the image."""
    zero = F.lit(0).cast("long")
    return [F.greatest(zero, -w[0]), F.greatest(zero, -w[1]), F.greatest(zero, w[2] - width), F.greatest(zero, w[3] - height)]


def source_extent(w: list[Column], width: Column, height: Column, size: int) -> Column:
    """Share of the window's whole area that the image covers."""
    zero = F.lit(0)
    return area(overlap(w, [zero, zero, width, height])).cast("double") / float(size * size)


def mirror(b: list[Column], width: Column) -> list[Column]:
    return [width - b[2], b[1], width - b[0], b[3]]


def restore(b: list[Column], mirrored: Column, width: Column, dx: Column, dy: Column) -> list[Column]:
    """Back to the original image: first the mirror, then the one offset that applies."""
    m = mirror(b, width)
    return [F.when(mirrored, m[0]).otherwise(b[0]) + dx, b[1] + dy, F.when(mirrored, m[2]).otherwise(b[2]) + dx, b[3] + dy]


def pad_scale_clamp(b: list[Column], pad: tuple[Column, Column], scale: tuple[Column, Column], size: tuple[Column, Column]) -> list[Column]:
    """Into a padded and scaled variant, clamped to it."""
    zero = F.lit(0.0)
    return [F.least(F.greatest((c + pad[k % 2]) * scale[k % 2], zero), size[k % 2]) for k, c in enumerate(b)]


def canvas(max_height: Column, max_width: Column, divisor: int = 32) -> tuple[Column, Column]:
    return round_up(max_height, divisor), round_up(max_width, divisor)


def variant_width(height: Column, canvas_height: Column, canvas_width: Column) -> Column:
    """Content width of a variant of some height: aspect of the canvas, half rounded up."""
    return half_up(height * canvas_width / canvas_height)


def letterbox(height: Column, width: Column, target: int) -> dict[str, Column]:
    """Scale, content size and paddings of an image fitted into a square."""
    scale = F.least(F.lit(float(target)) / height, F.lit(float(target)) / width)
    h, w = F.greatest(half_up(height * scale), F.lit(1).cast("long")), F.greatest(half_up(width * scale), F.lit(1).cast("long"))
    left, top = F.floor((F.lit(target) - w) / 2).cast("long"), F.floor((F.lit(target) - h) / 2).cast("long")
    return {"scale": scale, "content_h": h, "content_w": w, "pad_left": left, "pad_top": top, "pad_right": target - w - left, "pad_bottom": target - h - top}


def safe_origins(lo: Column, hi: Column, size: int, margin: int, most: Column) -> tuple[Column, Column]:
    """Interval of window origins that keep [lo, hi] inside by a margin; nulls where there is none."""
    a, b = F.greatest(F.lit(0.0), F.ceil(hi + margin - size)), F.least(most, F.floor(lo - margin))
    return F.when(a <= b, a.cast("long")), F.when(a <= b, b.cast("long"))


def scale_boxes(b: list[Column], shape: tuple[Column, Column], to: tuple[Column, Column]) -> list[Column]:
    """Boxes from one (width, height) to another; unknown shapes leave them as they are."""
    return [F.coalesce(c * (to[k % 2] / shape[k % 2].cast("double")), c) for k, c in enumerate(b)]


def resize_mapping(mode: Column, width: Column, height: Column, to_width: int, to_height: int) -> tuple[Column, Column, Column, Column]:
    """(scale x, scale y, pad x, pad y) of resizing by mode: none, stretch or fit_pad (centred, sizes half to even)."""
    kx, ky = F.lit(float(to_width)) / width, F.lit(float(to_height)) / height
    fit = F.least(kx, ky)
    sx, sy = (F.when(mode == "none", 1.0).when(mode == "stretch", k).otherwise(fit) for k in (kx, ky))
    pads = (F.floor((F.lit(n) - F.greatest(F.lit(1.0), F.bround(size * fit))) / 2) for n, size in ((to_width, width), (to_height, height)))
    px, py = (F.when(mode == "fit_pad", p).otherwise(0) for p in pads)
    return sx, sy, px, py


def coarse_positions(lo: Column, hi: Column, step: int) -> Column:
    """Origins from lo to hi by step, hi included; lo alone where the interval is empty."""
    return F.array_distinct(F.concat(F.sequence(lo, F.greatest(lo, hi), F.lit(max(1, step)).cast("long")), F.array(F.greatest(lo, hi))))


def peak_score(peak: Column, x0: Column, x1: Column, size: int) -> Column:
    """1 for a peak inside the window, falling with the distance from its centre."""
    away = F.abs(peak - (x0 + x1) / 2.0) / float(max(1, size))
    return F.when(peak.between(x0, x1), 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - away))


def padded_bounds(bounds: list[Column], width: Column, height: Column, share: float, least: int = 0, most: int | None = None) -> list[Column]:
    """Bounds (half open) widened on every side by a share of their longer side, within the image; a null bound gives the whole image."""
    x0, y0, x1, y1 = bounds
    pad = F.greatest(F.bround(F.greatest(x1 - x0, y1 - y0) * share).cast("long"), F.lit(least).cast("long"))
    pad = pad if most is None else F.least(pad, F.lit(most).cast("long"))
    zero = F.lit(0)
    grown = [F.greatest(zero, x0 - pad), F.greatest(zero, y0 - pad), F.least(width, x1 + pad), F.least(height, y1 + pad)]
    known = x0.isNotNull() & (grown[2] > grown[0]) & (grown[3] > grown[1])
    return [F.when(known, c).otherwise(whole) for c, whole in zip(grown, (zero, zero, width, height))]


def shifted_window(w: list[Column], shift: Column) -> list[Column]:
    """The window in an image before it is moved down by ``shift``: the same content without moving the image."""
    down = F.coalesce(F.bround(shift).cast("long"), F.lit(0))
    return [w[0], w[1] - down, w[2], w[3] - down]
