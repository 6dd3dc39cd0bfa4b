"""Kernels over array<double>: normalisation, distances, profiles; higher-order functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once a row."""
    return F.transform(F.array(value), body)[0]


def min_max(a: Column) -> Column:
    """To 0..1; a flat array to zeros."""
    return let(F.struct(F.array_min(a).alias("lo"), F.array_max(a).alias("hi")), lambda s: F.transform(a, lambda x: F.when(s["hi"] > s["lo"], (x - s["lo"]) / (s["hi"] - s["lo"])).otherwise(0.0)))


def mean_std(a: Column) -> Column:
    """struct(mean, std) with the population standard deviation."""
    n = F.size(a)
    return let(total(a) / n, lambda m: F.struct(m.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), total(F.transform(a, lambda x: (x - m) * (x - m))) / n)).alias("std")))


def z_clip(a: Column, limit: float = 3.0) -> Column:
    return let(mean_std(a), lambda s: F.transform(a, lambda x: F.when(s["std"] > 0, F.greatest(F.lit(-limit), F.least(F.lit(limit), (x - s["mean"]) / s["std"]))).otherwise(0.0)))


def quantile(sorted_array: Column, q: float) -> Column:
    """Linear interpolation on a sorted array."""
    place = (F.size(sorted_array) - 1) * F.lit(q)
    lo = F.floor(place).cast("int")
    a, b = F.get(sorted_array, lo), F.coalesce(F.get(sorted_array, lo + 1), F.get(sorted_array, lo))
    return a + (b - a) * (place - lo)


def percentile_normalise(a: Column, low: float, high: float) -> Column:
    def scaled(s: Column) -> Column:
        return let(F.struct(quantile(s, low).alias("lo"), quantile(s, high).alias("hi")), lambda r: F.transform(a, lambda x: F.when(r["hi"] > r["lo"], F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - r["lo"]) / (r["hi"] - r["lo"])))).otherwise(0.0)))

    return let(F.array_sort(a), scaled)


def gamma(a: Column, g: float) -> Column:
    return F.transform(min_max(a), lambda x: F.pow(x, F.lit(g)))


def log_scale(a: Column) -> Column:
    return F.transform(min_max(a), lambda x: F.log1p(x) / F.log(F.lit(2.0)))


def invert(a: Column) -> Column:
    return let(F.array_max(a) + F.array_min(a), lambda s: F.transform(a, lambda x: s - x))


#: Normalisers by name; an unknown name leaves the array as it is.
OPERATIONS = {"minmax": min_max, "zscore_clip": z_clip, "invert": invert, "log": log_scale, "gamma": lambda a: gamma(a, 0.5), "percentile": lambda a: percentile_normalise(a, 0.01, 0.99)}


def apply_operation(a: Column, name: str) -> Column:
    return OPERATIONS.get(name, lambda x: x)(a)


def moving_average(df: DataFrame, key: str, place: str, value: str, valid: str, rows: int) -> DataFrame:
    """Centred mean over the valid rows among k before and k after."""
    k = (rows | 1) // 2
    w = Window.partitionBy(key).orderBy(place).rowsBetween(-k, k)
    return df.withColumn("smooth", F.avg(F.when(F.col(valid), F.col(value))).over(w))


def longest_run(df: DataFrame, key: str, place: str, flag: str) -> DataFrame:
    """(key, start, length) of the first longest run of true flags."""
    hit = df.where(F.col(flag)).withColumn("island", F.col(place) - F.row_number().over(Window.partitionBy(key).orderBy(place)))
    runs = hit.groupBy(key, "island").agg(F.min(place).cast("long").alias("start"), F.count("*").alias("length"))
    best = Window.partitionBy(key).orderBy(F.desc("length"), "start")
    return runs.withColumn("r", F.row_number().over(best)).where("r = 1").select(key, "start", "length")


def histogram_shares(a: Column, bins: int) -> Column:
    """Shares of the equal bins between an array's ends, each with 1e-12 more; a flat array lies in the first."""
    places = F.transform(min_max(a), lambda x: F.least(F.lit(bins - 1), F.floor(x * bins)))
    counts = let(places, lambda p: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.size(F.filter(p, lambda x: x == b)) + F.lit(1e-12)))
    return let(counts, lambda n: let(total(n), lambda s: F.transform(n, lambda x: x / s)))


def entropy(a: Column, bins: int = 64) -> Column:
    """Entropy of the histogram as a share of the most that so many bins can have."""
    return -total(F.transform(histogram_shares(a, bins), lambda p: p * F.log2(F.greatest(p, F.lit(1e-12))))) / F.log2(F.lit(float(max(bins, 2))))


def summary(a: Column, quantiles: tuple[float, ...], bins: int = 64) -> Column:
    """struct(percentiles, mean, std, iqr, entropy) of the finite values; an array without one counts as a zero."""
    finite = F.filter(a, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.when(F.size(finite) > 0, finite).otherwise(F.array(F.lit(0.0)))

    def of(s: Column) -> Column:
        m = mean_std(s)
        return F.struct(F.array(*[quantile(s, q) for q in quantiles]).alias("percentiles"), m["mean"].alias("mean"), m["std"].alias("std"), (quantile(s, 0.75) - quantile(s, 0.25)).alias("iqr"), entropy(s, bins).alias("entropy"))

    return let(F.array_sort(whole), of)


def centroid(a: Column) -> Column:
    """Mean place weighted by the positive values; null where they add up to nothing."""
    up = F.transform(a, lambda x: F.greatest(F.lit(0.0), F.nanvl(x, F.lit(0.0))))
    placed = F.transform(up, lambda x, i: x * i)
    return F.when(total(up) > 1e-8, total(placed) / total(up))


def whole_levels(a: Column, inverted: Column | bool = False, most: int = 65535) -> Column:
    """Whole numbers 0..most between an array's ends, half to even; values that aren't finite count as the least, a flat array gives zeros."""

    def finite(x: Column) -> Column:
        return ~F.isnan(x) & (F.abs(x) < float("inf"))

    def scaled(least: Column) -> Column:
        filled = F.transform(a, lambda x: F.when(finite(x), x).otherwise(least))
        turned = F.when(F.lit(inverted) if isinstance(inverted, bool) else inverted, invert(filled)).otherwise(filled)
        return F.transform(min_max(turned), lambda x: F.rint(x * most).cast("int"))

    return let(F.array_min(F.filter(a, finite)), scaled)


def window_of(a: Column, width: Column, x0: Column, y0: Column, size: int, pad: Column) -> Column:
    """The square window of an image in rows of ``width``, row by row; places outside the image hold ``pad``."""
    height = F.floor(F.size(a) / width)
    steps = F.sequence(F.lit(0), F.lit(size - 1))

    def at(x: Column, y: Column) -> Column:
        inside = (x >= 0) & (x < width) & (y >= 0) & (y < height)
        return F.when(inside, F.get(a, (y * width + x).cast("int"))).otherwise(pad)

    return F.flatten(F.transform(steps, lambda j: F.transform(steps, lambda i: at(x0 + i, y0 + j))))


def share_in_window(mask: Column, width: Column, x0: Column, y0: Column, size: int) -> Column:
    """Pixels of a mask in a window as a share of the whole window, also where that leaves the image."""
    return F.size(F.filter(window_of(mask, width, x0, y0, size, F.lit(False)), lambda m: m)) / float(max(1, size * size))
