"""Exact descriptive statistics, counts, coverage and fit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions.scalar import finite


def value_counts(df: DataFrame, column: str, missing: str | None = "Unknown") -> DataFrame:
    key = F.col(column).cast("string")
    return df.groupBy((F.coalesce(key, F.lit(missing)) if missing is not None else key).alias("value")).agg(F.count("*").alias("n"))


def quantiles(df: DataFrame, keys: list[str], value: Column, wanted: dict[str, float], buckets: int = 4096) -> DataFrame:
    """(keys, a column a quantile): exact, linear between neighbours; nulls are left out.

    Values are counted by equal ranges between a key's ends; only the ranges that hold a wanted place are
    then counted value by value, so no task meets all values of a key unless they lie in one range.
    """
    rows = df.select(F.struct(*keys, F.lit(0).alias("_")).alias("_k"), value.cast("double").alias("_v")).where("_v is not null")
    ends = rows.groupBy("_k").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n"))
    share = F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    rows = rows.join(ends, "_k").select("_k", "_v", F.least(F.lit(buckets - 1), F.floor(F.coalesce(share, F.lit(0.0)) * buckets)).cast("int").alias("_b"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_k", "_b").agg(F.count("*").alias("_c")).withColumn("_ahead", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(q).alias("q"), F.lit(k).alias("next")) for n, q in wanted.items() for k in (0, 1)]))
    at = ends.select("_k", "_n", asked.alias("w")).withColumn("_place", F.least(F.col("_n") - 1, F.floor((F.col("_n") - 1) * F.col("w.q")) + F.col("w.next")))
    at = at.join(counts, "_k").where("_place >= _ahead and _place < _ahead + _c").withColumn("_in", F.col("_place") - F.col("_ahead"))
    near = rows.join(at.select("_k", "_b").distinct(), ["_k", "_b"], "left_semi").groupBy("_k", "_b", "_v").agg(F.count("*").alias("_m"))
    upto = F.sum("_m").over(Window.partitionBy("_k", "_b").orderBy("_v"))
    hit = near.withColumn("_upto", upto).join(at, ["_k", "_b"]).where("_in < _upto and _in >= _upto - _m")
    def part(name: str, k: int) -> Column:
        return F.max(F.when((F.col("w.name") == name) & (F.col("w.next") == k), F.col("_v")))

    def between(name: str, q: float) -> Column:
        exact = (F.max("_n") - 1) * q
        return part(name, 0) + (part(name, 1) - part(name, 0)) * (exact - F.floor(exact))

    return hit.groupBy("_k").agg(*[between(n, q).alias(n) for n, q in wanted.items()]).select(*[F.col(f"_k.{k}").alias(k) for k in keys], *wanted)


def describe(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """count, mean, sample std (0 for one value), min, quartiles, max; exact, NaN as null."""
    x = finite(F.col(column).cast("double"))
    std = F.when(F.count(x) > 0, F.coalesce(F.stddev_samp(x), F.lit(0.0)))
    aggs = [F.count(x).alias("n"), F.avg(x).alias("mean"), std.alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
    q = quantiles(df, keys, x, {"p25": 0.25, "median": 0.5, "p75": 0.75})
    out = df.groupBy(*keys).agg(*aggs).withColumn("_k", F.struct(*keys))
    return out.join(q.withColumn("_k", F.struct(*keys)).drop(*keys), "_k", "left").select(*keys, "n", "mean", "std", "min", "p25", "median", "p75", "max")


def top_and_other(df: DataFrame, column: str, n: int, other: str = "other") -> DataFrame:
    """Counts of the n most frequent values (ties by value) and of the rest together."""
    counts = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("missing")).alias("value")).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), "value"))  # over the distinct values
    return counts.withColumn("value", F.when(place <= n, F.col("value")).otherwise(other)).groupBy("value").agg(F.sum("n").alias("n"))


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, keys: list[str], column: str, lo: float, hi: float, bins: int) -> DataFrame:
    place = F.least(F.lit(bins - 1), F.floor((F.col(column) - lo) / ((hi - lo) / bins))).cast("long")
    return df.where((F.col(column) >= lo) & (F.col(column) <= hi)).groupBy(*keys, place.alias("bin")).agg(F.count("*").alias("n"))


def fit_summary(boxes: DataFrame, scope: str, scopes: list[str], width: float, height: float) -> DataFrame:
    """A row for all boxes and one for each listed scope, empty ones kept: fits, reasons, medians."""
    w, h = F.col("box_w"), F.col("box_h")
    fits = (w <= width) & (h <= height)
    side = F.greatest(w, h)
    got = boxes.rollup(scope).agg(
        F.count("*").alias("boxes"),
        F.count_if(fits).alias("fit"),
        F.count_if((w > width) & (h > height)).alias("too_both"),
        F.count_if((w > width) & (h <= height)).alias("too_wide"),
        F.count_if((w <= width) & (h > height)).alias("too_tall"),
    )
    got = got.withColumn("scope", F.coalesce(F.col(scope), F.lit("all"))).drop(scope)
    both = boxes.select(F.explode(F.array(F.lit("all"), F.col(scope))).alias("scope"), side.alias("side"))
    got = got.join(quantiles(both, ["scope"], F.col("side"), {"median_side": 0.5, "p95_side": 0.95}), "scope", "left")
    listed = boxes.sparkSession.createDataFrame([(s,) for s in ["all", *scopes]], "scope string")
    return listed.join(got, "scope", "left").na.fill(0, ["boxes", "fit", "too_both", "too_wide", "too_tall"])


def moments(df: DataFrame, keys: list[str], array: str) -> DataFrame:
    """Pixel-weighted mean and population std, min and max over arrays, without exploding them."""
    a = F.transform(array, lambda x: x.cast("double"))
    part = df.select(*keys, F.size(array).cast("long").alias("_n"), F.aggregate(a, F.lit(0.0), lambda s, x: s + x).alias("_s"), F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x).alias("_q"), F.array_min(a).alias("_lo"), F.array_max(a).alias("_hi"))
    sums = part.groupBy(*keys).agg(F.sum("_n").alias("n"), F.sum("_s").alias("s"), F.sum("_q").alias("q"), F.min("_lo").alias("min"), F.max("_hi").alias("max"))
    mean = F.col("s") / F.col("n")
    return sums.select(*keys, "n", mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean)).alias("std"), "min", "max")


def percent_of(total_keys: list[str], count: Column) -> Column:
    return count * 100.0 / F.sum(count).over(Window.partitionBy(*total_keys))
