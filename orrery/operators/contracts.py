"""Validation as queries: every broken rule is a row, an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(metrics: DataFrame, scope: str, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(rule, scope, expected, actual) of the rules whose two sides differ; nulls are values."""
    parts = [F.struct(F.lit(n).alias("rule"), e.cast("long").alias("expected"), a.cast("long").alias("actual")) for n, (e, a) in rules.items()]
    out = metrics.select(F.col(scope).alias("scope"), F.explode(F.array(*parts)).alias("p")).select("p.rule", "scope", "p.expected", "p.actual")
    return out.where(~F.equal_null("expected", "actual"))


def require_empty(found: DataFrame, what: str, shown: int = 12) -> None:
    """Raises with the first violations; for strict modes."""
    if rows := found.take(shown):
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def split_overlaps(df: DataFrame, split: str, key: str) -> DataFrame:
    """Keys that two splits share, counted a pair of splits."""
    sets = df.select(split, key).distinct()
    a, b = sets.select(F.col(split).alias("split_a"), key), sets.select(F.col(split).alias("split_b"), key)
    both = a.join(b, key).where("split_a < split_b")  # a key has as many rows as there are splits
    return both.groupBy("split_a", "split_b").agg(F.count_distinct(key).alias("studies"))


def missing_rows(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).join(actual.select(*keys), keys, "left_anti")


def out_of_bounds(df: DataFrame, b: list[Column], width: Column, height: Column) -> DataFrame:
    """Boxes that pass their image, by how much."""
    zero = F.lit(0.0)
    excess = F.greatest(zero, -b[0], -b[1], b[2] - width, b[3] - height)
    return df.withColumn("excess", excess).where(F.col("excess") > 0)


def first_reason(rules: dict[str, Column], otherwise: str | None = None) -> Column:
    """Name of the first rule that holds, in the given order."""
    out = F.lit(otherwise)
    for name, rule in reversed(list(rules.items())):
        out = F.when(rule, F.lit(name)).otherwise(out)
    return out
