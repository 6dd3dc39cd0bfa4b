"""Joins with fallbacks, keyed first and last rows, self and range joins, diffs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions import geometry as G
from orrery.functions.scalar import opposite_side


def require_columns(df: DataFrame, names: set[str], what: str = "table") -> DataFrame:
    if missing := sorted(names - set(df.columns)):
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def resolve_column(df: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate among the columns, by names without case and signs; decided from the schema."""
    plain = {"".join(ch for ch in c.lower() if ch.isalnum()): c for c in reversed(df.columns)}
    return next((plain[k] for k in ("".join(ch for ch in c.lower() if ch.isalnum()) for c in candidates) if k in plain), None)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; Spark keeps only the best row of a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.desc(c) for c in order])


def numbered(df: DataFrame, name: str, keys: list[str], order: list[Column | str], start: int = 0) -> DataFrame:
    """Dense running numbers within a key."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) + (start - 1)).cast("long"))


def numbered_by_range(df: DataFrame, name: str, keys: list[str], column: str, ties: list[str] | None = None, start: int = 0, ranges: int = 4096) -> DataFrame:
    """Dense running numbers within keys by an integer column; rows are numbered within ranges of it and the ranges' counts give the rest."""
    bounds = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    d = df.crossJoin(F.broadcast(bounds))  # one row
    place = F.floor((F.col(column) - F.col("_lo")) / F.greatest(F.lit(1.0), (F.col("_hi") - F.col("_lo") + 1) / float(ranges)))
    d = d.withColumn("_k", F.struct(*keys, F.coalesce(place, F.lit(-1).cast("long")).alias("_range"))).drop("_lo", "_hi")
    before = Window.partitionBy(*[F.col(f"_k.{k}") for k in keys]).orderBy("_k._range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = d.groupBy("_k").agg(F.count("*").alias("_n")).select("_k", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    out = d.withColumn(name, F.row_number().over(Window.partitionBy("_k").orderBy(column, *(ties or []))) + (start - 1))
    return out.join(ahead, "_k").withColumn(name, (F.col(name) + F.col("_ahead")).cast("long")).drop("_k", "_ahead")


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join by a key that neither side may repeat, adding only the columns that left lacks; a repeated key raises."""
    for what, side in (("left", left), ("right", right)):
        if bad := side.groupBy(*keys).count().where("count > 1").take(5):
            raise ValueError(f"{what} repeats keys: {bad}")
    return left.join(right.select(*keys, *[c for c in right.columns if c not in left.columns]), keys, "left")


def evenly_spaced(df: DataFrame, order: str, most: int) -> DataFrame:
    """Rows at distinct half-even rounded, evenly spaced places of an integer order (both ends among them)."""
    d = numbered_by_range(df, "_place", [], order)
    n = df.agg(F.count("*").alias("_n"))
    k = F.least(F.lit(most), F.col("_n"))
    step = F.when(k > 1, (F.col("_n") - 1) / (k - 1)).otherwise(F.lit(0.0))
    want = n.where(k > 0).select(F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0).cast("long"), k.cast("long") - 1), lambda i: F.bround(i * step).cast("long")))).alias("_place"))
    return d.join(F.broadcast(want), "_place", "left_semi").drop("_place")  # at most `most` places


def with_fallback(left: DataFrame, first: DataFrame, second: DataFrame, first_keys: list[str], second_keys: list[str], values: list[str]) -> DataFrame:
    """Values from ``first`` where its key is present, even with nulls, else from ``second``."""
    a = first.select(*first_keys, *[F.col(v).alias(f"_a_{v}") for v in values], F.lit(True).alias("_hit"))
    b = second.select(*second_keys, *[F.col(v).alias(f"_b_{v}") for v in values])
    out = left.join(a, first_keys, "left").join(b, second_keys, "left")
    picked = [F.when(F.col("_hit"), F.col(f"_a_{v}")).otherwise(F.col(f"_b_{v}")).alias(v) for v in values]
    return out.select(*[left_c for left_c in left.columns], *picked)


def contralateral(df: DataFrame, study: str, view: str, side: str, row_id: str) -> DataFrame:
    """Each row with the id of the last row of the other side, same study and view."""
    other = last_per_key(df, [study, view, side], [row_id]).select(study, view, F.col(side).alias("_side"), F.col(row_id).alias("other_id"))
    flipped = df.withColumn("_side", opposite_side(F.col(side)))
    return flipped.join(other, [study, view, "_side"], "left").drop("_side")


def _seen(pairs: DataFrame, least: float) -> DataFrame:
    w, b = [F.col(c) for c in ("x0", "y0", "x1", "y1")], [F.col(c) for c in ("bx0", "by0", "bx1", "by1")]
    if least > 0:
        pairs = pairs.where((b[0] < w[2]) & (b[2] > w[0]) & (b[1] < w[3]) & (b[3] > w[1]))
    return pairs.withColumn("visible", G.visible_fraction(b, w)).where(F.col("visible") >= least)


def window_boxes(windows: DataFrame, boxes: DataFrame, key: str, least: float = 0.0) -> DataFrame:
    """Windows by the boxes of the same image, with the visible fraction.

    An equi-join on the image; with a positive bound only boxes that meet the window remain. Both sides shuffle:
    Spark takes exploded windows for as few as their images, and would broadcast them.
    """
    return _seen(windows.hint("merge").join(boxes, key), least)


def grid_boxes(images: DataFrame, boxes: DataFrame, key: str, width: str, height: str, size: int, stride: int, policy: str = "edge_align", least: float = 0.0) -> DataFrame:
    """window_boxes of the images' grids; the images join, and each pair makes its windows in place, so no grid is shuffled."""
    return _seen(G.grid(images.hint("merge").join(boxes, key), width, height, size, stride, policy), least)


def hits_by_image(images: DataFrame, boxes: DataFrame, key: str, width: str, height: str, size: int, stride: int, policy: str, least: float) -> DataFrame:
    """(key, hits): the windows of the image's grid that hold boxes, with their number; a row an image, so hits need no shuffle of windows.

    An image's map has an entry a window at most, however many boxes it has.
    """
    found = grid_boxes(images.select(key, width, height), boxes.select(key, "bx0", "by0", "bx1", "by1"), key, width, height, size, stride, policy, least)
    found = found.groupBy(key, "x0", "y0").agg(F.count("*").alias("n"))
    return found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.struct("x0", "y0"), "n"))).alias("hits"))


def hits_of(hits: str, x0: Column, y0: Column) -> Column:
    """Boxes in a window, from the map of its image."""
    return F.coalesce(F.try_element_at(F.col(hits), F.struct(x0.alias("x0"), y0.alias("y0"))), F.lit(0).cast("long"))


def best_match(left: DataFrame, right: DataFrame, keys: list[str], rank: list[Column], keep: list[str]) -> DataFrame:
    """Left rows with the best ranked right row of their key; rank breaks all ties."""
    best = first_per_key(right, keys, rank).select(*keys, *keep)
    return left.join(best, keys, "left")


def unique_key_join(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Left join to the right rows whose key occurs once."""
    once = right.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(v).alias(v) for v in values]).where("_n = 1").drop("_n")
    return left.join(once, keys, "left")


def presence(a: DataFrame, b: DataFrame, keys: list[str], names: tuple[str, str]) -> DataFrame:
    """Full outer join of two key sets with a flag for each side."""
    x = a.select(*keys).distinct().withColumn(names[0], F.lit(True))
    y = b.select(*keys).distinct().withColumn(names[1], F.lit(True))
    return x.join(y, keys, "full_outer").na.fill(False, list(names))


def changed_fields(df: DataFrame, key: str, order: list[str], fields: dict[str, Column]) -> DataFrame:
    """(key, at, field, old, new) wherever a field differs from the key's previous row; nulls are values."""
    w = Window.partitionBy(key).orderBy(*order)
    parts = [F.struct(F.lit(n).alias("field"), F.lag(c.cast("string")).over(w).alias("old"), c.cast("string").alias("new")) for n, c in fields.items()]
    seen = df.withColumn("_first", F.lag(F.lit(1)).over(w).isNull()).withColumn("_parts", F.array(*parts)).where(~F.col("_first"))
    out = seen.select(key, *order, F.explode("_parts").alias("p")).select(key, *order, "p.field", "p.old", "p.new")
    return out.where(~F.equal_null("old", "new"))


def nested_targets(images: DataFrame, findings: DataFrame, key: str, fields: list[str], is_mass: Column) -> DataFrame:
    """Images with ``findings``, an ordered array of structs, and ``masses``, those of them that are masses; empty arrays where there is none."""
    rows = findings.select(key, F.struct(*fields, F.coalesce(is_mass, F.lit(False)).alias("is_mass")).alias("f")).groupBy(key).agg(F.array_sort(F.collect_list("f")).alias("findings"))
    out = images.join(rows, key, "left").withColumn("findings", F.coalesce("findings", F.array().cast(rows.schema["findings"].dataType)))
    return out.withColumn("masses", F.filter("findings", lambda f: f["is_mass"]))


def first_text(*columns: Column) -> Column:
    """First of some columns that isn't blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in columns])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
