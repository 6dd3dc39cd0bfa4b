"""What a run has left to do, what changed between runs, and families of window grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions import geometry as G
from orrery.functions.scalar import seeded_order


def pending(work: DataFrame, done: DataFrame, keys: list[str], overwrite: bool = False) -> DataFrame:
    """The work whose output isn't there yet; all of it where outputs may be overwritten. Null keys are never done."""
    return work if overwrite else work.join(done.select(*keys), keys, "left_anti")


def explain_changes(settings: dict[str, tuple[Column, Column]], counts: dict[str, tuple[Column, Column]], same: str) -> Column:
    """A line for each setting (label: before, after) that differs, a line with the signed difference for each count, or ``same``.

    Nulls are values: null to null is no change, and a null count stands for 0.
    """
    lines = []
    for label, (before, after) in settings.items():
        told = F.concat(F.lit(f"{label} changed from "), F.coalesce(before.cast("string"), F.lit("none")), F.lit(" to "), F.coalesce(after.cast("string"), F.lit("none")), F.lit("."))
        lines.append(F.when(~before.eqNullSafe(after), told))
    for label, pair in counts.items():
        old, new = (F.coalesce(c.cast("long"), F.lit(0).cast("long")) for c in pair)
        lines.append(F.when(old != new, F.format_string(f"{label} changed from %d to %d (%+d).", old, new, new - old)))
    text = F.concat_ws("\n", *lines)
    return F.when(text == "", same).otherwise(text)


def grid_family(df: DataFrame, width: str, height: str, settings: list[tuple[int, int]], policy: str = "edge_align") -> DataFrame:
    """A row a window of every (size, stride), from one scan: size, stride, x0, y0, x1, y1 follow the columns of ``df``."""
    if len(set(settings)) != len(settings):
        raise ValueError("a grid is given twice")

    def windows(size: int, stride: int) -> Column:
        across, down = G.origins(F.col(width), size, stride, policy), G.origins(F.col(height), size, stride, policy)
        made = lambda x, y: F.struct(F.lit(size).alias("size"), F.lit(stride).alias("stride"), x.alias("x0"), y.alias("y0"), (x + size).alias("x1"), (y + size).alias("y1"))
        return F.flatten(F.transform(down, lambda y: F.transform(across, lambda x: made(x, y))))

    return df.select("*", F.explode(F.concat(*[windows(*s) for s in settings])).alias("_w")).select(*df.columns, "_w.*")


def pick_of_best(df: DataFrame, keys: list[str], score: Column, most: int, seed: int | str, tie: str) -> DataFrame:
    """One row a key: of the ``most`` highest scores the one whose seeded digest is the smallest. Ties go by ``tie``; null scores are last."""
    best = Window.partitionBy(*keys).orderBy(score.desc_nulls_last(), F.col(tie))
    top = df.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= most)
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    return top.groupBy(*keys).agg(F.min_by(row, F.struct(seeded_order(seed, F.col(tie)), F.col(tie))).alias("_s")).select(*keys, "_s.*")


def variant_size(name: Column) -> Column:
    """struct(width, height) in the name of a resized variant, null in any other name."""
    pattern = F.lit("^resized_whole_(\\d+)x(\\d+)$")
    side = [F.regexp_extract(name, "^resized_whole_(\\d+)x(\\d+)$", k).try_cast("int") for k in (1, 2)]
    return F.when(F.rlike(name, pattern), F.struct(side[0].alias("width"), side[1].alias("height")))
