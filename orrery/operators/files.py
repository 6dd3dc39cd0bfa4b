"""Relations over file listings: where an image lies, which files pair up, whether counts agree.

A listing is a DataFrame of paths, one row a file, as a binaryFile scan without its content gives it. Every
operator is an equi-join or a grouping on names, so none probes files one by one on the driver.
"""

from __future__ import annotations

from copy import deepcopy
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUFFIXES = (".dicom", ".dcm", "")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The last part of a path without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(file_name(path), "(?<=.)\\.[^.]*$", "")


def resolve_paths(rows: DataFrame, listing: DataFrame, folder: str, name: str, root: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``rows`` with ``path``, the file ``root/folder/name`` under the first suffix that the listing holds, and ``found``.

    A row without a file gets the path of the first suffix. Rows stay as many, whatever the listing repeats;
    null names get a null path and found = false.
    """
    kinds = F.array(*[F.lit(s) for s in suffixes])
    held = listing.select(F.element_at(F.split("path", "/"), -2).alias("_folder"), F.explode(F.transform(kinds, lambda s, k: F.struct(k.alias("rank"), s.alias("suffix")))).alias("_kind"), file_name(F.col("path")).alias("_file"))
    held = held.where(F.col("_file").endswith(F.col("_kind.suffix")))
    held = held.select("_folder", F.expr("left(_file, length(_file) - length(_kind.suffix))").alias("_name"), "_kind")
    best = held.groupBy("_folder", "_name").agg(F.min("_kind").alias("_kind"))
    key = (F.col(f"_r.{folder}").cast("string") == F.col("_b._folder")) & (F.col(f"_r.{name}").cast("string") == F.col("_b._name"))
    out = rows.alias("_r").join(best.alias("_b"), key, "left")
    path = F.concat(F.lit(root.rstrip("/") + "/"), F.col(f"_r.{folder}").cast("string"), F.lit("/"), F.col(f"_r.{name}").cast("string"), F.coalesce("_b._kind.suffix", F.lit(suffixes[0])))
    return out.select("_r.*", path.alias("path"), F.col("_b._kind").isNotNull().alias("found"))


def missing_paths(resolved: DataFrame, shown: int = 10) -> DataFrame:
    """One row: how many rows have no file, and the first few of their paths in order (a report's preview)."""
    lost = resolved.where(~F.col("found"))
    first = lost.select("path").orderBy("path").limit(shown).agg(F.array_sort(F.collect_list("path")).alias("preview"))
    return lost.agg(F.count("*").alias("missing")).crossJoin(first)


def pair_files(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer pairs of two listings by keys and stem, with ``status``: paired, left_only or right_only."""
    a, b = (x.select(*keys, stem(F.col("path")).alias("stem"), F.lit(True).alias(side)).distinct() for x, side in ((left, "_a"), (right, "_b")))
    out = a.join(b, [*keys, "stem"], "full")
    status = F.when(F.col("_a").isNull(), "right_only").when(F.col("_b").isNull(), "left_only").otherwise("paired")
    return out.select(*keys, "stem", status.alias("status"))


def sanity_report(listing: DataFrame, keys: list[str], kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """Files a key by kind (name: folder column value, suffix) and whether the first two kinds have equally many."""
    counts = [F.count_if((F.col("kind") == folder) & F.col("path").endswith(suffix)).alias(name) for name, (folder, suffix) in kinds.items()]
    first, second = list(kinds)[:2]
    return listing.groupBy(*keys).agg(*counts).withColumn(f"{first}_match", F.col(first) == F.col(second))


def merged(base: dict, *patches: dict) -> dict:
    """Nested options with later ones over earlier ones; neither is changed, lists are replaced whole."""

    def over(a: dict, b: dict) -> dict:
        both = [k for k in a.keys() & b.keys() if isinstance(a[k], dict) and isinstance(b[k], dict)]
        return deepcopy(a) | deepcopy(b) | {k: over(a[k], b[k]) for k in both}

    return reduce(over, patches, base)
