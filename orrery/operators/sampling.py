"""Group-safe splits, stratified quotas and ratio samplers in relational form.

Random choices are orders by a digest of seed and key, so they don't depend on partitioning or engine.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions.scalar import seeded_order, wanted_negatives


def hash_rank(keys: list[str], order: Column, *ties: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order, *ties))


def seeded_rank(df: DataFrame, name: str, keys: list[str], seed: int | str, key: str, digits: int = 3) -> DataFrame:
    """df with its 1-based place in the seeded order within keys; no task sorts a whole group.

    Rows are numbered within buckets of the digest's first digits, and the buckets' counts give what lies
    before each; a key's counts are 16 ** digits numbers at most. Null keys are a group.
    """
    digest = seeded_order(seed, F.col(key))
    d = df.withColumn("_digest", digest).withColumn("_k", F.struct(*keys, F.left("_digest", F.lit(digits)).alias("_bucket")))
    before = Window.partitionBy(*[F.col(f"_k.{k}") for k in keys]).orderBy("_k._bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = d.groupBy("_k").agg(F.count("*").alias("_n")).select("_k", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    placed = d.withColumn(name, F.row_number().over(Window.partitionBy("_k").orderBy("_digest", key)))
    return placed.join(ahead, "_k").withColumn(name, F.col(name) + F.col("_ahead")).drop("_k", "_digest", "_ahead")


def group_split(df: DataFrame, group: str, official: Column, fraction: float, seed: int) -> DataFrame:
    """train, val or test by whole groups: official test groups stay, a fraction of the others is val.

    The count is round-half-even, at least 1 if there are two groups or more.
    """
    test = F.lower(F.trim(official)) == "test"
    groups = df.groupBy(group).agg(F.max(F.coalesce(test, F.lit(False))).alias("_test"))
    sizes = groups.groupBy("_test").agg(F.count("*").alias("_size"))  # two rows
    groups = seeded_rank(groups, "_rank", ["_test"], seed, group).join(F.broadcast(sizes), "_test")
    rank, n = F.col("_rank"), F.col("_size")
    want = F.when((n > 1) & F.lit(fraction > 0), F.greatest(F.lit(1.0), F.bround(n * fraction))).otherwise(0)
    split = F.when(F.col("_test"), "test").when(rank <= want, "val").otherwise("train")
    return df.join(groups.withColumn("export_split", split).select(group, "export_split"), group)


def stratified_quota(groups: DataFrame, stratum: str, n: int) -> DataFrame:
    """(stratum, size, quota): largest remainders, ties by name, no quota above the size."""
    sizes = groups.groupBy(stratum).agg(F.count("*").alias("size"))
    whole = Window.partitionBy()  # over the strata only
    exact = F.lit(float(n)) * F.col("size") / F.sum("size").over(whole)
    base = F.least(F.col("size"), F.floor(exact))
    out = sizes.withColumn("exact", exact).withColumn("base", base)
    out = out.withColumn("left", F.lit(n) - F.sum("base").over(whole)).withColumn("open", F.col("base") < F.col("size"))
    place = F.row_number().over(Window.partitionBy("open").orderBy(F.desc(F.col("exact") - F.col("base")), stratum))
    return out.select(stratum, "size", (F.col("base") + F.when(F.col("open") & (place <= F.col("left")), 1).otherwise(0)).cast("long").alias("quota"))


def stratified_sample(groups: DataFrame, group: str, stratum: str, n: int, seed: int) -> DataFrame:
    quota = stratified_quota(groups, stratum, n).select(stratum, "quota")
    ranked = seeded_rank(groups, "_rank", [stratum], seed, group)
    return ranked.join(quota, stratum).where("_rank <= quota").drop("_rank", "quota")


def count_matched_quota(classes: dict[tuple[str, int], int], groups: int, members: int) -> dict[tuple[str, int], int]:
    """How many groups of each (stratum, size) make exactly ``groups`` groups with ``members`` members.

    Of all exact choices the one nearest the strata's and sizes' shares (least sum of deviations, ties by
    fewer of the earlier classes). A table over (groups, members) is kept a class: that bounds its use.
    """
    order = sorted(classes)
    total = max(1, sum(classes.values()))
    best = np.full((groups + 1, members + 1), np.inf)
    best[0, 0] = 0.0
    taken = []
    for stratum, size in order:
        have, share = classes[stratum, size], groups * classes[stratum, size] / total
        after, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int32)
        for k in range(min(have, groups, members // size if size else groups) + 1):
            cost = best[: groups + 1 - k, : members + 1 - k * size] + abs(k - share)
            here, where = after[k:, k * size :], pick[k:, k * size :]
            lower = cost < here
            here[lower], where[lower] = cost[lower], k
        best = after
        taken.append(pick)
    if not np.isfinite(best[groups, members]):
        raise ValueError(f"no choice has exactly {groups} groups with {members} members")
    out, g, m = {}, groups, members
    for key, pick in zip(reversed(order), reversed(taken)):
        out[key] = int(pick[g, m])
        g, m = g - out[key], m - out[key] * key[1]
    return out


def count_matched_sample(df: DataFrame, group: str, stratum: str, groups: int, members: int, seed: int) -> DataFrame:
    """(group, stratum, size) of a seeded sample of exactly so many groups and members; a group's stratum is its least."""
    each = df.groupBy(group).agg(F.min(stratum).alias(stratum), F.count("*").alias("size"))
    classes = {(r[stratum], r["size"]): r["count"] for r in each.groupBy(stratum, "size").count().collect()}  # strata times distinct sizes
    quota = count_matched_quota(classes, groups, members)
    plan = df.sparkSession.createDataFrame([(*key, n) for key, n in quota.items() if n], f"{stratum} string, size long, _quota long")
    ranked = seeded_rank(each, "_rank", [stratum, "size"], seed, group)
    return ranked.join(F.broadcast(plan), [stratum, "size"]).where("_rank <= _quota").select(group, stratum, "size")


def with_negatives(df: DataFrame, positive: str, wanted: Callable[[Column, Column], Column], seed: int | str, key: str, within: list[str], digits: int = 3) -> DataFrame:
    """All positives and the first ``wanted(positives, negatives)`` rows of each other label (false, null) in the seeded order, by ``within``.

    Counts by label and bucket of the digest's first digits tell the bucket that holds the last wanted row; only
    the rows of that bucket are dealt and numbered, all others stay where they are. ``within`` makes few groups, as
    splits do: the last buckets, a row a group and label, are broadcast.
    """
    label, groups = F.coalesce(F.col(positive), F.lit(False)), [*within, positive]
    d = df.withColumn("_digest", F.when(~label, seeded_order(seed, F.col(key)))).withColumn("_bucket", F.left("_digest", F.lit(digits)))
    sizes = d.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    every, before = Window.partitionBy(*within), Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    total = [F.coalesce(F.sum(F.when(c, F.col("_n"))).over(every), F.lit(0)) for c in (F.col(positive), ~F.col(positive))]
    sizes = sizes.withColumn("_rest", wanted(*total) - F.coalesce(F.sum("_n").over(before), F.lit(0))).where(~label & (F.col("_rest") > 0))
    last = sizes.groupBy(*groups).agg(F.max(F.struct("_bucket", "_rest")).alias("_last")).select(*[F.col(c).alias(f"_of_{c}") for c in groups], "_last")
    d = d.join(F.broadcast(last), [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in groups], "left")
    place = F.row_number().over(Window.partitionBy(*groups).orderBy("_digest", key))
    cut = d.where(~label & (F.col("_bucket") == F.col("_last._bucket"))).withColumn("_place", place).where(F.col("_place") <= F.col("_last._rest"))
    return d.where(label | (F.col("_bucket") < F.col("_last._bucket"))).select(*df.columns).unionByName(cut.select(*df.columns))


def positive_ratio(df: DataFrame, positive: str, ratio: float, seed: int, key: str, within: list[str] | None = None, eligible: Column | None = None) -> DataFrame:
    """All positives and as many seeded negatives as make their share ``ratio``; none without positives."""
    use = df if eligible is None else df.where(F.col(positive) | eligible)
    return with_negatives(use, positive, lambda pos, neg: wanted_negatives(pos, ratio), seed, key, within or [])


def negative_fraction(df: DataFrame, positive: str, fraction: float, seed: int, key: str, within: list[str]) -> DataFrame:
    """All positives and the fraction of the negatives, rounded half to even."""
    return with_negatives(df, positive, lambda pos, neg: F.bround(neg * fraction), seed, key, within)


def ratio_mixture(mass: int, negative: int, target: float, mandatory: int = 0) -> tuple[int, int]:
    """(positives, negatives) of the largest mixture nearest the target within both pools."""
    total = min(int(mass // target) if target > 0 else negative, int(negative // (1 - target)) if target < 1 else mass)
    m0 = int(round(total * target))
    around = [(m, n) for m in range(m0 - 1, m0 + 2) for n in range(total - m0 - 1, total - m0 + 2) if 0 <= m <= mass and 0 <= n <= negative and m + n > 0]
    if not around:
        return 0, 0
    best = min(around, key=lambda x: (abs(x[0] / sum(x) - target), -sum(x), *x))
    if mandatory > best[0]:
        raise ValueError("more mandatory rows than the mixture has positives")
    return best


def nearest_mixture(mass: Column, negative: Column, target: float) -> Column:
    """struct(mass, negative): the largest whole mixture of both pools nearest the target share, ties to the larger."""
    total = F.least(F.floor(mass / target), F.floor(negative / (1.0 - target))) if target < 1 else mass
    m0 = F.least(mass, F.bround(total * target).cast("long"))
    n0 = F.least(negative, total - m0)
    near = [F.struct(F.abs(m / (m + n) - target).alias("off"), (-(m + n)).alias("size"), m.alias("mass"), n.alias("negative")) for m, n in ((m0 + a, n0 + b) for a in (-1, 0, 1) for b in (-1, 0, 1))]
    fits = F.filter(F.array(*[F.when((x["mass"].between(0, mass)) & (x["negative"].between(0, negative)) & (x["size"] < 0), x) for x in near]), lambda x: x.isNotNull())
    best = F.array_min(fits)
    return F.struct(mass.alias("mass"), F.lit(0).cast("long").alias("negative")) if target >= 1 else F.struct(best["mass"].alias("mass"), best["negative"].alias("negative"))


def source_ratio(df: DataFrame, mass_source: str, positive: str, target: float, seed: int, key: str, within: list[str], strict: bool = False) -> DataFrame:
    """Rows balanced by the status of their source, not their own label; positive rows of mass sources are all kept.

    Adds mass_candidates, negative_candidates, mandatory, selected_mass and selected_negative. A group without both
    pools, or whose mixture can't hold the positive rows, has no answer: strict raises, otherwise it gives no rows.
    """
    m = F.col(mass_source)
    pools = df.groupBy(*within).agg(F.count_if(m).alias("mass_candidates"), F.count_if(~m).alias("negative_candidates"), F.count_if(m & F.col(positive)).alias("mandatory"))
    mixture = nearest_mixture(F.col("mass_candidates"), F.col("negative_candidates"), target)
    pools = pools.withColumn("_mix", F.when((F.col("mass_candidates") > 0) & ((F.col("negative_candidates") > 0) | F.lit(target >= 1)), mixture))
    pools = pools.withColumns({"selected_mass": F.col("_mix.mass"), "selected_negative": F.col("_mix.negative")}).drop("_mix")
    ok = F.col("selected_mass").isNotNull() & (F.col("mandatory") <= F.col("selected_mass"))
    if strict and (bad := pools.where(~F.coalesce(ok, F.lit(False))).take(5)):
        raise ValueError(f"no mixture for {bad}")
    d = df.withColumn("_class", F.when(~m, 2).when(F.col(positive), 0).otherwise(1))
    d = seeded_rank(d, "_rank", [*within, "_class"], seed, key).join(F.broadcast(pools.where(ok)), within)  # a row a group
    most = F.when(F.col("_class") == 2, F.col("selected_negative")).when(F.col("_class") == 1, F.col("selected_mass") - F.col("mandatory"))
    return d.where((F.col("_class") == 0) | (F.col("_rank") <= most)).drop("_class", "_rank")


def hashed_unit(seed: int | str, *keys: Column) -> Column:
    """A reproducible number in [0, 1) from the digest of seed and keys."""
    return F.conv(F.left(seeded_order(seed, *keys), F.lit(8)), 16, 10).cast("double") / float(1 << 32)


def first_acceptable(df: DataFrame, keys: list[str], place: str, accepted: str) -> DataFrame:
    """Of each key's tries the first accepted one, else the last; with whether it was accepted."""
    order = F.struct((~F.col(accepted)).alias("a"), F.when(F.col(accepted), F.col(place)).otherwise(-F.col(place)).alias("b"))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_s")).select(*keys, "_s.*")


def online_balance(df: DataFrame, keys: list[str], order: list[str], positive: str, ratio: float) -> DataFrame:
    """One-pass balancing as windows: a negative is admitted iff fewer were so far than the positives so far allow.

    What the rule has refused up to a row is the running maximum of (negatives - allowance), as the
    allowance never falls; a negative is admitted where that maximum doesn't rise.
    """
    ratio = min(1.0, max(0.01, ratio))
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    row = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_p", F.sum(F.col(positive).cast("long")).over(so_far)).withColumn("_n", F.sum((~F.col(positive)).cast("long")).over(so_far))
    over = F.when(~F.col(positive), F.greatest(F.lit(0).cast("long"), F.col("_n") - wanted_negatives(F.col("_p"), ratio))).otherwise(0)
    out = out.withColumn("_lost", F.max(over).over(so_far))
    before = F.coalesce(F.lag("_lost").over(row), F.lit(0))
    return out.withColumn("admitted", F.col(positive) | (F.col("_lost") == before)).drop("_p", "_n", "_lost")


def cadence_schedule(df: DataFrame, positive: str, seed: int, key: str, positives: int, negatives: int) -> DataFrame:
    """Rows with their schedule place: runs of positives and negatives in turn; the rest as reserve (place null)."""
    ranked = seeded_rank(df, "_i", [positive], seed, key).withColumn("_i", F.col("_i") - 1)
    count = df.agg(F.count_if(F.col(positive)).alias("_pos"), F.count_if(~F.col(positive)).alias("_neg"))
    ranked = ranked.crossJoin(F.broadcast(count))  # one row
    budget = F.least(F.col("_neg"), F.ceil(F.col("_pos") * negatives / max(1, positives))) if negatives else F.lit(0)
    turn = F.when(F.col(positive), F.floor(F.col("_i") / max(1, positives))).otherwise(F.floor(F.col("_i") / max(1, negatives)))
    used = F.col(positive) | (F.col("_i") < budget)
    ranked = ranked.withColumn("used", used).withColumn("turn", F.when(used, turn.cast("long"))).withColumn("slot", F.when(used, F.col("_i").cast("long")))
    return ranked.drop("_i", "_pos", "_neg")
