"""More queries of the engine's own operators: balancing by source, contracts, window tries, estimates, array summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions import arrays as R
from orrery.functions import geometry as G
from orrery.functions import scalar as X
from orrery.operators import aggregate as A
from orrery.operators import contracts as V
from orrery.operators import relations as J
from orrery.operators import sampling as S
from orrery.plans.catalog import _CAND, _VIS, BOX, SRC, bcols, box, candidates, register, src, table, wcols

# ---- balancing by the status of the source breast ---------------------------------------------------

MASS = "l_returnflag = 'R' and l_linenumber >= 6"
_BREAST = f"""{_CAND.replace("from lineitem)", f"from lineitem where {MASS})")},
br as (select study_id, laterality, bool_or(image_id in (select image_id from box)) as breast_has_mass from src group by all),
b as (select ok.*, breast_has_mass from ok join br using (study_id, laterality))"""


def _breast_candidates(spark, sf):
    """Candidate windows of the lesions (boxes of category R on late lines) with the status of their breast (study and side)."""
    s, boxes = src(spark, sf), box(spark, sf).where("category = 'R' and line >= 6")
    lesions = boxes.select("image_id").distinct().withColumn("hit", F.lit(True))
    breasts = s.join(lesions.hint("merge"), "image_id", "left").groupBy("study_id", "laterality").agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("breast_has_mass"))
    return candidates(spark, sf, boxes=boxes, images=s.join(breasts.hint("merge"), ["study_id", "laterality"]))  # images are dealt by breast, not windows


@register(f"""with {_BREAST}, p as (select split, count_if(breast_has_mass) as m, count_if(not breast_has_mass) as n, count_if(breast_has_mass and positive) as mand from b group by split),
t as (select *, least(floor(m / 0.75), floor(n / 0.25)) as total from p where m > 0 and n > 0),
z as (select *, least(m, round_even(total * 0.75, 0)) as m0 from t), y as (select *, least(n, total - m0) as n0 from z),
c as (select split, m, n, mand, m0 + dm as sm, n0 + dn as sn from y, (values (-1), (0), (1)) a(dm), (values (-1), (0), (1)) d(dn) where m0 + dm between 0 and m and n0 + dn between 0 and n and m0 + dm + n0 + dn > 0),
best as (select * from (select *, row_number() over (partition by split order by abs(sm / (sm + sn) - 0.75), -(sm + sn), sm, sn) as k from c) where k = 1 and mand <= sm),
r as (select b.*, case when not breast_has_mass then 2 when positive then 0 else 1 end as cls from b),
q as (select *, row_number() over (partition by split, cls order by md5('13:' || window_id), window_id) as rk from r)
select image_id, q.split, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, positive, breast_has_mass, m as mass_candidates, n as negative_candidates, mand as mandatory, cast(sm as bigint) as selected_mass, cast(sn as bigint) as selected_negative,
  round(cast(sm / (sm + sn) as double), 9) as achieved from q join best using (split) where cls = 0 or rk <= case cls when 2 then sn else sm - mand end""")
def source_breast_ratio(spark, sf):
    out = S.source_ratio(_breast_candidates(spark, sf), "breast_has_mass", "positive", 0.75, 13, "window_id", ["split"])
    achieved = F.col("selected_mass") / (F.col("selected_mass") + F.col("selected_negative"))
    return out.select("image_id", "split", "x0", "y0", "positive", "breast_has_mass", "mass_candidates", "negative_candidates", "mandatory", "selected_mass", "selected_negative", F.round(achieved, 9).alias("achieved"))


@register(f"""with {_BREAST}, e as (select * from b where positive or (not image_has_mass and not breast_has_mass)),
r as (select *, row_number() over (partition by split, positive order by md5('17:' || window_id), window_id) as rk, count_if(positive) over (partition by split) as pos from e)
select image_id, split, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, positive from r where pos > 0 and (positive or rk <= round_even(pos * 0.3 / 0.7, 0))""")
def crop_label_ratio(spark, sf):
    """Negatives only from images and breasts without a lesion."""
    eligible = ~F.col("image_has_mass") & ~F.col("breast_has_mass")
    return S.positive_ratio(_breast_candidates(spark, sf), "positive", 0.7, 17, "window_id", ["split"], eligible).select("image_id", "split", "x0", "y0", "positive")


# ---- window tries, scores and duplicates -----------------------------------------------------------

_U = "cast(cast('0x' || left(md5('{seed}:' || {key}), 8) as bigint) as double) / 4294967296.0"


@register(f"""with {SRC}, {BOX}, b as (select distinct image_id, line, bx0, by0, bx1, by1, w, h from box join src using (image_id)),
t as (select *, unnest(generate_series(1, 4)) as k from b),
u as (select *, ({_U.format(seed="x", key="image_id || ':' || line || ':' || cast(bx0 as bigint) || ':' || cast(by0 as bigint) || ':' || k")} - 0.5) * 320 as dx, ({_U.format(seed="y", key="image_id || ':' || line || ':' || cast(bx0 as bigint) || ':' || cast(by0 as bigint) || ':' || k")} - 0.5) * 320 as dy from t),
o as (select *, least(greatest(0, round_even((bx0 + bx1) / 2 + dx - 320, 0)), greatest(0, w - 640)) as x0, least(greatest(0, round_even((by0 + by1) / 2 + dy - 320, 0)), greatest(0, h - 640)) as y0 from u),
v as (select *, greatest(0, least(bx1, x0 + 640) - greatest(bx0, x0)) * greatest(0, least(by1, y0 + 640) - greatest(by0, y0)) / greatest((bx1 - bx0) * (by1 - by0), 1e-12) >= 0.9 as accepted from o)
select image_id, line, bx0, by0, cast(k as integer) as k, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, accepted from (select *, row_number() over (partition by image_id, line, bx0, by0, bx1, by1 order by case when accepted then k else 100 - k end) as r from v) where r = 1""")
def box_centred_windows(spark, sf):
    """Windows shifted at random around a box's centre: the first of four tries that shows 0.9 of the box, else the last."""
    keys = ["image_id", "line", "bx0", "by0", "bx1", "by1"]
    t = box(spark, sf).join(src(spark, sf), "image_id").select(*keys, "w", "h").distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(4))))
    names = [F.col("image_id"), F.col("line"), F.col("bx0").cast("long"), F.col("by0").cast("long"), F.col("k")]

    def origin(lo: str, hi: str, length: str, seed: str):
        shift = (S.hashed_unit(seed, *names) - 0.5) * 320
        return F.least(F.greatest(F.lit(0.0), F.bround((F.col(lo) + F.col(hi)) / 2 + shift - 320)), F.greatest(F.lit(0), F.col(length) - 640)).cast("long")

    t = t.withColumn("x0", origin("bx0", "bx1", "w", "x")).withColumn("y0", origin("by0", "by1", "h", "y"))
    w = [F.col("x0"), F.col("y0"), F.col("x0") + 640, F.col("y0") + 640]
    t = t.withColumn("accepted", G.visible_fraction(bcols(), w) >= 0.9).drop("w", "h")
    return S.first_acceptable(t, keys, "k", "accepted").select("image_id", "line", "bx0", "by0", "k", "x0", "y0", "accepted")


@register(f"""with {SRC}, {BOX}, t as (select image_id, w, h, unnest(generate_series(1, 3)) as k from src),
o as (select *, cast(floor({_U.format(seed="rx", key="image_id || ':' || k")} * (greatest(0, w - 640) + 1)) as bigint) as x0, cast(floor({_U.format(seed="ry", key="image_id || ':' || k")} * (greatest(0, h - 640) + 1)) as bigint) as y0 from t),
g as (select *, x0 + 640 as x1, y0 + 640 as y1 from o),
v as (select g.image_id, k, x0, y0, coalesce(max({_VIS}), 0) <= 0.1 as accepted from g left join box using (image_id) group by all)
select image_id, cast(k as integer) as k, x0, y0, accepted from (select *, row_number() over (partition by image_id order by case when accepted then k else 100 - k end) as r from v) where r = 1""")
def random_clean_windows(spark, sf):
    """A window an image at a random place: the first of three tries that shows at most 0.1 of any box, else the last."""
    t = src(spark, sf).select("image_id", "w", "h").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3))))

    def origin(length: str, seed: str):
        return F.floor(S.hashed_unit(seed, F.col("image_id"), F.col("k")) * (F.greatest(F.lit(0), F.col(length) - 640) + 1)).cast("long")

    t = t.withColumn("x0", origin("w", "rx")).withColumn("y0", origin("h", "ry")).withColumn("x1", F.col("x0") + 640).withColumn("y1", F.col("y0") + 640)
    seen = t.join(box(spark, sf), "image_id", "left").groupBy("image_id", "k", "x0", "y0").agg((F.coalesce(F.max(G.visible_fraction(bcols(), wcols())), F.lit(0.0)) <= 0.1).alias("accepted"))
    return S.first_acceptable(seen, ["image_id"], "k", "accepted").select("image_id", "k", "x0", "y0", "accepted")


@register(f"""with {BOX}, {SRC}, s as (select distinct image_id, line, bx0, bx1, greatest(0, ceil(bx1 + 16 - 640)) as a, least(greatest(w - 640, 0), floor(bx0 - 16)) as b from box join src using (image_id)),
p as (select image_id, line, bx0, bx1, cast(unnest(list_distinct(list_concat(generate_series(cast(a as bigint), cast(b as bigint), 128), [cast(b as bigint)]))) as bigint) as x0 from s where a <= b)
select *, round(cast(case when (bx0 + bx1) / 2 between x0 and x0 + 640 then 1 else greatest(0, 1 - abs((bx0 + bx1) / 2 - (x0 + 320)) / 640.0) end as double), 9) as peak from p""")
def coarse_origins(spark, sf):
    """Origins every 128 pixels of a box's safe interval, its end included, with the score of the box's centre as peak."""
    b = box(spark, sf).join(src(spark, sf), "image_id").select("image_id", "line", "bx0", "bx1", "w").distinct()
    lo, hi = G.safe_origins(F.col("bx0"), F.col("bx1"), 640, 16, F.greatest(F.col("w") - 640, F.lit(0)))
    p = b.withColumn("lo", lo).withColumn("hi", hi).where("lo is not null").withColumn("x0", F.explode(G.coarse_positions(F.col("lo"), F.col("hi"), 128)))
    peak = G.peak_score((F.col("bx0") + F.col("bx1")) / 2, F.col("x0"), F.col("x0") + 640, 640)
    return p.select("image_id", "line", "bx0", "bx1", "x0", F.round(peak, 9).alias("peak"))


@register(f"""with {SRC}, a as (select image_id, unnest(generate_series(0, greatest(w - 640, 0), 256)) as x0, 256 as stride from src union all select image_id, unnest(generate_series(0, greatest(w - 640, 0), 512)), 512 from src),
r as (select *, row_number() over (partition by image_id, x0 order by stride) as k, count(*) over (partition by image_id) as made from a)
select image_id, count(*) as kept, cast(any_value(made) - count(*) as bigint) as duplicates from r where k = 1 group by image_id""")
def window_dedup(spark, sf):
    """Windows of two grids, each once a source, the first grid's kept."""
    s = src(spark, sf)
    both = J.union_by_name([s.select("image_id", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("w") - 640, F.lit(0)).cast("long"), F.lit(n).cast("long"))).alias("x0")).withColumn("stride", F.lit(n)) for n in (256, 512)])
    made = both.groupBy("image_id").agg(F.count("*").alias("made"))
    kept = J.first_per_key(both, ["image_id", "x0"], [F.col("stride")]).groupBy("image_id").agg(F.count("*").alias("kept"))
    return kept.join(made, "image_id").select("image_id", "kept", (F.col("made") - F.col("kept")).alias("duplicates"))


# ---- contracts -------------------------------------------------------------------------------------


@register(f"""with {_CAND}, m as (select split, count(*) as windows, count_if(positive) as positives, count(distinct image_id) as sources, count(distinct study_id) as studies, count(*) - count(distinct window_id) as duplicates,
  count_if(x0 < 0 or y0 < 0) as negative_origins, count_if(positive <> (n_boxes > 0)) as label_errors, count_if(x1 - x0 <> 640 or y1 - y0 <> 640) as size_errors, count_if(extent > 1) as extent_errors,
  count_if(not positive and extent <= 0.1) as bypassed, count_if(positive and not image_has_mass) as orphans from ok group by split),
x as (select count(*) as n from (select image_id from ok group by image_id having count(distinct split) > 1))
select 'positives' as rule, split as scope, cast(1000 as bigint) as expected, positives as actual from m where positives <> 1000
union all select 'sources', split, studies, sources from m where sources <> studies
union all select 'duplicates', split, 0, duplicates from m where duplicates <> 0 union all select 'negative_origins', split, 0, negative_origins from m where negative_origins <> 0
union all select 'label_errors', split, 0, label_errors from m where label_errors <> 0 union all select 'size_errors', split, 0, size_errors from m where size_errors <> 0
union all select 'extent_errors', split, 0, extent_errors from m where extent_errors <> 0 union all select 'bypassed', split, 0, bypassed from m where bypassed <> 0
union all select 'orphans', split, 0, orphans from m where orphans <> 0 union all select 'sources_in_several_splits', 'all', 0, n from x where n <> 0""")
def patch_contract(spark, sf):
    """Broken rules of a window set, recomputed from the windows themselves; an empty result is a pass."""
    c = candidates(spark, sf)
    none = {
        "negative_origins": (F.col("x0") < 0) | (F.col("y0") < 0), "label_errors": F.col("positive") != (F.col("n_boxes") > 0),
        "size_errors": (F.col("x1") - F.col("x0") != 640) | (F.col("y1") - F.col("y0") != 640), "extent_errors": F.col("extent") > 1,
        "bypassed": ~F.col("positive") & (F.col("extent") <= 0.1), "orphans": F.col("positive") & ~F.col("image_has_mass"),
    }
    # windows stay with their image, whose id is a part of theirs: sums of its rows replace distinct counts over all windows
    image = c.groupBy("image_id", "split").agg(
        F.count_if("positive").alias("positives"), (F.count("*") - F.count_distinct("window_id")).alias("duplicates"), *[F.count_if(rule).alias(n) for n, rule in none.items()]
    )
    image = image.withColumn("place", F.row_number().over(Window.partitionBy("image_id").orderBy("split")))
    m = image.rollup("split").agg(
        F.grouping("split").alias("over_all"), F.count("image_id").alias("sources"), F.sum("positives").alias("positives"), F.count_if((F.col("place") == 2)).alias("several"),
        F.sum("duplicates").alias("duplicates"), *[F.sum(n).alias(n) for n in none],
    )
    studies = c.groupBy("split").agg(F.count_distinct("study_id").alias("studies"))
    m = m.join(studies, "split", "left").withColumn("scope", F.when(F.col("over_all") == 1, "all").otherwise(F.col("split")))
    each = F.col("over_all") == 0
    rules = {"positives": (F.lit(1000), F.col("positives")), "sources": (F.col("studies"), F.col("sources"))} | {n: (F.lit(0), F.col(n)) for n in ["duplicates", *none]}
    rules = {n: (e, F.when(each, a).otherwise(e)) for n, (e, a) in rules.items()} | {"sources_in_several_splits": (F.lit(0), F.when(each, 0).otherwise(F.col("several")))}
    return V.violations(m, "scope", rules)


_VARIANTS = f"""{SRC}, {BOX}, v as (select image_id, split, w, h, height, height * 1.0 / h as s, cast(floor(w * (height * 1.0 / h) + 0.5) as bigint) as vw from src, (values (512), (1024)) t(height)),
a as (select v.*, bx0, by0, bx1, by1, least(greatest(bx0 * vw / w, 0), vw) as vx0, least(greatest(bx1 * vw / w, 0), vw) as vx1, least(greatest(by0 * height / h, 0), height) as vy0, least(greatest(by1 * height / h, 0), height) as vy1 from v join box using (image_id)),
k as (select *, vx1 > vx0 and vy1 > vy0 as kept, greatest(abs(vx0 * w / vw - bx0), abs(vx1 * w / vw - bx1), abs(vy0 * h / height - by0), abs(vy1 * h / height - by1)) as err from a)"""


def _variant_boxes(spark, sf):
    """Boxes of every image in two resized variants, clipped to them, with the error of the way back."""
    s = src(spark, sf).withColumn("height", F.explode(F.array(F.lit(512), F.lit(1024)))).withColumn("vw", X.half_up(F.col("w") * (F.col("height") * 1.0 / F.col("h"))))
    a = s.join(box(spark, sf), "image_id")
    ends = {f"v{c}": F.least(F.greatest(F.col(f"b{c}") * F.col(to) / F.col(of), F.lit(0.0)), F.col(to)) for c, to, of in (("x0", "vw", "w"), ("x1", "vw", "w"), ("y0", "height", "h"), ("y1", "height", "h"))}
    a = a.withColumns(ends).withColumn("kept", (F.col("vx1") > F.col("vx0")) & (F.col("vy1") > F.col("vy0")))
    back = [F.abs(F.col(f"v{c}") * F.col(of) / F.col(to) - F.col(f"b{c}")) for c, to, of in (("x0", "vw", "w"), ("x1", "vw", "w"), ("y0", "height", "h"), ("y1", "height", "h"))]
    return s, a.withColumn("err", F.greatest(*back))


@register(f"""with {_VARIANTS}, m as (select height, split, count(*) as images, count(distinct image_id) as ids, count_if(vw < 1) as empty from v group by all),
e as (select height, split, count_if(not kept) as dropped, count_if(kept and err > 1e-3) as inexact, count_if(vx1 > vw or vy1 > height or vx0 < 0 or vy0 < 0) as outside from k group by all),
j as (select m.*, coalesce(dropped, 0) as dropped, coalesce(inexact, 0) as inexact, coalesce(outside, 0) as outside, height || '/' || split as scope from m left join e using (height, split)),
p as (select split, max(n) - min(n) as gap from (select height, split, count_if(kept) as n from k group by all) group by split)
select 'duplicates' as rule, scope, ids as expected, images as actual from j where ids <> images union all select 'empty', scope, 0, empty from j where empty <> 0
union all select 'dropped', scope, 0, dropped from j where dropped <> 0 union all select 'inexact', scope, 0, inexact from j where inexact <> 0
union all select 'outside', scope, 0, outside from j where outside <> 0 union all select 'parity', split, 0, gap from p where gap <> 0""")
def whole_image_contract(spark, sf):
    """Broken rules of the resized variants: duplicates, bounds, lost boxes, error of the way back over 1e-3, parity between variants."""
    images, a = _variant_boxes(spark, sf)
    m = images.groupBy("height", "split").agg(F.count("*").alias("images"), F.count_distinct("image_id").alias("ids"), F.count_if(F.col("vw") < 1).alias("empty"))
    outside = (F.col("vx1") > F.col("vw")) | (F.col("vy1") > F.col("height")) | (F.col("vx0") < 0) | (F.col("vy0") < 0)
    e = a.groupBy("height", "split").agg(F.count_if(~F.col("kept")).alias("dropped"), F.count_if(F.col("kept") & (F.col("err") > 1e-3)).alias("inexact"), F.count_if(outside).alias("outside"), F.count_if("kept").alias("kept"))
    j = m.join(e.drop("kept"), ["height", "split"], "left").na.fill(0).withColumn("scope", F.concat_ws("/", "height", "split"))
    rules = {"duplicates": (F.col("ids"), F.col("images"))} | {n: (F.lit(0), F.col(n)) for n in ("empty", "dropped", "inexact", "outside")}
    gap = e.groupBy("split").agg((F.max("kept") - F.min("kept")).alias("gap"))
    return V.violations(j, "scope", rules).unionByName(V.violations(gap, "split", {"parity": (F.lit(0), F.col("gap"))}))


@register(f"with {_VARIANTS} select height, count(*) as annotations, count_if(kept) as kept, round(min(err), 6) as least_error, round(max(err), 6) as most_error from k group by height")
def annotation_parity(spark, sf):
    e = _variant_boxes(spark, sf)[1]
    return e.groupBy("height").agg(F.count("*").alias("annotations"), F.count_if("kept").alias("kept"), F.round(F.min("err"), 6).alias("least_error"), F.round(F.max("err"), 6).alias("most_error"))


@register("select a.c_custkey as key, 'missing' as what from customer a left join (select distinct o_custkey from orders) o on a.c_custkey = o.o_custkey where o.o_custkey is null union all select l_orderkey, 'repeated' from lineitem group by l_orderkey, l_linenumber, l_partkey having count(*) > 1")
def split_map_check(spark, sf):
    """Keys that a map lacks, and composite keys that it repeats."""
    missing = V.missing_rows(table(spark, sf, "customer").select(F.col("c_custkey").alias("key")), table(spark, sf, "orders").select(F.col("o_custkey").alias("key")), ["key"])
    repeated = V.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"]).select(F.col("l_orderkey").alias("key"))
    return missing.withColumn("what", F.lit("missing")).unionByName(repeated.withColumn("what", F.lit("repeated")))


# ---- records, joins and estimates ------------------------------------------------------------------


@register(f"""with {SRC}, {BOX} select image_id, row_number() over (order by image_id) - 1 as index, split, 'study ' || study_id || ' ' || laterality || ' ' || view_position as display_name, image_id in (select image_id from box where category = 'R') as has_mass,
  c_mktsegment as vendor from src left join customer on c_custkey = study_id""")
def enriched_records(spark, sf):
    s = J.numbered_by_range(src(spark, sf), "index", [], "image_id")
    lesions = box(spark, sf).where("category = 'R'").select("image_id").distinct().withColumn("has_mass", F.lit(True))
    vendors = table(spark, sf, "customer").select(F.col("c_custkey").alias("study_id"), F.col("c_mktsegment").alias("vendor"))
    out = J.one_to_one(s, lesions, ["image_id"]).join(vendors, "study_id", "left").na.fill(False, ["has_mass"])
    return out.select("image_id", "index", "split", F.concat_ws(" ", F.lit("study"), "study_id", "laterality", "view_position").alias("display_name"), "has_mass", "vendor")


@register(f"""with {SRC}, n as (select count(*) as n from src), p as (select distinct cast(round_even(i * ((n - 1) / 8.0), 0) as bigint) as place from n, (select unnest(generate_series(0, 8)) as i) where n >= 9)
select image_id, split from (select *, row_number() over (order by image_id) - 1 as place from src) join p using (place)""")
def evenly_spaced_records(spark, sf):
    return J.evenly_spaced(src(spark, sf), "image_id", 9).select("image_id", "split")


@register(f"with {SRC}, {BOX} select image_id, w, h from src where image_id in (select image_id from box where category = 'R') order by image_id limit 20 offset 10")
def paged_mass_images(spark, sf):
    """The second page of twenty, after ten, of the images that have a lesion: a report by its nature."""
    lesions = box(spark, sf).where("category = 'R'").select("image_id").distinct()
    return src(spark, sf).join(lesions, "image_id", "left_semi").select("image_id", "w", "h").orderBy("image_id").offset(10).limit(20)


@register("select lang as value, count(*) as n from documents group by lang union all select case when quality is null then null else cast(quality as varchar) end, count(*) from documents left join labels using (doc_id) group by 1")
def null_value_counts(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return A.value_counts(table(spark, sf, "documents"), "lang", None).unionByName(A.value_counts(d, "quality", None))


@register(f"""with {SRC}, {BOX}, i as (select image_id, split, w, h, count(box.image_id) as n from src left join box using (image_id) group by all), s as (select greatest(bx1 - bx0, by1 - by0) as side, (bx1 - bx0) * (by1 - by0) as area from box)
select count(*) as images, count_if(n > 0) as positives, cast(sum(n) as bigint) as boxes, round(count_if(n > 0) / count(*), 9) as positive_rate, round(avg(n), 9) as mean_boxes, cast(max(w) as bigint) as most_width, cast(max(h) as bigint) as most_height,
 (select round(median(side), 6) from s) as median_side, (select round(avg(area), 6) from s) as mean_area from i""")
def global_statistics(spark, sf):
    n = box(spark, sf).groupBy("image_id").agg(F.count("*").alias("n"))
    i = src(spark, sf).join(n, "image_id", "left").na.fill(0, ["n"])
    pos = F.count_if(F.col("n") > 0)
    one = i.agg(F.count("*").alias("images"), pos.alias("positives"), F.sum("n").alias("boxes"), F.round(pos / F.count("*"), 9).alias("positive_rate"), F.round(F.avg("n"), 9).alias("mean_boxes"), F.max("w").alias("most_width"), F.max("h").alias("most_height"))
    b = box(spark, sf).select(F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0")).alias("side"), ((F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0"))).alias("area"))
    median = A.quantiles(b, [], F.col("side"), {"median_side": 0.5}).select(F.round("median_side", 6).alias("median_side"))
    return one.crossJoin(median).crossJoin(b.agg(F.round(F.avg("area"), 6).alias("mean_area")))  # one row each


@register(f"""with {_CAND}, i as (select image_id, split, count(*) as windows, count_if(positive) as positives, bool_or(image_has_mass) as mass from ok group by all)
select split, count(*) as sources, count_if(mass) as mass_sources, count_if(positives > 0) as positive_sources, cast(sum(windows) as bigint) as windows, cast(sum(case when not mass then windows else 0 end) as bigint) as clean_windows, cast(max(windows) as bigint) as most_windows from i group by split""")
def source_scan_summary(spark, sf):
    i = candidates(spark, sf).groupBy("image_id", "split").agg(F.count("*").alias("windows"), F.count_if("positive").alias("positives"), F.bool_or("image_has_mass").alias("mass"))
    clean = F.sum(F.when(~F.col("mass"), F.col("windows")).otherwise(0))
    return i.groupBy("split").agg(F.count("*").alias("sources"), F.count_if("mass").alias("mass_sources"), F.count_if(F.col("positives") > 0).alias("positive_sources"), F.sum("windows").alias("windows"), clean.alias("clean_windows"), F.max("windows").alias("most_windows"))


@register("with v as (select case when p_size % 7 = 0 then 'Unknown' else p_brand end as vendor, count(*) as n from part group by 1) select vendor, n, cast(k as integer) as place from (select *, row_number() over (order by vendor = 'Unknown', n desc, vendor) as k from v) where k <= 3")
def top_vendors(spark, sf):
    """The three commonest vendors, known ones first."""
    v = table(spark, sf, "part").groupBy(F.when(F.col("p_size") % 7 == 0, "Unknown").otherwise(F.col("p_brand")).alias("vendor")).agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col("vendor") == "Unknown", F.desc("n"), "vendor")  # over the distinct vendors
    return v.withColumn("place", F.row_number().over(order)).where("place <= 3")


@register(f"""with {SRC}, g as (select split, w, h, case when w <= 1024 then 1 else cast(ceil((w - 1024) / 512.0) as bigint) + 1 end * case when h <= 1024 then 1 else cast(ceil((h - 1024) / 512.0) as bigint) + 1 end as crops, 1 as wholes from src)
select split, cast(sum(crops) as bigint) as crops, cast(sum(crops + wholes) as bigint) as images, cast(sum((crops + wholes) * 1024 * 1024 * 3) as bigint) as bytes, cast(ceil(sum((crops + wholes) * 1024 * 1024 * 3) * cast(1.15 as double)) as bigint) as with_safety from g group by split""")
def export_space_estimate(spark, sf):
    """Crops of a padded sliding grid and one whole image a source, three bytes a pixel, with a safety factor."""

    def axis(c: str):
        return F.when(F.col(c) <= 1024, F.lit(1).cast("long")).otherwise(F.ceil((F.col(c) - 1024) / 512.0) + 1)

    g = src(spark, sf).withColumn("crops", axis("w") * axis("h"))
    images = F.sum(F.col("crops") + 1)
    pixels = images * (1024 * 1024 * 3)
    return g.groupBy("split").agg(F.sum("crops").alias("crops"), images.alias("images"), pixels.cast("long").alias("bytes"), F.ceil(pixels * 1.15).cast("long").alias("with_safety"))


@register(f"""with {SRC}, {BOX}, m as (select image_id, mode from src, (values ('none'), ('stretch'), ('fit_pad')) t(mode)),
g as (select image_id, line, mode, bx0, by0, bx1, by1, w, h, case mode when 'none' then 1.0 when 'stretch' then 640.0 / w else least(640.0 / w, 512.0 / h) end as sx, case mode when 'none' then 1.0 when 'stretch' then 512.0 / h else least(640.0 / w, 512.0 / h) end as sy from m join src using (image_id) join box using (image_id)),
p as (select *, case mode when 'fit_pad' then floor((640 - greatest(1, round_even(cast(w * sx as double), 0))) / 2) else 0 end as px, case mode when 'fit_pad' then floor((512 - greatest(1, round_even(cast(h * sy as double), 0))) / 2) else 0 end as py from g)
select mode, count(*) as n, round(sum(cast(bx0 * sx + px as double)), 3) as sx0, round(sum(cast(by0 * sy + py as double)), 3) as sy0, round(sum(cast(bx1 * sx + px as double)), 3) as sx1, round(sum(cast(by1 * sy + py as double)), 3) as sy1 from p group by mode""")
def baseline_resize(spark, sf):
    b = box(spark, sf).join(src(spark, sf), "image_id").withColumn("mode", F.explode(F.array(F.lit("none"), F.lit("stretch"), F.lit("fit_pad"))))
    sx, sy, px, py = G.resize_mapping(F.col("mode"), F.col("w"), F.col("h"), 640, 512)
    ends = [(F.col("bx0") * sx + px, "sx0"), (F.col("by0") * sy + py, "sy0"), (F.col("bx1") * sx + px, "sx1"), (F.col("by1") * sy + py, "sy1")]
    return b.groupBy("mode").agg(F.count("*").alias("n"), *[F.round(F.sum(c), 3).alias(n) for c, n in ends])


@register("""with e as (select user_id, event_id, ts, event_type in ('error', 'purchase') as p from events)
select user_id, event_id, cast(sum(p::int) over w as bigint) as positives, cast(sum((not p)::int) over w as bigint) as negatives, round(cast(avg(p::int) over w as double), 9) as ratio from e window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)""")
def running_provenance(spark, sf):
    """Counts and ratio so far, on every row of a source's stream."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    p = F.col("event_type").isin("error", "purchase").cast("long")
    return table(spark, sf, "events").select("user_id", "event_id", F.sum(p).over(w).alias("positives"), F.sum(1 - p).over(w).alias("negatives"), F.round(F.avg(p).over(w), 9).alias("ratio"))


@register("""with e as (select user_id, event_id, ts, row_number() over (partition by user_id order by ts, event_id) as done, value from events), f as (select *, least(1, done / 40.0) * (case when event_id % 3 = 0 then 0.5 else 1 end) as raw, epoch_us(ts) - min(epoch_us(ts)) over (partition by user_id) as us from e),
m as (select *, max(raw) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as fraction from f)
select user_id, event_id, round(cast(fraction as double), 9) as fraction, case when fraction > 0 and fraction < 1 and us > 0 then round(cast(us / 1e6 * (1 - fraction) / fraction as double), 3) end as eta_seconds from m""")
def progress_eta(spark, sf):
    """A fraction that never falls though reports do, and the time left at the pace so far."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events").withColumn("done", F.row_number().over(w)).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")) - F.min(F.unix_micros(F.col("ts").cast("timestamp"))).over(Window.partitionBy("user_id")))
    raw = F.least(F.lit(1.0), F.col("done") / 40.0) * F.when(F.col("event_id") % 3 == 0, 0.5).otherwise(1.0)
    e = e.withColumn("fraction", F.max(raw).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    eta = F.when((F.col("fraction") > 0) & (F.col("fraction") < 1) & (F.col("us") > 0), F.round(F.col("us") / 1e6 * (1 - F.col("fraction")) / F.col("fraction"), 3))
    return e.select("user_id", "event_id", F.round("fraction", 9).alias("fraction"), eta.alias("eta_seconds"))


# ---- parsing, options and naming -------------------------------------------------------------------


@register("""select p_partkey, case p_size % 3 when 0 then '1024x1024|640x512' when 1 then '640x640' else '' end as names, p_size % 3 = 2 as bad,
 case p_size % 5 when 0 then 'mass_only' when 1 then 'positive_ratio' when 2 then 'source_breast_ratio' when 3 then 'all' else 'mass_only' end as mode,
 sha256('{"brand":"' || p_brand || '","size":' || p_size || '}') as cache_key, case when p_size % 2 = 0 then p_size else 50 end as option from part""")
def parsed_options(spark, sf):
    """Sizes and modes as users type them, a key of the canonical settings, a split's option before the general one."""
    k, five = F.col("p_size") % 3, F.col("p_size") % 5
    sizes = X.parse_sizes(F.when(k == 0, " 1024 ; 640x512").when(k == 1, "640,").otherwise("64 by 64"))
    mode = X.selection_mode(F.when(five == 0, " Positive_Only").when(five == 1, "all mass + sampled non-mass").when(five == 2, "Mass/negative breasts").when(five == 3, "?").otherwise(""), five == 3)
    key = F.sha2(F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))), 256)
    names = F.array_join(F.transform(sizes, lambda s: F.concat_ws("x", s["width"], s["height"])), "|")
    option = F.coalesce(F.when(F.col("p_size") % 2 == 0, F.col("p_size")), F.lit(None).cast("int"), F.lit(50))
    return table(spark, sf, "part").select("p_partkey", F.coalesce(names, F.lit("")).alias("names"), sizes.isNull().alias("bad"), mode.alias("mode"), key.alias("cache_key"), option.alias("option"))


@register(f"""with {SRC}, f as (select image_id, split, (image_id % 11) / 10.0 as fraction from src)
select split, count_if(fraction > 0.5) as strict, count_if(fraction >= 0.5) as inclusive, cast(case split when 'train' then 0 when 'val' then 1 when 'test' then 2 end as bigint) as place from f group by split""")
def fraction_threshold(spark, sf):
    f = src(spark, sf).withColumn("fraction", (F.col("image_id") % 11) / 10.0)
    place = X.ordered_rank(F.col("split"), ["train", "val", "test"]) - 1
    return f.groupBy("split").agg(F.count_if(X.passes(F.col("fraction"), 0.5, "strict")).alias("strict"), F.count_if(X.passes(F.col("fraction"), 0.5)).alias("inclusive")).withColumn("place", place)


@register(f"""with {SRC} select image_id, greatest(16, w) // 16 as grid_w, greatest(16, h) // 16 as grid_h, 5 + (greatest(16, w) // 16) * (greatest(16, h) // 16) as tokens,
  case when image_id % 4 = 0 then 700 else cast(h as bigint) end as known_h from src""")
def feature_shapes(spark, sf):
    """Patch grid and tokens of a model input, four register tokens and a class token, and a size from either of two places."""
    gw, gh, tokens = X.patch_grid(F.col("w"), F.col("h"), 16, 4)
    known = F.when(F.col("image_id") % 4 != 0, F.col("h"))
    return src(spark, sf).select("image_id", gw.alias("grid_w"), gh.alias("grid_h"), tokens.alias("tokens"), X.positive_or(known, F.lit(700)).alias("known_h"))


@register(f"with {BOX}, {SRC} select image_id, line, bx0, by0, case when image_id % 5 = 0 then bx0 else round(bx0 * 512.0 / w, 9) end as sx0, case when image_id % 5 = 0 then by0 else round(by0 * 640.0 / h, 9) end as sy0 from box join src using (image_id)")
def scaled_boxes(spark, sf):
    """Boxes from one shape to another; an unknown shape leaves them."""
    b = box(spark, sf).join(src(spark, sf), "image_id")
    known = F.col("image_id") % 5 != 0
    out = G.scale_boxes(bcols(), (F.when(known, F.col("w")), F.when(known, F.col("h"))), (F.lit(512), F.lit(640)))
    return b.select("image_id", "line", "bx0", "by0", F.round(out[0], 9).alias("sx0"), F.round(out[1], 9).alias("sy0"))


# ---- arrays ----------------------------------------------------------------------------------------


@register("""with e as (select vec_id, cast(unnest(embedding) as double) as x, generate_subscripts(embedding, 1) - 1 as i from embeddings),
b as (select *, min(x) over (partition by vec_id) as lo, max(x) over (partition by vec_id) as hi from e), h as (select vec_id, cast(least(63, floor((x - lo) / nullif(hi - lo, 0) * 64)) as bigint) as bin, count(*) as n from b group by all),
f as (select vec_id, unnest(generate_series(0, 63)) as bin from (select distinct vec_id from e)), p as (select f.vec_id, (coalesce(n, 0) + 1e-12) / (64 + 64e-12) as p from f left join h using (vec_id, bin)),
s as (select vec_id, -sum(p * log2(greatest(p, 1e-12))) / 6 as entropy from p group by vec_id)
select vec_id, round(quantile_cont(x, 0.01), 6) as p1, round(quantile_cont(x, 0.25), 6) as p25, round(median(x), 6) as p50, round(quantile_cont(x, 0.99), 6) as p99, round(avg(x), 6) as mean, round(stddev_pop(x), 6) as std,
 round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) as iqr, round(any_value(entropy), 6) as entropy, round(sum(i * greatest(x, 0)) / nullif(sum(greatest(x, 0)), 0), 6) as centroid from e join s using (vec_id) group by vec_id""")
def array_summary(spark, sf):
    """Percentiles, moments, entropy of the 64-bin histogram and centroid of every array."""
    a = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", R.summary(a, (0.01, 0.25, 0.5, 0.99), 64).alias("s"), R.centroid(a).alias("c")).select(
        "vec_id", *[F.round(F.get("s.percentiles", F.lit(k)), 6).alias(n) for k, n in enumerate(("p1", "p25", "p50", "p99"))], *[F.round(f"s.{n}", 6).alias(n) for n in ("mean", "std", "iqr", "entropy")], F.round("c", 6).alias("centroid")
    )


@register("""with e as (select label, cast(unnest(embedding) as double) as x, generate_subscripts(embedding, 1) as i from embeddings), m as (select label, i, avg(x) as m from e group by all),
s as (select i, stddev_pop(m) as sd, avg(m) as mm from m group by i), d as (select i, avg(abs(m - mm)) as mad from m join s using (i) group by i)
select cast(i as integer) as place, round(case when sd > 1e-8 then sd when mad > 1e-8 then mad else 1 end, 9) as scale from s join d using (i)""")
def feature_scale(spark, sf):
    """A stable scale a place: the standard deviation, else the mean deviation, else 1."""
    m = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    s = m.groupBy("i").agg(F.stddev_pop("m").alias("sd"), F.avg("m").alias("mm"))
    d = m.join(s, "i").groupBy("i", "sd").agg(F.avg(F.abs(F.col("m") - F.col("mm"))).alias("mad"))
    return d.select((F.col("i") + 1).alias("place"), F.round(F.when(F.col("sd") > 1e-8, F.col("sd")).when(F.col("mad") > 1e-8, F.col("mad")).otherwise(1.0), 9).alias("scale"))


@register(f"""with {SRC}, {BOX}, f as (select image_id, count(*) as n, string_agg(category, ',' order by line, category) as categories, cast(sum((bx1 - bx0) * (by1 - by0)) as bigint) as area from (select distinct * from box) group by image_id),
m as (select image_id, count(*) as masses from (select distinct * from box) where category = 'R' group by image_id)
select image_id, '{{"image":{{"id":' || image_id || ',"width":' || w || ',"height":' || h || '}},"findings":[' || coalesce(categories, '') || '],"masses":' || coalesce(masses, 0) || '}}' as document, coalesce(n, 0) as n, coalesce(area, 0) as area from src left join f using (image_id) left join m using (image_id)""")
def nested_targets(spark, sf):
    """An image with its findings and its masses as one nested row; the text is put together from the nested fields."""
    t = J.nested_targets(src(spark, sf), box(spark, sf).distinct(), "image_id", ["line", "category", "bx0", "by0", "bx1", "by1"], F.col("category") == "R")
    listed = F.array_join(F.transform("findings", lambda f: f["category"]), ",")
    area = F.aggregate("findings", F.lit(0).cast("double"), lambda s, f: s + (f["bx1"] - f["bx0"]) * (f["by1"] - f["by0"]))
    document = F.format_string('{"image":{"id":%d,"width":%d,"height":%d},"findings":[%s],"masses":%d}', "image_id", "w", "h", listed, F.size("masses"))
    return t.select("image_id", document.alias("document"), F.size("findings").cast("long").alias("n"), area.cast("long").alias("area"))
