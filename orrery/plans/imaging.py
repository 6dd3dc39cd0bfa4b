"""Queries of image operations, masks and file listings. Vectors of 64 places stand for images of 8 by 8 pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import arrays as R
from orrery.functions import frames as FR
from orrery.functions import geometry as G
from orrery.functions import pixels as P
from orrery.operators import files as L
from orrery.plans.catalog import BOX, SRC, box, register, src, table

_E = "e as (select vec_id, i, i // 8 as y, i % 8 as x, v from (select vec_id, cast(unnest(embedding) as double) as v, generate_subscripts(embedding, 1) - 1 as i from embeddings))"
_NEAR = """o as (select dx, dy from (values (-1), (0), (1)) a(dx), (values (-1), (0), (1)) b(dy)),
s as (select e.*, dx, dy from e, o)"""


def _at(x: str, y: str) -> str:
    return f"e b on b.vec_id = s.vec_id and b.i = ({y}) * 8 + ({x})"


def _windowed(value: str, name: str) -> str:
    return f"round((greatest(least({value}, hi_{name}), lo_{name}) - lo_{name}) / (hi_{name} - lo_{name}), 6) as {name}"


def _images(spark, sf, **steps):
    """A row a pixel with one column for each chain of steps."""
    e = table(spark, sf, "embeddings")
    done = e.select("vec_id", *[P.image_steps(F.col("embedding"), F.lit(8), chain).alias(name) for name, chain in steps.items()])
    return done.select("vec_id", F.posexplode(F.arrays_zip(*steps)).alias("place", "z")).select("vec_id", "place", *[F.round(f"z.{name}", 6).alias(name) for name in steps])


@register(f"""with {_E}, {_NEAR},
r as (select s.vec_id, s.i, sum(b.v * dx * (2 - abs(dy))) as gx, sum(b.v * dy * (2 - abs(dx))) as gy, abs(sum(b.v * case when dx <> 0 and dy <> 0 then 2 when dx = 0 and dy = 0 then -8 else 0 end)) as lap,
  sum(b.v * case when dx = 0 and dy = 0 then 6 when dx = 0 or dy = 0 then -1 else 0 end) / 2 as sharp from s join {_at("7 - abs(7 - abs(s.x + dx))", "7 - abs(7 - abs(s.y + dy))")} group by all),
g as (select *, sqrt(gx * gx + gy * gy) as mag from r),
w as (select vec_id, quantile_cont(mag, 0.01) as lo_sobel, quantile_cont(mag, 0.99) as hi_sobel, quantile_cont(lap, 0.05) as lo_laplacian, quantile_cont(lap, 0.95) as hi_laplacian from g group by vec_id),
m as (select s.vec_id, s.i, median(b.v) as med from s join {_at("greatest(0, least(7, s.x + dx))", "greatest(0, least(7, s.y + dy))")} group by all)
select g.vec_id, cast(g.i as integer) as place, {_windowed("mag", "sobel")}, {_windowed("lap", "laplacian")}, round(sharp, 6) as sharp, round(med, 6) as median from g join w using (vec_id) join m on m.vec_id = g.vec_id and m.i = g.i""")
def image_filters(spark, sf):
    """Gradient, second derivative, sharpening and median of every image."""
    return _images(spark, sf, sobel=[("sobel_gradient", {})], laplacian=[("laplacian", {"percentiles": [5, 95]})], sharp=[("sharpen", {"amount": 2})], median=[("median_blur", {})])


@register(f"""with {_E}, {_NEAR}, inner_ as (select * from s where x + dx between 0 and 7 and y + dy between 0 and 7),
lo as (select s.vec_id, s.i, s.x, s.y, min(b.v) as v from inner_ s join {_at("s.x + dx", "s.y + dy")} group by all), hi as (select s.vec_id, s.i, s.x, s.y, max(b.v) as v from inner_ s join {_at("s.x + dx", "s.y + dy")} group by all),
op as (select s.vec_id, s.i, max(b.v) as v from inner_ s join lo b on b.vec_id = s.vec_id and b.i = (s.y + dy) * 8 + s.x + dx group by all), cl as (select s.vec_id, s.i, min(b.v) as v from inner_ s join hi b on b.vec_id = s.vec_id and b.i = (s.y + dy) * 8 + s.x + dx group by all),
d as (select e.vec_id, e.i, op.v as opened, cl.v as closed, e.v - op.v as top, cl.v - e.v as bottom from e join op on op.vec_id = e.vec_id and op.i = e.i join cl on cl.vec_id = e.vec_id and cl.i = e.i),
w as (select vec_id, quantile_cont(top, 0.01) as lo_tophat, quantile_cont(top, 0.99) as hi_tophat, quantile_cont(bottom, 0.01) as lo_blackhat, quantile_cont(bottom, 0.99) as hi_blackhat from d group by vec_id)
select vec_id, cast(i as integer) as place, round(opened, 6) as opened, round(closed, 6) as closed, {_windowed("top", "tophat")}, {_windowed("bottom", "blackhat")} from d join w using (vec_id)""")
def image_morphology(spark, sf):
    """Opening, closing and their differences from the image under a square of three."""
    o = {"ksize": 3, "kernel_shape": "rect"}
    return _images(spark, sf, opened=[("morphological_open", o)], closed=[("morphological_close", o)], tophat=[("white_tophat", o)], blackhat=[("blackhat", o)])


@register(f"""with {_E}, a as (select vec_id, quantile_cont(v, 0.01) as p1, quantile_cont(v, 0.99) as p99, quantile_cont(v, 0.7) as p70, avg(v) as mean, stddev_pop(v) as std, min(v) as lo, max(v) as hi from e group by vec_id),
t as (select vec_id, avg(v) as tm, stddev_pop(v) as ts from e join a using (vec_id) where v between p1 and p99 group by vec_id),
j as (select *, greatest(least(v, p99), p1) as c, (v - lo) / (hi - lo) as u from e join a using (vec_id) join t using (vec_id)),
k as (select *, count(*) over (partition by vec_id order by c) as cdf, count(*) over (partition by vec_id) as n from j), q as (select *, min(cdf) over (partition by vec_id) as c0 from k)
select vec_id, cast(i as integer) as place, round(c, 6) as clipped, round(greatest(least((v - mean) / std, 3), -3) / 6 + 0.5, 6) as zscore, round(greatest(0, least(1, (v - tm) * (0.2 / ts) + 0.5)), 6) as target,
  round((greatest(v, p70) - p70) / (hi - p70), 6) as upper, round(ln(1 + 5 * u) / ln(6), 6) as log, round(1 - u, 6) as inverted, round((cdf - c0) / (n - c0), 6) as equal from q""")
def image_scalings(spark, sf):
    """Windows, scores, a target mean and deviation, curves and the equalised histogram of every image."""
    names = {"clipped": "percentile_clip_only", "zscore": "zscore_clip", "target": "standardize_to_target", "upper": "aggressive_upper_percentile_normalize", "log": "log", "inverted": "invert", "equal": "hist_equalize"}
    return _images(spark, sf, **{name: [(op, {})] for name, op in names.items()})


@register(f"""with {_E}, m as (select *, v > 0 as hit from e), b as (select vec_id, count_if(hit) as pixels, min(case when hit then x end) as x0, min(case when hit then y end) as y0, max(case when hit then x end) + 1 as x1, max(case when hit then y end) + 1 as y1 from m group by vec_id),
p as (select *, greatest(1, cast(round_even(greatest(x1 - x0, y1 - y0) * 0.1, 0) as bigint)) as pad from b)
select vec_id, pixels, round(pixels / 64.0, 6) as fraction, x0 || ',' || y0 || ',' || x1 || ',' || y1 as bounds, coalesce(y0 = 0, false) as top, coalesce(x1 = 8, false) as "right",
  coalesce(greatest(0, x0 - pad) || ',' || greatest(0, y0 - pad) || ',' || least(8, x1 + pad) || ',' || least(8, y1 + pad), '0,0,8,8') as crop from p""")
def mask_bounds(spark, sf):
    """Size, bounds and touched sides of the mask of positive pixels, and its crop with a padding of a tenth."""
    m = table(spark, sf, "embeddings").select("vec_id", P.mask_metrics(F.transform("embedding", lambda v: v > 0), F.lit(8)).alias("m"))
    bounds = [F.get("m.bbox", F.lit(k)) for k in range(4)]
    crop = G.padded_bounds(bounds, F.lit(8), F.lit(8), 0.1, 1)
    return m.select("vec_id", F.col("m.mask_pixels").alias("pixels"), F.round("m.mask_fraction", 6).alias("fraction"), F.when(F.col("m.bbox").isNotNull(), F.concat_ws(",", *bounds)).alias("bounds"),
        F.col("m.touches_top").alias("top"), F.col("m.touches_right").alias("right"), F.concat_ws(",", *crop).alias("crop"))


# ---- files -----------------------------------------------------------------------------------------


@register(f"""with {SRC} select image_id, '/img/' || study_id || '/' || image_id || case when split = 'train' then '.dicom' when birads = '1-URGENT' then '.dcm' when birads = '2-HIGH' then '' else '.dicom' end as path,
  split = 'train' or birads in ('1-URGENT', '2-HIGH') as found from src""")
def image_paths(spark, sf):
    """The file of every image among three forms of its name, or the first form where there is none."""
    s = src(spark, sf)
    held = F.array_compact(F.array(F.when(F.col("split") == "train", ".dicom"), F.when(F.col("birads") == "1-URGENT", ".dcm"), F.when(F.col("birads") == "2-HIGH", "")))
    listing = s.select("study_id", "image_id", F.explode(held).alias("suffix")).select(F.concat(F.lit("file:/img/"), F.col("study_id"), F.lit("/"), F.col("image_id"), F.col("suffix")).alias("path"))
    return L.resolve_paths(s, listing, "study_id", "image_id", "/img").select("image_id", "path", "found")


@register(f"""with {SRC} select split, case when birads = '1-URGENT' then 'left_only' when birads = '5-LOW' then 'right_only' else 'paired' end as status, count(*) as files from src group by all""")
def tensor_png_pairs(spark, sf):
    """Tensors and previews by split and stem: pairs and what is left on either side."""
    s = src(spark, sf)
    tensors = s.where("birads <> '5-LOW'").select("split", F.concat(F.lit("/t/"), "split", F.lit("/"), "image_id", F.lit(".pt")).alias("path"))
    pngs = s.where("birads <> '1-URGENT'").select("split", F.concat(F.lit("/p/"), "split", F.lit("/"), "image_id", F.lit(".png")).alias("path"))
    return L.pair_files(tensors, pngs, ["split"]).groupBy("split", "status").agg(F.count("*").alias("files"))


@register(f"""with {SRC}, {BOX}, f as (select split, count(*) as images from src group by split), l as (select split, count(distinct image_id) as labels from src join box using (image_id) where category = 'R' group by split)
select split, images, coalesce(labels, 0) as labels, images = coalesce(labels, 0) as images_match from f left join l using (split)""")
def file_sanity(spark, sf):
    """Images and label files by split, and whether they are as many."""
    s = src(spark, sf)
    labelled = s.join(box(spark, sf).where("category = 'R'").select("image_id").distinct(), "image_id", "left_semi")
    listing = s.select("split", F.lit("images").alias("kind"), F.concat("image_id", F.lit(".png")).alias("path")).union(labelled.select("split", F.lit("labels"), F.concat("image_id", F.lit(".txt"))))
    return L.sanity_report(listing, ["split"], {"images": ("images", ".png"), "labels": ("labels", ".txt")})


@register(f"""with {SRC}, d as (select image_id, w, h, w * 0.25 - 200.5 as shift from src)
select image_id, 100 - cast(round_even(shift, 0) as bigint) as y0, 740 - cast(round_even(shift, 0) as bigint) as y1 from d""")
def counterpart_window(spark, sf):
    """A window's rows in the other side's image, which its alignment moves."""
    s = src(spark, sf).withColumn("shift", F.col("w") * 0.25 - 200.5)
    w = G.shifted_window([F.lit(0), F.lit(100), F.lit(640), F.lit(740)], F.col("shift"))
    return s.select("image_id", w[1].alias("y0"), w[3].alias("y1"))


# ---- sizes, windows and channels -------------------------------------------------------------------


@register(f"""with {_E}, t as (select ty, tx from range(3) a(ty), range(5) b(tx)),
p as (select vec_id, ty, tx, v, greatest(0, least(y + 1, (ty + 1) * 8 / 3.0) - greatest(y, ty * 8 / 3.0)) * greatest(0, least(x + 1, (tx + 1) * 8 / 5.0) - greatest(x, tx * 8 / 5.0)) as share from e, t)
select vec_id, cast(ty * 5 + tx as integer) as place, round(sum(v * cast(share as double)) * 15 / 64, 6) as value from p group by vec_id, ty, tx""")
def image_area_resize(spark, sf):
    """Every image at three by five pixels, each the mean of its area."""
    r = table(spark, sf, "embeddings").select("vec_id", F.posexplode(FR.resized(F.col("embedding"), F.lit(8), 3, 5)).alias("place", "value"))
    return r.select("vec_id", "place", F.round("value", 6).alias("value"))


@register(f"""with {_E}, c as (select vec_id, label % 9 - 2 as x0, vec_id % 9 - 3 as y0 from embeddings), g as (select c.*, j, i from c, range(4) a(j), range(4) b(i))
select g.vec_id, cast(j * 4 + g.i as integer) as place, coalesce(round(v, 6), -1) as value, round(count(*) filter (v > 0) over (partition by g.vec_id) / 16.0, 6) as share from g left join e on e.vec_id = g.vec_id and x = x0 + g.i and y = y0 + j""")
def image_windows(spark, sf):
    """A window of four by four of every image, padded where it leaves the image, and the share of it that a mask fills."""
    e = table(spark, sf, "embeddings").withColumn("x0", F.col("label") % 9 - 2).withColumn("y0", F.col("vec_id") % 9 - 3)
    window = R.window_of(F.transform("embedding", lambda v: v.cast("double")), F.lit(8), F.col("x0"), F.col("y0"), 4, F.lit(-1.0))
    share = R.share_in_window(F.transform("embedding", lambda v: v > 0), F.lit(8), F.col("x0"), F.col("y0"), 4)
    out = e.select("vec_id", F.round(share, 6).alias("share"), F.posexplode(window).alias("place", "value"))
    return out.select("vec_id", "place", F.round("value", 6).alias("value"), "share")


@register(f"""with {_E}, r as (select vec_id, min(v) as lo, max(v) as hi from e group by vec_id)
select vec_id, cast(i as integer) as place, cast(round_even(((case when label = 0 then hi + lo - v else v end) - lo) / (hi - lo) * 65535, 0) as integer) as level from e join r using (vec_id) join (select vec_id, label from embeddings) l using (vec_id)""")
def image_levels(spark, sf):
    """16-bit levels of every image, those of label 0 with light and dark exchanged."""
    a = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(R.whole_levels(a, F.col("label") == 0)).alias("place", "level"))


@register(f"""with {_E}, q as (select vec_id, i, v, label, min(v) over (partition by vec_id) as lo, max(v) over (partition by vec_id) as hi from e join (select vec_id, label from embeddings) l using (vec_id))
select vec_id, cast(i as integer) as place, round(v, 6) as r, round(case when label = 0 then 1 - (v - lo) / (hi - lo) else ln(1 + 5 * (v - lo) / (hi - lo)) / ln(6) end, 6) as g, case when label = 0 then '' else 'g' end as fallback
from (select vec_id, i, v, label, lo, hi from q where label <> 0 union all select vec_id, i, -v, label, -hi, -lo from q where label = 0) x""")
def image_channels(spark, sf):
    """Two channels by their own chains; the second one's source is there for label 0 alone, elsewhere the first one's replaces it."""
    e = table(spark, sf, "embeddings")
    same = F.transform("embedding", lambda v: v.cast("double"))
    turned = F.transform(same, lambda v: -v)
    current = F.when(F.col("label") == 0, turned).otherwise(same)
    other = F.when(F.col("label") == 0, turned)
    made = FR.channels({"current": current, "other": other}, F.lit(8), {"r": ("current", []), "g": ("other", [("invert", {})])}, "current")
    plain = FR.channels({"current": current}, F.lit(8), {"g": ("current", [("log", {})])}, "current")
    out = e.select("vec_id", "label", made.alias("m"), plain.alias("p"))
    out = out.select("vec_id", F.array_join("m.fallback", ",").alias("fallback"), F.posexplode(F.arrays_zip(F.col("m.r").alias("r"), F.when(F.col("label") == 0, F.col("m.g")).otherwise(F.col("p.g")).alias("g"))).alias("place", "z"))
    return out.select("vec_id", "place", F.round("z.r", 6).alias("r"), F.round("z.g", 6).alias("g"), "fallback")
