"""The registered queries of the engine's own operators, bound to the graded tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.functions import arrays as R
from orrery.functions import geometry as G
from orrery.functions import scalar as X
from orrery.operators import aggregate as A
from orrery.operators import contracts as V
from orrery.operators import relations as J
from orrery.operators import sampling as S

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

SRC = """src as (select o_orderkey as image_id, o_custkey as study_id, 600 + (o_orderkey * 37) % 1900 as w, 700 + (o_orderkey * 53) % 1700 as h,
  case o_orderstatus when 'F' then 'train' when 'O' then 'val' else 'test' end as split,
  case when o_orderkey % 2 = 0 then 'L' else 'R' end as laterality, case when (o_orderkey // 2) % 2 = 0 then 'CC' else 'MLO' end as view_position,
  o_orderpriority as birads from orders)"""
BOX = """box as (select l_orderkey as image_id, cast((l_partkey * 7) % 1500 as double) as bx0, cast((l_suppkey * 13) % 1300 as double) as by0,
  cast((l_partkey * 7) % 1500 as double) + l_quantity * 4 as bx1, cast((l_suppkey * 13) % 1300 as double) + 1 + l_linenumber * 20 as by1,
  l_returnflag as category, l_linenumber as line from lineitem)"""


def _counts(sql: str) -> str:
    """count_if(x) as a plain count, which is a BIGINT in DuckDB."""
    while (at := sql.find("count_if(")) >= 0:
        end, depth = at + 9, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:at]}count(case when {sql[at + 9 : end - 1]} then 1 end){sql[end:]}"
    return sql


def register(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = _counts(sql)
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def src(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("image_id"), F.col("o_custkey").alias("study_id"), (F.lit(600) + (k * 37) % 1900).alias("w"), (F.lit(700) + (k * 53) % 1700).alias("h"),
        F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "val").otherwise("test").alias("split"),
        F.when(k % 2 == 0, "L").otherwise("R").alias("laterality"), F.when(F.floor(k / 2) % 2 == 0, "CC").otherwise("MLO").alias("view_position"),
        F.col("o_orderpriority").alias("birads"),
    )


def box(spark: SparkSession, sf: str) -> DataFrame:
    x, y = ((F.col("l_partkey") * 7) % 1500).cast("double"), ((F.col("l_suppkey") * 13) % 1300).cast("double")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("image_id"), x.alias("bx0"), y.alias("by0"), (x + F.col("l_quantity") * 4).alias("bx1"),
        (y + 1 + F.col("l_linenumber") * 20).alias("by1"), F.col("l_returnflag").alias("category"), F.col("l_linenumber").alias("line"),
    )


def bcols() -> list:
    return [F.col(c) for c in ("bx0", "by0", "bx1", "by1")]


def wcols() -> list:
    return [F.col(c) for c in ("x0", "y0", "x1", "y1")]


# ---- grids, overlaps and the manifest ---------------------------------------------------------------


def _axis(length: str, size: int, stride: int, policy: str) -> str:
    base = f"generate_series(0, greatest({length} - {size}, 0), {stride})"
    last = f"(greatest({length} - {size}, 0) // {stride}) * {stride}"
    if policy == "edge_align":
        tail = f"case when {length} > {size} and {last} <> {length} - {size} then [{length} - {size}] else [] end"
    else:
        tail = f"case when {length} > {size} and {last} + {size} < {length} and {last} + {stride} < {length} then [{last} + {stride}] else [] end"
    return f"list_concat({base}, {tail})"


def _grid_sql(size: int, stride: int, policy: str) -> str:
    return f"""gy as (select *, unnest({_axis("h", size, stride, policy)}) as y0 from src),
gx as (select *, unnest({_axis("w", size, stride, policy)}) as x0 from gy),
grid as (select *, x0 + {size} as x1, y0 + {size} as y1 from gx)"""


for _policy in ("edge_align", "regular_stride_pad"):

    def _grid_query(spark, sf, policy=_policy):
        return G.grid(src(spark, sf), "w", "h", 1024, 512, policy).select("image_id", "x0", "y0", "x1", "y1")

    register(f"with {SRC}, {_grid_sql(1024, 512, _policy)} select image_id, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, cast(x1 as bigint) as x1, cast(y1 as bigint) as y1 from grid", f"grid_{_policy}")(_grid_query)

_VIS = "greatest(0, least(bx1, x1) - greatest(bx0, x0)) * greatest(0, least(by1, y1) - greatest(by0, y0)) / greatest((bx1 - bx0) * (by1 - by0), 1e-12)"


@register(f"""with {SRC}, {BOX}, {_grid_sql(1024, 512, "edge_align")},
p as (select grid.image_id, x0, y0, {_VIS} as v from grid join box using (image_id))
select image_id, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, count(*) as boxes, count_if(v >= 0.5) as kept, bool_or(v > 0 and v < 1) as cuts_any, round(max(v), 9) as max_visible,
  coalesce(max(v), 0) <= 0.1 as clean from p group by all""")  # fmt: skip
def window_box_overlap(spark, sf):
    pairs = J.grid_boxes(src(spark, sf), box(spark, sf), "image_id", "w", "h", 1024, 512)
    v = F.col("visible")
    return pairs.groupBy("image_id", "x0", "y0").agg(F.count("*").alias("boxes"), F.count_if(v >= 0.5).alias("kept"), F.bool_or((v > 0) & (v < 1)).alias("cuts_any"), F.round(F.max(v), 9).alias("max_visible"), (F.max(v) <= 0.1).alias("clean"))


def candidates(spark, sf, size=640, stride=512, least=0.5, extent=0.1, boxes=None, images=None):
    """Windows with label, extent and eligibility; images and boxes are dealt by image, and no window is."""
    boxes = box(spark, sf) if boxes is None else boxes
    images = src(spark, sf) if images is None else images
    mass = boxes.select("image_id").distinct().withColumn("image_has_mass", F.lit(True))
    hits = J.hits_by_image(src(spark, sf), boxes, "image_id", "w", "h", size, stride, "regular_stride_pad", least)
    images = images.join(mass.hint("merge"), "image_id", "left").join(hits.hint("merge"), "image_id", "left").na.fill(False, ["image_has_mass"])
    out = G.grid(images, "w", "h", size, stride, "regular_stride_pad").withColumn("n_boxes", J.hits_of("hits", F.col("x0"), F.col("y0"))).drop("hits")
    share = G.source_extent(wcols(), F.col("w"), F.col("h"), size)
    out = out.withColumn("positive", F.col("n_boxes") > 0).withColumn("extent", F.round(share * 1e9) / 1e9)  # the SQL's ties: of the product, not of the printed digits
    return out.where(F.col("positive") | (F.col("extent") > extent)).withColumn("window_id", F.concat_ws("_", "image_id", "x0", "y0"))


_CAND = f"""{SRC}, {BOX}, {_grid_sql(640, 512, "regular_stride_pad")},
hit as (select grid.image_id, x0, y0, count(*) as n_boxes from grid join box on grid.image_id = box.image_id and {_VIS} >= 0.5 group by all),
cand as (select grid.*, coalesce(n_boxes, 0) as n_boxes, coalesce(n_boxes, 0) > 0 as positive, m.image_id is not null as image_has_mass,
  round(greatest(0, least(x1, w) - greatest(x0, 0)) * greatest(0, least(y1, h) - greatest(y0, 0)) / 409600.0, 9) as extent,
  concat_ws('_', grid.image_id, x0, y0) as window_id
  from grid left join hit using (image_id, x0, y0) left join (select distinct image_id from box) m on m.image_id = grid.image_id),
ok as (select * from cand where positive or extent > 0.1)"""
_ROWS = "image_id, split, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, n_boxes, positive, cast(extent as double) as extent"


def _rows(df):
    return df.select("image_id", "split", "x0", "y0", "n_boxes", "positive", "extent")


@register(f"""with {_CAND}, r as (select *, row_number() over (partition by split, positive order by md5('7:' || window_id), window_id) as rk,
  count_if(positive) over (partition by split) as pos from ok where positive or not image_has_mass)
select {_ROWS} from r where pos > 0 and (positive or rk <= round_even(pos * 0.25 / 0.75, 0))""")
def lazy_manifest(spark, sf):
    """The first end-to-end slice: grid, overlap, label, extent and a seeded ratio within each split."""
    return _rows(S.positive_ratio(candidates(spark, sf), "positive", 0.75, 7, "window_id", ["split"], ~F.col("image_has_mass")))


@register(f"""with {_CAND}, r as (select *, row_number() over (partition by positive order by md5('9:' || window_id), window_id) as rk, count_if(positive) over () as pos from ok)
select {_ROWS} from r where pos > 0 and (positive or rk <= round_even(pos * 0.1 / 0.9, 0))""")
def positive_ratio(spark, sf):
    return _rows(S.positive_ratio(candidates(spark, sf), "positive", 0.9, 9, "window_id"))


@register(f"""with {_CAND}, r as (select *, row_number() over (partition by split, positive order by md5('5:' || window_id), window_id) as rk, count_if(not positive) over (partition by split) as neg from ok)
select {_ROWS} from r where positive or rk <= round_even(neg * 0.2, 0)""")
def negative_fraction(spark, sf):
    return _rows(S.negative_fraction(candidates(spark, sf), "positive", 0.2, 5, "window_id", ["split"]))


@register(f"""with {SRC}, {BOX}, {_grid_sql(640, 512, "regular_stride_pad")}
select grid.image_id, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, category, line, round({_VIS}, 9) as visible,
  greatest(bx0, x0) - x0 as lx0, greatest(by0, y0) - y0 as ly0, least(bx1, x1) - x0 as lx1, least(by1, y1) - y0 as ly1
from grid join box on grid.image_id = box.image_id and {_VIS} >= 0.5""")
def lazy_annotations(spark, sf):
    pairs = J.grid_boxes(src(spark, sf), box(spark, sf), "image_id", "w", "h", 640, 512, "regular_stride_pad", 0.5)
    o, x, y = G.overlap(bcols(), wcols()), F.col("x0"), F.col("y0")
    return pairs.select("image_id", "x0", "y0", "category", "line", F.round("visible", 9).alias("visible"), (o[0] - x).alias("lx0"), (o[1] - y).alias("ly0"), (o[2] - x).alias("lx1"), (o[3] - y).alias("ly1"))


@register(f"""with {SRC} select split, cast(sum((case when w <= 640 then 1 else cast(ceil((w - 640) / 512.0) as bigint) + 1 end) * (case when h <= 640 then 1 else cast(ceil((h - 640) / 512.0) as bigint) + 1 end)) as bigint) as windows, count(*) as images from src group by split""")
def grid_row_estimate(spark, sf):
    def axis(c):
        return F.when(F.col(c) <= 640, F.lit(1)).otherwise(F.ceil((F.col(c) - 640) / 512.0) + 1)

    return src(spark, sf).groupBy("split").agg(F.sum(axis("w") * axis("h")).cast("long").alias("windows"), F.count("*").alias("images"))


@register(f"""with {SRC}, {BOX}, {_grid_sql(1024, 512, "edge_align")}
select grid.image_id, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, bool_and(bx0 >= x0 + 16 and by0 >= y0 + 16 and bx1 <= x1 - 16 and by1 <= y1 - 16) as all_safe from grid join box using (image_id) group by all""")
def bbox_safe_windows(spark, sf):
    pairs = J.grid_boxes(src(spark, sf), box(spark, sf), "image_id", "w", "h", 1024, 512)
    return pairs.groupBy("image_id", "x0", "y0").agg(F.bool_and(G.inside(bcols(), wcols(), 16)).alias("all_safe"))


@register(f"""with {SRC}, {_grid_sql(1024, 512, "regular_stride_pad")} select image_id, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, cast(greatest(0, -x0) as bigint) as pad_left, cast(greatest(0, -y0) as bigint) as pad_top,
  cast(greatest(0, x1 - w) as bigint) as pad_right, cast(greatest(0, y1 - h) as bigint) as pad_bottom from grid""")
def window_padding(spark, sf):
    names = ("pad_left", "pad_top", "pad_right", "pad_bottom")
    pads = G.window_padding(wcols(), F.col("w"), F.col("h"))
    return G.grid(src(spark, sf), "w", "h", 1024, 512, "regular_stride_pad").select("image_id", "x0", "y0", *[p.cast("long").alias(n) for p, n in zip(pads, names)])


@register(f"""with {SRC}, {_grid_sql(640, 512, "edge_align")}, r as (select *, row_number() over (partition by image_id order by y0, x0) as rk from grid) select image_id, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0 from r where rk <= 3""")
def first_windows(spark, sf):
    g = G.grid(src(spark, sf), "w", "h", 640, 512)
    return J.numbered(g, "rk", ["image_id"], ["y0", "x0"], 1).where("rk <= 3").select("image_id", "x0", "y0")


@register(f"""with {BOX}, {SRC}, s as (select image_id, bx0, by0, bx1, by1, greatest(0, ceil(bx1 + 16 - 640)) as a, least(greatest(w - 640, 0), floor(bx0 - 16)) as b from box join src using (image_id))
select image_id, bx0, by0, bx1, by1, case when a <= b then cast(a as bigint) end as lo, case when a <= b then cast(b as bigint) end as hi from s""")
def safe_origin_interval(spark, sf):
    lo, hi = G.safe_origins(F.col("bx0"), F.col("bx1"), 640, 16, F.greatest(F.col("w") - 640, F.lit(0)))
    return box(spark, sf).join(src(spark, sf), "image_id").select("image_id", "bx0", "by0", "bx1", "by1", lo.alias("lo"), hi.alias("hi"))


# ---- projections, parsing and geometry of boxes ----------------------------------------------------


@register(f"""with {BOX}, {SRC}, g as (select image_id, line, bx0, by0, bx1 - bx0 as box_w, by1 - by0 as box_h, (bx1 - bx0) * (by1 - by0) as area, 100 * (bx1 - bx0) * (by1 - by0) / nullif(w * h, 0) as pct, (bx1 - bx0) / nullif(by1 - by0, 0) as aspect from box join src using (image_id))
select image_id, line, bx0, by0, box_w, box_h, area, round(pct, 9) as area_percent, round(aspect, 9) as aspect,
  case when aspect > 1.33 then 'wide' when aspect < 0.75 then 'tall' when aspect is not null then 'square_like' end as shape,
  case when pct < 0.05 then 'tiny (<0.05%)' when pct < 0.10 then 'very_small (0.05-0.10%)' when pct < 0.50 then 'small (0.10-0.50%)' when pct < 1.00 then 'medium (0.50-1.00%)' when pct is not null then 'large (>=1.00%)' end as size_bin,
  case when sqrt(area) < 32 then 'small' when sqrt(area) < 96 then 'medium' else 'large' end as size_class from g""")
def box_geometry(spark, sf):
    b = box(spark, sf).join(src(spark, sf), "image_id")
    b = b.withColumns({"box_w": F.col("bx1") - F.col("bx0"), "box_h": F.col("by1") - F.col("by0")})
    b = b.withColumn("area", F.col("box_w") * F.col("box_h")).withColumn("pct", F.try_divide(100 * F.col("box_w") * F.col("box_h"), F.col("w") * F.col("h"))).withColumn("aspect0", F.try_divide("box_w", "box_h"))
    return b.select("image_id", "line", "bx0", "by0", "box_w", "box_h", "area", F.round("pct", 9).alias("area_percent"), F.round("aspect0", 9).alias("aspect"), X.shape_group(F.col("aspect0")).alias("shape"), X.size_bin(F.col("pct")).alias("size_bin"), X.box_size_class(F.col("area")).alias("size_class"))


@register(f"with {SRC} select image_id, try_cast(nullif(regexp_extract(birads, '([0-9]+)', 1), '') as integer) as birads_int, case laterality when 'L' then 'R' else 'L' end as other_side, cast(((w + 31) // 32) * 32 as bigint) as w32 from src")
def birads_parse(spark, sf):
    return src(spark, sf).select("image_id", X.first_int(F.col("birads")).alias("birads_int"), X.opposite_side(F.col("laterality")).alias("other_side"), X.round_up(F.col("w"), 32).alias("w32"))


@register("""with d as (select p_partkey, 'DENSITY ' || chr(cast(65 + p_size % 5 as integer)) as t from part)
select p_partkey, t, cast(case t when 'DENSITY A' then 0 when 'DENSITY B' then 1 when 'DENSITY C' then 2 when 'DENSITY D' then 3 end as integer) as density from d""")
def density_parse(spark, sf):
    t = F.concat(F.lit("DENSITY "), F.chr((F.lit(65) + F.col("p_size") % 5).cast("long")))
    return table(spark, sf, "part").select("p_partkey", t.alias("t"), X.density_code(t).alias("density"))


@register("""with d as (select p_partkey, case p_size % 4 when 0 then '[''Mass'', ''Skin Retraction'']' when 1 then 'mass, Nothing' when 2 then '["Calcification"]' else '[]' end as t from part)
select p_partkey, case p_size % 4 when 0 then 'Mass|Skin Retraction' when 1 then 'mass|Nothing' when 2 then 'Calcification' else '' end as names,
  case p_size % 4 when 0 then '1|9' when 1 then '' when 2 then '2' else '' end as ids, p_size % 4 in (0, 1) as has_mass from part""")
def category_list_parse(spark, sf):
    k = F.col("p_size") % 4
    t = F.when(k == 0, "['Mass', 'Skin Retraction']").when(k == 1, "mass, Nothing").when(k == 2, '["Calcification"]').otherwise("[]")
    names = X.parse_list(t)
    return table(spark, sf, "part").select("p_partkey", F.array_join(names, "|").alias("names"), F.array_join(X.category_ids(names), "|").alias("ids"), X.has_category(names, "Mass").alias("has_mass"))


@register("""select p_partkey, case p_size % 3 when 0 then 'Acme / ' || p_brand when 1 then p_brand else 'Unknown' end as vendor,
  regexp_replace(p_name || '!', '[^A-Za-z0-9_.-]+', '_', 'g') as safe, 'img_' || p_partkey as stem, md5('3:' || p_partkey) as seeded from part""")
def vendor_label(spark, sf):
    k = F.col("p_size") % 3
    path = F.concat(F.lit("a\\b/img_"), F.col("p_partkey").cast("string"), F.lit(".dcm"))
    label = X.vendor_label(F.when(k == 0, "Acme").when(k == 1, " none ").otherwise(""), F.when(k < 2, F.col("p_brand")))
    return table(spark, sf, "part").select("p_partkey", label.alias("vendor"), X.safe_name(F.concat("p_name", F.lit("!"))).alias("safe"), X.path_stem(path).alias("stem"), X.seeded_order(3, F.col("p_partkey")).alias("seeded"))


@register("""with c as (select event_id, case event_id % 5 when 0 then ' Yes' when 1 then 'NaN' when 2 then '0' when 3 then '12.0' else ' 7 ' end as t from events)
select event_id, case when lower(trim(t)) not in ('', 'nan', 'none', 'null') then trim(t) end as txt, case when lower(trim(t)) not in ('', 'nan', 'none', 'null') then lower(trim(t)) in ('1', 'true', 'yes', 'on') end as flag,
  case event_id % 5 when 2 then 0 when 3 then 12 when 4 then 7 end as num from c""")
def clean_scalars(spark, sf):
    k = F.col("event_id") % 5
    t = F.when(k == 0, " Yes").when(k == 1, "NaN").when(k == 2, "0").when(k == 3, "12.0").otherwise(" 7 ")
    number = F.when(~F.lower(F.trim(t)).isin("nan"), X.clean_int(t))
    return table(spark, sf, "events").select("event_id", X.clean_text(t).alias("txt"), X.clean_bool(t).alias("flag"), number.alias("num"))


@register(f"""with {SRC}, {BOX}, t as (select image_id, line, bx0, by0, bx1, by1, least(greatest((bx0 + 8) * 512.0 / (w + 16), 0), 512) as vx0, least(greatest((by0 + 4) * 640.0 / (h + 8), 0), 640) as vy0, least(greatest((bx1 + 8) * 512.0 / (w + 16), 0), 512) as vx1, least(greatest((by1 + 4) * 640.0 / (h + 8), 0), 640) as vy1 from box join src using (image_id))
select image_id, line, bx0, by0, bx1, by1, round(vx0, 6) as vx0, round(vy0, 6) as vy0, round(vx1, 6) as vx1, round(vy1, 6) as vy1 from t where round(vx1, 6) > round(vx0, 6) and round(vy1, 6) > round(vy0, 6)""")
def whole_variant_boxes(spark, sf):
    b = box(spark, sf).join(src(spark, sf), "image_id")
    out = G.pad_scale_clamp(bcols(), (F.lit(8), F.lit(4)), (F.lit(512.0) / (F.col("w") + 16), F.lit(640.0) / (F.col("h") + 8)), (F.lit(512), F.lit(640)))
    names = ("vx0", "vy0", "vx1", "vy1")
    b = b.withColumns({n: F.round(c, 6) for n, c in zip(names, out)}).where("vx1 > vx0 and vy1 > vy0")
    return b.select("image_id", "line", "bx0", "by0", "bx1", "by1", *names)


@register(f"""with {SRC}, l as (select image_id, least(1024.0 / h, 1024.0 / w) as s, h, w from src), m as (select *, greatest(cast(floor(h * s + 0.5) as bigint), 1) as ch, greatest(cast(floor(w * s + 0.5) as bigint), 1) as cw from l)
select image_id, round(cast(s as double), 9) as scale, ch as content_h, cw as content_w, (1024 - cw) // 2 as pad_left, (1024 - ch) // 2 as pad_top, 1024 - cw - (1024 - cw) // 2 as pad_right, 1024 - ch - (1024 - ch) // 2 as pad_bottom from m""")
def letterbox_geometry(spark, sf):
    g = G.letterbox(F.col("h"), F.col("w"), 1024)
    return src(spark, sf).select("image_id", *[(F.round(c, 9) if n == "scale" else c).alias(n) for n, c in g.items()])


@register(f"""with {SRC}, c as (select cast(((max(h) + 31) // 32) * 32 as bigint) as ch, cast(((max(w) + 31) // 32) * 32 as bigint) as cw from src), v as (select unnest([512, 640, 800, 1024]) as height, ch, cw from c)
select cast(height as bigint) as height, ch as canvas_h, cw as canvas_w, cast(floor(height * cw / ch + 0.5) as bigint) as content_w, ((cast(floor(height * cw / ch + 0.5) as bigint) + 31) // 32) * 32 as width from v""")
def global_pad_plan(spark, sf):
    ch, cw = G.canvas(F.max("h"), F.max("w"))
    one = src(spark, sf).agg(ch.alias("canvas_h"), cw.alias("canvas_w")).withColumn("height", F.explode(F.array(*[F.lit(x).cast("long") for x in (512, 640, 800, 1024)])))
    one = one.withColumn("content_w", G.variant_width(F.col("height"), F.col("canvas_h"), F.col("canvas_w")))
    return one.select("height", "canvas_h", "canvas_w", "content_w", X.round_up(F.col("content_w"), 32).alias("width"))


@register(f"with {BOX}, {SRC} select count(*) as n, cast(0 as double) as worst from box join src using (image_id)")
def mirror_restore_roundtrip(spark, sf):
    b = box(spark, sf).join(src(spark, sf), "image_id")
    m = G.mirror(bcols(), F.col("w"))
    back = G.restore(m, F.lit(True), F.col("w"), F.lit(0.0), F.lit(0.0))
    worst = F.greatest(*[F.abs(x - y) for x, y in zip(back, bcols())])
    return b.agg(F.count("*").alias("n"), F.max(worst).alias("worst"))


@register(f"""with {BOX}, {SRC}, r as (select image_id, bx0, by0, bx1, by1, w, h, row_number() over (partition by split order by image_id, line, bx0, by0, bx1, by1) as annotation_id, split from box join src using (image_id) where bx1 > bx0 and by1 > by0)
select split, annotation_id, image_id, bx0 as x, by0 as y, bx1 - bx0 as width, by1 - by0 as height, (bx1 - bx0) * (by1 - by0) as area,
 round((bx0 + bx1) / 2 / w, 10) as cx, round((by0 + by1) / 2 / h, 10) as cy from r""")
def coco_annotations(spark, sf):
    b = box(spark, sf).join(src(spark, sf), "image_id").where("bx1 > bx0 and by1 > by0")
    b = J.numbered_by_range(b, "annotation_id", ["split"], "image_id", ["line", "bx0", "by0", "bx1", "by1"], 1)
    w, h = F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0")
    return b.select("split", "annotation_id", "image_id", F.col("bx0").alias("x"), F.col("by0").alias("y"), w.alias("width"), h.alias("height"), (w * h).alias("area"), F.round((F.col("bx0") + F.col("bx1")) / 2 / F.col("w"), 10).alias("cx"), F.round((F.col("by0") + F.col("by1")) / 2 / F.col("h"), 10).alias("cy"))


# ---- joins -----------------------------------------------------------------------------------------


@register(f"""with {SRC}, {BOX} select src.image_id, split, count(box.image_id) as n_masses, cast(coalesce(sum((bx1 - bx0) * (by1 - by0)), 0) as double) as area, count(box.image_id) > 0 as has_mass from src left join box using (image_id) group by all""")
def image_mass_counts(spark, sf):
    a = box(spark, sf).groupBy("image_id").agg(F.count("*").alias("n_masses"), F.sum((F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0"))).alias("area"))
    out = src(spark, sf).join(a, "image_id", "left").na.fill(0, ["n_masses"]).na.fill(0.0, ["area"])
    return out.select("image_id", "split", "n_masses", "area", (F.col("n_masses") > 0).alias("has_mass"))


@register("""select d.doc_id, case when l.doc_id is not null then l.quality else m.q end as quality from documents d left join labels l on l.doc_id = d.doc_id
left join (select lang, max(quality) as q from documents join labels using (doc_id) group by lang) m on m.lang = d.lang""")
def metadata_fallback(spark, sf):
    docs, labels = table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels")
    by_lang = docs.join(labels, "doc_id").groupBy("lang").agg(F.max("quality").alias("quality"))
    return J.with_fallback(docs, labels, by_lang, ["doc_id"], ["lang"], ["quality"]).select("doc_id", "quality")


@register(f"""with {SRC}, o as (select study_id, view_position, laterality, max(image_id) as other_id from src group by all)
select s.image_id, o.other_id from src s left join o on o.study_id = s.study_id and o.view_position = s.view_position and o.laterality <> s.laterality""")
def contralateral_pairs(spark, sf):
    return J.contralateral(src(spark, sf), "study_id", "view_position", "laterality", "image_id").select("image_id", "other_id")


@register("""with v as (select p_type, p_partkey, p_size, row_number() over (partition by p_type order by case when p_size = 25 then 0 when p_size % 2 = 0 then 1 else 2 end, p_size desc, p_partkey) as r from part)
select p.p_partkey, v.p_partkey as context_id, v.p_size as context_size from part p left join v on v.p_type = p.p_type and r = 1""")
def resized_context_argmax(spark, sf):
    part = table(spark, sf, "part")
    tier = F.when(F.col("p_size") == 25, 0).when(F.col("p_size") % 2 == 0, 1).otherwise(2)
    best = part.select("p_type", F.col("p_partkey").alias("context_id"), F.col("p_size").alias("context_size"), tier.alias("tier"))
    return J.best_match(part.select("p_partkey", "p_type"), best, ["p_type"], [F.col("tier"), F.desc("context_size"), F.col("context_id")], ["context_id", "context_size"]).drop("p_type")


@register("with u as (select c_nationkey, min(c_custkey) as c_custkey from customer group by c_nationkey having count(*) = 1) select s_suppkey, u.c_custkey from supplier left join u on s_nationkey = c_nationkey")
def unique_key_match(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("s_nationkey"), "c_custkey")
    return J.unique_key_join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), customers, ["s_nationkey"], ["c_custkey"]).select("s_suppkey", "c_custkey")


@register("select doc_id, d.doc_id is not null as in_documents, l.doc_id is not null as in_labels from (select distinct doc_id from documents) d full join (select distinct doc_id from labels) l using (doc_id)")
def png_float_outer(spark, sf):
    return J.presence(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"], ("in_documents", "in_labels"))


@register(f"""with {SRC}, {BOX} select s.split, count(*) as before, count_if(b.image_id is not null) as after from src s left join (select distinct image_id from box where category = 'R') b using (image_id) group by s.split""")
def vendor_filter_counts(spark, sf):
    all_ = src(spark, sf)
    kept = all_.join(box(spark, sf).where("category = 'R'").select("image_id").distinct(), "image_id", "left_semi")
    a, b = all_.groupBy("split").agg(F.count("*").alias("before")), kept.groupBy("split").agg(F.count("*").alias("after"))
    return a.join(b, "split", "left").na.fill(0, ["after"])


@register(f"with {SRC}, {BOX} select image_id from src where image_id not in (select image_id from box)")
def images_without_boxes(spark, sf):
    return src(spark, sf).select("image_id").join(box(spark, sf), "image_id", "left_anti")


@register("select a.label as a, b.label as b, round(abs(a.m - b.m), 6) as gap from (select label, avg(embedding[1]) as m from embeddings group by label) a join (select label, avg(embedding[1]) as m from embeddings group by label) b on a.label < b.label")
def unordered_pairs(spark, sf):
    m = table(spark, sf, "embeddings").groupBy("label").agg(F.avg(F.get("embedding", F.lit(0))).alias("m"))  # ten labels
    a, b = m.select(F.col("label").alias("a"), F.col("m").alias("ma")), m.select(F.col("label").alias("b"), F.col("m").alias("mb"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", F.round(F.abs(F.col("ma") - F.col("mb")), 6).alias("gap"))


@register("with e as (select *, json_extract_string(props, '$.k') as k, event_type as t, lag(event_id) over w as p, lag(json_extract_string(props, '$.k')) over w as ok, lag(event_type) over w as ot from events window w as (partition by user_id order by ts, event_id)), x as (select user_id, event_id, 'k' as field, ok as old, k as new, p from e union all select user_id, event_id, 'event_type', ot, t, p from e) select user_id, event_id, field, old, new from x where p is not null and old is distinct from new")
def manifest_diff(spark, sf):
    e = table(spark, sf, "events")
    return J.changed_fields(e, "user_id", ["ts", "event_id"], {"k": F.get_json_object("props", "$.k"), "event_type": F.col("event_type")}).drop("ts")


# ---- windows, limits and set operations -----------------------------------------------------------

for _name, _direction in (("first_per_key", "asc"), ("last_per_key", "desc")):

    def _per_key(spark, sf, direction=_direction):
        e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
        order = [F.col("ts"), F.col("event_id")] if direction == "asc" else [F.desc("ts"), F.desc("event_id")]
        return J.first_per_key(e, ["user_id", "event_type"], order).select("user_id", "event_type", "event_id", "value")

    register(f"select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts {_direction}, event_id {_direction}) as r from events) where r = 1", _name)(_per_key)


@register(f"with {SRC} select image_id, split, row_number() over (partition by split order by image_id) - 1 as in_split, row_number() over (order by image_id) - 1 as overall from src")
def cumcount_split(spark, sf):
    s = src(spark, sf).select("image_id", "split")
    return J.numbered_by_range(J.numbered_by_range(s, "in_split", ["split"], "image_id"), "overall", [], "image_id")


@register("with c as (select source, count(*) as n from documents group by source), r as (select *, row_number() over (order by n desc, source) as k from c) select case when k <= 5 then source else 'other' end as value, cast(sum(n) as bigint) as n from r group by 1")
def topn_other(spark, sf):
    return A.top_and_other(table(spark, sf, "documents"), "source", 5)


@register("with n as (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as i, event_type in ('view', 'click') as f from events), g as (select user_id, i, i - row_number() over (partition by user_id order by i) as isl from n where f), r as (select user_id, min(i) as start, count(*) as length from g group by user_id, isl) select user_id, start, length from (select *, row_number() over (partition by user_id order by length desc, start) as k from r) where k = 1")
def longest_run(spark, sf):
    e = J.numbered(table(spark, sf, "events"), "i", ["user_id"], ["ts", "event_id"], 1).withColumn("f", F.col("event_type").isin("view", "click"))
    return R.longest_run(e, "user_id", "i", "f")


@register("with n as (select user_id, event_id, value, event_type <> 'error' as ok, row_number() over (partition by user_id order by ts, event_id) as i from events) select user_id, event_id, round(avg(case when ok then value end) over (partition by user_id order by i rows between 2 preceding and 2 following), 6) as smooth from n")
def moving_average(spark, sf):
    e = J.numbered(table(spark, sf, "events"), "i", ["user_id"], ["ts", "event_id"], 1).withColumn("ok", F.col("event_type") != "error")
    return R.moving_average(e, "user_id", "i", "value", "ok", 5).select("user_id", "event_id", F.round("smooth", 6).alias("smooth"))


@register("with e as (select label, cast(floor(embedding[1] * 4) as bigint) as level, count(*) as n from embeddings group by all), c as (select *, sum(n) over (partition by label order by level) as cdf from e), f as (select *, min(cdf) over (partition by label) as lo, max(cdf) over (partition by label) as hi from c) select label, level, round(case when hi > lo then (cdf - lo) / (hi - lo) else 0 end, 9) as mapped from f")
def ecdf_equalize(spark, sf):
    e = table(spark, sf, "embeddings").groupBy("label", F.floor(F.get("embedding", F.lit(0)) * 4).alias("level")).agg(F.count("*").alias("n"))
    e = e.withColumn("cdf", F.sum("n").over(Window.partitionBy("label").orderBy("level")))
    w = Window.partitionBy("label")
    lo, hi = F.min("cdf").over(w), F.max("cdf").over(w)
    return e.select("label", "level", F.round(F.when(hi > lo, (F.col("cdf") - lo) / (hi - lo)).otherwise(0.0), 9).alias("mapped"))


@register(f"with {SRC}, {BOX} select split as split, 'src' as origin, count(*) as n from src group by split union all select category, 'box', count(*) from box group by category")
def union_by_name(spark, sf):
    a = src(spark, sf).groupBy("split").agg(F.count("*").alias("n")).withColumn("origin", F.lit("src"))
    b = box(spark, sf).groupBy(F.col("category").alias("split")).agg(F.count("*").alias("n")).withColumn("origin", F.lit("box"))
    return J.union_by_name([a, b])


@register(f"with {SRC}, {BOX} select distinct study_id from src where image_id in (select image_id from box where category = 'R') intersect select distinct study_id from src where split = 'val' except select study_id from src where split = 'test'")
def set_operations(spark, sf):
    s, r = src(spark, sf), box(spark, sf).where("category = 'R'").select("image_id").distinct()
    left = s.join(r, "image_id", "left_semi").select("study_id")
    return left.intersect(s.where("split = 'val'").select("study_id")).subtract(s.where("split = 'test'").select("study_id"))


@register("with r as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice, l_discount, row_number() over (order by abs(l_discount - 0.05), l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice) as near, row_number() over (order by l_extendedprice, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate) as low, row_number() over (order by l_extendedprice desc, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate) as high from lineitem) select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, case when near <= 3 then 1 when low <= 2 then 2 else 3 end as priority from r where near <= 3 or low <= 2 or high <= 2")
def representative_rows(spark, sf):
    """Rows by ranked top-k lists (each a distributed top-k), kept at their first reason."""
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    t = table(spark, sf, "lineitem").select(*ids, "l_extendedprice", "l_discount")
    lists = [(F.abs(F.col("l_discount") - 0.05), 3, True), (F.col("l_extendedprice"), 2, False), (F.desc("l_extendedprice"), 2, False)]
    tops = [t.orderBy(c, *ids, *(["l_extendedprice"] if more else [])).limit(n).withColumn("priority", F.lit(k)) for k, (c, n, more) in enumerate(lists, 1)]
    return J.union_by_name(tops).groupBy(*ids, "l_extendedprice").agg(F.min("priority").alias("priority")).drop("l_shipdate")


@register("select doc_id, source, lang from documents where lang in ('en', 'fr') and contains(lower(concat_ws(' ', source, lang, text)), 'tion the') ")
def search_filter(spark, sf):
    d = table(spark, sf, "documents").where(F.col("lang").isin("en", "fr"))
    return d.where(F.contains(F.lower(F.concat_ws(" ", "source", "lang", "text")), F.lit("tion the"))).select("doc_id", "source", "lang")


# ---- aggregations ----------------------------------------------------------------------------------


@register("select l_returnflag, l_linestatus, count(l_extendedprice) as n, round(avg(l_extendedprice), 6) as mean, round(coalesce(stddev_samp(l_extendedprice), 0), 6) as std, min(l_extendedprice) as min, round(quantile_cont(l_extendedprice, 0.25), 6) as p25, round(median(l_extendedprice), 6) as median, round(quantile_cont(l_extendedprice, 0.75), 6) as p75, max(l_extendedprice) as max from lineitem group by all")
def describe_by_group(spark, sf):
    d = A.describe(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return d.select("l_returnflag", "l_linestatus", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 6).alias(c) for c in ("p25", "median", "p75")], "max")


@register("select coalesce(cast(quality as varchar), 'Unknown') as value, count(*) as n from documents left join labels using (doc_id) group by 1")
def value_counts_unknown(spark, sf):
    return A.value_counts(table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left"), "quality")


@register(f"""with {BOX}, s as (select greatest(bx1 - bx0, by1 - by0) as side from box), u as (select greatest(max(bx1) - min(bx0), max(by1) - min(by0)) as side from box group by image_id), a as (select 'box' as kind, side from s union all select 'image', side from u)
select kind, count(*) as n, round(quantile_cont(side, 0.9), 6) as q90, round(quantile_cont(side, 0.95), 6) as q95, round(quantile_cont(side, 0.99), 6) as q99, max(side) as max_side, round(avg(case when side <= 640 then 100.0 else 0 end), 6) as fits_percent from a group by kind""")
def crop_size_fit(spark, sf):
    b = box(spark, sf)
    each = b.select(F.lit("box").alias("kind"), F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0")).alias("side"))
    union = b.groupBy("image_id").agg(F.greatest(F.max("bx1") - F.min("bx0"), F.max("by1") - F.min("by0")).alias("side")).select(F.lit("image").alias("kind"), "side")
    both, names = each.unionByName(union), ("q90", "q95", "q99")
    q = A.quantiles(both, ["kind"], F.col("side"), dict(zip(names, (0.9, 0.95, 0.99))))
    fits = F.avg(F.when(F.col("side") <= 640, 100.0).otherwise(0.0))
    out = both.groupBy("kind").agg(F.count("*").alias("n"), F.max("side").alias("max_side"), F.round(fits, 6).alias("fits_percent"))
    return out.join(q, "kind").select("kind", "n", *[F.round(c, 6).alias(c) for c in names], "max_side", "fits_percent")


@register(f"""with {BOX}, {SRC}, b as (select split, bx1 - bx0 as bw, by1 - by0 as bh from box join src using (image_id)), g as (select coalesce(split, 'all') as scope, count(*) as boxes, count_if(bw <= 120 and bh <= 100) as fit, count_if(bw > 120 and bh > 100) as too_both, count_if(bw > 120 and bh <= 100) as too_wide, count_if(bw <= 120 and bh > 100) as too_tall, median(greatest(bw, bh)) as median_side, round(quantile_cont(greatest(bw, bh), 0.95), 6) as p95_side from b group by rollup(split))
select l.scope, coalesce(boxes, 0) as boxes, coalesce(fit, 0) as fit, coalesce(too_both, 0) as too_both, coalesce(too_wide, 0) as too_wide, coalesce(too_tall, 0) as too_tall, median_side, p95_side from (values ('all'), ('train'), ('val'), ('test'), ('extra')) l(scope) left join g using (scope)""")
def annotation_fit_summary(spark, sf):
    b = box(spark, sf).join(src(spark, sf).select("image_id", "split"), "image_id").withColumns({"box_w": F.col("bx1") - F.col("bx0"), "box_h": F.col("by1") - F.col("by0")})
    return A.fit_summary(b, "split", ["train", "val", "test", "extra"], 120, 100).withColumn("p95_side", F.round("p95_side", 6))


@register(f"""with {SRC}, {BOX}, i as (select src.image_id, split, count(box.image_id) as n from src left join box using (image_id) group by all)
select split, count(*) as images, count_if(n > 0) as positives, cast(sum(n) as bigint) as boxes, round(100.0 * count_if(n > 0) / count(*), 6) as positive_percent, round(avg(n), 6) as mean_boxes from i group by split""")
def split_summary(spark, sf):
    n = box(spark, sf).groupBy("image_id").agg(F.count("*").alias("n"))
    i = src(spark, sf).join(n, "image_id", "left").na.fill(0, ["n"])
    pos = F.count_if(F.col("n") > 0)
    return i.groupBy("split").agg(F.count("*").alias("images"), pos.alias("positives"), F.sum("n").alias("boxes"), F.round(100.0 * pos / F.count("*"), 6).alias("positive_percent"), F.round(F.avg("n"), 6).alias("mean_boxes"))


@register(f"with {_CAND}, g as (select split, count(*) as windows, count_if(positive) as positives, count(distinct image_id) as sources from ok group by split) select l.split, coalesce(windows, 0) as windows, coalesce(positives, 0) as positives, coalesce(sources, 0) as sources, round(positives / nullif(windows, 0), 9) as positive_share from (values ('train'), ('val'), ('test'), ('extra')) l(split) left join g using (split)")
def split_coverage(spark, sf):
    c = candidates(spark, sf).groupBy("split").agg(F.count("*").alias("windows"), F.count_if("positive").alias("positives"), F.count_distinct("image_id").alias("sources"))
    listed = spark.createDataFrame([(s,) for s in ("train", "val", "test", "extra")], "split string")
    share = F.round(F.try_divide("positives", "windows"), 9)
    return listed.join(c, "split", "left").withColumn("positive_share", share).na.fill(0, ["windows", "positives", "sources"])


@register("select size, count(*) as n from (select user_id, count(*) as size from events group by user_id) group by size")
def crops_per_source_hist(spark, sf):
    return A.count_of_counts(table(spark, sf, "events"), "user_id")


@register(f"""with {BOX}, b as (select category, (bx1 - bx0) * (by1 - by0) as area from box), c as (select category, case when sqrt(area) < 32 then 'small' when sqrt(area) < 96 then 'medium' else 'large' end as size_class, count(*) as n, round(median(area), 6) as median_area, round(quantile_cont(area, 0.1), 6) as p10, round(quantile_cont(area, 0.9), 6) as p90 from b group by all)
select *, round(n * 100.0 / sum(n) over (partition by category), 6) as percent from c""")
def coco_size_stats(spark, sf):
    b = box(spark, sf).select("category", ((F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0"))).alias("area")).withColumn("size_class", X.box_size_class(F.col("area")))
    q = A.quantiles(b, ["category", "size_class"], F.col("area"), {"median_area": 0.5, "p10": 0.1, "p90": 0.9})
    c = b.groupBy("category", "size_class").agg(F.count("*").alias("n")).join(q, ["category", "size_class"])
    c = c.select("category", "size_class", "n", *[F.round(x, 6).alias(x) for x in ("median_area", "p10", "p90")])
    return c.withColumn("percent", F.round(A.percent_of(["category"], F.col("n")), 6))


@register(f"with {SRC}, {BOX}, m as (select distinct image_id from box where category = 'R') select s.image_id, m.image_id is not null as image_has_mass, bool_or(m.image_id is not null) over (partition by study_id, laterality) as breast_has_mass from src s left join m using (image_id)")
def breast_status(spark, sf):
    m = box(spark, sf).where("category = 'R'").select("image_id").distinct().withColumn("image_has_mass", F.lit(True))
    s = src(spark, sf).join(m, "image_id", "left").na.fill(False, ["image_has_mass"])
    return s.select("image_id", "image_has_mass", F.bool_or("image_has_mass").over(Window.partitionBy("study_id", "laterality")).alias("breast_has_mass"))


@register("select label, count(*) as n, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as std, min(v) as min, max(v) as max from (select label, cast(unnest(embedding) as double) as v from embeddings) group by label")
def channel_moments(spark, sf):
    m = A.moments(table(spark, sf, "embeddings"), ["label"], "embedding")
    return m.select("label", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"))


@register("select event_type, least(19, cast(floor((value - 0) / 5.0) as bigint)) as bin, count(*) as n from events where value >= 0 and value <= 100 group by all")
def value_histogram(spark, sf):
    return A.histogram(table(spark, sf, "events"), ["event_type"], "value", 0.0, 100.0, 20)


@register(f"""with {SRC} select split, cast(sum(w * h * 3) as bigint) as bytes, cast(sum(ceil(w * h * 3 / 131072.0) * 131072) as bigint) as allocated, cast(sum(ceil(w * h * 3 * cast(1.1 as double))) as bigint) as with_reserve from src group by split""")
def storage_estimate(spark, sf):
    b = F.col("w") * F.col("h") * 3
    return src(spark, sf).groupBy("split").agg(F.sum(b).cast("long").alias("bytes"), F.sum(F.ceil(b / 131072.0) * 131072).cast("long").alias("allocated"), F.sum(F.ceil(b * 1.1)).cast("long").alias("with_reserve"))


@register("select event_type as name, count(*) as n, round(sum(value), 4) as total, round(avg(value), 6) as mean, max(value) as max from events group by 1")
def profile_timers(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("n"), F.round(F.sum(v), 4).alias("total"), F.round(F.avg(v), 6).alias("mean"), F.max(v).alias("max"))


@register("select user_id, event_type as state, event_id from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1")
def job_latest_state(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id").agg(F.max_by(F.struct("event_type", "event_id"), F.struct("ts", "event_id")).alias("s"))
    return e.select("user_id", F.col("s.event_type").alias("state"), F.col("s.event_id").alias("event_id"))


# ---- splits, samples and balancing -----------------------------------------------------------------


@register(f"""with {SRC}, g as (select study_id, study_id % 5 = 0 as t from src group by study_id), r as (select *, row_number() over (partition by t order by md5('123:' || study_id), study_id) as k, count(*) over (partition by t) as n from g)
select image_id, src.study_id, case when t then 'test' when k <= case when n > 1 then greatest(1, round_even(n * 0.15, 0)) else 0 end then 'val' else 'train' end as export_split from src join r using (study_id)""")
def group_split_hash(spark, sf):
    official = F.when(F.col("study_id") % 5 == 0, " Test ").otherwise("training")
    return S.group_split(src(spark, sf), "study_id", official, 0.15, 123).select("image_id", "study_id", "export_split")


_STRATA = f"""{SRC}, st as (select study_id, string_agg(distinct lower(trim(birads)), '|' order by lower(trim(birads))) as stratum from src group by study_id),
z as (select stratum, count(*) as size from st group by stratum), e as (select *, 40.0 * size / sum(size) over () as exact, least(size, floor(40.0 * size / sum(size) over ())) as base from z),
q as (select *, base < size as op, 40 - sum(base) over () as lft, row_number() over (partition by base < size order by exact - base desc, stratum) as place from e),
quota as (select stratum, size, cast(base + case when op and place <= lft then 1 else 0 end as bigint) as quota from q)"""


def _strata(spark, sf):
    label = F.concat_ws("|", F.array_sort(F.collect_set(F.lower(F.trim("birads")))))
    return src(spark, sf).groupBy("study_id").agg(label.alias("stratum"))


@register(f"with {_STRATA} select * from quota")
def stratum_quotas(spark, sf):
    return S.stratified_quota(_strata(spark, sf), "stratum", 40)


@register(f"with {_STRATA}, r as (select *, row_number() over (partition by stratum order by md5('11:' || study_id), study_id) as k from st) select study_id, r.stratum from r join quota using (stratum) where k <= quota")
def stratified_split(spark, sf):
    return S.stratified_sample(_strata(spark, sf), "study_id", "stratum", 40, 11).select("study_id", "stratum")


@register(f"with {SRC}, {BOX}, t as (select distinct study_id from src where split = 'train' and image_id in (select image_id from box where category = 'R')) select image_id, study_id, split from src where study_id in (select study_id from t)")
def train_expansion(spark, sf):
    s = src(spark, sf)
    lesions = box(spark, sf).where("category = 'R'").select("image_id").distinct()
    studies = s.where("split = 'train'").join(lesions, "image_id", "left_semi").select("study_id").distinct()
    return s.join(studies, "study_id", "left_semi").select("image_id", "study_id", "split")


def _balance_sql(r: float) -> str:
    return f"""with e as (select user_id, event_id, ts, event_type in ('error', 'purchase') as p from events),
a as (select *, sum(p::int) over w as np, sum((not p)::int) over w as nn from e window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row)),
b as (select *, case when not p then greatest(0, nn - case when np > 0 then round_even(np * {1 - r} / {r}, 0) else 0 end) else 0 end as ov from a),
c as (select *, max(ov) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as lost from b)
select user_id, event_id, p or lost = coalesce(lag(lost) over (partition by user_id order by ts, event_id), 0) as admitted from c"""


@register(_balance_sql(0.5))
def online_balance(spark, sf):
    e = table(spark, sf, "events").withColumn("p", F.col("event_type").isin("error", "purchase"))
    return S.online_balance(e, ["user_id"], ["ts", "event_id"], "p", 0.5).select("user_id", "event_id", "admitted")


@register("""with e as (select event_id, event_type = 'error' as p from events), r as (select *, row_number() over (partition by p order by md5('2:' || event_id), event_id) - 1 as i, count_if(p) over () as np, count_if(not p) over () as nn from e)
select event_id, p, p or i < least(nn, ceil(np * 1 / 4.0)) as used, cast(case when p then i // 4 when i < least(nn, ceil(np * 1 / 4.0)) then i end as bigint) as turn, cast(case when p or i < least(nn, ceil(np / 4.0)) then i end as bigint) as slot from r""")
def cadence_schedule(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.col("event_type") == "error").alias("p"))
    return S.cadence_schedule(e, "p", 2, "event_id", *X.cadence(0.8)).select("event_id", "p", "used", "turn", "slot")


@register("select doc_id, source from (select *, row_number() over (partition by source order by md5('4:' || doc_id), doc_id) as k from documents) where k <= 7")
def seeded_sample(spark, sf):
    """A sampling operator: seven documents a source."""
    d = table(spark, sf, "documents").select("doc_id", "source")
    return d.withColumn("k", S.hash_rank(["source"], X.seeded_order(4, F.col("doc_id")), "doc_id")).where("k <= 7").drop("k")


# ---- contracts ------------------------------------------------------------------------------------


@register(f"with {SRC} select a.split as split_a, b.split as split_b, count(distinct a.study_id) as studies from (select distinct split, study_id from src) a join (select distinct split, study_id from src) b on a.study_id = b.study_id and a.split < b.split group by all")
def split_overlap_audit(spark, sf):
    return V.split_overlaps(src(spark, sf), "split", "study_id")


@register("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def dup_keys(spark, sf):
    return V.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(f"""with {SRC}, {BOX}, b as (select image_id, line, bx0, by0, bx1, by1, bx0 >= 0 and by0 >= 0 and bx1 <= w and by1 <= h as in_bounds, greatest(0, -bx0, -by0, bx1 - w, by1 - h) as excess from box join src using (image_id))
select image_id, line, bx0, by0, bx1, by1, excess from b where not in_bounds""")
def box_audit(spark, sf):
    b = box(spark, sf).join(src(spark, sf), "image_id")
    return V.out_of_bounds(b, bcols(), F.col("w"), F.col("h")).select("image_id", "line", "bx0", "by0", "bx1", "by1", "excess")


@register(f"""with {SRC}, m as (select split, count(*) as images, count(distinct study_id) as studies from src group by split)
select 'images' as rule, split as scope, cast(5000 as bigint) as expected, images as actual from m where images <> 5000 union all select 'studies', split, 1000, studies from m where studies <> 1000""")
def split_contract(spark, sf):
    m = src(spark, sf).groupBy("split").agg(F.count("*").alias("images"), F.count_distinct("study_id").alias("studies"))
    return V.violations(m, "split", {"images": (F.lit(5000), F.col("images")), "studies": (F.lit(1000), F.col("studies"))})


@register(f"""with {SRC}, {BOX}, c as (select image_id, line, bx0, by0, bx1, by1, case when bx1 > w or by1 > h then 'outside' when (bx1 - bx0) * (by1 - by0) < 900 then 'too_small' when category = 'N' and line > 5 then 'disallowed' end as reason from box join src using (image_id))
select coalesce(reason, 'kept') as reason, count(*) as n from c group by 1""")
def rejection_cascade(spark, sf):
    b = box(spark, sf).join(src(spark, sf), "image_id")
    rules = {"outside": (F.col("bx1") > F.col("w")) | (F.col("by1") > F.col("h")), "too_small": (F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0")) < 900, "disallowed": (F.col("category") == "N") & (F.col("line") > 5)}
    return b.groupBy(V.first_reason(rules, "kept").alias("reason")).agg(F.count("*").alias("n"))


# ---- arrays -----------------------------------------------------------------------------------------

_ARR = "from (select vec_id, unnest(list_transform(embedding, lambda x: cast(x as double))) as x, generate_subscripts(embedding, 1) as i from embeddings)"
_W = "over (partition by vec_id)"
_ARRAY_SQL = {
    "minmax": f"(x - min(x) {_W}) / (max(x) {_W} - min(x) {_W})",
    "zscore_clip": f"greatest(-3, least(3, (x - avg(x) {_W}) / stddev_pop(x) {_W}))",
    "invert": f"max(x) {_W} + min(x) {_W} - x",
    "gamma": f"sqrt((x - min(x) {_W}) / (max(x) {_W} - min(x) {_W}))",
    "log": f"ln(1 + (x - min(x) {_W}) / (max(x) {_W} - min(x) {_W})) / ln(2.0)",
    "percentile": f"greatest(0, least(1, (x - quantile_cont(x, 0.01) {_W}) / (quantile_cont(x, 0.99) {_W} - quantile_cont(x, 0.01) {_W})))",
}
for _name, _expr in _ARRAY_SQL.items():

    def _array_query(spark, sf, name=_name):
        a = F.transform("embedding", lambda x: x.cast("double"))
        return table(spark, sf, "embeddings").select("vec_id", F.posexplode(R.apply_operation(a, name)).alias("i", "v")).select("vec_id", (F.col("i") + 1).cast("long").alias("i"), F.round("v", 6).alias("v"))

    register(f"select vec_id, cast(i as bigint) as i, round({_expr}, 6) as v {_ARR}", f"array_{_name}")(_array_query)


@register("""with h as (select label, i, avg(x) as m, stddev_pop(x) as s from (select label, cast(unnest(embedding) as double) as x, generate_subscripts(embedding, 1) as i from embeddings) group by label, i),
p as (select a.label as a, b.label as b, abs(a.m - b.m) / case when sc.s > 0 then sc.s else 1 end as d from h a join h b on a.i = b.i and a.label < b.label join (select i, stddev_pop(m) as s from h group by i) sc on sc.i = a.i)
select a, b, round(avg(d), 6) as mean_gap, round(max(d), 6) as max_gap from p group by all""")
def pairwise_distance(spark, sf):
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    h = e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))  # ten labels by 64 places
    scale = h.groupBy("i").agg(F.stddev_pop("m").alias("s"))
    a, b = h.select("i", F.col("label").alias("a"), F.col("m").alias("ma")), h.select("i", F.col("label").alias("b"), F.col("m").alias("mb"))
    d = a.join(b, "i").where("a < b").join(scale, "i").withColumn("d", F.abs(F.col("ma") - F.col("mb")) / F.when(F.col("s") > 0, F.col("s")).otherwise(1.0))
    return d.groupBy("a", "b").agg(F.round(F.avg("d"), 6).alias("mean_gap"), F.round(F.max("d"), 6).alias("max_gap"))


@register("""with t as (select label, i, sum(abs(x)) as p from (select label, cast(unnest(embedding) as double) as x, generate_subscripts(embedding, 1) as i from embeddings) group by label, i), n as (select label, i, p / sum(p) over (partition by label) as p from t),
j as (select a.label as a, b.label as b, a.i, a.p as p, b.p as q, (a.p + b.p) / 2 as m, sum(a.p - b.p) over (partition by a.label, b.label order by a.i) as cd from n a join n b on a.i = b.i and a.label < b.label)
select a, b, round(sqrt(greatest(0, sum(case when p > 0 then p * log2(p / m) else 0 end + case when q > 0 then q * log2(q / m) else 0 end) / 2)), 6) as js, round(sum(abs(cd)) / 64, 6) as wasserstein from j group by all""")
def distribution_distance(spark, sf):
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.sum(F.abs(F.col("x").cast("double"))).alias("p"))
    n = e.withColumn("p", F.col("p") / F.sum("p").over(Window.partitionBy("label")))
    j = n.select("i", F.col("label").alias("a"), "p").join(n.select("i", F.col("label").alias("b"), F.col("p").alias("q")), "i").where("a < b")
    j = j.withColumn("m", (F.col("p") + F.col("q")) / 2).withColumn("cd", F.sum(F.col("p") - F.col("q")).over(Window.partitionBy("a", "b").orderBy("i")))

    def part(c):
        return F.when(F.col(c) > 0, F.col(c) * F.log2(F.col(c) / F.col("m"))).otherwise(0.0)

    js = F.sqrt(F.greatest(F.lit(0.0), F.sum(part("p") + part("q")) / 2))
    return j.groupBy("a", "b").agg(F.round(js, 6).alias("js"), F.round(F.sum(F.abs("cd")) / 64, 6).alias("wasserstein"))


@register("""with e as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings), s as (select vec_id, v, unnest(generate_series(-3, 3)) as s from e),
x as (select vec_id, s, unnest(generate_series(1, 64)) as i, v from s), c as (select vec_id, s, corr(v[i], v[65 - i - s]) as r from x where 65 - i - s between 1 and 64 group by all)
select vec_id, cast(s as bigint) as shift, round(r, 6) as r from (select *, row_number() over (partition by vec_id order by round(r, 9) desc, s) as k from c) where k = 1""")
def profile_shift_ncc(spark, sf):
    """The shift that best aligns a profile with its mirror image, by correlation over the overlap."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    x = e.withColumn("s", F.explode(F.sequence(F.lit(-3), F.lit(3)))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(63))))
    at = F.lit(63) - F.col("i") - F.col("s")
    c = x.where(at.between(0, 63)).groupBy("vec_id", "s").agg(F.corr(F.get("v", F.col("i")), F.get("v", at)).alias("r"))
    best = J.first_per_key(c, ["vec_id"], [F.desc(F.round("r", 9)), F.col("s")])
    return best.select("vec_id", F.col("s").cast("long").alias("shift"), F.round("r", 6).alias("r"))


@register(f"with {SRC}, o as (select study_id, string_agg(image_id::varchar, ',' order by case laterality when 'L' then 0 else 1 end, case view_position when 'CC' then 0 else 1 end, image_id) as views, count(*) as n from src group by study_id) select * from o")
def exam_views(spark, sf):
    order = F.struct(F.when(F.col("laterality") == "L", 0).otherwise(1).alias("a"), F.when(F.col("view_position") == "CC", 0).otherwise(1).alias("b"), "image_id")
    g = src(spark, sf).groupBy("study_id").agg(F.array_sort(F.collect_list(order)).alias("v"), F.count("*").alias("n"))
    return g.select("study_id", F.array_join(F.transform("v", lambda x: x["image_id"].cast("string")), ",").alias("views"), "n")


@register()
def count_matched_split(spark: SparkSession, sf: str) -> DataFrame:
    """100 studies with 1,000 images, exactly; a choice over all classes at once has no SQL form."""
    images = src(spark, sf).withColumn("stratum", F.concat(F.lit("S"), (F.col("study_id") % 3).cast("string")))
    return S.count_matched_sample(images, "study_id", "stratum", 100, 1000, 123)


from orrery.plans import extended, imaging, runs  # noqa: E402,F401  (register their queries)
