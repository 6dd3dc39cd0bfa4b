"""Queries of what runs have left, changes between runs, families of grids and choices among the best."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.operators import runs as U
from orrery.plans.catalog import _CAND, BOX, SRC, _grid_sql, box, candidates, register, src, table


@register(f"with {SRC}, {BOX} select split, count(*) as pending from src where image_id not in (select image_id from box where category = 'A') group by split")
def pending_outputs(spark, sf):
    """Images by split whose output doesn't exist yet."""
    done = box(spark, sf).where("category = 'A'").select("image_id")
    return U.pending(src(spark, sf), done, ["image_id"]).groupBy("split").agg(F.count("*").alias("pending"))


@register("""with e as (select user_id, event_id, event_type as t, cast(floor(value) as bigint) as n, lag(event_id) over w as p, lag(event_type) over w as pt, lag(cast(floor(value) as bigint)) over w as pn from events window w as (partition by user_id order by ts, event_id)),
x as (select *, concat_ws(chr(10), case when t is distinct from pt then 'type changed from ' || coalesce(pt, 'none') || ' to ' || coalesce(t, 'none') || '.' end,
  case when coalesce(n, 0) <> coalesce(pn, 0) then printf('crops changed from %d to %d (%+d).', coalesce(pn, 0), coalesce(n, 0), coalesce(n, 0) - coalesce(pn, 0)) end) as said from e where p is not null)
select user_id, event_id, case when said = '' then 'no change' else said end as said from x""")
def change_explanation(spark, sf):
    """What each of a user's states changed of the one before, in words."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events").withColumn("n", F.floor("value"))
    e = e.select("user_id", "event_id", "event_type", "n", *[F.lag(c).over(w).alias(f"p_{c}") for c in ("event_id", "event_type", "n")]).where("p_event_id is not null")
    said = U.explain_changes({"type": (F.col("p_event_type"), F.col("event_type"))}, {"crops": (F.col("p_n"), F.col("n"))}, "no change")
    return e.select("user_id", "event_id", said.alias("said"))


_FAMILY = [(640, 512), (512, 256), (1024, 1024)]
_UNION = " union all ".join(f"select {size} as size, {stride} as stride, split, x0, y0, x1, y1, w, h from (with {_grid_sql(size, stride, 'edge_align')} select * from grid)" for size, stride in _FAMILY)


@register(f"""with {SRC} select cast(size as integer) as size, cast(stride as integer) as stride, split, count(*) as windows, count_if(x1 > w or y1 > h) as padded, cast(sum(x0 + y0) as bigint) as places from ({_UNION}) f group by all""")
def grid_family(spark, sf):
    """Windows of three grids by split, from one scan of the images."""
    f = U.grid_family(src(spark, sf), "w", "h", _FAMILY)
    outside = (F.col("x1") > F.col("w")) | (F.col("y1") > F.col("h"))
    return f.groupBy("size", "stride", "split").agg(F.count("*").alias("windows"), F.count_if(outside).alias("padded"), F.sum(F.col("x0") + F.col("y0")).alias("places"))


@register(f"""with {_CAND}, r as (select *, row_number() over (partition by image_id order by extent desc, window_id) as place from ok where not positive),
p as (select *, row_number() over (partition by image_id order by md5('29:' || window_id), window_id) as pick from r where place <= 5)
select image_id, cast(x0 as bigint) as x0, cast(y0 as bigint) as y0, cast(round(extent * 409600) as bigint) as pixels from p where pick = 1""")
def best_empty_window(spark, sf):
    """A window without a box for every image: one of the five that show most of it, and how many of its pixels lie inside."""
    empty = candidates(spark, sf).where(~F.col("positive")).select("image_id", "x0", "y0", "extent", "window_id")
    return U.pick_of_best(empty, ["image_id"], F.col("extent"), 5, 29, "window_id").select("image_id", "x0", "y0", F.round(F.col("extent") * 409600).cast("long").alias("pixels"))


@register("""select p_partkey, case when p_size > 25 then p_size * 16 end as width, case when p_size > 25 then p_size * 8 end as height from part""")
def variant_sizes(spark, sf):
    """Input sizes from the names of variants; names of other kinds have none."""
    resized = F.concat(F.lit("resized_whole_"), F.col("p_size") * 16, F.lit("x"), F.col("p_size") * 8)
    name = F.when(F.col("p_size") > 25, resized).otherwise(F.concat(F.lit("window_"), resized))
    size = U.variant_size(name)
    return table(spark, sf, "part").select("p_partkey", size["width"].alias("width"), size["height"].alias("height"))
