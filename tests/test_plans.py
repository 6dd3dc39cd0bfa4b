"""What the plans broadcast, and joins of grids and boxes against loops."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from orrery.functions import geometry as G
from orrery.operators import relations as J
from orrery.operators import sampling as S
from orrery.plans import catalog, extended, runs  # noqa: F401

SF = "/root/testdata/sf0.001"
#: Queries on windows and boxes; no grid may be broadcast, however small its images are taken to be; sums of one may.
GRIDS = ["lazy_annotations", "window_box_overlap", "bbox_safe_windows", "lazy_manifest", "positive_ratio", "negative_fraction", "best_empty_window", "patch_contract", "source_scan_summary", "split_coverage", "source_breast_ratio", "crop_label_ratio"]


#: Queries whose windows stay where their image is; of the samplers only the rows of one bucket are dealt, behind a broadcast.
STAY = ["best_empty_window", "positive_ratio", "negative_fraction", "split_coverage", "source_scan_summary", "patch_contract", "crop_label_ratio"]


def below(df, node: str) -> list[str]:
    """The plan from each such node on, before anything has run."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(re.match(r"[ :+-]*", x)[0]) for x in lines]
    ends = [next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines)) for i in range(len(lines))]
    return ["\n".join(lines[i:j]) for i, j in enumerate(ends) if re.search(rf"\b{node}\b", lines[i])]


def broadcast(df) -> list[str]:
    return below(df, "BroadcastExchange")


@pytest.mark.parametrize("name", GRIDS)
def test_no_grid_is_broadcast(spark, name):
    assert not [x for x in broadcast(catalog.QUERIES[name](spark, SF)) if "Generate explode" in x.split("Aggregate")[0]]


@pytest.mark.parametrize("name", STAY)
def test_no_window_is_dealt(spark, name):
    for plan in below(catalog.QUERIES[name](spark, SF), "Exchange"):
        assert "window_id" not in plan.split("\n")[0].split("ENSURE")[0]
        assert "Generate explode" not in re.split("Aggregate|BroadcastHashJoin", plan)[0]


@pytest.mark.parametrize("name", ["negative_fraction", "source_scan_summary", "split_coverage"])
def test_only_sums_are_broadcast_in_a_run(spark, name):
    """By the plan as it ran, adaptive changes included, with a threshold above every table."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        df = catalog.QUERIES[name](spark, SF)
        df.collect()
        assert "isFinalPlan=true" in df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in broadcast(df) if re.search("Generate explode|FileScan|Scan parquet", x.split("Aggregate")[0])]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("digits", [1, 3])
def test_with_negatives(spark, digits):
    """Labels true, false and null, repeated and null keys, a group without positives, wants beyond the group, no groups."""
    rows = [(g, f"k{n % 90}" if n % 50 else None, lab) for n in range(300) for g, lab in [(n % 3, None if n % 11 == 0 else n % 4 == 0 and n % 3 != 2)]]
    df = spark.createDataFrame(rows, "g int, k string, p boolean")
    place = lambda r: hashlib.md5((f"5:{r[1]}" if r[1] is not None else "5").encode()).hexdigest()
    for within, wanted in (["g"], lambda pos, neg: pos + 7), ([], lambda pos, neg: pos - 3), (["g"], lambda pos, neg: pos + 500), (["g"], lambda pos, neg: pos * 0):
        want = []
        for g in {r[0] for r in rows} if within else [None]:
            mine = [r for r in rows if g is None or r[0] == g]
            n = wanted(sum(r[2] is True for r in mine), sum(r[2] is False for r in mine))
            want += [r for r in mine if r[2]] + [r for label in (False, None) for r in sorted((r for r in mine if r[2] is label), key=place)[: max(0, n)]]
        got = S.with_negatives(df, "p", wanted, 5, "k", within, digits).collect()
        if within:
            assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
        else:  # rows of one key and two groups are tied
            assert sorted(repr((r.k, r.p)) for r in got) == sorted(repr(r[1:]) for r in want)


def test_candidates_of_odd_images(spark):
    """Hits by image against loops: images that repeat, are null or hold nothing, boxes of no image or without area."""
    images = [(1, 900, 700), (1, 900, 1300), (2, 300, 200), (None, 700, 700)]
    boxes = [(1, 10.0, 10.0, 60.0, 50.0), (1, 20.0, 10.0, 60.0, 50.0), (1, 600.0, 500.0, 700.0, 690.0), (2, 5.0, 5.0, 5.0, 5.0), (None, 1.0, 1.0, 9.0, 9.0), (9, 1.0, 1.0, 9.0, 9.0)]
    i, b = spark.createDataFrame(images, "k long, w int, h int"), spark.createDataFrame(boxes, "k long, bx0 double, by0 double, bx1 double, by1 double")
    grid = [tuple(r) for r in G.grid(i, "w", "h", 640, 512).select("k", "x0", "y0").collect()]
    want = {}
    for k, x, y in grid:
        for n, u0, v0, u1, v1 in boxes:
            share = max(0, min(u1, x + 640) - max(u0, x)) * max(0, min(v1, y + 640) - max(v0, y)) / max((u1 - u0) * (v1 - v0), 1e-12)
            if k is not None and k == n and share >= 0.5:
                want[k, x, y] = want.get((k, x, y), 0) + 1
    hits = J.hits_by_image(i, b, "k", "w", "h", 640, 512, "edge_align", 0.5)
    got = G.grid(i.join(hits, "k", "left"), "w", "h", 640, 512).withColumn("n", J.hits_of("hits", F.col("x0"), F.col("y0"))).collect()
    assert sorted(((r.k or 0, r.x0, r.y0, r.n) for r in got)) == sorted((k or 0, x, y, want.get((k, x, y), 0)) for k, x, y in grid)
    assert hits.count() == hits.select("k").distinct().count() == 1


def test_extent_is_rounded_as_in_sql(spark):
    """Images with windows whose share has a 5 as its tenth and last digit."""
    images = [(k, "val", 600 + k * 37 % 1900, 700 + k * 53 % 1700) for k in (6516, 8252, 8644, 8808, 11064)]
    rows = catalog.candidates(spark, SF, images=spark.createDataFrame(images, "image_id long, split string, w long, h long")).collect()
    pixels = [(min(r.x1, r.w) - r.x0) * (min(r.y1, r.h) - r.y0) for r in rows]
    want = duckdb.execute("select list(round(p / 409600.0, 9) order by k) from (select unnest(?) as p, unnest(range(?)) as k)", [pixels, len(pixels)]).fetchone()[0]
    assert [r.extent for r in rows] == want


def test_grid_boxes(spark):
    images = [(1, 900, 700), (1, 900, 700), (2, 300, 200), (3, 1300, 640), (None, 700, 700)]  # a repeated, an empty-handed and a null image
    boxes = [(1, 10.0, 10.0, 60.0, 50.0), (1, 600.0, 500.0, 700.0, 690.0), (3, 700.0, 0.0, 900.0, 300.0), (3, 50.0, 50.0, 50.0, 50.0), (None, 1.0, 1.0, 9.0, 9.0), (9, 1.0, 1.0, 9.0, 9.0)]
    i, b = spark.createDataFrame(images, "k long, w int, h int"), spark.createDataFrame(boxes, "k long, bx0 double, by0 double, bx1 double, by1 double")
    grid = [tuple(r) for r in G.grid(i, "w", "h", 640, 512).select("k", "x0", "y0", "x1", "y1").collect()]
    for least in (0.0, 0.5):
        want = []
        for k, x0, y0, x1, y1 in grid:
            for n, u0, v0, u1, v1 in boxes:
                share = max(0, min(u1, x1) - max(u0, x0)) * max(0, min(v1, y1) - max(v0, y0)) / max((u1 - u0) * (v1 - v0), 1e-12)
                want += [(k, x0, y0, u0, v0, round(share, 9))] if k is not None and k == n and share >= least else []
        for got in (J.grid_boxes(i, b, "k", "w", "h", 640, 512, least=least), J.window_boxes(G.grid(i, "w", "h", 640, 512), b, "k", least)):
            assert sorted((r.k, r.x0, r.y0, r.bx0, r.by0, round(r.visible, 9)) for r in got.collect()) == sorted(want)
            assert not broadcast(got)
