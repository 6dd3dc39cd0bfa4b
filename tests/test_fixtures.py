"""Literal cases with known results, random comparisons with sequential loops, readers, writers, streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from orrery.functions import arrays as R
from orrery.functions import geometry as G
from orrery.functions import scalar as X
from orrery.operators import contracts as V
from orrery.operators import relations as J
from orrery.operators import sampling as S
from orrery.sources import sinks, tables
from orrery.streaming import balancer


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_grid_policies(spark):
    r = one(spark, ax=G.origins(F.lit(2500), 1024, 512), ay=G.origins(F.lit(1800), 1024, 512), px=G.origins(F.lit(2500), 1024, 512, "pad"), py=G.origins(F.lit(1800), 1024, 512, "regular_stride_pad"))
    assert (r.ax, r.ay, r.px, r.py) == ([0, 512, 1024, 1476], [0, 512, 776], [0, 512, 1024, 1536], [0, 512, 1024])
    with pytest.raises(ValueError):
        G.origins(F.lit(1), 0, 1)


def test_scalars(spark):
    sizes = [0, 1024, -1536]
    got = [one(spark, x=X.format_bytes(F.lit(s)))[0] for s in sizes] + [one(spark, x=X.format_bytes(F.lit(3 * 2**30), 2))[0]]
    assert got == ["0 B", "1.0 KiB", "-1.5 KiB", "3.00 GiB"]
    r = one(spark, a=X.first_int(F.lit("BI-RADS 4")), b=X.first_int(F.lit("none")), c=X.density_code(F.lit("DENSITY C")), d=X.parse_list(F.lit("['Mass', 'Skin Retraction']")), e=X.parse_box(F.lit("[1,2,3]")), f=X.parse_box(F.lit("[1,2,3,4]")), g=X.path_stem(F.lit("a\\b/c.dcm")))
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g) == (4, None, 2, ["Mass", "Skin Retraction"], None, [1.0, 2.0, 3.0, 4.0], "c")
    assert [X.cadence(x) for x in (0.5, 0.8, 0.7, 0.3, 1.0)] == [(1, 1), (4, 1), (3, 1), (1, 3), (1, 0)]
    assert S.ratio_mixture(8, 5, 0.5) == (5, 5)


def test_variant_plan(spark):
    r = one(spark, c=G.canvas(F.lit(3580), F.lit(2812))[0], d=G.canvas(F.lit(3580), F.lit(2812))[1], w=F.array(*[G.variant_width(F.lit(h), F.lit(3584), F.lit(2816)) for h in (512, 640, 800, 1024, 1280, 1600)]))
    assert (r.c, r.d, r.w) == (3584, 2816, [402, 503, 629, 805, 1006, 1257])


def test_online_balance_equals_loop(spark):
    rng, rows, want = random.Random(5), [], {}
    for k in range(60):
        p = n = 0
        for i in range(rng.randint(1, 40)):
            hit = rng.random() < 0.4
            rows.append((k, i, hit))
            ok = hit or n < balancer.allowance(p, 0.4)
            p, n = p + hit, n + (ok and not hit)
            want[k, i] = ok
    df = spark.createDataFrame(rows, "k long, i long, p boolean")
    got = {(r.k, r.i): r.admitted for r in S.online_balance(df, ["k"], ["i"], "p", 0.4).collect()}
    assert got == want


def test_stream_equals_batch(spark, tmp_path):
    rows = [(k, i, (i * 7 + k) % 3 == 0) for k in range(3) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, i long, p boolean")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = balancer.balance_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "k", "i", ["i"], "p", 0.5)
    q = stream.writeStream.format("memory").queryName("admitted").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {(r.k, r.i): r.admitted for r in spark.sql("select * from admitted").collect()}
    assert got == {(r.k, r.i): r.admitted for r in S.online_balance(df, ["k"], ["i"], "p", 0.5).collect()}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "f.csv").write_text(" study_id ,image_id,height,xmin,split\n01,007,12,nan,training\n02,8,x,3.5,test\n")
    t = tables.read_csv(spark, str(tmp_path / "f.csv"), tables.FINDINGS, {"study_id", "image_id"}).orderBy("study_id").collect()
    assert [(r.study_id, r.image_id, r.height, r.xmin) for r in t] == [("01", "007", 12, None), ("02", "8", None, 3.5)]
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(tmp_path / "f.csv"), tables.FINDINGS, {"absent"})
    (tmp_path / "m.jsonl").write_text('{"k":"a","n":1}\n{"k":"a","n":2}\nbroken\n')
    assert [(r.k, r.n) for r in tables.read_manifest(spark, str(tmp_path / "m.jsonl"), "k string, n long", "k", "n").collect()] == [("a", 2)]
    (tmp_path / "c.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "i.png", "width": 10, "height": 8}], "annotations": [{"id": 5, "image_id": 1, "category_id": 0, "bbox": [1, 2, 3, 4], "area": 12}, {"id": 6, "image_id": 9, "category_id": 0, "bbox": [0, 0, 1, 1], "area": 1}]}))
    got = {r.id: (r.file_name, r.x, r.h) for r in tables.read_coco_boxes(spark, str(tmp_path / "c.json")).collect()}
    assert got == {5: ("i.png", 1.0, 4.0), 6: (None, 0.0, 1.0)}
    boxes = spark.createDataFrame([("a", 8.0, 16.0, 24.0, 48.0)], "image string, a double, b double, c double, d double")
    text = sinks.yolo_texts(boxes, ["image"], sinks.yolo_line([F.col(c) for c in "abcd"], F.lit(64), F.lit(128)), ["a"]).first().text
    assert text == "0 0.25000000 0.25000000 0.25000000 0.25000000"
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.txt").write_text(text + "\nbad line\n")
    r = tables.read_yolo_boxes(spark, str(tmp_path / "l"), 64, 128).collect()
    assert [(x.x0, x.y0, x.x1, x.y1) for x in r] == [(8.0, 16.0, 24.0, 48.0)]
    assert [(x.stem, x.size > 0) for x in tables.list_files(spark, str(tmp_path / "l")).collect()] == [("a", True)]
    sinks.write_partitioned(boxes, str(tmp_path / "out"), ["image"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    with pytest.raises(Exception):
        sinks.write_partitioned(boxes, str(tmp_path / "out"), ["image"])


def test_contracts(spark):
    df = spark.createDataFrame([("train", 1), ("val", 1), ("val", 2)], "split string, study long")
    assert V.split_overlaps(df, "split", "study").count() == 1
    with pytest.raises(ValueError):
        V.require_empty(V.split_overlaps(df, "split", "study"), "overlap")
    assert [r.study for r in V.missing_rows(df, df.where("study = 1"), ["study"]).collect()] == [2]


def test_arrays_and_relations(spark):
    a = F.array(*[F.lit(float(x)) for x in (3, 1, 2)])
    r = one(spark, m=R.min_max(a), i=R.invert(a), z=R.z_clip(F.array(F.lit(1.0), F.lit(1.0))), u=R.apply_operation(a, "unknown"))
    assert (r.m, r.i, r.z, r.u) == ([1.0, 0.0, 0.5], [1.0, 3.0, 2.0], [0.0, 0.0], [3.0, 1.0, 2.0])
    df = spark.createDataFrame([("s", "CC", "L", 1), ("s", "CC", "R", 2), ("s", "CC", "R", 3), ("s", "MLO", "L", 4)], "study string, view string, side string, id long")
    assert {x.id: x.other_id for x in J.contralateral(df, "study", "view", "side", "id").collect()} == {1: 3, 2: 1, 3: 1, 4: None}
    assert J.resolve_column(df, ["Image ID", "STUDY"]) == "study"


def test_count_matched_sample(spark):
    from itertools import product

    from orrery.operators.sampling import count_matched_quota, count_matched_sample

    sizes = [1, 1, 2, 2, 2, 3, 3, 4]
    rows = [(study, "a" if study % 2 else "b") for study, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, "study long, stratum string")
    got = [sorted(r.study for r in count_matched_sample(d, "study", "stratum", 3, 6, 7).collect()) for d in (df, df.repartition(5))]
    assert got[0] == got[1] and len(got[0]) == 3 and sum(sizes[k] for k in got[0]) == 6
    classes = {("a", 1): 3, ("a", 2): 2, ("b", 2): 3, ("b", 5): 1}
    for groups in range(6):
        for members in range(14):
            exact = [q for q in product(*(range(n + 1) for n in classes.values())) if sum(q) == groups and sum(k * s for k, (_, s) in zip(q, classes)) == members]
            cost = [sum(abs(k - groups * n / 9) for k, n in zip(q, classes.values())) for q in exact]
            if not exact:
                with pytest.raises(ValueError):
                    count_matched_quota(classes, groups, members)
            else:
                quota = count_matched_quota(classes, groups, members)
                assert tuple(quota[c] for c in classes) in exact
                assert abs(sum(abs(quota[c] - groups * n / 9) for c, n in classes.items()) - min(cost)) < 1e-9


def test_source_ratio(spark):
    """A pool of eight mass-breast windows, three of them with a lesion, and five negatives: ten rows, half of each."""
    from orrery.operators.sampling import source_ratio

    rows = [("s", f"m{k}", True, k < 3) for k in range(8)] + [("s", f"n{k}", False, False) for k in range(5)] + [("t", "m", True, True)]
    df = spark.createDataFrame(rows, "split string, key string, mass boolean, positive boolean")
    got = source_ratio(df, "mass", "positive", 0.5, 1, "key", ["split"]).collect()
    assert len(got) == 10 and sum(r.mass for r in got) == 5 and {"m0", "m1", "m2"} <= {r.key for r in got}
    with pytest.raises(ValueError):
        source_ratio(df, "mass", "positive", 0.5, 1, "key", ["split"], strict=True)


def test_quantiles(spark):
    """Ties, one value, nulls, null keys and an outlier that puts all else in one range."""
    from pyspark.sql import functions as F

    from orrery.operators.aggregate import quantiles

    values = {"a": [1.0, 2.0, 2.0, 3.0, 1e12], "b": [5.0], None: [1.0, 4.0], "c": [7.0] * 9}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in [*vs, None]], "k string, v double")
    wanted = {"lo": 0.0, "q": 0.3, "hi": 1.0}
    got = {r.k: (r.lo, r.q, r.hi) for r in quantiles(df, ["k"], F.col("v"), wanted).collect()}
    for k, vs in values.items():
        for have, q in zip(got[k], wanted.values()):
            at = (len(vs) - 1) * q
            low = sorted(vs)[int(at)]
            assert have == pytest.approx(low + (sorted(vs)[min(int(at) + 1, len(vs) - 1)] - low) * (at - int(at)))


def test_seeded_rank(spark):
    from orrery.operators.relations import evenly_spaced, numbered_by_range, one_to_one
    from orrery.operators.sampling import seeded_rank

    df = spark.range(500).selectExpr("id", "if(id % 5 = 0, null, id % 2) as g").repartition(7)
    import hashlib

    got = {(r.g, r["_r"]): r.id for r in seeded_rank(df, "_r", ["g"], 3, "id").collect()}
    for g, ids in ((None, range(0, 500, 5)), (0, [k for k in range(500) if k % 5 and k % 2 == 0]), (1, [k for k in range(500) if k % 5 and k % 2])):
        order = sorted(ids, key=lambda k: hashlib.md5(f"3:{k}".encode()).hexdigest())
        assert [got[g, k + 1] for k in range(len(order))] == order
    numbered = sorted((r.id, r.n) for r in numbered_by_range(df, "n", ["g"], "id", ranges=8).where("g is null").collect())
    assert numbered == [(k * 5, k) for k in range(100)]
    assert sorted(r.id for r in evenly_spaced(df, "id", 3).collect()) == [0, 250, 499]
    with pytest.raises(ValueError):
        one_to_one(df, df.select("g").withColumnRenamed("g", "id"), ["id"])


def test_parse_sizes(spark):
    from pyspark.sql import functions as F

    from orrery.functions.scalar import parse_sizes, passes

    texts = [("1024, 640x512;\n 3 X 4", [(1024, 1024), (640, 512), (3, 4)]), ("64 by 64", None), ("", None), ("5,5x5", None)]
    df = spark.createDataFrame([(t,) for t, _ in texts], "t string").select("t", parse_sizes(F.col("t")).alias("s"))
    assert {r.t: r.s and [tuple(x) for x in r.s] for r in df.collect()} == dict(texts)
    with pytest.raises(ValueError):
        passes(F.lit(1), 0.5, "about")
