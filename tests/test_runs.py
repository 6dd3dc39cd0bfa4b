"""Run helpers on small cases."""

import pytest

from orrery.operators import runs as U


def test_pending(spark):
    work = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    done = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert {r.k for r in U.pending(work, done, ["k"]).collect()} == {1, None}
    assert U.pending(work, done, ["k"], overwrite=True).count() == 3


def test_explain_changes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", "b", 5, 3), (None, None, 1, 1), (None, "x", None, 2)], "a string, b string, n long, m long")
    said = U.explain_changes({"mode": (F.col("a"), F.col("b"))}, {"crops": (F.col("n"), F.col("m"))}, "nothing")
    assert [r[0] for r in df.select(said).collect()] == ["mode changed from a to b.\ncrops changed from 5 to 3 (-2).", "nothing", "mode changed from none to x.\ncrops changed from 0 to 2 (+2)."]


def test_grid_family(spark):
    from orrery.functions.geometry import grid

    df = spark.createDataFrame([(1, 1500, 900), (2, 100, 100)], "id int, w int, h int")
    got = {tuple(r) for r in U.grid_family(df, "w", "h", [(512, 256), (640, 640)]).drop("w", "h").collect()}
    want = {(r.id, s, t, r.x0, r.y0, r.x1, r.y1) for s, t in ((512, 256), (640, 640)) for r in grid(df, "w", "h", s, t).collect()}
    assert got == want
    with pytest.raises(ValueError):
        U.grid_family(df, "w", "h", [(1, 1), (1, 1)])


def test_pick_of_best(spark):
    import hashlib

    from pyspark.sql import functions as F

    rows = [("k", f"t{i}", float(i // 2)) for i in range(10)] + [("n", "t", None)]
    df = spark.createDataFrame(rows, "key string, tie string, score double")
    got = {r.key: r.tie for r in U.pick_of_best(df, ["key"], F.col("score"), 3, 7, "tie").collect()}
    assert got == {"k": min(["t8", "t9", "t6"], key=lambda t: hashlib.md5(f"7:{t}".encode()).hexdigest()), "n": "t"}
