"""File listings on small cases."""

from orrery.operators import files as L


def test_resolve_paths(spark):
    rows = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "a"), ("s2", None), ("s1", "c.d")], "study string, image string")
    paths = ["file:/r/s1/a.dcm", "file:/r/s1/a.dicom", "file:/r/s1/a.dicom", "file:/r/s1/b", "file:/r/s1/c.d.dcm", "file:/r/s3/a.dcm"]
    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    out = L.resolve_paths(rows, listing, "study", "image", "/r/")
    assert {(r.study, r.image): (r.path, r.found) for r in out.collect()} == {
        ("s1", "a"): ("/r/s1/a.dicom", True),
        ("s1", "b"): ("/r/s1/b", True),
        ("s1", "c.d"): ("/r/s1/c.d.dcm", True),
        ("s2", "a"): ("/r/s2/a.dicom", False),
        ("s2", None): (None, False),
    }
    report = L.missing_paths(out).first()
    assert (report.missing, report.preview) == (2, ["/r/s2/a.dicom"])


def test_pairs(spark):
    a = spark.createDataFrame([("x/1.pt",), ("x/2.a.pt",), ("x/1.pt",)], "path string").selectExpr("'t' as split", "path")
    b = spark.createDataFrame([("y/2.a.png",), ("y/3.png",)], "path string").selectExpr("'t' as split", "path")
    got = {(r.stem, r.status) for r in L.pair_files(a, b, ["split"]).collect()}
    assert got == {("1", "left_only"), ("2.a", "paired"), ("3", "right_only")}


def test_merged():
    base, patch = {"x": {"p": 1, "q": [1]}, "y": 2}, {"x": {"q": [2]}, "y": {"n": None}}
    out = L.merged(base, patch)
    assert out == {"x": {"p": 1, "q": [2]}, "y": {"n": None}} and base == {"x": {"p": 1, "q": [1]}, "y": 2}
    out["x"]["q"].append(3)
    assert patch["x"]["q"] == [2]
