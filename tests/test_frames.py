"""Sizes, masks and channels against plain loops."""

import numpy as np
import pytest

from orrery.functions import frames as FR

RNG = np.random.default_rng(3)


def test_area_resize():
    image = RNG.random((6, 9))
    assert np.allclose(FR.area_resize(image, 3, 3), image.reshape(3, 2, 3, 3).mean(axis=(1, 3)))
    fine = np.kron(image, np.ones((4, 2)))  # to 4 rows of 6, and 2 columns of 9
    assert np.allclose(FR.area_resize(image, 4, 2), fine.reshape(4, 6, 2, 9).mean(axis=(1, 3)))
    assert np.allclose(FR.area_resize(image, 6, 9), image)
    assert np.allclose(FR.area_resize(image, 12, 18), np.kron(image, np.ones((2, 2))))


def test_canvas():
    image = np.ones((2, 4))
    assert FR.on_canvas(image, 3, 5, 7).tolist() == [[1, 1, 1, 1, 7], [1, 1, 1, 1, 7], [7] * 5]
    assert FR.fit_on_canvas(image, 5, 8, 0, True).sum(axis=1).tolist() == [8, 8, 8, 8, 0]
    with pytest.raises(ValueError):
        FR.on_canvas(image, 1, 9)


def test_otsu():
    levels = np.concatenate([RNG.integers(20, 60, 400), RNG.integers(150, 220, 100)])
    variances = []
    for t in range(256):
        a, b = levels[levels <= t], levels[levels > t]
        variances.append(len(a) * len(b) * (a.mean() - b.mean()) ** 2 if len(a) and len(b) else 0)
    assert FR.otsu_level(levels) == int(np.argmax(variances))


@pytest.mark.parametrize("method", ["robust", "otsu", "percentile"])
def test_masks(method):
    image = RNG.random((50, 50)) * 0.001
    image[10:30, 15:45] = 0.8 + RNG.random((20, 30)) * 0.1
    image[40:42, 2:4] = 0.9
    mask = FR.mask_by(image, method)
    assert mask[10:30, 15:45].all() and not mask[40:42, 2:4].any()
    assert not FR.mask_by(np.full((3, 3), np.nan), method).any() and FR.mask_by(np.ones((3, 3)), method).shape == (3, 3)
    with pytest.raises(ValueError):
        FR.mask_by(image, "guess")


def test_columns(spark):
    from pyspark.sql import functions as F

    from orrery.functions import arrays as R

    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0]), (2, None), (3, []), (4, [1.0, float("nan"), 5.0])], "id int, v array<double>")
    got = {r.id: (r.a, r.b) for r in df.select("id", FR.resized(F.col("v"), F.lit(2), 1, 1).alias("a"), R.whole_levels(F.col("v")).alias("b")).collect()}
    assert got == {1: ([2.5], [0, 21845, 43690, 65535]), 2: (None, None), 3: (None, []), 4: (None, [0, 0, 65535])}
    with pytest.raises(KeyError):
        FR.resized(F.col("v"), F.lit(2), 1, 1, "crop")
