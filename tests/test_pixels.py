"""Image operations against plain loops over pixels."""

import numpy as np
import pytest

from orrery.functions import pixels as P

RNG = np.random.default_rng(5)
IMAGE = RNG.random((11, 13))


def mirrored(k, n):
    k = abs(k)
    return k if k < n else 2 * (n - 1) - k


def looped(image, kernel):
    h, w = image.shape
    r, c = kernel.shape[0] // 2, kernel.shape[1] // 2
    out = np.zeros_like(image)
    for y in range(h):
        for x in range(w):
            out[y, x] = sum(kernel[j + r, i + c] * image[mirrored(y + j, h), mirrored(x + i, w)] for j in range(-r, r + 1) for i in range(-c, c + 1))
    return out


def flooded(mask):
    seen, sizes = np.zeros_like(mask), []
    for y, x in np.argwhere(mask):
        if seen[y, x]:
            continue
        seen[y, x], todo, size = True, [(y, x)], 0
        while todo:
            a, b = todo.pop()
            size += 1
            for j in range(max(0, a - 1), min(mask.shape[0], a + 2)):
                for i in range(max(0, b - 1), min(mask.shape[1], b + 2)):
                    if mask[j, i] and not seen[j, i]:
                        seen[j, i] = True
                        todo.append((j, i))
        sizes.append(size)
    return sizes


def test_linear_filters():
    gx, gy = P.derivative(IMAGE, 3, 1)
    sobel = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]], float)
    assert np.allclose(gx, looped(IMAGE, sobel)) and np.allclose(gy, looped(IMAGE, sobel.T))
    assert np.allclose(sum(P.derivative(IMAGE, 3, 2)), looped(IMAGE, np.array([[2, 0, 2], [0, -8, 0], [2, 0, 2]], float)))
    row = np.exp(-((np.arange(5) - 2.0) ** 2) / 2)
    assert np.allclose(P.run_steps(IMAGE, [("gaussian_blur", {})]), looped(IMAGE, np.outer(row, row) / row.sum() ** 2))
    cross = np.array([[0, -1, 0], [-1, 6, -1], [0, -1, 0]], float)
    assert np.allclose(P.run_steps(IMAGE, [("sharpen", {"amount": 2})]), looped(IMAGE, cross) / 2)


@pytest.mark.parametrize("shape", ["ellipse", "rect"])
def test_morphology(shape):
    o = {"ksize": 5, "kernel_shape": shape}
    foot = P.footprint(o)
    assert foot.sum() == (17 if shape == "ellipse" else 25)  # the disc of five: rows of 1, 5, 5, 5, 1

    def pick(image, best):
        h, w = image.shape
        return np.array([[best(image[y + j - 2, x + i - 2] for j, i in np.argwhere(foot) if 0 <= y + j - 2 < h and 0 <= x + i - 2 < w) for x in range(w)] for y in range(h)])

    assert np.array_equal(P.opened(IMAGE, o), pick(pick(IMAGE, min), max))
    assert np.array_equal(P.closed(IMAGE, o), pick(pick(IMAGE, max), min))


def test_median_bilateral_and_wiener():
    padded = np.pad(IMAGE, 1, "edge")
    assert np.allclose(P.run_steps(IMAGE, [("median_blur", {})]), [[np.median(padded[y : y + 3, x : x + 3]) for x in range(13)] for y in range(11)])
    flat = np.full((6, 7), 0.25)
    for name in ("bilateral_filter", "wiener_filter", "gaussian_blur", "unsharp_mask"):
        inner = P.run_steps(flat, [(name, {"ksize": 3})])[2:-2, 2:-2]
        assert np.allclose(inner, 0.25), name


def test_equalisation():
    ranks = IMAGE.ravel().argsort().argsort().reshape(IMAGE.shape) / (IMAGE.size - 1)
    assert np.allclose(P.run_steps(IMAGE, [("hist_equalize", {})]), ranks)
    assert np.allclose(P.run_steps(IMAGE, [("clahe", {"tile_grid_size": 1, "clip_limit": 99})]), ranks)
    tiles = P.run_steps(IMAGE, [("clahe", {"tile_grid_size": 4})])
    assert tiles.min() >= 0 and tiles.max() <= 1
    levels, places = P.rank_mapping(np.array([1.0] + [2.0] * 8 + [3.0]), 1.0)
    cut, share = 10 / 3, (8 - 10 / 3) / 3  # 1, 8 and 1 values cut at the mean count, the excess dealt evenly
    assert list(levels) == [1, 2, 3] and np.allclose(places, [0, (cut + share) / (cut + share + 1 + share), 1])


@pytest.mark.parametrize("density", [0.0, 0.1, 0.4, 0.6, 1.0])
def test_components(density):
    for _ in range(20):
        mask = RNG.random((9, 14)) < density
        sizes = flooded(mask)
        got = P.mask_quality(mask)
        assert sorted(np.bincount(P.components(mask).ravel())[1:]) == sorted(sizes)
        assert (got["component_count"], got["largest_component_pixels"]) == (len(sizes), max(sizes, default=0))


def test_every_operation_keeps_the_shape():
    odd_ones = [np.zeros((5, 4)), np.full((1, 1), 3.0), np.array([[np.nan, np.inf, -2.0, 900.0]])]
    for name in P.OPERATIONS:
        for image in [*odd_ones, IMAGE]:
            out = P.run_steps(image, [(name, {})])
            assert out.shape == image.shape and np.isfinite(out).all(), name
    corner = P.run_steps(np.ones((10, 10)), [("pectoral_suppression", {})])
    assert corner[0, :3].sum() == 0 and corner[0, 3] == 1 and corner[9].all()


def test_foreground():
    image = RNG.random((60, 60)) * 0.01
    image[20:40, 20:40] = 1.0
    image[5, 5] = 1.0
    mask = P.foreground(image)
    assert mask[20:40, 20:40].all() and mask.sum() <= 401
    assert not P.foreground(np.full((4, 4), np.nan)).any()


def test_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, IMAGE.ravel().tolist(), 13), (2, None, 13), (3, [1.0, 2.0, 3.0], 2), (4, [1.0], None)], "id int, v array<double>, w int")
    steps = [("gaussian_blur", {"sigma": 1.0}), ("sobel_gradient", {})]
    got = {r.id: r.o for r in df.select("id", P.image_steps(F.col("v"), F.col("w"), steps).alias("o")).collect()}
    assert np.allclose(np.array(got[1]).reshape(11, 13), P.run_steps(IMAGE, steps)) and got[2] is got[3] is got[4] is None
    q = spark.createDataFrame([([True, False, False, True], 2)], "m array<boolean>, w int").select(P.mask_metrics(F.col("m"), F.col("w")).alias("q")).first().q
    assert (q.component_count, q.bbox, q.quality_flags) == (1, [0, 0, 2, 2], [])
