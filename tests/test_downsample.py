"""Largest triangles against a plain loop."""

import numpy as np
import pytest

from frameloom.operators import downsample


def plain(x, y, m):
    n = len(x)
    if n <= m:
        return list(range(n))
    cut = [i * (n - 2) // (m - 2) + 1 for i in range(m - 1)] + [n]
    out = [0]
    for i in range(m - 2):
        here, after = range(cut[i], cut[i + 1]), range(cut[i + 1], cut[i + 2] if i + 2 < m - 1 else n)
        cx, cy = np.mean(x[after.start : after.stop]), np.mean(y[after.start : after.stop])
        ax, ay = x[out[-1]], y[out[-1]]
        area = [abs((ax - cx) * (y[k] - ay) - (ax - x[k]) * (cy - ay)) for k in here]
        out.append(here[int(np.argmax(area))])
    return [*out, n - 1]


@pytest.mark.parametrize(("n", "m", "ranges"), [(100_000, 300, 9), (1000, 3, 4), (57, 10, 5), (57, 56, 2), (12, 11, 3), (10, 10, 2), (4, 3, 1)])
def test_points_equal_those_of_a_plain_loop(spark, n, m, ranges):
    draw = np.random.default_rng(n + m)
    x = np.cumsum(draw.integers(1, 5, n)).astype(float)
    y = np.cumsum(draw.normal(0, 1, n)) + 20 * (draw.random(n) > 0.99)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x double, bucket double").repartition(6)
    got = sorted(tuple(r) for r in downsample.largest_triangles(df, [], "x", "bucket", m, ranges).collect())
    assert got == [(x[k], y[k]) for k in plain(x, y, m)]


def test_many_series_nulls_and_short_ones(spark):
    draw = np.random.default_rng(1)
    series = {None: draw.normal(0, 1, 200), "a": draw.normal(0, 1, 90), "short": draw.normal(0, 1, 4)}
    rows = [(k, float(i), float(v), "z") for k, ys in series.items() for i, v in enumerate(ys)]
    odd = [("a", None, 1.0, "z"), ("a", 2.5, None, "z"), ("a", float("nan"), 1.0, "z"), ("gone", None, None, "z")]
    df = spark.createDataFrame(rows + odd, "k string, t double, v double, place string")
    got = downsample.largest_triangles(df, ["k"], "t", "v", 12)
    found = {(r["k"], r["t"], r["v"]) for r in got.collect()}
    want = {(k, float(i), float(ys[i])) for k, ys in series.items() for i in plain(np.arange(len(ys), dtype=float), ys, 12)}
    assert found == want and got.count() == len(want)
    numbers = downsample.chart_order(got, ["k"], "t", "at").where("k = 'a'").orderBy("at").collect()
    assert [r["at"] for r in numbers] == list(range(12))
    assert downsample.largest_triangles(df.limit(0), ["k"], "t", "v", 5).collect() == []
    with pytest.raises(ValueError):
        downsample.largest_triangles(df, ["k"], "t", "v", 2)


def test_outline_keeps_all_that_can_be_furthest():
    draw = np.random.default_rng(5)
    for _ in range(200):
        x, y = np.sort(draw.integers(0, 9, 12)).astype(float), draw.integers(0, 9, 12).astype(float)
        order = np.lexsort((y, x))
        x, y, kept = x[order], y[order], downsample.outline(x[order], y[order])
        for _ in range(30):
            a, b, c = draw.normal(0, 5, 3)
            far = np.abs(a * x + b * y + c)
            assert far[kept].max() == far.max()
