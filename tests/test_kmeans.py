"""Grouped k-means: separable data, plain Lloyd, blocks of any size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.operators import kmeans


def separable(seed, groups=3, n=240):
    """Rows of groups with one to six spots far from each other; (group, row, vector, the spot's rank by coordinates)."""
    draw, out = np.random.default_rng(seed), []
    for g in range(groups):
        spots = np.array([[100 * ((i * 7) % 11), 60 * ((i * 5) % 7), 0.0] for i in range(g + 1)], float)
        rank = np.argsort(np.lexsort(spots.T[::-1]))
        for i in range(n):
            out.append((f"g{g}" if g else None, 1000 * g + i, (spots[i % (g + 1)] + draw.normal(0, 1, 3)).tolist(), int(rank[i % (g + 1)])))
    return out


@pytest.mark.parametrize("block_rows", [4096, 50])
def test_separable_spots_are_found_and_numbered(spark, block_rows):
    rows = separable(1, 4)
    df = spark.createDataFrame(rows, "k string, i int, v array<double>, want int").repartition(5)
    got = {(r["k"], r["i"]): r["cluster_id"] for r in kmeans.grouped_kmeans(df, ["k"], "i", "v", clusters=4, restarts=6, block_rows=block_rows).collect()}
    assert len(got) == len(rows)
    for k in {r[0] for r in rows}:
        own = [(got[r[0], r[1]], r[3]) for r in rows if r[0] == k]
        if k == "g3":  # as many spots as clusters
            assert all(a == b for a, b in own)
        for label in {a for a, _ in own}:
            assert len({b for a, b in own if a == label}) == 1  # no cluster holds rows of two spots


def test_blocks_take_the_steps_of_whole_groups(spark):
    draw = np.random.default_rng(3)
    rows = [("abc"[i % 3], i, draw.normal(0, 1, 2).round(3).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, i int, v array<double>")
    one, many = ({(r["k"], r["i"]): r["cluster_id"] for r in kmeans.grouped_kmeans(df.repartition(n), ["k"], "i", "v", clusters=3, restarts=2, block_rows=b).collect()} for n, b in ((2, 4096), (7, 40)))
    assert one == many
    x, h = np.array([r[2] for r in rows if r[0] == "a"]), np.array([r["h"] for r in df.where("k = 'a'").select(F.xxhash64("i").alias("h")).collect()], np.int64)
    centres = kmeans.solved(x, h, 3, 2, kmeans.SEED)
    assert np.array_equal(kmeans.squared(x, centres).argmin(axis=1), [one["a", r[1]] for r in rows if r[0] == "a"])
    counts, sums, cost = kmeans.gathered(x, centres)
    assert not kmeans.moved(centres, counts, sums, cost)[1]  # a fixed point of Lloyd's step


def test_seeds_are_drawn_by_distance():
    h = np.arange(20_000, dtype=np.int64) * 7919
    x = np.array([[0.0], [1.0], [3.0]])
    picks = [kmeans.candidate(x, h[3 * i : 3 * i + 3], np.array([[0.0]]), i, 0)[1] for i in range(5000)]
    assert picks.count(0) == 0 and abs(picks.count(2) / 5000 - 0.9) < 0.02  # 9 to 1, as the squared distances


def test_fewer_rows_than_clusters_copies_and_bad_vectors(spark):
    rows = [("a", 1, [1.0, 2.0]), ("a", 2, [1.0, 2.0]), ("a", 3, [0.0, 5.0]), ("b", 4, [3.0, 3.0]), ("b", 5, None), ("b", 6, [None, 1.0]), ("b", 7, [float("nan"), 1.0]), ("c", 8, []), ("a", 1, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "k string, i int, v array<double>")
    for b in (1, 4096):
        got = sorted(tuple(r) for r in kmeans.grouped_kmeans(df, ["k"], "i", "v", block_rows=b).collect())
        assert got == [("a", 1, 1), ("a", 1, 1), ("a", 2, 1), ("a", 3, 0), ("b", 4, 0)]
    assert kmeans.grouped_kmeans(df.limit(0), ["k"], "i", "v").collect() == []
    assert {r["cluster_id"] for r in kmeans.grouped_kmeans(df.where("k = 'a'"), [], "i", "v", 2).collect()} == {0, 1}
