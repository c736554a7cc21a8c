"""Scans of long sequences: the same rows as windows, and work for all tasks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from frameloom.operators import catalog, scan, sequence


def events(spark, seed, n, keys):
    draw = random.Random(seed)
    rows = [(draw.choice(keys), i, draw.choice([None, 1, 2, 3]), draw.choice([True, False, False, None]), f"r{i}") for i in range(n)]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, v int, range boolean, `place` string").repartition(3)


@pytest.mark.parametrize(("keys", "ranges"), [([None], 7), (["a"], 1), (["a", "b", None], 5), ([str(i) for i in range(60)], 9), (["hot"] * 9 + ["b", "c"], 16)])
def test_scans_equal_windows(spark, keys, ranges):
    df = events(spark, ranges, 400, keys)
    w = Window.partitionBy("k").orderBy("t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({
        "p": F.lag("v").over(w), "s": F.sum(F.coalesce("v", F.lit(0)).cast("long")).over(upto), "l": F.last("v", ignorenulls=True).over(upto),
        "e": F.max(F.coalesce("range", F.lit(False))).over(upto),
    })
    rows = scan.in_ranges(df, ["k"], ["t"], ranges)
    got = rows.scan(p=scan.previous(F.col("v")), s=scan.running_sum(F.col("v"))).scan(l=scan.latest(F.col("v")), e=scan.ever(F.col("range"))).rows()
    assert got.columns == [*df.columns, "p", "s", "l", "e"]
    key = lambda r: (str(r["k"]), r["t"])
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_runs_and_islands_equal_those_of_windows(spark):
    df = events(spark, 3, 500, ["a", "b"])
    got = scan.runs(scan.in_ranges(df, ["k"], ["t"], 11), F.col("v") > 1).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in sequence.runs_of(df, ["k"], "t", F.col("v") > 1).select("k", "start", "end", "length").collect()}
    mine = scan.islands(scan.in_ranges(df, ["k"], ["t"], 6), F.col("range")).rows().select("k", "t", "cluster_id").collect()
    assert {tuple(r) for r in mine} == {tuple(r) for r in sequence.islands(df, ["k"], ["t"], F.coalesce("range", F.lit(False))).select("k", "t", "cluster_id").collect()}


def test_sections_equal_those_of_windows(spark):
    df = events(spark, 5, 300, ["x"]).withColumn("line", F.concat(F.lit("l"), "t"))
    header, passing = F.col("v") == 2, (F.col("v") == 3) & (F.col("t") > 200)
    got = scan.sections(scan.in_ranges(df, ["k"], ["t"], 8), header, passing).rows().select("t", "section", "is_header", "passed").collect()
    want = catalog.log_sections(df, ["k"], "t", "line", header, passing).select("t", F.col("section").cast("long"), "is_header", "passed").collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want} and sum(r["is_header"] for r in got) > 20


def test_one_key_is_work_for_all_tasks(spark):
    n = 8
    df = spark.range(40_000).select(F.lit("all").alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
    rows = scan.in_ranges(df, ["k"], ["t"], n)
    shares = [r["count"] for r in rows.df.groupBy(rows.range_).count().collect()]
    assert len(shares) == n and max(shares) < 2 * 40_000 / n
    found = rows.scan(s=scan.running_sum(F.col("v")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = [r["count"] for r in found.df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 1 and max(tasks) < 0.7 * 40_000  # eight ranges, dealt to four tasks by a hash
    assert found.rows().agg(F.max("s")).first()[0] == sum(i % 7 for i in range(40_000))


def test_scans_of_no_row_and_of_clashing_names(spark):
    none = spark.createDataFrame([], "k string, t int, first int, number int")
    assert scan.in_ranges(none, ["k"], ["t"]).scan(s=scan.running_sum(F.col("t"))).rows().collect() == []
    odd = spark.createDataFrame([("a", 1, 5, 6, 7), ("a", 2, 8, 9, 1)], "k string, t int, first int, of_k int, carry_s int")
    got = scan.in_ranges(odd, ["k"], ["t"], 2).scan(s=scan.running_sum(F.col("first"))).rows().orderBy("t").collect()
    assert [tuple(r) for r in got] == [("a", 1, 5, 6, 7, 5), ("a", 2, 8, 9, 1, 13)]


def test_scans_may_take_any_name(spark):
    df = spark.range(20).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    got = scan.in_ranges(df, ["k"], ["t"], 3).scan(place=scan.running_sum(F.lit(1).cast("long"))).scan(range=scan.running_sum(F.col("place"))).with_columns({"place_0": F.lit(7)}).scan(t=scan.previous(F.col("t"))).rows()
    assert sorted((r["place"], r["range"], r["place_0"], r["t"]) for r in got.collect()) == [(i + 1, (i + 1) * (i + 2) // 2, 7, i - 1 if i else None) for i in range(20)]


def test_plateau_extents_equal_a_plain_walk(spark):
    import numpy as np

    draw, rows, want = np.random.default_rng(9), [], set()
    for g in (None, "b", "c", "d", "e"):
        n = {"d": 1, "e": 3}.get(g, 60)
        x = np.round(np.cumsum(draw.normal(0, 1, n) * (draw.random(n) < 0.3)), 2)
        rows += [(g, i, float(v), "r") for i, v in enumerate(x)]
        size = min(5, n)
        flat = [round(float(np.var(x[i : i + size], ddof=1)), 9) if size > 1 else 0.0 for i in range(n - size + 1)]
        first = flat.index(min(flat))
        window = x[first : first + size]
        near = np.abs(x - window.mean()) < 3 * window.std()
        start, end = first, first + size - 1
        while start and near[start - 1]:
            start -= 1
        while end + 1 < n and near[end + 1]:
            end += 1
        want.add((g, start, end))
    df = spark.createDataFrame(rows, "k string, i int, v double, place string").repartition(4)
    assert {tuple(r) for r in sequence.plateau_extents(df, ["k"], "i", "v").collect()} == want


def test_operators_keep_columns_of_any_name(spark):
    from frameloom.operators import rank

    names = ["rank", "rank_0", "at", "range", "left", "n", "pick", "run", "variance"]
    df = spark.createDataFrame([(i % 3, i, float(i), *[f"{c}{i}" for c in names[:-1]]) for i in range(30)], ", ".join(["k int", "i int", "v double", *(f"`{c}` string" for c in names[:-1])]))
    own = {r["i"]: tuple(r) for r in df.collect()}
    for out in (rank.worst_of(df, ["k"], "v", "i"), rank.skip_first(df, ["k"], [F.col("i")], F.lit(True)), rank.seeded_split(df, "i", 0.8, 42).drop("split")):
        assert out.columns == df.columns and all(tuple(r) == own[r["i"]] for r in out.collect())
    assert {r["k"]: (r["start"], r["end"]) for r in sequence.runs_of(df, ["k"], "i", F.col("v") >= 15).collect()} == {0: (5, 10), 1: (5, 10), 2: (5, 10)}
    assert [tuple(r) for r in sequence.flattened(df.limit(1).select("k", F.array("i", "i").alias("is"), "n"), "is", "one").collect()] == [(0, "n0", 0)] * 2
