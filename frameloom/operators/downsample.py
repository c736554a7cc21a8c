"""Fewer points of long series for a chart: of each bucket the point that spans the largest triangle with its neighbours' choices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.names import unused
from frameloom.operators import scan
from frameloom.sources.scratch import written


def outline(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points, given in order of x, are on the outline of all, those on its straight parts included. Only such a point can be furthest from any line."""
    keep = np.zeros(len(x), bool)
    for sign in (1, -1):
        chain: list[int] = []
        for k in range(len(x)):
            while len(chain) > 1 and sign * ((x[chain[-1]] - x[chain[-2]]) * (y[k] - y[chain[-2]]) - (y[chain[-1]] - y[chain[-2]]) * (x[k] - x[chain[-2]])) < 0:
                chain.pop()
            chain.append(k)
        keep[chain] = True
    return keep


def largest_triangles(df: DataFrame, keys: list[str], x: str, y: str, points: int, ranges: int | None = None) -> DataFrame:
    """keys, x, y of at most so many points of each series: the first, the last, and of each bucket between one.

    A series of n points in order of x has points - 2 buckets of like size, cut at floor(i * (n - 2) / (points - 2)). A bucket's point is the one that spans the largest triangle with the
    point before, as chosen, and the mean of the next bucket; the first of equals. A choice depends on the one before, but only points on a bucket's outline
    can be chosen, and those are found bucket by bucket in parallel, first within each task: what is folded for each series are a few points for each
    bucket. Positions in a series come from a scan, so that one series is work for all tasks. Series of no more than points rows stay whole; rows whose x or y is null or NaN are left out;
    rows of equal x stand in order of y.
    """
    if points < 3:
        raise ValueError("a chart has at least three points")
    if not keys:
        (one,) = unused(df, "series")
        return largest_triangles(df.withColumn(one, F.lit(0)), [one], x, y, points, ranges).drop(one)
    sound = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double"))).select(*keys, x, y)
    place, n, bucket, px, py = unused(sound, "place", "n", "bucket", "px", "py")
    rows = scan.in_ranges(sound, keys, [x, y], ranges).scan(**{place: scan.running_sum(F.lit(1).cast("long"))}).rows().withColumn(place, F.col(place) - 1)
    rows = written(rows, "placed-points")
    sized = _with(rows, rows.groupBy(*keys).agg(F.count("*").alias(n)), keys, "inner")
    small = sized.where(F.col(n) <= points).select(*keys, x, y)
    inner = F.expr(f"(`{place}` * {points - 2} - 1) div (`{n}` - 2)")
    at = F.when(F.col(place) == 0, F.lit(-1)).when(F.col(place) == F.col(n) - 1, F.lit(points - 2)).otherwise(inner).cast("long")
    dealt = sized.where(F.col(n) > points).select(*keys, x, y, place, at.alias(bucket), F.col(x).cast("double").alias(px), F.col(y).cast("double").alias(py))
    dealt = written(dealt, "bucketed-points")
    names = dealt.columns
    by = [*keys, bucket]

    def outlined(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(place)
        return rows[outline(rows[px].to_numpy(float), rows[py].to_numpy(float))]

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.concat([outlined(g) for _, g in b.groupby(by, dropna=False, sort=False)])

    few = dealt.mapInPandas(within, dealt.schema).groupBy(*by).applyInPandas(lambda g: outlined(g)[names], dealt.schema)
    means = dealt.groupBy(*by).agg(F.avg(px).alias("mx"), F.avg(py).alias("my")).withColumn(bucket, F.col(bucket) - 1)
    mx, my = unused(few, "mx", "my")
    met = _with(few, means.withColumnsRenamed({"mx": mx, "my": my}), by, "left")

    def folded(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([bucket, place])
        chosen, last = [], None
        for _, own in rows.groupby(bucket, sort=True):
            a, b = own[px].to_numpy(float), own[py].to_numpy(float)
            k = 0
            if last is not None and len(own) > 1:
                cx, cy = float(own[mx].iloc[0]), float(own[my].iloc[0])
                k = int(np.argmax(np.abs((last[0] - cx) * (b - last[1]) - (last[0] - a) * (cy - last[1]))))
            chosen.append(own.index[k])
            last = a[k], b[k]
        return rows.loc[chosen, [*keys, x, y]]

    return small.unionByName(met.groupBy(*keys).applyInPandas(folded, small.schema))


def _with(df: DataFrame, told: DataFrame, keys: list[str], how: str) -> DataFrame:
    """df with what is told of its keys, null ones too."""
    of = unused(df, *(f"of_{k}" for k in keys), beside=told)
    told = told.toDF(*(of[keys.index(c)] if c in keys else c for c in told.columns))
    return df.join(told, [df[k].eqNullSafe(told[o]) for k, o in zip(keys, of, strict=True)], how).drop(*of)


def chart_order(df: DataFrame, keys: list[str], x: str, name: str) -> DataFrame:
    """Number a chart's points, which are few for each series, from 0."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(x)) - 1)
