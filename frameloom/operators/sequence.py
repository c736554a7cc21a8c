"""Ordered sequences: neighbours, runs, islands, plateaus. Every window is partitioned by the sequence's key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.names import unused


def with_previous(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str]) -> DataFrame:
    """Add each named column's value in the row before; null in the first row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({new: F.lag(old).over(w) for new, old in columns.items()})


def islands(df: DataFrame, keys: list[str], order: list[str], breaks: Column, name: str = "cluster_id") -> DataFrame:
    """Number the runs that begin at rows where breaks holds, from 1; rows before the first such row get 0."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(breaks.cast("long")).over(w))


def runs_of(df: DataFrame, keys: list[str], order: str, flag: Column, position: str | None = None) -> DataFrame:
    """The runs of consecutive rows that flag holds for: keys, start, end (positions from 0, end excluded), length."""
    w = Window.partitionBy(*keys).orderBy(order)
    at, run = unused(df, "at", "run")
    placed = df.withColumn(at, F.row_number().over(w) - 1) if position is None else df.withColumn(at, F.col(position))
    true = placed.where(flag).withColumn(run, F.col(at) - F.row_number().over(w))
    return true.groupBy(*keys, run).agg(F.min(at).alias("start"), (F.max(at) + 1).alias("end"), F.count("*").alias("length")).drop(run)


def plateau(df: DataFrame, keys: list[str], order: str, value: str, window: int = 5) -> DataFrame:
    """Of each group the last row of its flattest window: rows of keys, rank (from 1), order, value, variance.

    Windows have min(window, rows) rows; the sample variance is rounded so that equal ones tie, and the first
    wins. A group of one row has a null variance and is its own representative.
    """
    n, pick = unused(df, "n", "pick")
    ranked = _windows(df, keys, order, value, window, n)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("variance").asc_nulls_last(), "rank"))
    return ranked.where(F.col("rank") >= F.least(n, F.lit(window))).withColumn(pick, first).where(F.col(pick) == 1).drop(pick, n)


def _windows(df: DataFrame, keys: list[str], order: str, value: str, window: int, n: str) -> DataFrame:
    """keys, order, value, rank (from 1), the group's size under the name n, and the variance of the window that ends at the row."""
    w = Window.partitionBy(*keys).orderBy(order)
    last = w.rowsBetween(-(window - 1), Window.currentRow)
    return df.select(*keys, order, value, F.row_number().over(w).alias("rank"), F.count("*").over(Window.partitionBy(*keys)).alias(n), F.round(F.var_samp(value).over(last), 9).alias("variance"))


def plateau_extents(df: DataFrame, keys: list[str], order: str, value: str, window: int = 5) -> DataFrame:
    """keys, start, end (positions from 0, end included) of each group's flattest window, extended both ways while values stay within three of its standard deviations of its mean.

    The window ends before the next row that doesn't stay and begins after the last one before: two aggregates over the group, combined before their
    shuffle, so that no group is gathered. A window whose values are all equal isn't extended.
    """
    n, pick, mean, reach, low, high, place, seen, out = unused(df, "n", "pick", "mean", "reach", "low", "high", "place", "seen", "out")
    last = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(window - 1), Window.currentRow)
    told = df.select(*keys, order, F.col(value).cast("double").alias(value), F.avg(value).over(last).alias(mean), (3 * F.stddev_pop(value).over(last)).alias(reach))
    ranked = _windows(told.select(*keys, order, value), keys, order, value, window, n)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("variance").asc_nulls_last(), "rank"))
    best = ranked.where(F.col("rank") >= F.least(n, F.lit(window))).withColumn(pick, first).where(F.col(pick) == 1)
    of = unused(df, *(f"of_{k}" for k in (*keys, order)))
    same = lambda a, b, names: [a[x].eqNullSafe(b[o]) for x, o in zip(names, of, strict=False)]
    measures = told.select(*(F.col(k).alias(o) for k, o in zip((*keys, order), of, strict=True)), mean, reach)
    best = best.join(measures, same(best, measures, (*keys, order))).select(*keys, (F.col("rank") - 1).alias(high), (F.col("rank") - F.least(n, F.lit(window))).alias(low), mean, reach, n)
    places = ranked.select(*(F.col(k).alias(o) for k, o in zip(keys, of, strict=False)), (F.col("rank") - 1).alias(place), F.col(value).alias(seen))
    far = best.join(places, same(best, places, keys)).withColumn(out, ~(F.abs(F.col(seen) - F.col(mean)) < F.col(reach)))
    ends = far.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col(out) & (F.col(place) < F.col(low)), F.col(place))) + 1, F.lit(0)).cast("long").alias("start"),
        F.coalesce(F.min(F.when(F.col(out) & (F.col(place) > F.col(high)), F.col(place))) - 1, F.max(n) - 1).cast("long").alias("end"),
    )
    return ends


def flattened(df: DataFrame, items: str, item: str) -> DataFrame:
    """A row for each item of an array column, in its place, with the other columns; empty and null arrays give none."""
    return df.select(*(F.col(c) for c in df.columns if c != items), F.explode(items).alias(item))


def gallery(df: DataFrame, keys: list[str], order: str, item: str, best: str | None = None) -> DataFrame:
    """A row for each group: its items in order as an array, and the best item (the first unless a column tells)."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(order, item))), lambda x: x[item])
    pick = F.element_at(items, 1) if best is None else F.first(best)
    return df.groupBy(*keys).agg(items.alias("frames"), pick.alias("best"))
