"""Worst, best and first rows of groups, with ties named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.names import unused


def first_of_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in the given order, all its columns.

    A rank of 1 in a window: Spark limits such windows before the shuffle, so of each group a task sends one row.
    """
    (at,) = unused(df, "rank")
    return df.withColumn(at, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(at) == 1).drop(at)


def worst_of(df: DataFrame, keys: list[str], cost: str, *position: str) -> DataFrame:
    """The row of the highest cost in each group; of equals the one of the first position. NaN counts as below all."""
    clean = F.when(F.isnan(cost), None).otherwise(F.col(cost))
    return first_of_group(df, keys, [clean.desc_nulls_last(), *(F.col(p).asc() for p in position)])


best_of = worst_of


def skip_first(df: DataFrame, keys: list[str], order: list[Column], where: Column) -> DataFrame:
    """All rows but the first of each group that `where` holds for."""
    (at,) = unused(df, "rank")
    return df.withColumn(at, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where((F.col(at) > 1) | ~where).drop(at)


def sample_first(df: DataFrame, keys: list[str], time: str, seconds: int, position: str) -> DataFrame:
    """The first row of each interval of so many seconds."""
    bucket = F.floor(F.unix_timestamp(F.col(time).cast("timestamp")) / seconds)  # the column bucket is part of the result
    return first_of_group(df.withColumn("bucket", bucket), [*keys, "bucket"], [F.col(time), F.col(position)])


def flagged(df: DataFrame, keep: Column, name: str) -> DataFrame:
    """df with a column that tells whether keep holds; false where it is null. One pass, for what needs both halves together."""
    return df.withColumn(name, F.coalesce(keep, F.lit(False)))


def split_by(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that keep holds for, all others): together all rows, none twice; each half reads df, so this is for two sinks."""
    held = F.coalesce(keep, F.lit(False))
    return df.where(held), df.where(~held)


def seeded_split(df: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """split: train for the first int(n * share) rows in a seeded order of their keys, val for the others.

    The order is arithmetic on the key, so that any engine repeats it. The cut is found from counts of 1024 ranges
    of that order; only rows of the range it falls into are numbered.
    """
    spread, ranges = 2_147_483_647, 1024
    at, range_, left, rank = unused(df, "at", "range", "left", "rank")
    placed = df.withColumn(at, F.pmod(F.pmod(F.col(key), F.lit(spread)) * 48271 + seed, F.lit(spread))).withColumn(range_, F.floor(F.col(at) / (spread // ranges + 1)))
    counts = placed.groupBy(range_).agg(F.count("*").alias("n"))
    before = Window.orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cuts = counts.select(range_, (F.floor(F.sum("n").over(everything) * share) - F.coalesce(F.sum("n").over(before), F.lit(0))).alias(left))
    joined = placed.join(F.broadcast(cuts), range_).withColumn(rank, F.row_number().over(Window.partitionBy(range_).orderBy(at, key)))  # 1024 rows at most
    return joined.withColumn("split", F.when(F.col(rank) <= F.col(left), "train").otherwise("val")).drop(at, range_, left, rank)
