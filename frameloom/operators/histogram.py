"""Histograms and what is read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.names import unused


def histogram(df: DataFrame, keys: list[str], value: str, width: float) -> DataFrame:
    """keys, bin, n: counts of floor(value / width). Combines before its shuffle, so no group has to fit a task."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, F.floor(F.col(value) / width).alias("bin")).agg(F.count("*").alias("n"))


def centroid(bins: DataFrame, keys: list[str]) -> DataFrame:
    return bins.groupBy(*keys).agg((F.sum(F.col("bin") * F.col("n")) / F.sum("n")).alias("centroid"))


def entropy(bins: DataFrame, keys: list[str]) -> DataFrame:
    """Bits of the share of each bin."""
    p = F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    return bins.withColumn("p", p).groupBy(*keys).agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"))


def otsu(bins: DataFrame, keys: list[str]) -> DataFrame:
    """keys, threshold, variance: the bin after which a cut parts the values best; the first of equals.

    Windows run over bins, not rows; the variance between the classes is rounded so that equal cuts tie.
    """
    w = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    mass = F.col("bin") * F.col("n")
    cut = bins.select(*keys, "bin", F.sum("n").over(w).alias("n0"), F.sum(mass).over(w).alias("m0"), F.sum("n").over(whole).alias("nn"), F.sum(mass).over(whole).alias("mm"))
    n1 = F.col("nn") - F.col("n0")
    gap = F.col("m0") / F.col("n0") - (F.col("mm") - F.col("m0")) / n1
    share = (F.col("n0") / F.col("nn")) * (n1 / F.col("nn"))
    scored = cut.withColumn("variance", F.when(n1 == 0, 0.0).otherwise(F.round(share * gap * gap, 6)))
    pick = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("variance"), "bin"))
    (at,) = unused(scored, "pick")
    return scored.withColumn(at, pick).where(F.col(at) == 1).select(*keys, F.col("bin").alias("threshold"), "variance")


def shares_below(df: DataFrame, keys: list[str], value: str, cuts: dict[str, float]) -> DataFrame:
    """For each cut the share of values below it."""
    return df.groupBy(*keys).agg(*(F.avg((F.col(value) < c).cast("double")).alias(n) for n, c in cuts.items()))
