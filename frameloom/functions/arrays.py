"""Folds and pair measures over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C1, C2 = 6.5025, 58.5225


def longest_true_run(flags: Column) -> Column:
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(state: Column, flag: Column) -> Column:
        now = F.when(flag, state["now"] + 1).otherwise(F.lit(0))
        return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"))

    return F.aggregate(flags, start, step, lambda state: state["best"])


def array_mean(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / F.size(x)


def absolute_difference(x: Column, y: Column) -> Column:
    return array_mean(F.zip_with(x, y, lambda a, b: F.abs(a - b)))


def psim(x: Column, y: Column, least: float) -> Column:
    """The share of places where x and y differ by no more than least."""
    return 1 - F.size(F.filter(F.zip_with(x, y, lambda a, b: F.abs(a - b)), lambda d: d > least)) / F.size(x)


def ssim(x: Column, y: Column, c1: float = C1, c2: float = C2) -> Column:
    """(ssim, l, c, s) with one window over the whole arrays: likeness of level, contrast and structure."""
    mx, my = array_mean(x), array_mean(y)
    vx, vy = (F.greatest(array_mean(F.transform(z, lambda a: a * a)) - m * m, F.lit(0.0)) for z, m in ((x, mx), (y, my)))
    cov = array_mean(F.zip_with(x, y, lambda a, b: a * b)) - mx * my
    deviations = F.sqrt(vx * vy)
    level, contrast, structure = (2 * mx * my + c1) / (mx * mx + my * my + c1), (2 * deviations + c2) / (vx + vy + c2), (cov + c2 / 2) / (deviations + c2 / 2)
    return F.struct((level * contrast * structure).alias("ssim"), level.alias("l"), contrast.alias("c"), structure.alias("s"))
