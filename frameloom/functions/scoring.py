"""Scores as native expressions, so that they stay in one generated stage and can be pushed down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The weights and thresholds of the frame scores.
DARK_WEIGHTS = {
    "gray_mean": 0.10, "dark_ratio": 0.20, "hist_centroid": 0.10, "hsv_v": 0.10,
    "lab_l": 0.20, "very_dark_ratio": 0.15, "dark_concentration": 0.10, "max_dark_region": 0.05,
}
DARK_KEEP, LINE_KEEP, SAME_KEEP = 0.03445, 0.25, 0.93
SIGMOID_SLOPE, SIGMOID_CENTRE = 8.0, 0.5


def weighted_sum(weights: dict[str, float]) -> Column:
    return reduce(lambda a, b: a + b, (F.col(name) * F.lit(w) for name, w in weights.items()))


def sigmoid(x: Column, slope: float = SIGMOID_SLOPE, centre: float = SIGMOID_CENTRE) -> Column:
    return 1.0 / (1.0 + F.exp(-slope * (x - centre)))


def dark_cost() -> Column:
    """Cost of darkness from its eight features; 0.5 is the middle."""
    return sigmoid(weighted_sum(DARK_WEIGHTS))


def background_purity(outside_max: Column, band_ratio: Column) -> Column:
    """How empty it is outside the main band; bands over half the height count against it."""
    return (1.0 - outside_max) * (1.0 - F.greatest(band_ratio - 0.5, F.lit(0.0)) / 0.5)


def dispersion(first: Column, last: Column, rows: Column) -> Column:
    """How scattered the rows with content are: 0 for none or one."""
    return F.when(rows <= 1, 0.0).otherwise(F.least(((last - first + 1) / rows - 1) * 0.5, F.lit(1.0)))


def line_cost(concentration: Column, h_cont: Column, peak: Column, purity: Column, scattered: Column, band_ratio: Column) -> Column:
    """Cost of a region's missing line: low for one strong, continuous band over clean ground."""
    off = F.least(F.abs(band_ratio - 0.35) / 0.5, F.lit(1.0))
    return 0.20 * (1 - concentration) + 0.20 * (1 - h_cont) + 0.15 * (1 - peak) + 0.20 * (1 - purity) + 0.15 * scattered + 0.10 * off


def region_means(features: list[str], colours: list[str], default: float = 128.0) -> list[Column]:
    """Means over regions, as aggregates: a region without a feature (null) counts as zero, one without a colour (null or NaN) is left out; no colour at all is the default."""
    zero, seen = (lambda c: F.coalesce(F.col(c), F.lit(0.0))), (lambda c: F.when(~F.isnan(c), F.col(c)))
    return [*(F.avg(zero(c)).alias(c) for c in features), *(F.coalesce(F.avg(seen(c)), F.lit(default)).alias(c) for c in colours)]


def similarity(psim: Column, ssim: Column) -> Column:
    return 0.1 * psim + 0.9 * ssim


def quality(blur: Column, contrast: Column, entropy: Column, dark: Column, over: Column) -> Column:
    """Sharp, rich in contrast and detail, and neither dark nor burnt out."""
    return (0.5 * blur + 0.3 * contrast + 0.2 * entropy) / (1 + 10 * dark + 10 * over)


def passes(cost: Column, threshold: float) -> Column:
    """Whether a cost is within the threshold; a null or NaN cost is not, so that passes and not passes split all rows."""
    return F.coalesce((cost <= threshold) & ~F.isnan(cost), F.lit(False))
