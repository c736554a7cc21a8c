"""Colours: hue, saturation and value in 8 bits, palette names, theme aliases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hue ranges, first match wins; the least saturation of a colour; themes that share a layout.
PALETTE = (("pink", 170, 180), ("orange", 0, 25), ("green", 36, 85), ("blue", 86, 130), ("purplu", 131, 170))
LEAST_SATURATION, OTHER = 25, "orange"
ALIASES = {"purplu": "orange", "green": "orange"}


def palette_name(h: Column, s: Column) -> Column:
    out = F.when(s < LEAST_SATURATION, "gray")
    for name, low, high in PALETTE:
        out = out.when(h.between(low, high), name)
    return out.otherwise(OTHER)


def layout_theme(theme: Column) -> Column:
    return F.coalesce(*(F.when(theme == a, b) for a, b in ALIASES.items()), theme)


def hsv(b: Column, g: Column, r: Column) -> Column:
    """(h 0 to 179, s, v 0 to 255) of 8-bit blue, green and red."""
    v, low = F.greatest(b, g, r), F.least(b, g, r)
    span = (v - low).cast("double")
    degree = F.when(span == 0, 0.0).when(v == r, 60 * (g - b) / span).when(v == g, 120 + 60 * (b - r) / span).otherwise(240 + 60 * (r - g) / span)
    hue = F.round(F.when(degree < 0, degree + 360).otherwise(degree) / 2).cast("int") % 180
    return F.struct(hue.alias("h"), F.when(v == 0, 0).otherwise(F.round(255 * span / v)).cast("int").alias("s"), v.cast("int").alias("v"))
