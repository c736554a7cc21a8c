"""Geometry: boxes scaled to an image, clamped crops, tables of cells, grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scale_box(box: Column, width: Column, height: Column, ref_width: Column, ref_height: Column) -> Column:
    """A box of the reference size at another size; fractions are cut off."""
    sides = {"x": (width, ref_width), "y": (height, ref_height), "w": (width, ref_width), "h": (height, ref_height)}
    return F.struct(*((box[k] * new / ref).cast("int").alias(k) for k, (new, ref) in sides.items()))


def clamp_crop(box: Column, width: Column, height: Column) -> Column:
    """The part of a box that lies in the image; null if it begins outside or nothing is left.

    A negative start moves to 0 and keeps its extent.
    """
    x, y = F.greatest(box["x"], F.lit(0)), F.greatest(box["y"], F.lit(0))
    w, h = F.least(box["w"], width - x), F.least(box["h"], height - y)
    inside = (box["x"] < width) & (box["y"] < height) & (w > 0) & (h > 0)
    return F.when(inside, F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h")))


def checked_crop(box: Column, width: Column, height: Column) -> Column:
    """As clamp_crop, but a box without a part in the image is an error."""
    return F.coalesce(clamp_crop(box, width, height), F.raise_error(F.concat(F.lit("no part of the box is in the image: "), F.to_json(box))).cast("struct<x:int,y:int,w:int,h:int>"))


def table_layout(cells: DataFrame, keys: list[str], border: int, pad_x: int, pad_y: int) -> DataFrame:
    """Place cells (keys, row_no, col_no, w, h; null w for a missing one) in a table: x1, y1, x2, y2.

    Columns are as wide as their widest cell and rows as high as their highest. A cell stands left and in the
    middle of its height; a missing one takes its whole place. Offsets are running sums over columns and rows, not cells.
    """
    columns = cells.groupBy(*keys, "col_no").agg(F.coalesce(F.max("w"), F.lit(0)).alias("cw"))
    rows = cells.groupBy(*keys, "row_no").agg(F.coalesce(F.max("h"), F.lit(0)).alias("rh"))
    before = lambda by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    columns = columns.withColumn("left", F.lit(pad_x + border) + F.coalesce(F.sum(F.col("cw") + border).over(before("col_no")), F.lit(0)))
    rows = rows.withColumn("top", F.lit(pad_y + border) + F.coalesce(F.sum(F.col("rh") + border).over(before("row_no")), F.lit(0)))
    placed = cells.join(columns, [*keys, "col_no"]).join(rows, [*keys, "row_no"])
    gone = F.col("w").isNull()
    y1 = F.col("top") + F.when(gone, 0).otherwise(F.floor((F.col("rh") - F.col("h")) / 2))
    return placed.select(
        *keys, "row_no", "col_no", F.col("left").cast("long").alias("x1"), y1.cast("long").alias("y1"),
        (F.col("left") + F.coalesce("w", "cw")).cast("long").alias("x2"), (y1 + F.coalesce("h", "rh")).cast("long").alias("y2"),
    )


def canvas_size(cells: DataFrame, keys: list[str], border: int, pad_x: int, pad_y: int) -> DataFrame:
    columns = cells.groupBy(*keys, "col_no").agg(F.coalesce(F.max("w"), F.lit(0)).alias("cw")).groupBy(*keys).agg((F.sum("cw") + (F.count("*") + 1) * border + 2 * pad_x).cast("long").alias("width"))
    rows = cells.groupBy(*keys, "row_no").agg(F.coalesce(F.max("h"), F.lit(0)).alias("rh")).groupBy(*keys).agg((F.sum("rh") + (F.count("*") + 1) * border + 2 * pad_y).cast("long").alias("height"))
    return columns.join(rows, keys)


def best_columns(df: DataFrame, keys: list[str], n: str, w: str, h: str) -> DataFrame:
    """keys, cols, rows: the column count whose grid of n cells is nearest to a square; the smallest of equals.

    A last row that is begun must be half full. Candidates are an array fold inside each row; nothing is exploded.
    """
    count, width, height = F.col(n), F.col(w).cast("double"), F.col(h).cast("double")

    def scored(c: Column) -> Column:
        rows = F.ceil(count / c)
        bad = (count % c != 0) & ((count % c) < c * 0.5)
        return F.struct(F.when(bad, float("inf")).otherwise(F.round(F.abs(c * width / (rows * height) - 1), 9)).alias("score"), c.alias("cols"), rows.alias("rows"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), count.cast("int")), scored))
    return df.select(*keys, F.col(n), best["cols"].cast("long").alias("cols"), best["rows"].cast("long").alias("rows"))


def grid_place(index: Column, cols: Column, w: Column, h: Column, gap: int = 0) -> Column:
    """The place of the index-th cell (from 0), row by row."""
    row, col = F.floor(index / cols), index % cols
    return F.struct(row.alias("row"), col.alias("col"), (col * (w + gap)).alias("x"), (row * (h + gap)).alias("y"))
