"""Operators on frames (issue_id, frame_idx, name, height, width, bgr): features in Arrow batches, decisions in SQL.

Each operator selects the columns that it needs before its pixels go to Python, and no pixels leave it unless they are
its result. All windows are partitioned by issue.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions import colour, pixels, scoring
from frameloom.operators import layout, rank, records, sequence

KEYS = "issue_id int, frame_idx int"
# Boxes of a frame, 512 by 384, and of a standard image, 172 by 512.
FRAME_SIZE = (512, 384)
MOST_BOXES = 10_000
FRAME_BOXES = {"stats": (412, 0, 100, 312), "title": (0, 312, 512, 72)}


def image_of(row, data: str = "bgr") -> np.ndarray:
    x = np.frombuffer(row[data], np.uint8)
    return x.reshape(row["height"], row["width"], -1) if len(x) > row["height"] * row["width"] else x.reshape(row["height"], row["width"])


def cropped(image: np.ndarray, box: dict) -> np.ndarray:
    return image[box["y"] : box["y"] + box["h"], box["x"] : box["x"] + box["w"]]


def _mapped(df: DataFrame, columns: list[str], kernel: Callable[[dict], dict | list[dict] | None], schema: str) -> DataFrame:
    """Apply a kernel to rows of the named columns; each gives a row, several or none."""
    names = [x.split()[0] for x in schema.replace("\n", " ").split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                found = kernel(row)
                out += [] if found is None else found if isinstance(found, list) else [found]
            yield pd.DataFrame(out, columns=names)

    return df.select(*columns).mapInPandas(run, schema)


def standardise(frames: DataFrame) -> DataFrame:
    """The title, turned clockwise, beside the statistics of each frame; a frame without them is an error."""
    boxed = frames
    for name, (x, y, w, h) in FRAME_BOXES.items():
        box = F.struct(*(F.lit(v).alias(k) for k, v in zip("xywh", (x, y, w, h), strict=True)))
        scaled = layout.scale_box(box, F.col("width"), F.col("height"), F.lit(FRAME_SIZE[0]), F.lit(FRAME_SIZE[1]))
        boxed = boxed.withColumn(name, layout.checked_crop(scaled, F.col("width"), F.col("height")))

    def ready(row: dict) -> dict:
        image = image_of(row)
        out = pixels.beside([np.rot90(cropped(image, row["title"]), -1), cropped(image, row["stats"])])
        return {k: row[k] for k in ("issue_id", "frame_idx", "name")} | {"height": out.shape[0], "width": out.shape[1], "bgr": out.tobytes()}

    return _mapped(boxed, ["issue_id", "frame_idx", "name", "height", "width", "bgr", "title", "stats"], ready, f"{KEYS}, name string, height int, width int, bgr binary")


def dark_scores(frames: DataFrame) -> DataFrame:
    """cost and the eight features of each frame's darkness."""
    names = list(scoring.DARK_WEIGHTS)
    found = _mapped(frames, ["issue_id", "frame_idx", "height", "width", "bgr"], lambda r: {"issue_id": r["issue_id"], "frame_idx": r["frame_idx"]} | pixels.dark_features(image_of(r)), ", ".join([KEYS, *(f"{n} double" for n in names)]))
    return found.select("issue_id", "frame_idx", scoring.dark_cost().alias("cost"), *names)


def with_boxes(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """Each frame once, with all boxes of a region config (pos, name, box, ref_width, ref_height) scaled to it as an array.

    A config is a few boxes in a file; it comes as one row, whatever its sizes, so that the pixels are not copied for each box and no frame twice. More than
    MOST_BOXES boxes are an error, as that row goes to every task.
    """
    every = boxes.agg(F.array_sort(F.collect_list(F.struct("pos", "name", "box", "ref_width", "ref_height"))).alias("config"))
    checked = F.when(F.size("config") <= MOST_BOXES, F.col("config")).otherwise(F.raise_error(F.lit(f"a region config of more than {MOST_BOXES} boxes")).cast(every.schema["config"].dataType))
    scaled = F.transform("config", lambda c: F.struct(c["pos"].alias("pos"), c["name"].alias("name"), layout.checked_crop(layout.scale_box(c["box"], F.col("width"), F.col("height"), c["ref_width"], c["ref_height"]), F.col("width"), F.col("height")).alias("box")))
    return frames.join(F.broadcast(every.select(checked.alias("config")))).withColumn("boxes", scaled)


def line_scores(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """Of each frame the region whose line is most likely missing, with all its features; the first of equals."""
    names = ["concentration", "h_cont", "peak", "outside_max", "first", "last", "rows", "band_ratio"]

    def regions(row: dict) -> list[dict]:
        image = image_of(row)
        return [{"issue_id": row["issue_id"], "frame_idx": row["frame_idx"], "pos": b["pos"]} | pixels.line_features(cropped(image, b["box"])) for b in row["boxes"]]

    found = _mapped(with_boxes(frames, boxes), ["issue_id", "frame_idx", "height", "width", "bgr", "boxes"], regions, ", ".join([KEYS, "pos int", *(f"{n} double" for n in names)]))
    purity = scoring.background_purity(F.col("outside_max"), F.col("band_ratio"))
    scattered = scoring.dispersion(F.col("first"), F.col("last"), F.col("rows"))
    scored = found.withColumns({"bg_purity": purity, "dispersion": scattered}).withColumn("cost", scoring.line_cost(F.col("concentration"), F.col("h_cont"), F.col("peak"), F.col("bg_purity"), F.col("dispersion"), F.col("band_ratio")))
    worst = rank.worst_of(scored, ["issue_id", "frame_idx"], "cost", "pos")
    return worst.select("issue_id", "frame_idx", "cost", "concentration", "h_cont", "peak", "bg_purity", "dispersion", "band_ratio")


def pair_scores(frames: DataFrame) -> DataFrame:
    """Likeness of each frame to the one before it; all zeros for an issue's first. Only the gray images enter the window."""
    names = ["psim", "absdiff", "ssim", "l", "c", "s", "mu", "sigma"]
    grays = _mapped(frames, ["issue_id", "frame_idx", "height", "width", "bgr"], lambda r: {k: r[k] for k in ("issue_id", "frame_idx", "height", "width")} | {"gray": pixels.gray(image_of(r)).tobytes()}, f"{KEYS}, height int, width int, gray binary")
    paired = sequence.with_previous(grays, ["issue_id"], ["frame_idx"], {"before": "gray"})

    def compared(row: dict) -> dict:
        key = {"issue_id": row["issue_id"], "frame_idx": row["frame_idx"]}
        if row["before"] is None or len(row["before"]) != len(row["gray"]):
            return key | dict.fromkeys(names, 0.0)
        return key | pixels.pair_features(image_of(row, "before"), image_of(row, "gray"))

    found = _mapped(paired, ["issue_id", "frame_idx", "height", "width", "gray", "before"], compared, ", ".join([KEYS, *(f"{n} double" for n in names)]))
    return found.select("issue_id", "frame_idx", scoring.similarity(F.col("psim"), F.col("ssim")).alias("sim"), *names)


def same_frames(pairs: DataFrame, least: float = scoring.SAME_KEEP) -> tuple[DataFrame, DataFrame]:
    """(every frame with its cluster_id, one frame of each cluster): the last of its flattest stretch of differences."""
    found = sequence.islands(pairs, ["issue_id"], ["frame_idx"], F.col("sim") < least)
    return found, sequence.plateau(found, ["issue_id", "cluster_id"], "frame_idx", "absdiff").select("issue_id", "cluster_id", "frame_idx")


def colour_scores(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """Means over regions: features count an empty region as zeros, colours leave it out and are 128 if all are empty."""
    names = ["mean_a", "mean_b", "std_a", "std_b"]

    def regions(row: dict) -> list[dict]:
        image = image_of(row)
        return [{"issue_id": row["issue_id"], "frame_idx": row["frame_idx"]} | pixels.colour_features(cropped(image, b["box"])) for b in row["boxes"]]

    found = _mapped(with_boxes(frames, boxes), ["issue_id", "frame_idx", "height", "width", "bgr", "boxes"], regions, ", ".join([KEYS, *(f"{n} double" for n in [*names, "blue", "green", "red"])]))
    return found.groupBy("issue_id", "frame_idx").agg(*scoring.region_means(names, ["blue", "green", "red"]))


def group_themes(groups: DataFrame) -> DataFrame:
    """issue_id, cluster_id, h, s, v, theme of clusters from the mean colour of their frames, cut to whole numbers."""
    means = groups.groupBy("issue_id", "cluster_id").agg(*(F.avg(c).cast("int").alias(c) for c in ("blue", "green", "red")))
    out = means.withColumn("hsv", colour.hsv(F.col("blue"), F.col("green"), F.col("red"))).select("issue_id", "cluster_id", "hsv.*")
    return out.withColumn("theme", colour.palette_name(F.col("h"), F.col("s")))


def quality_scores(frames: DataFrame) -> DataFrame:
    names = ["blur", "bright", "contrast", "entropy", "dark", "over"]
    found = _mapped(frames, ["issue_id", "frame_idx", "height", "width", "bgr"], lambda r: {"issue_id": r["issue_id"], "frame_idx": r["frame_idx"]} | pixels.quality_features(image_of(r)), ", ".join([KEYS, *(f"{n} double" for n in names)]))
    score = scoring.quality(*(F.col(n) for n in ("blur", "contrast", "entropy", "dark", "over")))
    return found.select("issue_id", "frame_idx", score.alias("score"), *names)


def take_cells(frames: DataFrame, themed_boxes: DataFrame) -> DataFrame:
    """Cells (issue_id, cluster_id, frame_idx, theme, label, height, width, gray) of frames with a theme and a cluster.

    themed_boxes: theme, pos, name, box, ref_width, ref_height. The first frame of an orange cluster (not of one that only borrows its layout) is left
    out. Info cells are turned counter-clockwise; rates get a white border of 2; all are brought to the height of the title. A box outside the image is an
    error. Frames of a theme without boxes give one row without a label, so that they keep their row of the sheet.
    """
    later = rank.skip_first(frames.select("issue_id", "cluster_id", "frame_idx", "theme"), ["issue_id", "cluster_id"], [F.col("frame_idx")], F.col("theme") == "orange")
    frames = frames.join(later.select("issue_id", "frame_idx"), ["issue_id", "frame_idx"], "left_semi")
    config = themed_boxes.groupBy("theme", "ref_width", "ref_height").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "box"))).alias("config")).withColumnRenamed("theme", "layout_theme")
    joined = frames.withColumn("layout_theme", colour.layout_theme(F.col("theme"))).join(config, "layout_theme", "left")
    scaled = F.transform("config", lambda c: F.struct(c["name"].alias("name"), layout.checked_crop(layout.scale_box(c["box"], F.col("width"), F.col("height"), F.col("ref_width"), F.col("ref_height")), F.col("width"), F.col("height")).alias("box")))

    def cells(row: dict) -> list[dict]:
        image, found, key = pixels.gray(image_of(row)), {}, {k: row[k] for k in ("issue_id", "cluster_id", "frame_idx", "theme")}
        for b in row["boxes"] if row["boxes"] is not None else ():
            if b["name"] not in (*records.INFO_LABELS, *records.DATA_LABELS):
                continue
            cell = cropped(image, b["box"])
            cell = np.rot90(cell) if b["name"] in records.INFO_LABELS else cell
            found[b["name"]] = pixels.bordered(cell, 2, 2) if b["name"].endswith("rate") else cell
        high = found["title"].shape[0] if "title" in found else 0
        out = []
        for label, cell in found.items():
            if high and cell.shape[0] != high:
                cell = pixels.resized(cell, max(1, int(cell.shape[1] * high / cell.shape[0])), high)
            out.append(key | {"label": label, "height": cell.shape[0], "width": cell.shape[1], "gray": np.ascontiguousarray(cell).tobytes()})
        return out or [key | dict.fromkeys(("label", "height", "width", "gray"))]

    schema = "issue_id int, cluster_id int, frame_idx int, theme string, label string, height int, width int, gray binary"
    return _mapped(joined.withColumn("boxes", scaled), ["issue_id", "cluster_id", "frame_idx", "theme", "height", "width", "bgr", "boxes"], cells, schema)


def sheet_places(cells: DataFrame, labels: tuple[str, ...], border: int = 1, pad: int = 12) -> DataFrame:
    """Where each frame's cells stand on its issue's sheet, rows by cluster and frame: issue_id, row_no, col_no, x1, y1, x2, y2, label, frame_idx, theme (null for a missing cell)."""
    rows = cells.select("issue_id", "cluster_id", "frame_idx").distinct().withColumn("row_no", F.row_number().over(Window.partitionBy("issue_id").orderBy("cluster_id", "frame_idx")) - 1)
    grid = rows.withColumn("column", F.explode(F.array(*(F.struct(F.lit(i).alias("col_no"), F.lit(x).alias("label")) for i, x in enumerate(labels))))).select("issue_id", "frame_idx", "row_no", "column.*")
    full = grid.join(cells.select("issue_id", "frame_idx", "label", "theme", F.col("width").alias("w"), F.col("height").alias("h")), ["issue_id", "frame_idx", "label"], "left")
    placed = layout.table_layout(full, ["issue_id"], border, pad, pad)
    return placed.join(full.select("issue_id", "row_no", "col_no", "label", "frame_idx", "theme"), ["issue_id", "row_no", "col_no"])


def sheets(cells: DataFrame, places: DataFrame, ground: int = 255, border: int = 1, border_gray: int = 22, pad: int = 12) -> DataFrame:
    """issue_id, height, width, png: a sheet for each issue, whose cells are few. Lines stand around all rows and columns; what no cell covers is ground."""
    own = cells.select("issue_id", "frame_idx", "label", F.col("height").alias("h"), F.col("width").alias("w"), "gray")
    joined = places.join(own, ["issue_id", "frame_idx", "label"], "left")

    def drawn(rows: pd.DataFrame) -> pd.DataFrame:
        ends = []  # of the lines before each column or row and after the last
        for place, extent in (("col_no", "w"), ("row_no", "h")):
            most = rows.groupby(place)[extent].max().sort_index().fillna(0).astype(int)
            ends.append(pad + np.cumsum(np.append(0, most.to_numpy() + border)))
        (xs, ys), image = ends, np.full((ends[1][-1] + border + pad, ends[0][-1] + border + pad), ground, np.uint8)
        for y in ys:
            image[y : y + border, pad : xs[-1] + border] = border_gray
        for x in xs:
            image[pad : ys[-1] + border, x : x + border] = border_gray
        for x, y, h, w, gray in rows[["x1", "y1", "h", "w", "gray"]].itertuples(index=False):
            if gray is not None:
                image[y : y + int(h), x : x + int(w)] = np.frombuffer(gray, np.uint8).reshape(int(h), int(w))
        return pd.DataFrame({"issue_id": [rows["issue_id"].iloc[0]], "height": [image.shape[0]], "width": [image.shape[1]], "png": [pixels.png(image)]})

    return joined.groupBy("issue_id").applyInPandas(drawn, "issue_id int, height int, width int, png binary")


def tracks(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(issue_id, track) of places and of themes: for each issue a JSON array of rows, each an array of its cells' corners, or themes (null for a missing cell)."""
    rows = lambda item: places.groupBy("issue_id", "row_no").agg(F.array_sort(F.collect_list(F.struct("col_no", item.alias("item")))).alias("cells"))
    row = F.struct("row_no", F.transform("cells", lambda c: c["item"]).alias("items"))
    track = lambda item: rows(item).groupBy("issue_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["items"])).alias("track"))
    return track(F.struct("x1", "y1", "x2", "y2")), track(F.col("theme"))


def good_frames(frames: DataFrame, scores: DataFrame, keep: float) -> DataFrame:
    """The frames whose cost is within keep."""
    good, _ = rank.split_by(scores.select("issue_id", "frame_idx", "cost"), scoring.passes(F.col("cost"), keep))
    return frames.join(good.drop("cost"), ["issue_id", "frame_idx"], "left_semi")
