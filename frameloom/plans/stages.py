"""Pipelines of stages with a Parquet table between each two, and the frame pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import scoring
from frameloom.operators import clusters, images, records

Stage = Callable[[DataFrame], DataFrame]


def run_stages(spark: SparkSession, stages: list[tuple[str, Stage]], source: DataFrame | None, path: str, start: int = 0) -> DataFrame:
    """Run the stages from number start on, each from the table that the one before it wrote under path."""
    df = source if start == 0 else spark.read.parquet(f"{path}/{start - 1:02d}_{stages[start - 1][0]}")
    for k, (name, stage) in list(enumerate(stages))[start:]:
        stage(df).write.mode("overwrite").parquet(where := f"{path}/{k:02d}_{name}")
        df = spark.read.parquet(where)
    return df


def one_of_each(frames: DataFrame, least: float = scoring.SAME_KEEP) -> DataFrame:
    """One frame of each run of like ones."""
    _, kept = images.same_frames(images.pair_scores(frames), least)
    return frames.join(kept.drop("cluster_id"), ["issue_id", "frame_idx"], "left_semi")


def grouped_frames(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """Frames with the colour cluster and theme of their issue's groups."""
    scores = images.colour_scores(frames, boxes).withColumn("features", F.array("mean_a", "mean_b", "std_a", "std_b"))
    numbered = clusters.issue_clusters(scores, ["issue_id"], "frame_idx", "features").join(scores.select("issue_id", "frame_idx", "blue", "green", "red"), ["issue_id", "frame_idx"])
    themed = images.group_themes(numbered)
    return frames.join(numbered.select("issue_id", "frame_idx", "cluster_id"), ["issue_id", "frame_idx"]).join(themed.select("issue_id", "cluster_id", "theme"), ["issue_id", "cluster_id"])


def frame_stages(boxes: DataFrame, themed_boxes: DataFrame | None = None) -> list[tuple[str, Stage]]:
    """Frames to one standard image for each look, with its colour cluster, and, given the themes' boxes, to the cells of the sheets."""
    return [
        ("ready", images.standardise),
        ("bright", lambda f: images.good_frames(f, images.dark_scores(f), scoring.DARK_KEEP)),
        ("complete", lambda f: images.good_frames(f, images.line_scores(f, boxes), scoring.LINE_KEEP)),
        ("single", one_of_each),
        ("group", lambda f: grouped_frames(f, boxes)),
        *([] if themed_boxes is None else [("cells", lambda f: images.take_cells(f, themed_boxes))]),
    ]


def sheet_files(cells: DataFrame) -> dict[str, tuple[DataFrame, DataFrame, DataFrame]]:
    """(sheet, places, themes) of each kind of sheet, info and data: the image, the cells' places and their themes of each issue."""
    out = {}
    for kind, labels in (("info", records.INFO_LABELS), ("data", records.DATA_LABELS)):
        places = images.sheet_places(cells, labels)
        out[kind] = images.sheets(cells, places), *images.tracks(places)
    return out
