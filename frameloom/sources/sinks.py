"""Writers."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_stats(df: DataFrame, path: str) -> None:
    """CSV with a header, the index column first; quotes are doubled."""
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_gallery(df: DataFrame, path: str) -> None:
    """id, best, frames and an empty indicator for each item, as JSON lines."""
    df.withColumn("indicator", F.create_map().cast("map<string,string>")).select("id", "best", "frames", "indicator").write.mode("overwrite").json(path)


def write_check(df: DataFrame, path: str) -> None:
    """An ordered check table as one CSV file: it is a sheet's, for a person to correct."""
    df.coalesce(1).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_split(df: DataFrame, path: str) -> None:
    """A labelled data set by split and label, so that readers of one prune the others."""
    df.write.mode("overwrite").partitionBy("split", "label").parquet(path)


def write_issues(df: DataFrame, path: str) -> None:
    df.repartition("issue_id").write.mode("overwrite").partitionBy("issue_id").parquet(path)


def write_lines(df: DataFrame, line: str, order: list[str | Column], path: str) -> None:
    df.orderBy(*order).select(line).coalesce(1).write.mode("overwrite").text(path)


def write_document(df: DataFrame, path: str) -> None:
    """A JSON document of themes and their records (theme, order, record; one row of each theme and order): one line.

    Pieces stand side by side in one file, with a space after each; no row holds more than a record.
    """
    theme, order, record = (F.col(c) for c in df.columns)
    themes = df.groupBy(theme.alias("theme")).agg(F.min(order).alias("first"))
    least = themes.agg(F.min("theme").alias("least"))
    named = F.to_json(F.struct("theme"))
    none = F.lit(None).cast(df.schema[1].dataType)
    row = lambda at, name, kind, place, piece: [F.lit(at).alias("at"), name.alias("theme"), F.lit(kind).alias("kind"), place.alias("place"), piece.alias("piece")]
    ends = [least.select(*row(at, F.lit(None).cast("string"), 0, none, F.lit(piece))) for at, piece in ((0, "{"), (2, "}"))]
    heads = themes.crossJoin(least).select(*row(1, F.col("theme"), 0, none, F.concat(F.when(F.col("theme") == F.col("least"), "").otherwise(", "), named.substr(F.lit(10), F.length(named) - 10), F.lit(": ["))))
    tails = themes.select(*row(1, F.col("theme"), 2, none, F.lit("]")))
    records = df.select(theme.alias("theme"), order.alias("place"), record.alias("record")).join(themes, "theme")
    body = records.select(*row(1, F.col("theme"), 1, F.col("place"), F.concat(F.when(F.col("place") == F.col("first"), "").otherwise(", "), F.col("record"))))
    pieces = ends[0].unionByName(ends[1]).unionByName(heads).unionByName(tails).unionByName(body)
    pieces.orderBy("at", "theme", "kind", "place").select("piece").coalesce(1).write.mode("overwrite").option("lineSep", " ").text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_roi(boxes: DataFrame, path: str) -> None:
    """A region config (pos, name, box, ref_width, ref_height and, if it has one, color; one size) as one JSON document, as read_roi reads it."""
    box = F.struct((F.col("pos") + 1).alias("id"), "name", "box.x", "box.y", "box.w", "box.h", *(["color"] if "color" in boxes.columns else []))
    items = F.array_sort(F.collect_list(F.struct("pos", box.alias("b"))))
    config = boxes.groupBy(F.col("ref_width").alias("referenceWidth"), F.col("ref_height").alias("referenceHeight")).agg(F.transform(items, lambda x: x["b"]).alias("boxes"))
    config.coalesce(1).write.mode("overwrite").json(path)


def write_marks(marks: DataFrame, path: str) -> None:
    """Posted marks (id, url, deleted) in the form that read_marks reads."""
    marks.select("id", "url", F.col("deleted").alias("del")).write.mode("overwrite").json(path)


def write_track(tracks: DataFrame, path: str) -> None:
    """A JSON file of each issue's track, an array of arrays, under its number."""
    tracks.write.mode("overwrite").partitionBy("issue_id").text(path)


def logger(name: str, file: str | None = None) -> logging.Logger:
    """A driver's logger: INFO and above to the console, all to the file if one is given."""
    log = logging.getLogger(name)
    log.setLevel(logging.DEBUG)
    if not log.handlers:
        console = logging.StreamHandler()
        console.setLevel(logging.INFO)
        log.addHandler(console)
        if file:
            log.addHandler(logging.FileHandler(file, encoding="utf-8"))
    return log
