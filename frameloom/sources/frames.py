"""Images: decoded frames, labelled folders, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _three_channels(data: Column, channels: Column) -> Column:
    """BGR bytes of pixels of 1, 3 or 4 channels, without Python."""
    edited = lambda pixel, to: F.unhex(F.regexp_replace(F.hex(data), pixel, to))
    return F.when(channels == 1, edited("(..)", "$1$1$1")).when(channels == 4, edited("(......)..", "$1")).otherwise(data)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """issue_id, frame_idx, name, height, width, bgr of the images under path; broken files are left out.

    The frame is the number in the file's name; the issue is that of a folder issue_id=<n>, else 0.
    """
    images = spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")
    name = F.element_at(F.split("origin", "/"), -1)
    data = _three_channels(F.col("data"), F.col("nChannels"))
    issue = F.coalesce(F.nullif(F.regexp_extract("origin", r"issue_id=(\d+)/", 1), F.lit("")).cast("int"), F.lit(0))
    return images.select(issue.alias("issue_id"), F.regexp_extract("origin", r"(\d+)\.[A-Za-z]+$", 1).cast("int").alias("frame_idx"), name.alias("name"), "height", "width", data.alias("bgr"))


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """split, label, name and image of a tree split/label/file."""
    part = lambda i: F.element_at(F.split("path", "/"), i)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(part(-3).alias("split"), part(-2).alias("label"), part(-1).alias("name"), "content")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """samples: a map from the name of each PNG, without its extension, to its place. For a folder of samples."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(path).select("path")
    item = F.struct(F.regexp_extract("path", r"([^/]+)\.png$", 1), F.concat(F.lit("/sample/"), F.element_at(F.split("path", "/"), -1)))
    return files.agg(F.map_from_entries(F.array_sort(F.collect_list(item))).alias("samples"))
