"""Text, CSV and JSON files of the record, catalogue, review and log operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.sources.scratch import written

ROI_SCHEMA = "referenceWidth int, referenceHeight int, boxes array<struct<id:int,name:string,x:int,y:int,w:int,h:int,color:int>>"


def read_roi(spark: SparkSession, path: str) -> DataFrame:
    """pos, name, box, ref_width, ref_height, color of a region config; of boxes of one name the last stays, in the first's place.

    A missing file raises FileNotFoundError, one that isn't such a config ValueError.
    """
    try:
        raw = spark.read.schema(ROI_SCHEMA + ", _corrupt_record string").option("multiLine", True).json(path)
        head = raw.select("referenceWidth", F.size("boxes").alias("n")).first()
    except AnalysisException as e:
        raise FileNotFoundError(path) from e
    if head is None or head["referenceWidth"] is None or head["n"] < 0:
        raise ValueError(f"{path} is no region config")
    boxes = raw.select("referenceWidth", "referenceHeight", F.posexplode("boxes").alias("pos", "b"))
    last = F.max(F.struct("pos", "b"))["b"]
    found = boxes.groupBy("referenceWidth", "referenceHeight", F.col("b.name").alias("name")).agg(F.min("pos").alias("pos"), last.alias("b"))
    return found.select("pos", "name", F.struct("b.x", "b.y", "b.w", "b.h").alias("box"), F.col("referenceWidth").alias("ref_width"), F.col("referenceHeight").alias("ref_height"), F.col("b.color").alias("color"))


def read_sheet(spark: SparkSession, path: str, labels: tuple[str, ...]) -> DataFrame:
    """row_no and the labels' cells of a recognised sheet: ";" between cells, no header, cells beyond the labels left out.

    The row's number is its line's in the file, which is one sheet.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")).alias("row_no", "line"))
    schema = ", ".join(f"{x} string" for x in labels)
    return lines.select("row_no", F.from_csv("line", F.lit(schema), {"sep": ";"}).alias("c")).select("row_no", "c.*")


def read_check(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(header=True, escape='"').schema("nu string, label string, value string").csv(path).withColumn("nu", F.col("nu").try_cast("int"))


def read_theme_track(spark: SparkSession, path: str) -> DataFrame:
    """nu, theme: the first theme of each row of a track, an array of arrays."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<array<string>>")).alias("nu", "themes"))
    return rows.select("nu", F.get("themes", F.lit(0)).alias("theme"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """log, line_no (from 0), line of each file. A large file is read in blocks by many tasks.

    A line's number is that of the lines in the file's blocks before its own, a count, and its place in the block, in which reading keeps the order.
    """
    at = F.struct(F.col("_metadata.file_path").alias("log"), F.col("_metadata.file_block_start").alias("block"))
    lines = spark.read.text(path).select(at.alias("at"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("line")).select("at.*", "place", "line")
    before = Window.partitionBy("log").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("log", "block").count().select("log", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("log", "block").orderBy("place")) - 1
    return lines.withColumn("inside", inside).join(counts, ["log", "block"]).select("log", (F.col("before") + F.col("inside")).alias("line_no"), "line")


def read_media(spark: SparkSession, path: str) -> DataFrame:
    """The media of all landed pages; a page with another code than 0 is an error."""
    pages = spark.read.option("multiLine", True).schema("code int, message string, data struct<medias:array<struct<id:bigint,title:string>>>").json(path)
    checked = F.when(F.coalesce("code", F.lit(0)) == 0, F.col("data.medias")).otherwise(F.raise_error(F.concat(F.lit("page error: "), F.coalesce("message", F.lit("")))).cast("array<struct<id:bigint,title:string>>"))
    return pages.select(F.explode(checked).alias("m")).select("m.id", "m.title")


def _objects(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """The objects of JSON files, each an array of them or one to a line. A file is what a person's session has made, so it is one row."""
    whole, kind = spark.read.text(path, wholetext=True), f"struct<{fields}>"
    lines = F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")
    items = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{kind}>")).otherwise(F.transform(lines, lambda x: F.from_json(x, kind)))
    return whole.select(F.explode(items).alias("o")).select("o.*")


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """id, url, deleted of posted marks; of the older form, with a colour, red means deleted."""
    raw = _objects(spark, path, "id:int,url:string,del:boolean,color:string")
    return raw.select("id", "url", F.coalesce("del", F.col("color") == "red").alias("deleted"))


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """title, video_id of a catalogue of lines "title = id"."""
    from frameloom.operators.catalog import parse_ids

    return parse_ids(read_lines(spark, path), "line").select("title", "video_id")


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """cluster_id, frames, representative_frame, low_quality of the clusters of a review."""
    return _objects(spark, path, "cluster_id:int,frames:array<string>,representative_frame:string,low_quality:boolean")


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """row_no, label, series, value of a statistics CSV: the first column labels the rows, the others are series."""
    from frameloom.functions.text import leading_number

    wide = spark.read.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True).csv(path)
    label, *series = wide.columns
    cells = F.array(*(F.struct(F.lit(s).alias("series"), leading_number(F.col(f"`{s}`")).alias("value")) for s in series))
    return wide.select(F.col(f"`{label}`").alias("label"), F.explode(cells).alias("c")).select("label", "c.*")


def read_listing(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """folder, name, is_dir, size, mtime of the files and folders in path, or of all under it; folders have neither size nor time.

    Hidden files and index.html are left out, and a recursive listing doesn't go into hidden folders. A plain listing is one call to the file system; a recursive one
    lists the folders of each level in tasks. What may not be read is left out.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = store.makeQualified(where).toString().rstrip("/")
    if recursive:
        found = _tree(spark, root)
    else:
        entries = [(s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in store.listStatus(where)]
        listed = spark.createDataFrame(entries, "path string, is_dir boolean, size bigint, at bigint")
        found = listed.select("path", "is_dir", F.when(~F.col("is_dir"), F.col("size")).alias("size"), F.when(~F.col("is_dir"), F.timestamp_millis("at")).alias("mtime"))
    rows = found.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), F.element_at(F.split("path", "/"), -1).alias("name"), "is_dir", "size", "mtime")
    return rows.where(~F.col("name").startswith(".") & (F.col("name") != "index.html"))


def _tree(spark: SparkSession, root: str) -> DataFrame:
    """path, is_dir, size, mtime of all below root, a job for each level: its folders are dealt to tasks, which list them by pyarrow's file systems."""
    address = re.sub(r"^(\w+):/(?!/)", r"\1:///", root)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(address)
        for b in batches:
            rows = []
            for folder in b.column("path").to_pylist():
                try:
                    entries = store.get_file_info(fs.FileSelector(f"{base.rstrip('/')}{folder[len(root) :]}"))
                except OSError:  # not allowed, or gone since it was listed
                    continue
                for e in entries:
                    is_dir = e.type == fs.FileType.Directory
                    rows.append((f"{folder}/{e.base_name}", is_dir, None if is_dir else e.size, None if is_dir else e.mtime))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            types = (pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["path", "is_dir", "size", "mtime"])

    level, found = spark.createDataFrame([(root,)], "path string"), []
    while not found or not level.isEmpty():
        dealt = level.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path") if found else level
        found.append(written(dealt.mapInArrow(listed, "path string, is_dir boolean, size bigint, mtime timestamp"), "listing"))
        level = found[-1].where("is_dir").where(~F.element_at(F.split("path", "/"), -1).startswith(".")).select("path")
    all_ = found[0]
    for f in found[1:]:
        all_ = all_.unionByName(f)
    return all_


def line_numbers(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.withColumn("line_no", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
