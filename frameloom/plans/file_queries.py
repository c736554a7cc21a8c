"""Queries that write what the tables hold in the library's file forms and read it back, with the SQL that gives the same rows from the tables."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import pixels
from frameloom.operators import rank, sequence
from frameloom.plans import image_queries
from frameloom.plans.stages import run_stages
from frameloom.sources import files, frames, keyed_files, sinks
from frameloom.sources.scratch import shared_folder
from frameloom.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _new(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


@query("SELECT label, series, v AS value FROM (SELECT p_partkey::VARCHAR AS label, p_size::DOUBLE AS size, p_retailprice AS \"price, \"\"net\"\"\" FROM part) UNPIVOT (v FOR series IN (size, \"price, \"\"net\"\"\"))")
def stats_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _new(spark, "stats")
    sinks.write_stats(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias('price, "net"')), where)
    return files.read_series(spark, where)


@query("SELECT n_nationkey AS nu, label, v AS value FROM (SELECT n_nationkey, '\"' || n_name || '\", x' AS name, 'r' || n_regionkey AS region FROM nation) UNPIVOT (v FOR label IN (name, region))")
def check_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _new(spark, "check")
    cells = F.explode(F.array(F.struct(F.lit("name").alias("label"), F.concat(F.lit('"'), "n_name", F.lit('", x')).alias("value")), F.struct(F.lit("region").alias("label"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("value"))))
    sinks.write_check(table(spark, sf_dir, "nation").select(F.format_string("%03d", "n_nationkey").alias("nu"), cells.alias("c")).select("nu", "c.*").orderBy("label", "nu"), where)
    return files.read_check(spark, where)


@query("SELECT n_nationkey AS nu, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS theme FROM nation")
def theme_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _new(spark, "track")
    row = F.struct("n_nationkey", F.array(F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name")), F.lit("x")).alias("row"))
    rows = table(spark, sf_dir, "nation").groupBy(F.lit(7).alias("issue_id")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    sinks.write_track(rows.select("issue_id", F.to_json(F.transform("rows", lambda r: r["row"])).alias("track")), where)
    return files.read_theme_track(spark, f"{where}/issue_id=7")


@query("SELECT p_name AS title, '= ' || p_partkey AS video_id FROM part WHERE p_partkey % 4 <> 1")
def issue_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue of lines; every fourth has no number."""
    where, k = _new(spark, "issues"), F.col("p_partkey")
    line = F.when(k % 4 == 1, F.col("p_name")).otherwise(F.concat(F.lit("  "), "p_name", F.lit(" = = "), k.cast("string"), F.lit(" ")))
    sinks.write_lines(table(spark, sf_dir, "part").select("p_partkey", line.alias("line")), "line", ["p_partkey"], where)
    return files.read_issues(spark, where)


@query("SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS line_no, conv_id || ' ' || role AS line FROM conversations")
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _new(spark, "log")
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws(" ", F.col("conv_id").cast("string"), "role").alias("line"))
    sinks.write_lines(lines, "line", ["conv_id", "turn"], where)
    return files.read_lines(spark, where).select(F.col("line_no").cast("long").alias("line_no"), "line")


@query("SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS row_no, s_name AS title, s_nationkey::VARCHAR AS library, NULL::VARCHAR AS author FROM supplier")
def sheet_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recognised sheet with a cell too many in some rows and one missing in all."""
    where = _new(spark, "sheet")
    line = F.concat_ws(";", "s_name", F.col("s_nationkey").cast("string"), F.when(F.col("s_suppkey") % 2 == 0, F.lit("")), F.when(F.col("s_suppkey") % 4 == 0, F.lit("beyond")))
    body = table(spark, sf_dir, "supplier").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", line.alias("line")))).alias("rows")).select(F.lit("sheet.csv").alias("name"), F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("body"))
    keyed_files.write_files(body, "name", "body", where)
    return files.read_sheet(spark, f"{where}/sheet.csv", ("title", "library", "author")).select(F.col("row_no").cast("long").alias("row_no"), "title", "library", "author")


@query("SELECT p_partkey AS id, p_name AS title FROM part")
def media_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _new(spark, "media")
    pages = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 20).alias("page")).agg(F.collect_list(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))).alias("medias"))
    body = F.to_json(F.struct(F.lit(0).alias("code"), F.struct("medias").alias("data")))
    keyed_files.write_files(pages.select(F.format_string("%d.json", "page").alias("name"), body.alias("body")), "name", "body", where)
    return files.read_media(spark, where)


@query("SELECT doc_id::INT AS id, '/cache/frames/' || doc_id AS url, toxic = 1 AS deleted FROM labels")
def marks_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _new(spark, "marks")
    url = F.concat(F.lit("/cache/frames/"), F.col("doc_id").cast("string"))
    sinks.write_marks(table(spark, sf_dir, "labels").select(F.col("doc_id").cast("int").alias("id"), url.alias("url"), (F.col("toxic") == 1).alias("deleted")), where)
    return files.read_marks(spark, where)


@query("SELECT n_nationkey AS pos, n_name AS name, n_nationkey AS x, n_regionkey AS y, n_nationkey + 1 AS w, 7 AS h, 172 AS ref_width, 512 AS ref_height, CASE WHEN n_regionkey = 1 THEN 255 END AS color FROM nation")
def roi_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    where, n = _new(spark, "roi"), F.col("n_nationkey")
    box = F.struct(n.alias("x"), F.col("n_regionkey").alias("y"), (n + 1).alias("w"), F.lit(7).alias("h"))
    boxes = table(spark, sf_dir, "nation").select(n.alias("pos"), F.col("n_name").alias("name"), box.alias("box"), F.lit(172).alias("ref_width"), F.lit(512).alias("ref_height"), F.when(F.col("n_regionkey") == 1, 255).alias("color"))
    sinks.write_roi(boxes, where)
    return files.read_roi(spark, where).select("pos", "name", "box.*", "ref_width", "ref_height", "color")


@query("""
WITH told AS (SELECT 'r' || n_regionkey AS folder, n_name || '.txt' AS name, length(n_name) AS size FROM nation)
SELECT folder, name, false AS is_dir, size FROM told UNION ALL SELECT '', 'r' || r_regionkey, true, NULL FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
""")
def folder_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _new(spark, "listed")
    keyed_files.write_files(table(spark, sf_dir, "nation").select(F.format_string("r%d/%s.txt", "n_regionkey", "n_name").alias("name"), "n_name"), "name", "n_name", where)
    below = F.regexp_replace(F.element_at(F.split("folder", "/listed-[0-9a-f]+"), 2), "^/", "")
    return files.read_listing(spark, where, recursive=True).select(F.coalesce(below, F.lit("")).alias("folder"), "name", "is_dir", "size")


_SPLIT = "SELECT doc_id, CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS label, CASE WHEN row_number() OVER (ORDER BY (doc_id % 2147483647 * 48271 + 42) % 2147483647, doc_id) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'val' END AS split FROM labels"


@query(f"SELECT split, label, doc_id || '.txt' AS name, doc_id AS content FROM ({_SPLIT})")
def labelled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled data set as a tree of files by split and label."""
    where = _new(spark, "dataset")
    marked = rank.seeded_split(table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("label")), "doc_id", 0.8, 42)
    name = F.concat_ws("/", "split", "label", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    keyed_files.write_files(marked.select(name.alias("name"), F.col("doc_id").cast("string").alias("body")), "name", "body", where)
    return frames.read_labelled(spark, where).select("split", "label", "name", F.col("content").cast("string").cast("long").alias("content"))


@query(f"SELECT label, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM ({_SPLIT}) WHERE split = 'val' GROUP BY label")
def labelled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled data set as a table by split and label; one split is read."""
    where = _new(spark, "dataset")
    marked = rank.seeded_split(table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("label")), "doc_id", 0.8, 42)
    sinks.write_split(marked, where)
    return spark.read.parquet(where).where("split = 'val'").groupBy("label").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


def _png_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder of the small images of image_queries as PNG files, under names that a format of issue and frame gives."""

    def png(image: dict) -> bytes:
        return pixels.png(np.frombuffer(image["bgr"], np.uint8).reshape(image["height"], image["width"], 3))

    where = _new(spark, "frames")
    drawn = image_queries.frames(spark, sf_dir).select(F.format_string(name, "issue_id", "frame_idx").alias("name"), F.struct("height", "width", "bgr").alias("image"))
    keyed_files.write_files(drawn, "name", "image", where, encode=png)
    return where


@query(f"SELECT issue_id, frame_idx, printf('f%06d.png', frame_idx) AS name, 8 AS height, 8 AS width, sha256(unhex(string_agg(printf('%02x%02x%02x', b, g, r), '' ORDER BY i))) AS sha256 FROM ({image_queries._PIXELS}) GROUP BY issue_id, frame_idx")
def frame_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images written as files and decoded again."""
    return frames.read_frames(spark, f"{_png_files(spark, sf_dir, 'issue_id=%d/f%06d.png')}/*").select("issue_id", "frame_idx", "name", "height", "width", F.sha2("bgr", 256).alias("sha256"))


@query("SELECT printf('s%d-%06d', label, vec_id) AS sample, '/sample/' || printf('s%d-%06d', label, vec_id) || '.png' AS url FROM embeddings WHERE label IS NOT NULL AND len(embedding) = 64")
def sample_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.read_samples(spark, _png_files(spark, sf_dir, "s%d-%06d.png")).select(F.explode("samples").alias("sample", "url"))


@query("SELECT user_id % 7 AS issue_id, count(*) AS n FROM events WHERE user_id % 7 < 3 GROUP BY ALL")
def issue_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output by issue; only the folders of those that are asked for are read."""
    where = _new(spark, "issues")
    sinks.write_issues(table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("issue_id"), "event_id"), where)
    return spark.read.parquet(where).where("issue_id < 3").groupBy(F.col("issue_id").cast("long").alias("issue_id")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, round(o_totalprice * 2 + 1, 4) AS price FROM orders WHERE o_totalprice * 2 > 1000")
def staged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages with a table between each two; the last is run from the table that is there."""
    where, price = _new(spark, "stages"), F.col("price")
    stages = [("double", lambda d: d.withColumn("price", price * 2)), ("large", lambda d: d.where(price > 1000)), ("more", lambda d: d.withColumn("price", F.round(price + 1, 4)))]
    run_stages(spark, stages[:2], table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price")), where)
    return run_stages(spark, stages, None, where, start=2)


@query("SELECT user_id, event_id FROM events WHERE value > 20")
def cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Galleries of users' events, written as JSON, read, and flattened again."""
    where = _new(spark, "gallery")
    found = sequence.gallery(table(spark, sf_dir, "events").where("value > 20").withColumn("at", F.struct("ts", "event_id")), ["user_id"], "at", "event_id")
    text = F.transform("frames", lambda x: x.cast("string"))
    sinks.write_gallery(found.select(F.col("user_id").alias("id"), F.col("best").cast("string").alias("best"), text.alias("frames")), where)
    back = spark.read.schema("id bigint, best string, frames array<string>").json(where)
    return sequence.flattened(back.select(F.col("id").alias("user_id"), "frames"), "frames", "event_id").select("user_id", F.col("event_id").cast("long").alias("event_id"))


@query("SELECT c_custkey::INT AS cluster_id, 'f' || c_custkey || ',' || c_name AS frames, c_name AS representative_frame, c_nationkey % 2 = 0 AS low_quality FROM customer")
def review_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of a review as one JSON array."""
    where = _new(spark, "review")
    one = F.struct(F.col("c_custkey").cast("int").alias("cluster_id"), F.array(F.concat(F.lit("f"), F.col("c_custkey").cast("string")), "c_name").alias("frames"), F.col("c_name").alias("representative_frame"), (F.col("c_nationkey") % 2 == 0).alias("low_quality"))
    body = table(spark, sf_dir, "customer").groupBy(F.format_string("%d.json", "c_nationkey").alias("name")).agg(F.to_json(F.collect_list(one)).alias("body"))
    keyed_files.write_files(body, "name", "body", where)
    return files.read_review(spark, where).withColumn("frames", F.array_join("frames", ","))
