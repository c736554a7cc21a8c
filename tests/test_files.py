"""The source that pages, named files for keys, index pages, moved output."""

import hashlib
import http.server
import json
import threading

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frameloom.functions import text
from frameloom.operators import catalog
from frameloom.plans import file_queries, image_queries
from frameloom.sources import files, frames, keyed_files, paged, scratch


def pages(n, per=3, code=None):
    """Bodies of n pages and an empty one; code: the page that tells an error."""
    out = {k: {"code": 0, "data": {"medias": [{"id": 100 * k + i, "title": f"t{k}-{i}", "more": [1]} for i in range(per)]}} for k in range(1, n + 1)}
    out[n + 1] = {"code": 0, "data": {"medias": None}}
    if code:
        out[code] = {"code": -404, "message": "no such list"}
    return out


def landed(tmp_path, bodies):
    tmp_path.mkdir(exist_ok=True)
    for k, b in bodies.items():
        (tmp_path / f"p{k}.json").write_text(json.dumps(b, ensure_ascii=False), encoding="utf-8")
    return f"file://{tmp_path}/p{{page}}.json"


@pytest.mark.parametrize("n", [0, 1, 2, 7, 23])
def test_pages_are_read_as_landed_ones_are(spark, tmp_path, n):
    paged.register(spark)
    address = landed(tmp_path / "all", pages(n))
    got = spark.read.format("paged").option("page", address).option("partitions", 4).load()
    assert sorted(tuple(r) for r in got.collect()) == sorted((100 * k + i, f"t{k}-{i}") for k in range(1, n + 1) for i in range(3))
    assert got.rdd.getNumPartitions() <= 4
    if n:
        assert sorted(got.collect()) == sorted(files.read_media(spark, str(tmp_path / "all")).collect())


def test_few_pages_are_read_to_find_the_end(tmp_path):
    address, seen = landed(tmp_path / "all", pages(100)), []
    reader = paged.PagedReader(paged.StructType.fromDDL(paged.SCHEMA), {"page": address, "partitions": "8"})
    fetch = reader.fetch
    reader.fetch = lambda page: seen.append(page) or fetch(page)
    ranges = [(p.first, p.stop) for p in reader.partitions()]
    assert ranges[0] == (1, 14) and ranges[-1][1] == 101 and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False)) and len(seen) < 20


def test_an_error_code_is_raised_and_columns_may_be_chosen(spark, tmp_path):
    paged.register(spark)
    chosen = spark.read.format("paged").schema("title string, none int").option("page", landed(tmp_path / "good", pages(2))).load()
    assert sorted(tuple(r) for r in chosen.collect())[0] == ("t1-0", None)
    with pytest.raises(PySparkException, match="no such list"):
        spark.read.format("paged").option("page", landed(tmp_path / "bad", pages(3, code=2))).load().collect()
    with pytest.raises(PySparkException, match="page"):
        spark.read.format("paged").option("page", "file:///nowhere").load().collect()


def test_pages_by_http_are_tried_again(spark):
    bodies, tries = pages(5), {}

    class Lists(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            k = int(self.path.rpartition("=")[2])
            tries[k] = tries.get(k, 0) + 1
            self.send_response(503 if tries[k] == 1 else 200 if k in bodies else 404)
            self.end_headers()
            if tries[k] > 1 and k in bodies:
                self.wfile.write(json.dumps(bodies[k]).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Lists)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        paged.register(spark)
        got = spark.read.format("paged").option("page", f"http://127.0.0.1:{server.server_port}/list?pn={{page}}").option("wait", 0.01).load()
        assert got.count() == 15
    finally:
        server.shutdown()


def test_files_land_under_their_names(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    df = spark.createDataFrame([("a.txt", b"one"), ("sub/dir/b.png", b"\x00\x01"), ("ü.txt", None)], "n string, c binary").repartition(3)
    ask = lambda d, dry=False: sorted((r["name"], r["change"]) for r in keyed_files.write_files(d, "n", "c", root, dry).collect())
    all_new = [("a.txt", "new"), ("sub/dir/b.png", "new"), ("ü.txt", "new")]
    assert ask(df, True) == all_new and not (tmp_path / "out").exists()
    assert ask(df) == all_new and (tmp_path / "out/sub/dir/b.png").read_bytes() == b"\x00\x01" and (tmp_path / "out/ü.txt").read_bytes() == b""
    before = (tmp_path / "out/a.txt").stat().st_mtime_ns
    changed = df.withColumn("c", F.when(F.col("n") == "a.txt", F.col("c")).otherwise(F.lit(b"new")))
    want = [("a.txt", "same"), ("sub/dir/b.png", "changed"), ("ü.txt", "changed")]
    assert ask(changed, True) == want and (tmp_path / "out/ü.txt").read_bytes() == b""
    assert ask(changed) == want and (tmp_path / "out/ü.txt").read_bytes() == b"new" and (tmp_path / "out/a.txt").stat().st_mtime_ns == before
    assert ask(changed) == [(n, "same") for n, _ in want]  # a run again finds equal files
    assert sorted(p.name for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["a.txt", "b.png", "ü.txt"]  # no draft is left
    report = keyed_files.write_files(changed, "n", "c", root).where("name = 'ü.txt'").first()
    assert (report["bytes"], report["sha256"]) == (3, hashlib.sha256(b"new").hexdigest())


@pytest.mark.parametrize("names", [["a", "a"], [None], [""], ["/etc/x"], ["../x"], ["a/../../x"], ["a//b"], ["a/"], ["./a"]])
def test_names_that_lead_elsewhere_are_refused(spark, tmp_path, names):
    df = spark.createDataFrame([(n, "x") for n in names], "n string, c string")
    with pytest.raises(ValueError):
        keyed_files.write_files(df, "n", "c", f"file://{tmp_path}/out")
    assert not (tmp_path / "out").exists()


def test_sheets_land_as_images(spark, tmp_path):
    from frameloom.functions import pixels

    image = pixels.png(__import__("numpy").full((4, 6), 200, "uint8"))
    df = spark.createDataFrame([(7, image), (8, image)], "issue_id int, png binary").select(F.format_string("%d/data.png", "issue_id").alias("n"), "png")
    keyed_files.write_files(df, "n", "png", f"file://{tmp_path}/sheets")
    found = spark.read.format("image").load(str(tmp_path / "sheets/*/data.png")).select("image.height", "image.width").collect()
    assert [tuple(r) for r in found] == [(4, 6), (4, 6)]


def test_templates_are_filled_at_once(spark):
    df = spark.createDataFrame([("__B__", None, 3)], "a string, b string, n int")
    fill = lambda t: df.select(text.filled(t, {"__A__": F.col("a"), "__B__": F.col("b"), "__AB__": F.col("n")}).alias("x")).first()["x"]
    assert fill("<__A__|__B__|__AB__|__A__>") == "<__B__||3|__B__>" and fill("") == "" and fill("plain") == "plain"


def test_index_pages_of_a_tree(spark, tmp_path):
    (tmp_path / "site/sub/empty").mkdir(parents=True)
    (tmp_path / "site/a&b.txt").write_text("x" * 10)
    (tmp_path / "site/sub/c.txt").write_text("y")
    (tmp_path / "site/.hidden").write_text("z")
    root = f"file:{tmp_path}/site"
    listing = files.read_listing(spark, f"{tmp_path}/site", recursive=True)
    below = F.regexp_replace(F.substring("folder", F.lit(len(root) + 1), F.lit(1 << 30)), "^/", "")
    entries = listing.withColumn("folder", below)
    under = F.when(F.col("folder") == "", F.col("name")).otherwise(F.concat_ws("/", "folder", "name"))
    folders = entries.where("is_dir").select(under.alias("folder")).unionByName(spark.createDataFrame([("",)], "folder string"))
    pages_ = {r["folder"]: r["html"] for r in catalog.index_pages(folders, entries, "folder", "name", "is_dir", "size", "mtime", "__TITLE__;__TOTAL_COUNT__;__DIR_COUNT__;__FILE_COUNT__;__FILE_ROWS__").collect()}
    assert set(pages_) == {"", "sub", "sub/empty"}
    assert pages_[""].startswith("文件索引;2;1;1;") and "a&amp;b.txt" in pages_[""] and ".hidden" not in pages_[""] and "../" not in pages_[""]
    assert pages_["sub"].startswith("文件索引 — sub;3;1;1;") and '<a href="../"' in pages_["sub"]
    assert pages_["sub/empty"].startswith("文件索引 — sub/empty;1;0;0;<tr>") and pages_["sub/empty"].count("<tr>") == 1


def test_output_is_moved_and_scratch_deleted(spark, tmp_path):
    for d in ("layout", "frames"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x").write_text(d)
    at = lambda d: f"file://{tmp_path}/{d}"
    keyed_files.move_output(spark, at("layout"), at("done/7"), at("frames"), at("not-there"))
    assert (tmp_path / "done/7/x").read_text() == "layout" and not (tmp_path / "frames").exists() and not (tmp_path / "layout").exists()
    with pytest.raises(FileExistsError):
        keyed_files.move_output(spark, at("done"), at("done/7"))
    with pytest.raises(FileNotFoundError):
        keyed_files.move_output(spark, at("layout"), at("done/8"))


def test_contents_are_encoded_where_they_are_written_a_few_at_a_time(spark, tmp_path):
    root, limit = f"file://{tmp_path}/out", keyed_files.FILE_ROWS
    df = spark.range(3 * limit).select(F.format_string("%d.txt", "id").alias("n"), F.when(F.col("id") > 0, F.struct("id")).alias("c")).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    report = keyed_files.write_files(df, "n", "c", root, encode=lambda c: f"<{c['id']}>".encode())
    assert report.agg(F.count("*"), F.sum("bytes")).first() == (3 * limit, sum(len(f"<{k}>") for k in range(1, 3 * limit)))
    assert (tmp_path / "out" / "0.txt").read_bytes() == b"" and (tmp_path / "out" / "17.txt").read_bytes() == b"<17>"
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows]})

    assert scratch.written(df.select("n").mapInArrow(sizes, "rows long"), "sizes", limit).agg(F.max("rows")).first()[0] == limit


def test_small_images_are_drawn_and_read_without_python(spark, tmp_path):
    vectors = [[0.001 * i * (k - 1) for i in range(64)] for k in range(3)] + [[float("nan"), None, float("inf"), float("-inf")] + [0.1] * 60]
    spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").withColumn("label", F.lit(2)).write.parquet(str(tmp_path / "embeddings.parquet"))
    drawn = image_queries.frames(spark, str(tmp_path))
    read = frames.read_frames(spark, file_queries._png_files(spark, str(tmp_path), "issue_id=%d/f%06d.png") + "/*")
    for df in (drawn, read):
        assert "Python" not in df._jdf.queryExecution().toString() and "MapIn" not in df._jdf.queryExecution().toString()
    found = {r["frame_idx"]: (r["height"], r["width"], bytes(r["bgr"])) for r in drawn.collect()}
    assert found == {r["frame_idx"]: (r["height"], r["width"], bytes(r["bgr"])) for r in read.collect()}
    levels = [[int(min(max(128 + 400 * float(np.float32(x)), 0), 255)) for x in v] for v in vectors[:3]] + [[255, 255, 255, 0] + [168] * 60]  # as in SQL: NaN is largest, null is none of the least
    assert found == {k: (8, 8, bytes(x for i in range(64) for x in (v[i], v[63 - i], v[(i + 56) % 64]))) for k, v in enumerate(levels)}
