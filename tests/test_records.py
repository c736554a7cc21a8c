"""Readers, records, catalogues, scores, layouts, clusters and streams on small files and tables."""

import json

import pytest
from pyspark.sql import functions as F

from frameloom.functions import colour, scoring, text
from frameloom.operators import catalog, clusters, layout, rank, records, sequence
from frameloom.sources import files, sinks
from frameloom.streaming.pairs import stream_pairs


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_sheets_to_document(spark, tmp_path):
    (tmp_path / "info.csv").write_text("【x】;lib;auth;more\n[a]Song【b】;;who\n", encoding="utf-8")
    (tmp_path / "data.csv").write_text("\n".join(f"{i};new!!;1,234;5;6;7;8.1%;9%;date;sm{i}" for i in range(2)))
    (tmp_path / "track.json").write_text('[["blue", null], ["gray"]]')
    info = records.unpivot_check(files.read_sheet(spark, str(tmp_path / "info.csv"), records.INFO_LABELS), "row_no", records.INFO_LABELS, True)
    data = records.unpivot_check(files.read_sheet(spark, str(tmp_path / "data.csv"), records.DATA_LABELS), "row_no", records.DATA_LABELS, False)
    rows = records.check_rows(info, data)
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == 12 + 20 and ("000", "title", "【x】") in got and ("001", "title", "Song") in got and ("001", "tit__", "[a]Song【b】") in got
    assert got[12][1] == "id" and [g[1] for g in got[:2]] == ["auth__", "author"]
    sinks.write_check(rows, str(tmp_path / "check"))
    check = files.read_check(spark, str(tmp_path / "check"))
    assert check.count() == 32
    themes = files.read_theme_track(spark, str(tmp_path / "track.json"))
    wide = records.ready_pivot(records.attach_theme(check.withColumn("seq", F.monotonically_increasing_id()), themes, "nu"), ["theme", "nu"], "label", "value", "seq", [*records.INFO_LABELS, *records.DATA_LABELS])
    assert wide.where("theme = 'gray'").first()["id"] == "sm1"
    sinks.write_document(records.ready_json(wide, "theme", "nu"), str(tmp_path / "ready"))
    body = json.loads(spark.read.text(str(tmp_path / "ready")).first()[0])
    assert body["blue"][0]["title"] == "【x】" and body["gray"][0]["nu"] == 1
    with pytest.raises(Exception, match="no theme"):
        records.attach_theme(spark.createDataFrame([(9,)], "nu int"), themes, "nu").collect()


def test_documents_and_runs_hold_no_group_in_a_row(spark, tmp_path):
    from frameloom.plans import record_queries, score_queries

    wide = spark.range(2000).selectExpr("IF(id % 2 = 0, '青\"', 'gray') AS theme", "id AS nu", "repeat('x', 50) AS title")
    found = records.ready_json(wide, "theme", "nu")
    assert found.count() == 2000 and max(len(r["record"]) for r in found.collect()) < 100
    sinks.write_document(found, str(tmp_path / "ready"))
    body = json.loads(spark.read.text(str(tmp_path / "ready")).first()[0])
    assert {k: [r["nu"] for r in v] for k, v in body.items()} == {'青"': list(range(0, 2000, 2)), "gray": list(range(1, 2000, 2))}
    sinks.write_document(found.limit(0), str(tmp_path / "none"))
    assert json.loads(spark.read.text(str(tmp_path / "none")).first()[0]) == {}
    for query, table in ((record_queries.ready_json, "conversations"), (score_queries.longest_run, "events")):
        rows = {"conversations": "SELECT id AS conv_id, 1L AS turn, 'user' AS role, 'x' AS text FROM range(9)", "events": "SELECT 1L AS user_id, timestamp_seconds(id) AS ts, id AS event_id, IF(id = 4, 0.0, 60.0) AS value FROM range(9)"}[table]
        spark.sql(rows).write.parquet(str(tmp_path / f"sf/{table}.parquet"))
        got = query(spark, str(tmp_path / "sf"))
        assert "collect_list(" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert [r["longest"] for r in got.collect()] == [4] if table == "events" else got.count() == 9


def test_repeated_label_last_wins_and_wide_numbers(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "y", 2), (1, "b_", "z", 3)], "k int, label string, value string, seq int")
    assert records.ready_pivot(df, ["k"], "label", "value", "seq", ["a"]).collect()[0].asDict() == {"k": 1, "a": "y"}
    assert value(spark, text.numbered(F.lit(1000))) == "1000" and value(spark, text.shadow_label(F.lit("library"))) == "libra__"


def test_texts(spark):
    assert value(spark, text.human_size(F.lit(1023))) == "1023 B" and value(spark, text.human_size(F.lit(1024))) == "1.0 KB"
    assert value(spark, text.human_size(F.lit(-1))) == "-" and value(spark, text.human_size(F.lit(2**50))) == "1.0 PB" and value(spark, text.human_size(F.lit(1280))) == "1.2 KB"
    for raw, want in (("0.93abc", 0.93), (" -1e3x", -1000.0), ("NaN", 0.0), ("", 0.0), (".5", 0.5), ("abc", 0.0)):
        assert value(spark, text.leading_number(F.lit(raw))) == want
    assert value(spark, text.frame_number(F.lit("a_000123.png x"))) == 123 and value(spark, text.frame_number(F.lit("none"))) is None
    assert value(spark, text.log_message(F.lit("2024-01-02 03:04:05,678 - INFO - hello"))) == "hello" == value(spark, text.log_message(F.lit("2024-01-02 03:04:05,678 - warn_1 - hello")))
    for whole in ("2024-01-02 03:04:05 - INFO - hello", "2024-01-02 03:04:05,678 INFO hello", "x 2024-01-02 03:04:05,678 - INFO - hello"):
        assert value(spark, text.log_message(F.lit(whole))) == whole
    assert [tuple(p) for p in value(spark, text.breadcrumb(F.lit("a\\b/c")))] == [("a", "/a/"), ("b", "/a/b/"), ("c", None)]
    assert value(spark, text.follows(F.lit("1,234"), "count")) and not value(spark, text.follows(F.lit("12,34"), "count"))
    assert value(spark, text.html_escape(F.lit("<a href='x'>&"))) == "&lt;a href=&#x27;x&#x27;&gt;&amp;"


def test_palette(spark):
    cases = {(0, 24): "gray", (0, 25): "orange", (25, 99): "orange", (26, 99): "orange", (35, 99): "orange", (36, 99): "green", (85, 99): "green", (86, 99): "blue", (130, 99): "blue", (131, 99): "purplu", (170, 99): "pink", (180, 99): "pink"}
    rows = spark.createDataFrame(list(cases), "h int, s int").withColumn("name", colour.palette_name(F.col("h"), F.col("s"))).collect()
    assert {(r["h"], r["s"]): r["name"] for r in rows} == cases
    assert tuple(value(spark, colour.hsv(F.lit(255), F.lit(0), F.lit(0)))) == (120, 255, 255) and tuple(value(spark, colour.hsv(F.lit(7), F.lit(7), F.lit(7)))) == (0, 0, 7)
    assert value(spark, colour.layout_theme(F.lit("green"))) == "orange" and value(spark, colour.layout_theme(F.lit("blue"))) == "blue"


def test_scores_split_and_ties(spark):
    assert value(spark, scoring.sigmoid(F.lit(0.5))) == 0.5 and abs(sum(scoring.DARK_WEIGHTS.values()) - 1) < 1e-12
    df = spark.createDataFrame([(1, 0.25), (2, 0.26), (3, None), (4, float("nan"))], "i int, cost double")
    good, bad = rank.split_by(df, scoring.passes(F.col("cost"), 0.25))
    assert [r["i"] for r in good.collect()] == [1] and sorted(r["i"] for r in bad.collect()) == [2, 3, 4]
    tied = spark.createDataFrame([(1, 2, 5.0), (1, 1, 5.0), (1, 0, float("nan"))], "k int, pos int, cost double")
    assert rank.worst_of(tied, ["k"], "cost", "pos").first()["pos"] == 1


def test_plateaus(spark):
    rows = [(1, i, float(v)) for i, v in enumerate([9, 1, 1, 1, 1, 1, 8, 2])] + [(2, 0, 3.0)] + [(3, i, float(i * i)) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, i int, v double")
    assert {r["k"]: r["i"] for r in sequence.plateau(df, ["k"], "i", "v").collect()} == {1: 5, 2: 0, 3: 2}
    grown = spark.createDataFrame([(1, i, v) for i, v in enumerate([5.0, 1.1, 1.0, 1.2, 1.0, 1.1, 1.2, 1.05, 9.0])], "k int, i int, v double")
    got = sequence.plateau_extents(grown, ["k"], "i", "v").first()
    assert (got["start"], got["end"]) == (1, 7)


def test_layouts(spark):
    cells = spark.createDataFrame([(0, 0, 0, 10, 6), (0, 0, 1, 4, 2), (0, 1, 0, None, None), (0, 1, 1, 8, 8)], "k int, row_no int, col_no int, w int, h int")
    got = {(r["row_no"], r["col_no"]): (r["x1"], r["y1"], r["x2"], r["y2"]) for r in layout.table_layout(cells, ["k"], 1, 12, 12).collect()}
    assert got == {(0, 0): (13, 13, 23, 19), (0, 1): (24, 15, 28, 17), (1, 0): (13, 20, 23, 28), (1, 1): (24, 20, 32, 28)}
    assert tuple(layout.canvas_size(cells, ["k"], 1, 12, 12).first())[1:] == (18 + 3 + 24, 14 + 3 + 24)
    box = lambda x, y, w, h: F.struct(*(F.lit(v).alias(k) for k, v in zip("xywh", (x, y, w, h), strict=True)))
    assert tuple(value(spark, layout.clamp_crop(box(-5, 2, 20, 20), F.lit(10), F.lit(10)))) == (0, 2, 10, 8)
    assert value(spark, layout.clamp_crop(box(10, 0, 1, 1), F.lit(10), F.lit(10))) is None
    with pytest.raises(Exception, match="no part of the box"):
        value(spark, layout.checked_crop(box(10, 0, 1, 1), F.lit(10), F.lit(10)))
    assert tuple(value(spark, layout.grid_place(F.lit(7), F.lit(3), F.lit(10), F.lit(20), 2))) == (2, 1, 12, 44)


def test_ids_media_marks_review(spark, tmp_path):
    lines = [" #140 ~ x = 12", "", "none", "a = b = c", "   "]
    (tmp_path / "ids.txt").write_text("\n".join(lines))
    got = catalog.parse_ids(files.read_lines(spark, str(tmp_path / "ids.txt")), "line").orderBy("line_no").select("title", "video_id").collect()
    assert [tuple(r) for r in got] == [("#140 ~ x", "12"), ("a", "b = c")]
    (tmp_path / "p1.json").write_text(json.dumps({"code": 0, "data": {"medias": [{"id": 1, "title": "A VOCAL"}, {"id": 2, "title": "B"}]}}))
    (tmp_path / "p2.json").write_text(json.dumps({"code": 0, "data": {"medias": []}}))
    media = files.read_media(spark, str(tmp_path / "p*.json"))
    assert [r["id"] for r in catalog.titles_without(media, "title", "VOCAL").collect()] == [2]
    (tmp_path / "p3.json").write_text(json.dumps({"code": 5, "message": "no"}))
    with pytest.raises(Exception, match="page error"):
        files.read_media(spark, str(tmp_path / "p*.json")).collect()
    (tmp_path / "marks.json").write_text(json.dumps([{"id": 1, "url": "/a/x.png", "del": True}, {"id": 2, "url": "/a/y.png", "color": "blue"}, {"id": 3, "url": "/a/z.png"}]))
    marks = files.read_marks(spark, str(tmp_path / "marks.json"))
    assert {r["id"]: r["deleted"] for r in marks.collect()} == {1: True, 2: False, 3: None}
    there = spark.createDataFrame([("x.png",), ("x.png",), ("z.png",)], "name string")
    found = catalog.labelled_files(marks, "url", F.when(F.col("deleted"), "yes").when(~F.col("deleted"), "no"), there, "name")
    assert [(r["id"], r["label"]) for r in found.collect()] == [(1, "yes")]
    review = spark.createDataFrame([(["a", "b"], "b", True), (["a"], "q", False)], "frames array<string>, rep string, low boolean")
    assert [r[0] for r in review.select(catalog.representative_index(F.col("frames"), F.col("rep"))).collect()] == [1, 0]
    assert catalog.review_view(review, "synthesized", F.col("low"), F.lit(False)).count() == 1 and value(spark, catalog.moved_cursor(F.lit(0), F.lit(-1), F.lit(3))) == 2


def test_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("B.txt", "a.txt", ".hidden", "index.html", "sub/c.txt"):
        (tmp_path / name).write_text("xx")
    rows = files.read_listing(spark, str(tmp_path), recursive=True)
    here = rows.where(F.col("folder").endswith(tmp_path.name))
    assert [r["name"] for r in here.orderBy(*catalog.listing_order("is_dir", "name")).collect()] == ["sub", "a.txt", "B.txt"]
    html = catalog.listing_rows(here, ["folder"], "name", "is_dir", "size", "mtime").first()["html"]
    assert html.index("sub/") < html.index("a.txt") < html.index("B.txt") and "2 B" in html
    assert '"../"' not in html and '"../"' in catalog.listing_rows(here, ["folder"], "name", "is_dir", "size", "mtime", F.lit(True)).first()["html"]
    (tmp_path / "empty").mkdir()
    (tmp_path / "C.txt").write_text("")
    plain = files.read_listing(spark, str(tmp_path)).orderBy(*catalog.listing_order("is_dir", "name")).collect()
    assert [(r["name"], r["size"], r["mtime"] is None) for r in plain] == [("empty", None, True), ("sub", None, True), ("a.txt", 2, False), ("B.txt", 2, False), ("C.txt", 0, False)]
    (tmp_path / "sub" / "deep" / "er").mkdir(parents=True)
    (tmp_path / "sub" / "deep" / "er" / "x").write_text("x")
    found = files.read_listing(spark, str(tmp_path), recursive=True).where("is_dir").collect()
    assert sorted((r["folder"].rpartition(tmp_path.name)[2], r["name"]) for r in found) == [("", "empty"), ("", "sub"), ("/sub", "deep"), ("/sub/deep", "er")]
    (tmp_path / "s.csv").write_text('name, cost ,"a ""b"""\nf1,0.5x,\n f2 ,NaN,3\n')
    got = {(r["label"], r["series"]): r["value"] for r in files.read_series(spark, str(tmp_path / "s.csv")).collect()}
    assert got[("f1", "cost")] == 0.5 and got[("f2", "cost")] == 0.0 and got[("f2", 'a "b"')] == 3.0


def test_lines_of_large_files(spark, tmp_path):
    """Lines of files that are read in many blocks keep their numbers."""
    want = {}
    for name in ("a", "b"):
        lines = [f"{name} {i} {'x' * (i * 7 % 90)}" if i % 11 else "" for i in range(3000)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        want |= {(name, i): x for i, x in enumerate(lines)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = files.read_lines(spark, str(tmp_path))
        got = {(r["log"].rpartition("/")[2], r["line_no"]): r["line"] for r in read.collect()}
        assert got == want and spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_configs_marks_and_videos(spark, tmp_path):
    roi = {"referenceWidth": 10, "referenceHeight": 20, "boxes": [{"id": 1, "name": "b", "x": 1, "y": 2, "w": 3, "h": 4}, {"id": 2, "name": "a", "x": 5, "y": 6, "w": 7, "h": 8}]}
    (tmp_path / "roi.json").write_text(json.dumps(roi))
    read = files.read_roi(spark, str(tmp_path / "roi.json"))
    sinks.write_roi(read, str(tmp_path / "roi"))
    assert json.loads(spark.read.text(str(tmp_path / "roi")).first()[0]) == roi
    assert sorted(map(str, files.read_roi(spark, str(tmp_path / "roi")).collect())) == sorted(map(str, read.collect()))
    marks = spark.createDataFrame([(1, "/a/x.png", True), (2, "/a/y.png", False)], "id int, url string, deleted boolean")
    sinks.write_marks(marks, str(tmp_path / "marks"))
    assert sorted(files.read_marks(spark, str(tmp_path / "marks")).collect()) == sorted(marks.collect())
    (tmp_path / "ids.txt").write_text("#1 = 11\n\n#2 = 22\n")
    assert sorted(map(tuple, files.read_issues(spark, str(tmp_path / "ids.txt")).collect())) == [("#1", "11"), ("#2", "22")]
    videos = spark.createDataFrame([(1, 11), (2, 22)], "tid int, aid long")
    assert {tuple(r) for r in catalog.with_video(spark.createDataFrame([(1,), (2,), (2,)], "tid int"), videos, "tid", "aid").collect()} == {(1, 11), (2, 22)}
    with pytest.raises(Exception, match="no video for issue 3"):
        catalog.with_video(spark.createDataFrame([(3,)], "tid int"), videos, "tid", "aid").collect()
    assert [value(spark, text.axis_interval(F.lit(n))) for n in (0, 9, 10, 35)] == [1, 1, 1, 3]


def test_log_snip(spark):
    lines = ["start", "", "Section A", "", "x_000001.png", "x_000050.png", "x_000060.png", "x_000200.png", "Section B", "x_000300.png", "Section C", "no number", "x_000055.png", "Clusters", "x_000900.png", "Section D"]
    df = spark.createDataFrame([("log", i, x) for i, x in enumerate(lines)], "log string, line_no int, line string")
    sections = catalog.log_sections(df, ["log"], "line_no", "line", F.col("line").startswith("Section"), F.col("line").startswith("Clusters"))
    out = catalog.log_snip(sections, ["log"], "line_no", "line", text.frame_number(F.col("line")), 10, 110).orderBy("line_no", "pos")
    cut = catalog.SNIPPED
    assert [r["out"] for r in out.collect()] == ["start", "Section A", cut, "x_000050.png", "x_000060.png", cut, "Section C", cut, "x_000055.png", "Clusters", "x_000900.png", "Section D"]


def test_split_and_sinks(spark, tmp_path):
    df = spark.range(1001).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "yes").otherwise("no").alias("label"))
    split = rank.seeded_split(df, "doc_id", 0.8, 42)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"train": 800, "val": 201}
    assert {r["doc_id"] for r in split.where("split = 'val'").collect()} == {r["doc_id"] for r in rank.seeded_split(df.repartition(5), "doc_id", 0.8, 42).where("split = 'val'").collect()}
    sinks.write_split(split, str(tmp_path / "set"))
    assert spark.read.parquet(str(tmp_path / "set")).where("split = 'train' and label = 'yes'").count() == split.where("split = 'train' and label = 'yes'").count()
    gallery = sequence.gallery(df.withColumn("id", F.col("doc_id") % 3), ["id"], "doc_id", "label")
    sinks.write_gallery(gallery, str(tmp_path / "gallery"))
    assert set(spark.read.json(str(tmp_path / "gallery")).columns) >= {"id", "best", "frames"}


def test_clusters(spark, tmp_path):
    rows = [(i, [float(i % 3 * 10), float(i % 7) / 10, 0.0, 1.0]) for i in range(90)]
    df = spark.createDataFrame(rows, "i int, f array<double>")
    got = {r["i"]: r["cluster_id"] for r in clusters.kmeans(df, "f", clusters=3, restarts=2).collect()}
    assert all(got[i] == i % 3 for i in got)
    assert len(clusters.pca_project(df, "f", 2).first()["projected"]) == 2
    labelled = df.withColumn("y", (F.col("i") % 3 == 0).cast("int"))
    _, accuracy = clusters.train_keep_best(labelled, labelled, "f", "y", str(tmp_path / "model"), rounds=2)
    assert accuracy > 0.9


def test_stream_pairs_match_batch(spark, tmp_path):
    rows = [(i % 3, i, float(i * i % 17)) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    for part in range(3):
        df.where((F.col("t") >= part * 10) & (F.col("t") < part * 10 + 10)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream_pairs(stream, "k", "t", "v").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r["k"], r["t"]): r["difference"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = sequence.with_previous(df, ["k"], ["t"], {"b": "v"}).select("k", "t", F.coalesce(F.abs(F.col("v") - F.col("b")), F.lit(0.0)).alias("d"))
    assert got == {(r["k"], r["t"]): r["d"] for r in batch.collect()}
