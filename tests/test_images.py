"""Pixel kernels by identities and small cases; the frame pipeline on generated PNG files."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.functions import pixels as P
from frameloom.operators import clusters, images
from frameloom.operators.records import DATA_LABELS
from frameloom.plans.stages import frame_stages, run_stages, sheet_files
from frameloom.sources.files import read_roi, read_theme_track
from frameloom.sources.frames import read_frames, read_labelled, read_samples
from frameloom.sources.sinks import write_roi, write_track


def noise(seed, *shape):
    return np.random.default_rng(seed).integers(0, 256, shape, dtype=np.uint8)


def test_gray_and_colours():
    assert P.gray(np.full((2, 2, 3), 77, np.uint8)).tolist() == [[77, 77], [77, 77]]
    white = P.lab(np.full((1, 1, 3), 255, np.uint8))[0, 0]
    assert white.tolist() == [255, 128, 128] and P.lab(np.zeros((1, 1, 3), np.uint8))[0, 0].tolist() == [0, 128, 128]
    s, v = P.saturation_value(np.array([[[0, 0, 200], [10, 10, 10], [0, 0, 0]]], np.uint8))
    assert s.tolist() == [[255, 0, 0]] and v.tolist() == [[200, 10, 0]]


def test_filters():
    flat = np.full((5, 7), 9, np.uint8)
    assert np.allclose(P.filtered(flat, P.BLUR), 9) and np.allclose(P.filtered(flat, P.LAPLACE), 0) and abs(P.GAUSS.sum() - 1) < 1e-12
    assert P.filtered(noise(1, 1, 4), P.BLUR).shape == (1, 4)


def test_components_touch_at_corners():
    mask = np.array([[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 0, 1], [1, 0, 0, 1]], bool)
    assert sorted(P.component_sizes(mask).tolist()) == [1, 2, 2]
    assert len(P.component_sizes(np.zeros((3, 3), bool))) == 0
    snake = np.zeros((9, 9), bool)
    snake[::2] = True
    snake[1::4, -1] = snake[3::4, 0] = True
    assert P.component_sizes(snake).tolist() == [int(snake.sum())]


def test_runs_and_cut():
    assert P.longest_run(np.array([0, 1, 1, 0, 1, 1, 0], bool)) == (1, 3) and P.longest_run(np.zeros(3, bool)) == (0, 0)
    two = np.array([[10] * 5 + [200] * 5], np.uint8)
    assert 10 <= P.otsu_cut(two) < 200


def test_pairs():
    a, b = noise(1, 20, 30), noise(2, 20, 30)
    same, other = P.pair_features(a, a), P.pair_features(a, b)
    assert same["psim"] == 1 and abs(same["ssim"] - 1) < 1e-9 and same["absdiff"] == same["mu"] == same["sigma"] == 0
    assert other["ssim"] < 0.5 and 0 <= other["psim"] <= 1


def test_dark_line_quality_colour():
    black, white = np.zeros((8, 8, 3), np.uint8), np.full((8, 8, 3), 255, np.uint8)
    assert P.dark_features(black)["dark_ratio"] == 1 and P.dark_features(black)["max_dark_region"] == 1
    assert all(abs(v) < 1e-9 for v in P.dark_features(white).values())
    line = np.full((12, 40, 3), 250, np.uint8)
    line[5:7] = 0
    found = P.line_features(line)
    assert found["h_cont"] == 1 and found["peak"] == 1 and found["concentration"] > 0.6
    assert P.line_features(np.rot90(line))["h_cont"] == 1
    assert P.quality_features(black) == {"blur": 0, "bright": 0, "contrast": 0, "entropy": 0, "dark": 1, "over": 0}
    assert P.colour_features(white)["blue"] is None and P.colour_features(black)["red"] == 0


def test_canvas():
    a, b = np.zeros((2, 3), np.uint8), np.zeros((4, 1), np.uint8)
    assert P.beside([a, b]).tolist() == [[0, 0, 0, 0], [0, 0, 0, 0], [255, 255, 255, 0], [255, 255, 255, 0]]
    assert P.bordered(a, 1, 2).shape == (4, 7)
    ramp = np.arange(16, dtype=np.uint8).reshape(4, 4)
    assert P.resized(ramp, 4, 4).tolist() == ramp.tolist() and P.resized(ramp, 2, 8).shape == (8, 2)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("frames")
    rng = np.random.default_rng(0)
    looks = [np.full((384, 512, 3), c, np.uint8) for c in ((230, 200, 180), (120, 220, 240))]
    for k, look in enumerate(looks):
        for y in range(20 + 30 * k, 384, 60):
            look[y : y + 6] = 20
        look[:, 30:36] = look[:, 480:486] = 20
    n = 0
    for look in looks:
        for _ in range(4):
            n += 1
            frame = np.clip(look.astype(int) + rng.integers(-1, 2, look.shape), 0, 255).astype(np.uint8)
            (path / f"f{n:06d}.png").write_bytes(P.png(frame))
    (path / f"f{n + 1:06d}.png").write_bytes(P.png(np.zeros((384, 512, 3), np.uint8)))
    (path / f"f{n + 2:06d}.png").write_bytes(P.png(np.full((384, 512), 255, np.uint8)))
    (path / "f999999.png").write_bytes(b"broken")
    return str(path)


ROI = """{"referenceWidth": 172, "referenceHeight": 512, "boxes": [
 {"id": 1, "name": "l1", "x": 20, "y": 0, "w": 30, "h": 500}, {"id": 2, "name": "l3", "x": 80, "y": 10, "w": 80, "h": 28}, {"id": 3, "name": "l1", "x": 10, "y": 0, "w": 40, "h": 500}]}"""


def test_read_frames_and_roi(spark, folder, tmp_path):
    rows = read_frames(spark, folder).orderBy("frame_idx").collect()
    assert [r["frame_idx"] for r in rows] == list(range(1, 11)) and all(len(r["bgr"]) == 384 * 512 * 3 for r in rows)
    (tmp_path / "roi.json").write_text(ROI)
    boxes = {r["name"]: r for r in read_roi(spark, str(tmp_path / "roi.json")).collect()}
    assert set(boxes) == {"l1", "l3"} and boxes["l1"]["box"]["x"] == 10 and boxes["l1"]["pos"] == 0
    with pytest.raises(FileNotFoundError):
        read_roi(spark, str(tmp_path / "none.json"))
    (tmp_path / "bad.json").write_text("[1, 2")
    with pytest.raises(ValueError):
        read_roi(spark, str(tmp_path / "bad.json"))
    assert len(read_samples(spark, folder).first()["samples"]) == 11
    (tmp_path / "red.json").write_text(ROI.replace('"h": 28}', '"h": 28, "color": 16711680}'))
    coloured = read_roi(spark, str(tmp_path / "red.json"))
    write_roi(coloured, str(tmp_path / "again"))
    again = {r["name"]: (r["color"], tuple(r["box"])) for r in read_roi(spark, str(tmp_path / "again")).collect()}
    assert again == {r["name"]: (r["color"], tuple(r["box"])) for r in coloured.collect()} and again["l3"][0] == 16711680 and again["l1"][0] is None


def test_frame_operators(spark, folder, tmp_path):
    frames = read_frames(spark, folder)
    ready = images.standardise(frames)
    sizes = {(r["width"], r["height"]) for r in ready.select("width", "height").collect()}
    assert sizes == {(172, 512)}
    dark = {r["frame_idx"]: r["cost"] for r in images.dark_scores(ready).collect()}
    assert dark[9] > 0.9 and dark[10] < 0.03 and max(dark, key=dark.get) == 9
    pairs = images.pair_scores(ready)
    sims = {r["frame_idx"]: r["sim"] for r in pairs.collect()}
    assert sims[1] == 0 and sims[5] < 0.93 and sims[2] > sims[5]
    found, kept = images.same_frames(pairs, 0.5)
    assert found.count() == 10 and kept.count() == found.select("cluster_id").distinct().count()
    (tmp_path / "roi.json").write_text(ROI)
    boxes = read_roi(spark, str(tmp_path / "roi.json"))
    assert images.line_scores(ready, boxes).count() == 10
    colours = {r["frame_idx"]: r for r in images.colour_scores(ready, boxes).collect()}
    assert abs(colours[1]["mean_b"] - colours[5]["mean_b"]) > 5 and colours[10]["blue"] == 128
    stages = [s for s in frame_stages(boxes) if s[0] in ("ready", "bright", "single")]
    first = run_stages(spark, stages[:2], frames, str(tmp_path / "run"))
    out = run_stages(spark, stages, None, str(tmp_path / "run"), start=2)
    assert 1 <= out.count() <= first.count() < 10


def brute_table(grid, border, line, pad, ground):
    """A table of cells (arrays or None) drawn pixel by pixel, and the corners of each."""
    wide = [max((c.shape[1] for row in grid if (c := row[k]) is not None), default=0) for k in range(len(grid[0]))]
    high = [max((c.shape[0] for c in row if c is not None), default=0) for row in grid]
    image = np.full((sum(high) + (len(high) + 1) * border + 2 * pad, sum(wide) + (len(wide) + 1) * border + 2 * pad), ground, np.uint8)
    xs = [pad + sum(wide[:k]) + k * border for k in range(len(wide) + 1)]
    ys = [pad + sum(high[:k]) + k * border for k in range(len(high) + 1)]
    for y in range(pad, image.shape[0] - pad):
        for x in range(pad, image.shape[1] - pad):
            if any(0 <= y - t < border for t in ys) or any(0 <= x - t < border for t in xs):
                image[y, x] = line
    corners = []
    for r, row in enumerate(grid):
        corners.append([])
        for k, c in enumerate(row):
            x, y = xs[k] + border, ys[r] + border
            if c is None:
                corners[-1].append({"x1": x, "y1": y, "x2": x + wide[k], "y2": y + high[r]})
                continue
            y += (high[r] - c.shape[0]) // 2
            image[y : y + c.shape[0], x : x + c.shape[1]] = c
            corners[-1].append({"x1": x, "y1": y, "x2": x + c.shape[1], "y2": y + c.shape[0]})
    return image, corners


BOXES = [("title", 0, 0, 4, 10), ("rank", 4, 0, 4, 10), ("mylist_rate", 8, 0, 4, 5), ("other", 12, 0, 4, 10), ("author", 16, 0, 3, 7)]


def test_cells_sheets_and_tracks(spark, tmp_path):
    rows = [(k, i % 2, i, noise(10 * k + i, 20, 40, 3).tobytes(), 20, 40, ("orange", "green")[i % 2] if k < 3 else "pink") for k in (1, 2, 3) for i in range(6 - k)]
    frames = spark.createDataFrame(rows, "issue_id int, cluster_id int, frame_idx int, bgr binary, height int, width int, theme string")
    boxes = spark.createDataFrame([("orange", i, n, b, 40, 20) for i, (n, *b) in enumerate(BOXES)], "theme string, pos int, name string, box struct<x:int,y:int,w:int,h:int>, ref_width int, ref_height int")
    cells = images.take_cells(frames, boxes)
    made = sheet_files(cells)
    for kind, labels in (("info", ("title", "library", "author")), ("data", DATA_LABELS)):
        sheets, places, themes = ({r["issue_id"]: r for r in x.collect()} for x in made[kind])
        for issue in (1, 2, 3):
            kept = [r for c in (0, 1) for n, r in enumerate(r for r in rows if r[:2] == (issue, c)) if n or c or r[6] != "orange"]
            grid, theme_rows = [], []
            for r in kept:
                image, found = P.gray(np.frombuffer(r[3], np.uint8).reshape(20, 40, 3)), {}
                for name, x, y, w, h in BOXES if r[6] != "pink" else ():
                    cell = image[y : y + h, x : x + w]
                    found[name] = np.rot90(cell) if name in ("title", "author") else np.pad(cell, 2, constant_values=255) if name.endswith("rate") else cell
                high = found["title"].shape[0] if found else 0
                grid.append([None if (c := found.get(n)) is None else c if c.shape[0] == high else P.resized(c, int(c.shape[1] * high / c.shape[0]), high) for n in labels])
                theme_rows.append([None if c is None else r[6] for c in grid[-1]])
            want, corners = brute_table(grid, 1, 22, 12, 255)
            (tmp_path / f"{kind}{issue}").mkdir()
            (tmp_path / f"{kind}{issue}" / "f000001.png").write_bytes(sheets[issue]["png"])
            got = read_frames(spark, str(tmp_path / f"{kind}{issue}")).first()
            assert (got["height"], got["width"]) == want.shape and np.array_equal(np.frombuffer(got["bgr"], np.uint8).reshape(*want.shape, 3)[:, :, 0], want)
            assert json.loads(places[issue]["track"]) == corners and json.loads(themes[issue]["track"]) == theme_rows
    write_track(made["data"][2], str(tmp_path / "tracks"))
    assert read_theme_track(spark, str(tmp_path / "tracks" / "issue_id=1")).orderBy("nu").first()["theme"] == "orange"


def test_clusters_of_each_issue(spark):
    rows = [(1, i, [float(i // 2), 0.0]) for i in range(20)] + [(2, i, [100.0 * i, 5.0]) for i in range(3)] + [(3, i, [7.0, 7.0]) for i in range(4)]
    got = clusters.issue_clusters(spark.createDataFrame(rows, "issue_id int, frame_idx int, f array<double>"), ["issue_id"], "frame_idx", "f").collect()
    by = {(r["issue_id"], r["frame_idx"]): r["cluster_id"] for r in got}
    assert [by[2, i] for i in range(3)] == [0, 1, 2] and {by[3, i] for i in range(4)} == {0} and [by[1, i] for i in range(20)] == [i // 4 for i in range(20)]


def test_frame_pipeline_clusters_issues_apart(spark, folder, tmp_path):
    one = read_frames(spark, folder).where("frame_idx in (1, 2, 5, 6)")
    two = one.where("frame_idx in (1, 5)").withColumn("issue_id", F.lit(9))
    (tmp_path / "roi.json").write_text(ROI)
    boxes = read_roi(spark, str(tmp_path / "roi.json"))
    themed = spark.createDataFrame([(t, i, n, (20 * i, 0, 15, 60), 172, 512) for t in ("blue", "gray", "orange") for i, n in enumerate(("title", "rank"))], "theme string, pos int, name string, box struct<x:int,y:int,w:int,h:int>, ref_width int, ref_height int")
    stages = [s for s in frame_stages(boxes, themed) if s[0] in ("ready", "single", "group", "cells")]
    cells = run_stages(spark, stages, one.unionByName(two), str(tmp_path / "run"))
    grouped = spark.read.parquet(str(tmp_path / "run" / "02_group"))
    looks = {r["issue_id"]: sorted(r["c"]) for r in grouped.groupBy("issue_id").agg(F.collect_list("cluster_id").alias("c")).collect()}
    assert looks == {0: [0, 1], 9: [0, 1]}
    assert cells.select("issue_id").distinct().count() <= 2


def test_read_labelled(spark, tmp_path):
    for split, label in (("train", "yes"), ("val", "no")):
        (tmp_path / split / label).mkdir(parents=True)
        (tmp_path / split / label / "a.png").write_bytes(b"x")
    assert {(r["split"], r["label"], r["name"]) for r in read_labelled(spark, str(tmp_path)).collect()} == {("train", "yes", "a.png"), ("val", "no", "a.png")}


def test_colours_in_fixed_point_by_hand():
    """Worked out by hand: 12-bit quotients 255 / v and 180 / (6 * span), halves up; light, roots and the matrix in 11, 15 and 12 bits."""
    given = np.array([[[10, 20, 30], [0, 0, 255], [0, 255, 0], [255, 0, 0], [200, 100, 50], [7, 7, 7], [30, 0, 29]]], np.uint8)
    # 10, 20, 30: span 20 of 30: 255 / 30 = 34816, 20 * 34816 + 2048 >> 12 = 170; 180 / 120 = 6144, 10 * 6144 + 2048 >> 12 = 15
    # 30, 0, 29: blue is the value: red less green and 4 spans, 29 + 120 = 149; 180 / 180 = 4096, so 149
    assert P.hsv(given)[0].tolist() == [[15, 170, 30], [0, 255, 255], [60, 255, 255], [120, 255, 255], [110, 191, 200], [0, 0, 7], [149, 255, 30]]
    # red: light 2040 times 1777, 871 and 73 of 4096 is 885, 434 and 36, whose roots are 24804, 19556 and 8534 of 32768
    light = P._descaled(P._LIGHT[np.array([255, 0, 0])] @ P._XYZ.T, 12)
    assert light.tolist() == [885, 434, 36] and P._XYZ[:, 0].tolist() == [1777, 871, 73]
    roots = [round(32768 * (885 / 2040) ** (1 / 3)), round(32768 * (434 / 2040) ** (1 / 3)), round(32768 * (36 / 2040) ** (1 / 3))]
    by_hand = [(296 * roots[1] - 1336934 + 16384) >> 15, (500 * (roots[0] - roots[1]) + (128 << 15) + 16384) >> 15, (200 * (roots[1] - roots[2]) + (128 << 15) + 16384) >> 15]
    assert P._ROOT[light].tolist() == roots and P.lab(given)[0, 1].tolist() == by_hand == [136, 208, 195]
    assert P.lab(np.array([[[0, 0, 0], [255, 255, 255], [128, 128, 128]]], np.uint8))[0].tolist() == [[0, 128, 128], [255, 128, 128], [137, 128, 128]]


def test_resizing_in_fixed_point_by_hand():
    # two to four: taps 2048 | 1536 512 | 512 1536 | 2048; 0 * 1536 + 100 * 512 = 51200, >> 4 = 3200; 3200 * 2048 >> 16 = 100, + 2 >> 2 = 25
    assert P.resized(np.array([[0, 100]], np.uint8), 4, 1).tolist() == [[0, 25, 75, 100]]
    assert P.resized(np.array([[0, 100], [200, 50]], np.uint8), 4, 4).tolist() == [[0, 25, 75, 100], [50, 59, 78, 88], [150, 128, 84, 63], [200, 163, 88, 50]]
    assert P.resized(np.array([[10, 20, 30, 40]], np.uint8), 2, 1).tolist() == [[15, 35]]
    colour = np.arange(36, dtype=np.uint8).reshape(3, 4, 3)
    assert all(np.array_equal(P.resized(colour, 6, 5)[..., k], P.resized(colour[..., k], 6, 5)) for k in range(3))


def test_blur_in_fixed_point_by_hand():
    spot = np.zeros((3, 3), np.uint8)
    spot[1, 1] = 10  # 10 * 4 / 16 = 2.5, halves up; edges mirror without repeating: 2 * 10 * 2 / 16 = 2.5; corners 4 * 10 / 16 = 2.5
    assert np.floor(P.filtered(spot, P.BLUR) + 0.5).tolist() == [[3, 3, 3], [3, 3, 3], [3, 3, 3]]


def test_regions_are_those_of_a_flood_fill():
    draw = np.random.default_rng(7)
    for _ in range(400):
        mask = draw.random((draw.integers(1, 12), draw.integers(1, 12))) < draw.random()
        seen, want = np.zeros(mask.shape, bool), []
        for y, x in zip(*np.nonzero(mask), strict=True):
            if not seen[y, x]:
                todo, n, seen[y, x] = [(y, x)], 0, True
                while todo:
                    a, b = todo.pop()
                    n += 1
                    for c, d in ((c, d) for c in range(max(0, a - 1), min(mask.shape[0], a + 2)) for d in range(max(0, b - 1), min(mask.shape[1], b + 2)) if mask[c, d] and not seen[c, d]):
                        seen[c, d] = True
                        todo.append((c, d))
                want.append(n)
        assert P.component_sizes(mask).tolist() == want
