"""Queries of the image operators, over small images drawn from the embeddings (8 by 8 pixels of three channels)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions.pixels import GAUSS
from frameloom.operators import images
from frameloom.operators.records import DATA_LABELS
from frameloom.plans.score_queries import r6
from frameloom.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
# Two upright and two level strips of an 8 by 8 image.
STRIPS = [("l1", 0, 0, 2, 8), ("l2", 6, 0, 2, 8), ("l3", 0, 0, 8, 3), ("l4", 0, 5, 8, 3)]


def query(f):
    QUERIES[f.__name__] = f
    return f


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame for each vector: its label is the issue, its components are the pixels' levels. No Python: what reads the frames has the only worker of a task."""
    rows = table(spark, sf_dir, "embeddings").where("label is not null and size(embedding) = 64").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    blue = F.transform("embedding", lambda x: F.substring(F.hex(256 + F.floor(F.greatest(F.least(128 + 400 * x, F.lit(255.0)), F.lit(0.0)))), 2, 2))
    drawn = rows.select("vec_id", "label", blue.alias("b"))
    down = F.concat(F.slice("b", 57, 8), F.slice("b", 1, 56))
    pixel = F.zip_with(F.zip_with("b", F.reverse("b"), lambda b, g: F.concat(b, g)), down, lambda bg, r: F.concat(bg, r))
    return drawn.select(F.col("label").alias("issue_id"), F.col("vec_id").cast("int").alias("frame_idx"), F.format_string("f%06d.png", "vec_id").alias("name"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.unhex(F.array_join(pixel, "")).alias("bgr"))


def _strips(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, (x, y, w, h), 8, 8) for i, (n, x, y, w, h) in enumerate(STRIPS)], "pos int, name string, box struct<x:int,y:int,w:int,h:int>, ref_width int, ref_height int")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(r6(c).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))


@query
def image_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.standardise(frames(spark, sf_dir)).select("issue_id", "frame_idx", "height", "width", F.sha2("bgr", 256).alias("sha256"))


@query
def image_dark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(images.dark_scores(frames(spark, sf_dir)))


@query
def image_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(images.line_scores(frames(spark, sf_dir), _strips(spark)))


@query
def image_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(images.pair_scores(frames(spark, sf_dir)))


@query
def image_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.same_frames(images.pair_scores(frames(spark, sf_dir)), 0.5)[1]


@query
def image_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(images.colour_scores(frames(spark, sf_dir), _strips(spark)))


@query
def image_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = images.colour_scores(frames(spark, sf_dir), _strips(spark))
    return images.group_themes(scores.withColumn("cluster_id", F.col("frame_idx") % 5))


@query
def image_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(images.quality_scores(frames(spark, sf_dir)))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    themed = frames(spark, sf_dir).withColumns({"cluster_id": F.col("frame_idx") % 3, "theme": F.element_at(F.array(F.lit("blue"), F.lit("green"), F.lit("orange")), F.col("frame_idx") % 3 + 1)})
    boxes = spark.createDataFrame([(t, i, n, (i % 4 * 2, i // 4 * 2, 2 + i % 3, 2), 8, 8) for t in ("blue", "orange") for i, n in enumerate(DATA_LABELS) if (t, n) != ("blue", "last")], "theme string, pos int, name string, box struct<x:int,y:int,w:int,h:int>, ref_width int, ref_height int")
    return images.take_cells(themed, boxes)


@query
def image_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    return images.sheets(cells, images.sheet_places(cells, DATA_LABELS)).select("issue_id", "height", "width", F.sha2("png", 256).alias("sha256"))


_ORDER = "SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id % 3, vec_id) - 1 AS row_no FROM (SELECT *, row_number() OVER (PARTITION BY label, vec_id % 3 ORDER BY vec_id) AS turn FROM embeddings WHERE label IS NOT NULL AND len(embedding) = 64) WHERE vec_id % 3 <> 2 OR turn > 1"
_WIDE = "least(2 + i % 3, 8 - i % 4 * 2) + CASE WHEN i IN (6, 7) THEN 4 ELSE 0 END"
_LABELS = ", ".join(f"({i}, '{n}')" for i, n in enumerate(DATA_LABELS))


@query
def image_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    places, themes = images.tracks(images.sheet_places(_cells(spark, sf_dir), DATA_LABELS))
    return places.withColumnRenamed("track", "places").join(themes.withColumnRenamed("track", "themes"), "issue_id")


SQL["image_tracks"] = f"""
WITH r AS ({_ORDER}), c AS (SELECT * FROM (VALUES {_LABELS}) v(i, name)),
g AS (SELECT label, row_no, i, vec_id % 3 = 0 AND name = 'last' AS gone, CASE WHEN i IN (6, 7) THEN 6 ELSE 2 END AS h, {_WIDE} AS w, ['blue', 'green', 'orange'][vec_id % 3 + 1] AS theme FROM r, c),
cols AS (SELECT label, i, cw, 13 + coalesce(sum(cw + 1) OVER (PARTITION BY label ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x FROM (SELECT label, i, coalesce(max(CASE WHEN NOT gone THEN w END), 0) AS cw FROM g GROUP BY ALL)),
p AS (SELECT g.label, row_no, g.i, gone, theme, x::BIGINT AS x1, (13 + row_no * 7 + CASE WHEN gone THEN 0 ELSE (6 - h) // 2 END)::BIGINT AS y1, (x + CASE WHEN gone THEN cw ELSE w END)::BIGINT AS x2, (13 + row_no * 7 + CASE WHEN gone THEN 6 ELSE (6 - h) // 2 + h END)::BIGINT AS y2 FROM g JOIN cols ON g.label = cols.label AND g.i = cols.i),
q AS (SELECT label, row_no, string_agg('{{"x1":' || x1 || ',"y1":' || y1 || ',"x2":' || x2 || ',"y2":' || y2 || '}}', ',' ORDER BY i) AS a, string_agg(CASE WHEN gone THEN 'null' ELSE '"' || theme || '"' END, ',' ORDER BY i) AS b FROM p GROUP BY ALL)
SELECT label AS issue_id, '[' || string_agg('[' || a || ']', ',' ORDER BY row_no) || ']' AS places, '[' || string_agg('[' || b || ']', ',' ORDER BY row_no) || ']' AS themes FROM q GROUP BY label
"""

_GRAY = """SELECT label AS issue_id, vec_id::INT AS frame_idx, list_transform(range(1, 65), lambda i: ((114 * v[i] + 587 * v[65 - i] + 299 * v[(i + 55) % 64 + 1] + 500) // 1000)::DOUBLE) AS g
  FROM (SELECT label, vec_id, list_transform(embedding, lambda x: floor(greatest(least(128 + 400 * x::DOUBLE, 255.0), 0.0))::INT) AS v FROM embeddings WHERE label IS NOT NULL AND len(embedding) = 64)"""
_AT = "g[(CASE WHEN {y} < 0 THEN 1 WHEN {y} > 7 THEN 6 ELSE {y} END) * 8 + (CASE WHEN {x} < 0 THEN 1 WHEN {x} > 7 THEN 6 ELSE {x} END) + 1]"
_NEAR = " + ".join(_AT.format(y=f"(i // 8 {dy})", x=f"(i % 8 {dx})") for dy, dx in (("- 1", ""), ("+ 1", ""), ("", "- 1"), ("", "+ 1")))
SQL["image_quality"] = f"""
SELECT issue_id, frame_idx, round((0.5 * blur + 0.3 * contrast + 0.2 * entropy) / (1 + 10 * dark + 10 * over_), 6) AS score, round(blur, 6) AS blur, round(bright, 6) AS bright, round(contrast, 6) AS contrast, round(entropy, 6) AS entropy, round(dark, 6) AS dark, round(over_, 6) AS over FROM (
  SELECT issue_id, frame_idx, var_pop(lap) AS blur, avg(level) AS bright, stddev_pop(level) AS contrast, avg((level < 30)::INT) AS dark, avg((level > 225)::INT) AS over_, -sum(log2(n / 64.0) / 64.0) AS entropy FROM (
    SELECT issue_id, frame_idx, level, lap, count(*) OVER (PARTITION BY frame_idx, issue_id, level) AS n FROM (
      SELECT issue_id, frame_idx, unnest(g) AS level, unnest(list_transform(range(0, 64), lambda i: {_NEAR} - 4 * g[i + 1])) AS lap FROM ({_GRAY}))) GROUP BY issue_id, frame_idx)
"""

_LEVELS = """SELECT label AS issue_id, vec_id::INT AS frame_idx, list_transform(embedding, lambda x: floor(greatest(least(128 + 400 * x::DOUBLE, 255.0), 0.0))::INT) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) = 64"""
_PIXELS = f"SELECT issue_id, frame_idx, unnest(range(0, 64)) AS i, unnest(v) AS b, unnest(list_reverse(v)) AS g, unnest(list_concat(v[57:64], v[1:56])) AS r FROM ({_LEVELS})"


def _light(c: str) -> str:
    return f"round(2040 * CASE WHEN {c} / 255.0 <= 0.04045 THEN {c} / 255.0 / 12.92 ELSE pow(({c} / 255.0 + 0.055) / 1.055, 2.4) END)::BIGINT"


def _root(x: str) -> str:
    return f"round(32768 * CASE WHEN {x} / 2040.0 < 0.008856 THEN {x} / 2040.0 * 7.787 + 16 / 116.0 ELSE cbrt({x} / 2040.0) END)::BIGINT"


#: Each pixel's gray, value and lightness in the fixed point of functions.pixels, and its root of X, Y and Z.
_MEASURED = f"""SELECT *, ((114 * b + 587 * g + 299 * r + 500) // 1000) AS gray, greatest(b, g, r) AS top, least(b, g, r) AS low, {_root('((1777 * lr + 1541 * lg + 778 * lb + 2048) >> 12)')} AS fx,
  {_root('((871 * lr + 2929 * lg + 296 * lb + 2048) >> 12)')} AS fy, {_root('((73 * lr + 448 * lg + 3575 * lb + 2048) >> 12)')} AS fz FROM (SELECT *, {_light('r')} AS lr, {_light('g')} AS lg, {_light('b')} AS lb FROM ({_PIXELS}))"""
_ALL_BITS = "18446744073709551615::UBIGINT"
_NOT_LEFT, _NOT_RIGHT, _NOT_LAST_ROW = "18374403900871474942::UBIGINT", "9187201950435737471::UBIGINT", "72057594037927935::UBIGINT"
_SIDES = f"(part | ((part & {_NOT_RIGHT}) << 1) | ((part & {_NOT_LEFT}) >> 1))"
_GROWN = f"({_SIDES} | (({_SIDES} & {_NOT_LAST_ROW}) << 8) | ({_SIDES} >> 8)) & rest"
_LOWEST = "CASE WHEN {0} = 0 THEN 0::UBIGINT ELSE {0} & xor({0} - 1, " + _ALL_BITS + ") END"
_NEXT = f"(rest & xor(part, {_ALL_BITS}))"

#: An image's dark pixels are one number of 64 bits; a part grows by shifts until it stays, is counted and taken away.
SQL["image_dark"] = f"""
WITH RECURSIVE measured AS (SELECT *, (296 * fy - 1336934 + 16384) >> 15 AS light FROM ({_MEASURED})),
told AS (SELECT issue_id, frame_idx, 1 - avg(gray) / 255 AS gray_mean, avg((gray < 50)::INT) AS dark_ratio, 1 - sum(gray) / 64.0 / 255 AS hist_centroid, 1 - avg(top) / 255 AS hsv_v,
  1 - avg(least(greatest(light, 0), 255)) / 255 AS lab_l, avg((gray < 30)::INT) AS very_dark_ratio, coalesce(bit_or(CASE WHEN gray <= 50 THEN pow(2, i)::UBIGINT END), 0::UBIGINT) AS mask FROM measured GROUP BY ALL),
flood AS (
  SELECT issue_id, frame_idx, mask AS rest, {_LOWEST.format('mask')} AS part, []::BIGINT[] AS sizes FROM told
  UNION ALL
  SELECT issue_id, frame_idx, CASE WHEN same THEN {_NEXT} ELSE rest END, CASE WHEN same THEN {_LOWEST.format(_NEXT)} ELSE grown END, CASE WHEN same THEN list_append(sizes, bit_count(part)::BIGINT) ELSE sizes END
  FROM (SELECT *, grown = part AS same FROM (SELECT *, {_GROWN} AS grown FROM flood WHERE rest <> 0))),
parts AS (SELECT issue_id, frame_idx, CASE WHEN len(sizes) > 0 THEN least(list_avg(sizes) / 32.0, 1.0) ELSE 0.0 END AS dark_concentration, coalesce(list_max(sizes), 0) / 64.0 AS max_dark_region FROM flood WHERE rest = 0)
SELECT issue_id, frame_idx, round(1 / (1 + exp(-8.0 * (0.10 * gray_mean + 0.20 * dark_ratio + 0.10 * hist_centroid + 0.10 * hsv_v + 0.20 * lab_l + 0.15 * very_dark_ratio + 0.10 * dark_concentration + 0.05 * max_dark_region - 0.5))), 6) AS cost,
  round(gray_mean, 6) AS gray_mean, round(dark_ratio, 6) AS dark_ratio, round(hist_centroid, 6) AS hist_centroid, round(hsv_v, 6) AS hsv_v, round(lab_l, 6) AS lab_l, round(very_dark_ratio, 6) AS very_dark_ratio,
  round(dark_concentration, 6) AS dark_concentration, round(max_dark_region, 6) AS max_dark_region
FROM told JOIN parts USING (issue_id, frame_idx)
"""

_REGIONS = ", ".join(f"({k}, {x}, {y}, {w}, {h})" for k, (_, x, y, w, h) in enumerate(STRIPS))
_FOREGROUND = "(top - low) * round((255 << 12) / greatest(top, 1)::DOUBLE)::BIGINT + 2048 >> 12 > 20 OR top < 245"
_COLOURS = f"""
  SELECT issue_id, frame_idx, avg(coalesce(ma, 0)) AS mean_a, avg(coalesce(mb, 0)) AS mean_b, avg(coalesce(sa, 0)) AS std_a, avg(coalesce(sb, 0)) AS std_b, coalesce(avg(cb), 128.0) AS blue, coalesce(avg(cg), 128.0) AS green, coalesce(avg(cr), 128.0) AS red FROM (
    SELECT issue_id, frame_idx, k, avg(a) FILTER (fore) AS ma, avg(bb) FILTER (fore) AS mb, stddev_pop(a) FILTER (fore) AS sa, stddev_pop(bb) FILTER (fore) AS sb, avg(b) FILTER (fore) AS cb, avg(g) FILTER (fore) AS cg, avg(r) FILTER (fore) AS cr FROM (
      SELECT *, {_FOREGROUND} AS fore, least(greatest((500 * (fx - fy) + 4194304 + 16384) >> 15, 0), 255) AS a, least(greatest((200 * (fy - fz) + 4194304 + 16384) >> 15, 0), 255) AS bb FROM ({_MEASURED}), (VALUES {_REGIONS}) s(k, x, y, w, h)
      WHERE i % 8 >= x AND i % 8 < x + w AND i // 8 >= y AND i // 8 < y + h) GROUP BY ALL) GROUP BY ALL"""
SQL["image_colour"] = f"SELECT issue_id, frame_idx, {', '.join(f'round({c}, 6) AS {c}' for c in ('mean_a', 'mean_b', 'std_a', 'std_b', 'blue', 'green', 'red'))} FROM ({_COLOURS})"
_HUE = "CASE WHEN v = low THEN 0.0 WHEN v = red THEN 60.0 * (green - blue) / (v - low) WHEN v = green THEN 120 + 60.0 * (blue - red) / (v - low) ELSE 240 + 60.0 * (red - green) / (v - low) END"
SQL["image_theme"] = f"""
SELECT issue_id, cluster_id, h, s, v, CASE WHEN s < 25 THEN 'gray' WHEN h BETWEEN 170 AND 180 THEN 'pink' WHEN h BETWEEN 0 AND 25 THEN 'orange' WHEN h BETWEEN 36 AND 85 THEN 'green' WHEN h BETWEEN 86 AND 130 THEN 'blue' WHEN h BETWEEN 131 AND 170 THEN 'purplu' ELSE 'orange' END AS theme FROM (
  SELECT issue_id, cluster_id, (round((CASE WHEN d < 0 THEN d + 360 ELSE d END) / 2)::INT % 180) AS h, CASE WHEN v = 0 THEN 0 ELSE round(255.0 * (v - low) / v)::INT END AS s, v FROM (
    SELECT *, {_HUE} AS d FROM (SELECT *, greatest(blue, green, red) AS v, least(blue, green, red) AS low FROM (
      SELECT issue_id, frame_idx % 5 AS cluster_id, trunc(avg(blue))::INT AS blue, trunc(avg(green))::INT AS green, trunc(avg(red))::INT AS red FROM ({_COLOURS}) GROUP BY ALL))))
"""

_AROUND = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def _blurred(of: str) -> str:
    """A gray pixel's 3 by 3 blur, edges mirrored, as a whole number."""
    at = lambda dy, dx: _AT.format(y=f"(i // 8 + {dy})", x=f"(i % 8 + {dx})").replace("g[", f"{of}[")
    return f"floor(({' + '.join(f'{(2 - abs(dy)) * (2 - abs(dx))} * {at(dy, dx)}' for dy, dx in _AROUND)}) / 16.0 + 0.5)"


def _weighed(*of: str) -> str:
    """The mean of a product over the window of local likeness around an inner pixel."""
    return " + ".join(f"{GAUSS[dy + 1, dx + 1]!r} * {' * '.join(f'{x}[i + {8 * dy + dx + 1}]' for x in of)}".replace("np.float64(", "").replace(") *", " *", 1) for dy, dx in _AROUND)


_PAIRED = f"""
  SELECT issue_id, frame_idx, coalesce(avg((abs(bp - bq) <= 25)::INT), 0.0) AS psim, coalesce(avg(abs(bp - bq)) / 255, 0.0) AS absdiff, coalesce(avg(lum * con * str), 0.0) AS ssim, coalesce(avg(lum), 0.0) AS l, coalesce(avg(con), 0.0) AS c,
    coalesce(avg(str), 0.0) AS s, coalesce(avg(abs(mp - mq)) / 255, 0.0) AS mu, coalesce(avg(abs(vp - vq)), 0.0) AS sigma FROM (
    SELECT *, (2 * mp * mq + 6.5025) / (mp * mp + mq * mq + 6.5025) AS lum, (2 * both_ + 58.5225) / (vp + vq + 58.5225) AS con, (cov + 58.5225 / 2) / (both_ + 58.5225 / 2) AS str FROM (
      SELECT *, sqrt(vp * vq) AS both_ FROM (SELECT *, CASE WHEN pp IS NOT NULL THEN greatest(pp - mp * mp, 0) END AS vp, CASE WHEN pp IS NOT NULL THEN greatest(qq - mq * mq, 0) END AS vq, pq - mp * mq AS cov FROM (
        SELECT issue_id, frame_idx, {_blurred('p')} AS bp, {_blurred('q')} AS bq, CASE WHEN inner_ THEN {_weighed('p')} END AS mp, CASE WHEN inner_ THEN {_weighed('q')} END AS mq,
          CASE WHEN inner_ THEN {_weighed('p', 'p')} END AS pp, CASE WHEN inner_ THEN {_weighed('q', 'q')} END AS qq, CASE WHEN inner_ THEN {_weighed('p', 'q')} END AS pq FROM (
          SELECT *, i // 8 BETWEEN 1 AND 6 AND i % 8 BETWEEN 1 AND 6 AS inner_ FROM (SELECT issue_id, frame_idx, unnest(range(0, 64)) AS i, lag(g) OVER (PARTITION BY issue_id ORDER BY frame_idx) AS p, g AS q FROM ({_GRAY}))))))) GROUP BY ALL"""
SQL["image_pair"] = f"SELECT issue_id, frame_idx, round(0.1 * psim + 0.9 * ssim, 6) AS sim, {', '.join(f'round({c}, 6) AS {c}' for c in ('psim', 'absdiff', 'ssim', 'l', 'c', 's', 'mu', 'sigma'))} FROM ({_PAIRED})"
SQL["image_same"] = f"""
WITH isles AS (SELECT *, (sum((0.1 * psim + 0.9 * ssim < 0.5)::INT) OVER (PARTITION BY issue_id ORDER BY frame_idx ROWS UNBOUNDED PRECEDING))::BIGINT AS cluster_id FROM ({_PAIRED})),
ranked AS (SELECT *, row_number() OVER w AS turn, count(*) OVER (PARTITION BY issue_id, cluster_id) AS n, round(var_samp(absdiff) OVER (PARTITION BY issue_id, cluster_id ORDER BY frame_idx ROWS 4 PRECEDING), 9) AS variance FROM isles WINDOW w AS (PARTITION BY issue_id, cluster_id ORDER BY frame_idx))
SELECT issue_id, cluster_id, frame_idx FROM (SELECT *, row_number() OVER (PARTITION BY issue_id, cluster_id ORDER BY variance NULLS LAST, turn) AS pick FROM ranked WHERE turn >= least(n, 5)) WHERE pick = 1
"""

#: The title, a row of eight pixels, stands upright on the left; the statistics, a column of six, on the right, with white below.
SQL["image_ready"] = f"""
WITH placed AS (SELECT issue_id, frame_idx, CASE WHEN i // 8 = 6 THEN i % 8 ELSE i // 8 END AS row, CASE WHEN i // 8 = 6 THEN 0 ELSE 1 END AS col, printf('%02x%02x%02x', b, g, r) AS px FROM ({_PIXELS}) WHERE i // 8 = 6 OR (i % 8 = 6 AND i // 8 < 6)
  UNION ALL SELECT issue_id, frame_idx, w, 1, 'ffffff' FROM ({_LEVELS}), (VALUES (6), (7)) v(w))
SELECT issue_id, frame_idx, 8 AS height, 2 AS width, sha256(unhex(string_agg(px, '' ORDER BY row, col))) AS sha256 FROM placed GROUP BY issue_id, frame_idx
"""

#: Strips lie down: the upright ones are turned clockwise. Of each place its strip, row, column, and the strip's rows.
_LYING = """SELECT k, r, c, n, CASE WHEN k < 2 THEN (7 - c) * 8 + 6 * k + r ELSE (5 * (k - 2) + r) * 8 + c END AS i
  FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 3)) s(k, n), range(0, 3) a(r), range(0, 8) b(c) WHERE r < n"""
_MIRROR = "CASE WHEN {0} < 0 THEN -({0}) WHEN {0} >= {1} THEN 2 * {1} - 2 - ({0}) ELSE {0} END"
_STRIP_AT = "levels[(" + _MIRROR.format("r + {dy}", "n") + ") * 8 + " + _MIRROR.format("c + {dx}", "8") + " + 1]"
_STRIP_BLUR = " + ".join(f"{(2 - abs(dy)) * (2 - abs(dx))} * {_STRIP_AT.format(dy=dy, dx=dx)}" for dy, dx in _AROUND)
SQL["image_line"] = f"""
WITH lying AS ({_LYING}),
strips AS (SELECT issue_id, frame_idx, k, n, list(g[i + 1] ORDER BY r, c) AS levels FROM ({_GRAY}), lying GROUP BY issue_id, frame_idx, k, n),
blurred AS (SELECT issue_id, frame_idx, k, n, r, c, floor(({_STRIP_BLUR}) / 16.0 + 0.5) AS v FROM strips JOIN (SELECT k AS kk, r, c FROM lying) ON kk = k),
cuts AS (SELECT a.issue_id, a.frame_idx, a.k, a.t, count(*) FILTER (v <= t)::DOUBLE AS below, sum(v) FILTER (v <= t) AS mass, count(*)::DOUBLE AS n, sum(v) AS whole FROM (SELECT DISTINCT issue_id, frame_idx, k, v AS t FROM blurred) a
  JOIN blurred b ON a.issue_id = b.issue_id AND a.frame_idx = b.frame_idx AND a.k = b.k GROUP BY ALL),
best AS (SELECT issue_id, frame_idx, k, CASE WHEN max(between_) > 0 THEN arg_max(t, between_) ELSE 0 END AS cut FROM (
  SELECT *, CASE WHEN n > below THEN below * (n - below) * pow(mass / below - (whole - mass) / (n - below), 2) ELSE 0 END AS between_ FROM cuts ORDER BY t) GROUP BY ALL),
rows_ AS (SELECT issue_id, frame_idx, k, n, r, avg((v <= cut)::INT) AS share, list_max(list_transform(string_split(string_agg((v <= cut)::INT::VARCHAR, '' ORDER BY c), '0'), lambda x: length(x))) AS across FROM blurred JOIN best USING (issue_id, frame_idx, k) GROUP BY ALL),
told AS (SELECT issue_id, frame_idx, k, n, list(share ORDER BY r) AS s, list(across ORDER BY r) AS across, max(share) AS peak, sum(share) AS total, min(r) FILTER (share > 0.05) AS first, max(r) FILTER (share > 0.05) AS last, count(*) FILTER (share > 0.05) AS seen,
  string_agg((share > 0.3 * top)::INT::VARCHAR, '' ORDER BY r) AS band FROM (SELECT *, max(share) OVER (PARTITION BY issue_id, frame_idx, k) AS top FROM rows_) GROUP BY ALL),
banded AS (SELECT *, CASE WHEN band IN ('01', '010', '011') THEN 1 WHEN band = '001' THEN 2 ELSE 0 END AS b0, CASE WHEN band = '111' THEN 3 WHEN band IN ('11', '110', '011') THEN 2 ELSE 1 END AS high FROM told),
measured AS (SELECT *, CASE WHEN total > 0.01 THEN list_sum(s[b0 + 1:b0 + high]) / total ELSE 0 END AS concentration, across[least((2 * b0 + high) // 2, n - 1) + 1] / 8.0 AS h_cont,
  coalesce(list_max(list_concat(s[1:b0], s[b0 + high + 1:n])), 0) AS outside, high / n::DOUBLE AS band_ratio, CASE WHEN seen <= 1 THEN 0 ELSE least(((last - first + 1) / seen::DOUBLE - 1) * 0.5, 1.0) END AS dispersion FROM banded),
costed AS (SELECT *, (1 - outside) * (1 - greatest(band_ratio - 0.5, 0) / 0.5) AS bg_purity FROM measured)
SELECT issue_id, frame_idx, round(cost, 6) AS cost, round(concentration, 6) AS concentration, round(h_cont, 6) AS h_cont, round(peak, 6) AS peak, round(bg_purity, 6) AS bg_purity, round(dispersion, 6) AS dispersion, round(band_ratio, 6) AS band_ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY issue_id, frame_idx ORDER BY round(cost, 12) DESC, k) AS place FROM (SELECT *, 0.20 * (1 - concentration) + 0.20 * (1 - h_cont) + 0.15 * (1 - peak) + 0.20 * (1 - bg_purity) + 0.15 * dispersion + 0.10 * least(abs(band_ratio - 0.35) / 0.5, 1.0) AS cost FROM costed)) WHERE place = 1
"""
