"""Queries of the scoring, ranking and histogram operators, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import arrays, colour, scoring, text
from frameloom.operators import histogram as H
from frameloom.operators import rank, sequence
from frameloom.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(x):
    return F.round(x, 6)


@query("""
SELECT o_orderkey, round(1 / (1 + exp(-8.0 * ((0.5 * least(o_totalprice / 500000.0, 1.0) + 0.3 * (o_custkey % 100) / 100.0 + 0.2 * day(o_orderdate) / 31.0) - 0.5))), 6) AS score
FROM orders
""")
def weighted_sigmoid_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.least(F.col("o_totalprice") / 500000.0, F.lit(1.0)).alias("price"), ((F.col("o_custkey") % 100) / 100.0).alias("cust"), (F.dayofmonth("o_orderdate") / 31.0).alias("day")
    )
    return orders.select("o_orderkey", r6(scoring.sigmoid(scoring.weighted_sum({"price": 0.5, "cust": 0.3, "day": 0.2}))).alias("score"))


@query("""
SELECT o_orderkey, round(o_totalprice / 500000.0, 9) AS cost, coalesce(o_totalprice / 500000.0 <= 0.25, false) AS good FROM orders
""")
def threshold_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 500000.0).alias("cost"))
    return rank.flagged(orders, scoring.passes(F.col("cost"), 0.25), "good").select("o_orderkey", F.round("cost", 9).alias("cost"), "good")


_LINE_COST = "round(0.4 * (1 - l_discount * 10) + 0.3 * l_quantity / 50.0 + 0.3 * l_tax * 10, 9)"


@query(f"""
SELECT l_orderkey, l_linenumber, cost, l_quantity, l_discount, l_tax FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY cost DESC, l_linenumber, l_quantity, l_discount, l_tax) AS rn
  FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, {_LINE_COST} AS cost FROM lineitem)) WHERE rn = 1
""")
def worst_of_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.round(0.4 * (1 - F.col("l_discount") * 10) + 0.3 * F.col("l_quantity") / 50.0 + 0.3 * F.col("l_tax") * 10, 9)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", cost.alias("cost"), "l_quantity", "l_discount", "l_tax")
    return rank.worst_of(lines, ["l_orderkey"], "cost", "l_linenumber", "l_quantity", "l_discount", "l_tax")


@query("""
SELECT l_orderkey, round(0.20 * (1 - c) + 0.20 * (1 - h) + 0.15 * (1 - p) + 0.20 * (1 - b) + 0.15 * d + 0.10 * least(abs(br - 0.35) / 0.5, 1.0), 6) AS cost FROM (
  SELECT l_orderkey, max(r) AS p, avg(CASE WHEN r > 0.5 THEN 1.0 ELSE 0.0 END) AS br,
    CASE WHEN sum(r) > 0.01 THEN sum(CASE WHEN r > 0.5 THEN r ELSE 0.0 END) / sum(r) ELSE 0.0 END AS c, avg(l_discount * 10) AS h,
    (1 - coalesce(max(CASE WHEN r <= 0.5 THEN r END), 0.0)) * (1 - greatest(avg(CASE WHEN r > 0.5 THEN 1.0 ELSE 0.0 END) - 0.5, 0.0) / 0.5) AS b,
    CASE WHEN count(CASE WHEN r > 0.05 THEN 1 END) <= 1 THEN 0.0 ELSE least(((max(CASE WHEN r > 0.05 THEN l_linenumber END) - min(CASE WHEN r > 0.05 THEN l_linenumber END) + 1)::DOUBLE / count(CASE WHEN r > 0.05 THEN 1 END) - 1) * 0.5, 1.0) END AS d
  FROM (SELECT l_orderkey, l_linenumber, l_discount, l_quantity / 50.0 AS r FROM lineitem) GROUP BY l_orderkey)
""")
def line_cost_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, at = F.col("r"), F.col("l_linenumber")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", (F.col("l_quantity") / 50.0).alias("r"))
    some = r > 0.05
    got = lines.groupBy("l_orderkey").agg(
        F.max("r").alias("peak"), F.avg(F.when(r > 0.5, 1.0).otherwise(0.0)).alias("band"), F.sum("r").alias("mass"), F.sum(F.when(r > 0.5, r).otherwise(0.0)).alias("inside"),
        F.avg(F.col("l_discount") * 10).alias("run"), F.coalesce(F.max(F.when(r <= 0.5, r)), F.lit(0.0)).alias("outside"),
        F.min(F.when(some, at)).alias("first"), F.max(F.when(some, at)).alias("last"), F.count_if(some).alias("rows"),
    )
    concentration = F.when(F.col("mass") > 0.01, F.col("inside") / F.col("mass")).otherwise(0.0)
    cost = scoring.line_cost(concentration, F.col("run"), F.col("peak"), scoring.background_purity(F.col("outside"), F.col("band")), scoring.dispersion(F.col("first"), F.col("last"), F.col("rows")), F.col("band"))
    return got.select("l_orderkey", r6(cost).alias("cost"))


_FLAGS = "SELECT user_id, ts, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events"
_RUNS = f"""SELECT user_id, min(pos) AS s, max(pos) + 1 AS e, count(*) AS n FROM (
  SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS grp FROM ({_FLAGS}) WHERE value > 50) GROUP BY user_id, grp"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")


@query(f"SELECT u.user_id, coalesce(max(n), 0)::BIGINT AS longest FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN ({_RUNS}) r ON u.user_id = r.user_id GROUP BY u.user_id")
def longest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    runs = sequence.runs_of(events, ["user_id"], "at", F.col("value") > 50).select("user_id", "length")
    return runs.unionByName(events.select("user_id", F.lit(0).cast("long").alias("length"))).groupBy("user_id").agg(F.max("length").alias("longest"))


@query(f"SELECT user_id, s AS band_start, e AS band_end FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, s) AS rn FROM ({_RUNS})) WHERE rn = 1")
def main_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    bands = sequence.runs_of(events, ["user_id"], "at", F.col("value") > 50)
    return rank.worst_of(bands, ["user_id"], "length", "start").select("user_id", F.col("start").cast("long").alias("band_start"), F.col("end").cast("long").alias("band_end"))


@query("SELECT l_returnflag, floor(l_quantity / 5.0)::BIGINT AS bin, count(*) AS n FROM lineitem GROUP BY ALL")
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.histogram(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", 5.0)


@query("SELECT l_returnflag, round(avg((l_quantity < 10)::INT), 6) AS dark, round(avg((l_quantity < 5)::INT), 6) AS very_dark FROM lineitem GROUP BY l_returnflag")
def dark_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = H.shares_below(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", {"dark": 10.0, "very_dark": 5.0})
    return got.select("l_returnflag", r6("dark").alias("dark"), r6("very_dark").alias("very_dark"))


@query("SELECT l_shipmode, round(sum(bin * n)::DOUBLE / sum(n), 6) AS centroid FROM (SELECT l_returnflag AS l_shipmode, floor(l_quantity)::BIGINT AS bin, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_shipmode")
def hist_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = H.histogram(table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "l_shipmode"), ["l_shipmode"], "l_quantity", 1.0)
    return H.centroid(bins, ["l_shipmode"]).select("l_shipmode", r6("centroid").alias("centroid"))


@query("""
SELECT event_type, bin AS threshold, variance FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY variance DESC, bin) AS rn FROM (
    SELECT event_type, bin, CASE WHEN nn = n0 THEN 0.0 ELSE round((n0 / nn) * ((nn - n0) / nn) * (m0 / n0 - (mm - m0) / (nn - n0)) * (m0 / n0 - (mm - m0) / (nn - n0)), 6) END AS variance FROM (
      SELECT event_type, bin, sum(n) OVER w::DOUBLE AS n0, sum(bin * n) OVER w::DOUBLE AS m0, sum(n) OVER a::DOUBLE AS nn, sum(bin * n) OVER a::DOUBLE AS mm
      FROM (SELECT event_type, floor(value / 4.0)::BIGINT AS bin, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY ALL)
      WINDOW w AS (PARTITION BY event_type ORDER BY bin), a AS (PARTITION BY event_type)))) WHERE rn = 1
""")
def otsu_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.otsu(H.histogram(table(spark, sf_dir, "events"), ["event_type"], "value", 4.0), ["event_type"])


@query("""
SELECT event_type, round(-sum(p * log2(p)), 6) AS entropy FROM (
  SELECT event_type, n / sum(n) OVER (PARTITION BY event_type) AS p FROM (SELECT event_type, floor(value / 4.0) AS bin, count(*)::DOUBLE AS n FROM events WHERE value IS NOT NULL GROUP BY ALL)) GROUP BY event_type
""")
def entropy_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = H.histogram(table(spark, sf_dir, "events"), ["event_type"], "value", 4.0)
    return H.entropy(bins, ["event_type"]).select("event_type", r6("entropy").alias("entropy"))


_QUALITY = "round((0.5 * n_chars / 1000.0 + 0.3 * (doc_id % 97) / 97.0 + 0.2 * length(source)) / (1 + 10 * ((doc_id % 7) / 7.0) + 10 * ((doc_id % 11) / 11.0)), 9)"


@query(f"SELECT lang, source, doc_id, score FROM (SELECT lang, source, doc_id, {_QUALITY} AS score, row_number() OVER (PARTITION BY lang, source ORDER BY {_QUALITY} DESC, doc_id) AS rn FROM documents) WHERE rn = 1")
def quality_score_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    score = scoring.quality(F.col("n_chars") / 1000.0, (i % 97) / 97.0, F.length("source").cast("double"), (i % 7) / 7.0, (i % 11) / 11.0)
    docs = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", F.round(score, 9).alias("score"))
    return rank.best_of(docs, ["lang", "source"], "score", "doc_id")


_LAG = "SELECT event_id, user_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events"


@query(f"SELECT event_id, user_id, coalesce(round(abs(value - before), 6), 0.0) AS difference FROM ({_LAG})")
def lag_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = sequence.with_previous(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {"before": "value"})
    return pairs.select("event_id", "user_id", F.coalesce(r6(F.abs(F.col("value") - F.col("before"))), F.lit(0.0)).alias("difference"))


_SIM = f"SELECT event_id, user_id, ts, value, CASE WHEN before IS NULL THEN 0.0 ELSE 1 - least(abs(value - before) / 200.0, 1.0) END AS sim FROM ({_LAG})"
_ISLES = f"SELECT *, sum(CASE WHEN sim < 0.93 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cluster_id FROM ({_SIM})"


def _isles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = sequence.with_previous(_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], {"before": "value"})
    sim = F.when(F.col("before").isNull(), 0.0).otherwise(1 - F.least(F.abs(F.col("value") - F.col("before")) / 200.0, F.lit(1.0)))
    return sequence.islands(pairs.withColumn("sim", sim), ["user_id"], ["ts", "event_id"], F.col("sim") < 0.93)


@query(f"SELECT event_id, user_id, round(sim, 6) AS sim, cluster_id::BIGINT AS cluster_id FROM ({_ISLES})")
def similarity_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _isles(spark, sf_dir).select("event_id", "user_id", r6("sim").alias("sim"), "cluster_id")


@query(f"""
SELECT user_id, cluster_id::BIGINT AS cluster_id, event_id, rank, coalesce(variance, -1.0) AS variance FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, cluster_id ORDER BY variance NULLS LAST, rank) AS pick FROM (
    SELECT user_id, cluster_id, event_id, value, row_number() OVER w AS rank, count(*) OVER (PARTITION BY user_id, cluster_id) AS n,
      round(var_samp(value) OVER (PARTITION BY user_id, cluster_id ORDER BY ts, event_id ROWS 4 PRECEDING), 9) AS variance
    FROM ({_ISLES}) WINDOW w AS (PARTITION BY user_id, cluster_id ORDER BY ts, event_id)) WHERE rank >= least(n, 5)) WHERE pick = 1
""")
def plateau_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    isles = _isles(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    picked = sequence.plateau(isles, ["user_id", "cluster_id"], "at", "value")
    return picked.select("user_id", "cluster_id", F.col("at.event_id").alias("event_id"), F.col("rank").cast("long").alias("rank"), F.coalesce("variance", F.lit(-1.0)).alias("variance"))


@query("""
WITH told AS (SELECT user_id, value, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n, round(var_samp(value) OVER l, 9) AS variance, avg(value) OVER l AS mean, 3 * stddev_pop(value) OVER l AS reach FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id), l AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING)),
best AS (SELECT user_id, n, pos AS high, pos + 1 - least(n, 5) AS low, mean, reach FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY variance NULLS LAST, pos) AS pick FROM told WHERE pos + 1 >= least(n, 5)) WHERE pick = 1)
SELECT b.user_id, coalesce(max(pos) FILTER (abs(value - b.mean) >= b.reach AND pos < low) + 1, 0)::BIGINT AS reach_start, coalesce(min(pos) FILTER (abs(value - b.mean) >= b.reach AND pos > high) - 1, any_value(b.n) - 1)::BIGINT AS reach_end
FROM best b JOIN told t ON t.user_id = b.user_id GROUP BY b.user_id
""")
def plateau_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each user's flattest stretch of five events reaches while values stay near its mean."""
    events = _events(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    return sequence.plateau_extents(events, ["user_id"], "at", "value").select("user_id", F.col("start").alias("reach_start"), F.col("end").alias("reach_end"))


@query(f"SELECT user_id, cluster_id::BIGINT AS cluster_id, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS frames, count(*) AS n FROM ({_ISLES}) GROUP BY user_id, cluster_id")
def cluster_gallery(spark: SparkSession, sf_dir: str) -> DataFrame:
    isles = _isles(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    got = sequence.gallery(isles, ["user_id", "cluster_id"], "at", "event_id")
    return got.select("user_id", "cluster_id", F.array_join(F.transform("frames", lambda x: x.cast("string")), ",").alias("frames"), F.size("frames").cast("long").alias("n"))


_PAIR = "FROM (SELECT vec_id, embedding::DOUBLE[] AS x, lead(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) AS y FROM embeddings) WHERE y IS NOT NULL"


def _vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, x, y of each vector and the next of its label: only ids enter the window, vectors are fetched by them."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    pairs = sequence.with_previous(vectors.select("vec_id", "label"), ["label"], ["vec_id"], {"first_id": "vec_id"}).where("first_id is not null").select(F.col("first_id").alias("vec_id"), F.col("vec_id").alias("next_id"))
    return pairs.join(vectors.select("vec_id", "x"), "vec_id").join(vectors.select(F.col("vec_id").alias("next_id"), F.col("x").alias("y")), "next_id").select("vec_id", "x", "y")


@query(f"SELECT vec_id, round(list_sum(list_transform(list_zip(x, y), lambda p: abs(p[1] - p[2]))) / len(x), 6) AS absdiff, round(1 - len(list_filter(list_zip(x, y), lambda p: abs(p[1] - p[2]) > 0.1))::DOUBLE / len(x), 6) AS psim {_PAIR}")
def array_psim(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    return _vector_pairs(spark, sf_dir).select("vec_id", r6(arrays.absolute_difference(x, y)).alias("absdiff"), r6(arrays.psim(x, y, 0.1)).alias("psim"))


@query(f"""
SELECT vec_id, round(l * c * s, 6) AS ssim, round(l, 6) AS l, round(c, 6) AS c, round(s, 6) AS s, round(0.1 * psim + 0.9 * l * c * s, 6) AS sim FROM (
  SELECT vec_id, psim, (2 * mx * my + 0.01) / (mx * mx + my * my + 0.01) AS l, (2 * sqrt(vx * vy) + 0.03) / (vx + vy + 0.03) AS c, (cv + 0.015) / (sqrt(vx * vy) + 0.015) AS s FROM (
    SELECT vec_id, psim, mx, my, greatest(xx - mx * mx, 0.0) AS vx, greatest(yy - my * my, 0.0) AS vy, xy - mx * my AS cv FROM (
      SELECT vec_id, list_sum(x) / len(x) AS mx, list_sum(y) / len(y) AS my, list_sum(list_transform(x, lambda a: a * a)) / len(x) AS xx, list_sum(list_transform(y, lambda a: a * a)) / len(y) AS yy,
        list_sum(list_transform(list_zip(x, y), lambda p: p[1] * p[2])) / len(x) AS xy, 1 - len(list_filter(list_zip(x, y), lambda p: abs(p[1] - p[2]) > 0.1))::DOUBLE / len(x) AS psim {_PAIR})))
""")
def array_ssim(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    got = _vector_pairs(spark, sf_dir).select("vec_id", arrays.psim(x, y, 0.1).alias("psim"), arrays.ssim(x, y, 0.01, 0.03).alias("m"))
    return got.select("vec_id", *(r6(f"m.{k}").alias(k) for k in ("ssim", "l", "c", "s")), r6(scoring.similarity(F.col("psim"), F.col("m.ssim"))).alias("sim"))


@query("""
SELECT c_custkey, round(avg(coalesce(v, 0.0)), 6) AS feature, round(coalesce(avg(v), 128.0), 6) AS colour
FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 7.0 END AS v FROM orders) ON o_custkey = c_custkey GROUP BY c_custkey
""")
def roi_mean_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") / 7.0).alias("v"))
    joined = table(spark, sf_dir, "customer").select("c_custkey").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    means = joined.select("c_custkey", F.col("v").alias("feature"), F.col("v").alias("colour")).groupBy("c_custkey").agg(*scoring.region_means(["feature"], ["colour"]))
    return means.select("c_custkey", r6("feature").alias("feature"), r6("colour").alias("colour"))


_NAME = "CASE WHEN s < 25 THEN 'gray' WHEN h BETWEEN 170 AND 180 THEN 'pink' WHEN h BETWEEN 0 AND 25 THEN 'orange' WHEN h BETWEEN 36 AND 85 THEN 'green' WHEN h BETWEEN 86 AND 130 THEN 'blue' WHEN h BETWEEN 131 AND 170 THEN 'purplu' ELSE 'orange' END"


@query(f"SELECT p_partkey, theme, CASE WHEN theme IN ('purplu', 'green') THEN 'orange' ELSE theme END AS layout FROM (SELECT p_partkey, {_NAME} AS theme FROM (SELECT p_partkey, p_partkey % 181 AS h, p_size * 5 AS s FROM part))")
def palette_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", colour.palette_name(F.col("p_partkey") % 181, F.col("p_size") * 5).alias("theme"))
    return parts.withColumn("layout", colour.layout_theme(F.col("theme")))


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn > 1 OR o_orderpriority <> '1-URGENT'
""")
def skip_first_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return rank.skip_first(orders, ["o_custkey", "o_orderpriority"], [F.col("o_orderdate"), F.col("o_orderkey")], F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_orderkey", "o_orderpriority")


@query("SELECT bucket, event_id, user_id FROM (SELECT floor(epoch(ts) / 3600)::BIGINT AS bucket, event_id, user_id, row_number() OVER (PARTITION BY floor(epoch(ts) / 3600) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def frame_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.sample_first(_events(spark, sf_dir), [], "ts", 3600, "event_id").select("bucket", "event_id", "user_id")


@query("SELECT split, count(*) AS n, sum(quality)::BIGINT AS good, min(doc_id) AS least, max(doc_id) AS most FROM (SELECT doc_id, quality, CASE WHEN row_number() OVER (ORDER BY (doc_id % 2147483647 * 48271 + 42) % 2147483647, doc_id) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'val' END AS split FROM labels) GROUP BY split")
def seeded_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = rank.seeded_split(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", 0.8, 42)
    return split.groupBy("split").agg(F.count("*").alias("n"), F.sum("quality").alias("good"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))


_UNITS = " ".join(f"WHEN n < {1024 ** (k + 1)} THEN printf('%.1f {u}', n / {1024**k}.0)" for k, u in enumerate(("KB", "MB", "GB", "TB"), 1))


@query(f"SELECT doc_id, CASE WHEN n < 0 THEN '-' WHEN n < 1024 THEN n || ' B' {_UNITS} ELSE printf('%.1f PB', n / {1024**5}.0) END AS size FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 6 THEN -1 ELSE n_chars * pow(1024, doc_id % 5)::BIGINT END AS n FROM documents)")
def size_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from bytes to petabytes, and one that is not known."""
    size = F.when(F.col("doc_id") % 7 == 6, F.lit(-1).cast("long")).otherwise(F.col("n_chars") * F.pow(F.lit(1024), F.col("doc_id") % 5).cast("long"))
    return table(spark, sf_dir, "documents").select("doc_id", text.human_size(size).alias("size"))
