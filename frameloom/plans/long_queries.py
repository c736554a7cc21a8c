"""Queries over whole tables as one long sequence, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.operators import downsample, scan
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


_LAG = "SELECT event_id, ts, value, lag(value) OVER (ORDER BY ts, event_id) AS before FROM events"
_SIM = f"SELECT *, CASE WHEN before IS NULL THEN 0.0 ELSE 1 - least(abs(value - before) / 200.0, 1.0) END AS sim FROM ({_LAG})"


def _similar(spark: SparkSession, sf_dir: str) -> scan.Ranges:
    """All events as one sequence, with their likeness to the event before."""
    rows = scan.in_ranges(table(spark, sf_dir, "events").select("event_id", "ts", "value"), [], ["ts", "event_id"])
    sim = F.when(F.col("before").isNull(), 0.0).otherwise(1 - F.least(F.abs(F.col("value") - F.col("before")) / 200.0, F.lit(1.0)))
    return scan.pairs(rows, before="value").with_columns({"sim": sim})


@query(f"SELECT event_id, coalesce(round(abs(value - before), 6), 0.0) AS difference, round(sim, 6) AS sim FROM ({_SIM})")
def long_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir).rows().select("event_id", F.coalesce(F.round(F.abs(F.col("value") - F.col("before")), 6), F.lit(0.0)).alias("difference"), F.round("sim", 6).alias("sim"))


@query(f"""
SELECT cluster_id::BIGINT AS cluster_id, count(*) AS n, min(event_id) AS least, max(event_id) AS greatest, round(min(value), 6) AS low, round(max(value), 6) AS high
FROM (SELECT *, sum((sim < 0.93)::INT) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cluster_id FROM ({_SIM})) GROUP BY cluster_id
""")
def long_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan.islands(_similar(spark, sf_dir), F.col("sim") < 0.93).rows()
    return rows.groupBy("cluster_id").agg(
        F.count("*").alias("n"), F.min("event_id").alias("least"), F.max("event_id").alias("greatest"), F.round(F.min("value"), 6).alias("low"), F.round(F.max("value"), 6).alias("high")
    )


@query("""
SELECT run_start, run_end, run_end - run_start AS length FROM (
  SELECT min(pos)::BIGINT AS run_start, max(pos)::BIGINT + 1 AS run_end FROM (
    SELECT pos, pos - row_number() OVER (ORDER BY pos) AS run FROM (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, value > 50 AS flag FROM events) WHERE flag) GROUP BY run)
""")
def long_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    found = scan.runs(scan.in_ranges(events, [], ["ts", "event_id"]), F.col("value") > 50)
    return found.select(F.col("start").alias("run_start"), F.col("end").alias("run_end"), "length")


_LONG_LOG = "SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN 'Section ' || turn ELSE 'frame_' || (turn * 20 + conv_id % 13) || '.png ' || role END AS line, role = 'user' AS header, conv_id > (SELECT max(conv_id) FROM conversations) - 3 AS passing FROM conversations"


@query(f"""
SELECT conv_id, turn, (sum(is_header::INT) OVER w)::BIGINT AS section, is_header, passed, last_value(CASE WHEN is_header THEN line END IGNORE NULLS) OVER w AS title FROM (
  SELECT *, header AND NOT passed AS is_header FROM (SELECT *, max(passing::INT) OVER (ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING) = 1 AS passed FROM ({_LONG_LOG})))
WINDOW w AS (ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING)
""")
def long_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as one log: its lines' sections and their titles."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    line = F.when(F.col("role") == "user", F.concat(F.lit("Section "), F.col("turn").cast("string"))).otherwise(F.concat(F.lit("frame_"), (F.col("turn") * 20 + F.col("conv_id") % 13).cast("string"), F.lit(".png "), F.col("role")))
    last = talk.agg(F.max("conv_id")).first()[0] or 0
    rows = scan.in_ranges(talk.withColumn("line", line), [], ["conv_id", "turn"])
    found = scan.sections(rows, F.col("role") == "user", F.col("conv_id") > last - 3).scan(title=scan.latest(F.when(F.col("is_header"), F.col("line"))))
    return found.rows().select("conv_id", "turn", "section", "is_header", "passed", "title")


_BASE = 1_704_067_200_000_000  # microseconds at the beginning of 2024


@query(f"""
WITH RECURSIVE points AS (
  SELECT event_type, x, value AS y, row_number() OVER (PARTITION BY event_type ORDER BY x, value) - 1 AS p, count(*) OVER (PARTITION BY event_type) AS n FROM (SELECT *, (epoch_us(ts) - {_BASE}) / 1000000.0 AS x FROM events)),
placed AS (SELECT *, CASE WHEN p = 0 THEN -1 WHEN p = n - 1 THEN 38 ELSE (p * 38 - 1) // (n - 2) END AS bucket FROM points WHERE n > 40),
means AS (SELECT event_type, bucket - 1 AS bucket, avg(x) AS mx, avg(y) AS my FROM placed GROUP BY ALL),
known AS (SELECT event_type, bucket, x, y, mx, my FROM placed LEFT JOIN means USING (event_type, bucket)),
chosen AS (
  SELECT event_type, bucket, x, y FROM known WHERE bucket = -1
  UNION ALL
  SELECT event_type, bucket, arg_max(x, area), arg_max(y, area) FROM (
    SELECT k.event_type, k.bucket, k.x, k.y, coalesce(abs((s.x - mx) * (k.y - s.y) - (s.x - k.x) * (my - s.y)), 0) AS area FROM chosen s JOIN known k ON k.event_type = s.event_type AND k.bucket = s.bucket + 1) GROUP BY event_type, bucket)
SELECT event_type, (bucket + 1)::BIGINT AS at, round(x, 3) AS x, round(y, 6) AS y FROM chosen
""")
def chart_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty points of each event type's values over time, for a chart."""
    at = (F.unix_micros(F.col("ts").cast("timestamp")) - _BASE) / F.lit(1000000.0)
    events = table(spark, sf_dir, "events").select("event_type", at.alias("x"), F.col("value").alias("y"))
    found = downsample.chart_order(downsample.largest_triangles(events, ["event_type"], "x", "y", 40), ["event_type"], "x", "at")
    return found.select("event_type", F.col("at").cast("long").alias("at"), F.round("x", 3).alias("x"), F.round("y", 6).alias("y"))
