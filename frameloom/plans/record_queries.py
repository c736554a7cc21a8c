"""Queries of the geometry, record, catalogue, listing, review and log operators, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import text
from frameloom.operators import catalog, clusters, layout, records
from frameloom.plans.score_queries import r6
from frameloom.sources import keyed_files, paged, scratch
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


_BOX = "SELECT p_partkey, (p_partkey % 400 - 20)::INT AS x, (p_size * 7)::INT AS y, (p_partkey % 90 + 1)::INT AS w, (p_size * 3 + 1)::INT AS h, (300 + p_size * 10)::INT AS iw, 384 AS ih FROM part"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    box = F.struct((k % 400 - 20).cast("int").alias("x"), (s * 7).cast("int").alias("y"), (k % 90 + 1).cast("int").alias("w"), (s * 3 + 1).cast("int").alias("h"))
    return table(spark, sf_dir, "part").select("p_partkey", box.alias("box"), (s * 10 + 300).cast("int").alias("iw"), F.lit(384).alias("ih"))


@query(f"SELECT p_partkey, trunc(x * iw / 172.0)::BIGINT AS x, trunc(y * ih / 512.0)::BIGINT AS y, trunc(w * iw / 172.0)::BIGINT AS w, trunc(h * ih / 512.0)::BIGINT AS h FROM ({_BOX})")
def scale_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = layout.scale_box(F.col("box"), F.col("iw"), F.col("ih"), F.lit(172), F.lit(512))
    return _boxes(spark, sf_dir).select("p_partkey", box.alias("b")).select("p_partkey", *(F.col(f"b.{k}").cast("long").alias(k) for k in "xywh"))


@query(f"""
SELECT p_partkey, CASE WHEN ok THEN cx END AS x, CASE WHEN ok THEN cy END AS y, CASE WHEN ok THEN cw END AS w, CASE WHEN ok THEN ch END AS h FROM (
  SELECT p_partkey, greatest(x, 0)::BIGINT AS cx, greatest(y, 0)::BIGINT AS cy, least(w, iw - greatest(x, 0))::BIGINT AS cw, least(h, ih - greatest(y, 0))::BIGINT AS ch,
    x < iw AND y < ih AND least(w, iw - greatest(x, 0)) > 0 AND least(h, ih - greatest(y, 0)) > 0 AS ok FROM ({_BOX}))
""")
def clamp_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = layout.clamp_crop(F.col("box"), F.col("iw"), F.col("ih"))
    return _boxes(spark, sf_dir).select("p_partkey", box.alias("b")).select("p_partkey", *(F.col(f"b.{k}").cast("long").alias(k) for k in "xywh"))


_CELLS = """SELECT n_regionkey, (n_nationkey % 5)::INT AS row_no, (n_nationkey // 5)::INT AS col_no,
  CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE length(n_name) * 8 END AS w, CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE 20 + n_nationkey % 4 * 6 END AS h FROM nation"""


@query(f"""
SELECT c.n_regionkey, c.row_no, c.col_no, x0::BIGINT AS x1, (y0 + CASE WHEN w IS NULL THEN 0 ELSE (rh - h) // 2 END)::BIGINT AS y1,
  (x0 + coalesce(w, cw))::BIGINT AS x2, (y0 + CASE WHEN w IS NULL THEN 0 ELSE (rh - h) // 2 END + coalesce(h, rh))::BIGINT AS y2
FROM ({_CELLS}) c
JOIN (SELECT n_regionkey, col_no, cw, 4 + 2 + coalesce(sum(cw + 2) OVER (PARTITION BY n_regionkey ORDER BY col_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x0 FROM (SELECT n_regionkey, col_no, coalesce(max(w), 0) AS cw FROM ({_CELLS}) GROUP BY ALL)) a ON a.n_regionkey = c.n_regionkey AND a.col_no = c.col_no
JOIN (SELECT n_regionkey, row_no, rh, 3 + 2 + coalesce(sum(rh + 2) OVER (PARTITION BY n_regionkey ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS y0 FROM (SELECT n_regionkey, row_no, coalesce(max(h), 0) AS rh FROM ({_CELLS}) GROUP BY ALL)) b ON b.n_regionkey = c.n_regionkey AND b.row_no = c.row_no
""")
def table_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.table_layout(_nation_cells(spark, sf_dir), ["n_regionkey"], 2, 4, 3)


def _nation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    here = n % 7 != 3
    return table(spark, sf_dir, "nation").select(
        "n_regionkey", (n % 5).cast("int").alias("row_no"), F.floor(n / 5).cast("int").alias("col_no"), F.when(here, F.length("n_name") * 8).alias("w"), F.when(here, 20 + n % 4 * 6).alias("h")
    )


@query("""
SELECT n_regionkey, n, cols, rows FROM (
  SELECT n_regionkey, n, c AS cols, r AS rows, row_number() OVER (PARTITION BY n_regionkey ORDER BY round(abs(c * 172.0::DOUBLE / (r * 512.0::DOUBLE) - 1), 9), c) AS rn FROM (
    SELECT n_regionkey, n, c, ceil(n / c)::BIGINT AS r FROM (SELECT n_regionkey, n, unnest(range(1, n + 1)) AS c FROM (SELECT n_regionkey, (count(*) * (n_regionkey + 3))::BIGINT AS n FROM nation GROUP BY n_regionkey))
    WHERE n % c = 0 OR n % c >= c * 0.5)) WHERE rn = 1
""")
def grid_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg((F.count("*") * (F.first("n_regionkey") + 3)).alias("n")).withColumns({"w": F.lit(172), "h": F.lit(512)})
    return layout.best_columns(sizes, ["n_regionkey"], "n", "w", "h")


@query("""
SELECT printf('%03d', n_nationkey) AS nu, label, value FROM (
  SELECT n_nationkey, 'tit__' AS label, title AS value FROM (SELECT n_nationkey, '[' || n_regionkey || ']' || n_name AS title FROM nation)
  UNION ALL SELECT n_nationkey, 'title', coalesce(nullif(regexp_replace('[' || n_regionkey || ']' || n_name, '\\[.*?\\]|【.*?】', '', 'g'), ''), '') FROM nation
  UNION ALL SELECT n_nationkey, 'libra__', n_regionkey::VARCHAR FROM nation UNION ALL SELECT n_nationkey, 'library', n_regionkey::VARCHAR FROM nation
  UNION ALL SELECT n_nationkey, 'auth__', lower(n_name) FROM nation UNION ALL SELECT n_nationkey, 'author', lower(n_name) FROM nation)
""")
def unpivot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("["), F.col("n_regionkey").cast("string"), F.lit("]"), F.col("n_name"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", raw.alias("title"), F.col("n_regionkey").alias("library"), F.lower("n_name").alias("author"))
    return records.unpivot_check(nations, "n_nationkey", records.INFO_LABELS, True).select("nu", "label", "value")


_THEME = "CASE conv_id % 3 WHEN 0 THEN 'blue' WHEN 1 THEN 'gray' ELSE 'orange' END"
_ROLES = ["system", "user", "assistant"]


def _ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    theme = F.when(F.col("conv_id") % 3 == 0, "blue").when(F.col("conv_id") % 3 == 1, "gray").otherwise("orange")
    themes = talk.select("conv_id").distinct().withColumn("theme", theme)
    themed = records.attach_theme(talk, themes, "conv_id")
    marked = themed.withColumn("role", F.when(F.col("turn") % 4 == 3, F.concat("role", F.lit("_"))).otherwise(F.col("role")))  # shadows, which are left out
    return records.ready_pivot(marked, ["theme", "conv_id"], "role", "text", "turn", [*_ROLES, "user_"])


@query(f"SELECT {_THEME} AS theme, conv_id, {', '.join(f"arg_max(text, turn) FILTER (role = '{r}') AS {r}" for r in _ROLES)}, NULL::VARCHAR AS user_ FROM conversations WHERE turn % 4 <> 3 GROUP BY conv_id")
def ready_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ready(spark, sf_dir)


@query(f"""SELECT theme, conv_id, '{{' || concat_ws(',', '"conv_id":' || conv_id, {", ".join(f"""'"{r}":' || to_json({r})""" for r in _ROLES)}) || '}}' AS record FROM ({SQL["ready_pivot"]})""")
def ready_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.ready_json(_ready(spark, sf_dir), "theme", "conv_id")


_TITLED = "CASE WHEN doc_id % 5 = 0 THEN '【' || lang || '】' WHEN doc_id % 5 = 1 THEN '[' || source || '] ' || lang || ' [x]' ELSE lang || '【' || source || '】' || doc_id END"


@query(f"SELECT doc_id, coalesce(nullif(regexp_replace(t, '\\[.*?\\]|【.*?】', '', 'g'), ''), t) AS title FROM (SELECT doc_id, {_TITLED} AS t FROM documents)")
def title_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, lang, source = F.col("doc_id") % 5, F.col("lang"), F.col("source")
    raw = F.when(k == 0, F.concat(F.lit("【"), lang, F.lit("】"))).when(k == 1, F.concat(F.lit("["), source, F.lit("] "), lang, F.lit(" [x]"))).otherwise(F.concat(lang, F.lit("【"), source, F.lit("】"), F.col("doc_id").cast("string")))
    return table(spark, sf_dir, "documents").select("doc_id", text.chosen_value(F.lit("title"), raw).alias("title"))


_LINE = "CASE WHEN p_partkey % 11 = 0 THEN '  ' WHEN p_partkey % 11 = 1 THEN p_name ELSE ' ' || p_name || ' = ' || p_partkey || CASE WHEN p_partkey % 5 = 0 THEN ' = more' ELSE '' END END"


@query(f"SELECT p_partkey, trim(substr(line, 1, strpos(line, '=') - 1)) AS title, trim(substr(line, strpos(line, '=') + 1)) AS video_id FROM (SELECT p_partkey, trim({_LINE}) AS line FROM part) WHERE line <> '' AND strpos(line, '=') > 0")
def parse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("p_partkey"), F.col("p_name")
    line = F.when(k % 11 == 0, "  ").when(k % 11 == 1, name).otherwise(F.concat(F.lit(" "), name, F.lit(" = "), k.cast("string"), F.when(k % 5 == 0, " = more").otherwise("")))
    return catalog.parse_ids(table(spark, sf_dir, "part").select("p_partkey", line.alias("line")), "line").select("p_partkey", "title", "video_id")


@query("SELECT p_partkey, p_name, word FROM part JOIN (VALUES ('red'), ('re'), ('gear')) AS v(word) ON contains(p_name, word) WHERE NOT contains(p_name, 'bolt')")
def contains_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spark.createDataFrame([("red",), ("re",), ("gear",)], "word string")
    parts = catalog.titles_without(table(spark, sf_dir, "part"), "p_name", "bolt")
    return catalog.titles_with(parts, "p_name", words, "word").select("p_partkey", "p_name", "word")


@query("""
SELECT word, count(*) AS texts, min(doc_id) AS first FROM documents JOIN (SELECT DISTINCT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM benchmark) w ON contains(text, word) GROUP BY word
""")
def words_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many documents each word of the benchmark's texts occurs, as a part of any text."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("word")).distinct()
    found = catalog.titles_with(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", words, "word")
    return found.groupBy("word").agg(F.count("*").alias("texts"), F.min("doc_id").alias("first"))


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS label FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def file_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("/cache/frames/"), F.col("doc_id").cast("string"))
    marks = table(spark, sf_dir, "labels").select("doc_id", "toxic", url.alias("url"))
    files = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("doc_id").cast("string").alias("name"))
    return catalog.labelled_files(marks, "url", F.when(F.col("toxic") == 1, "yes").otherwise("no"), files, "name").select("doc_id", "label")


_LOG = "SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN 'Section ' || turn ELSE 'frame_' || (turn * 20 + conv_id % 13) || '.png ' || role END AS line, role = 'user' AS header, role = 'user' AND conv_id % 4 = 0 AND turn > 4 AS passing FROM conversations"
_SECTIONS = f"""SELECT *, sum(is_header::INT) OVER w AS section FROM (
  SELECT *, header AND NOT passed AS is_header FROM (SELECT *, max(passing::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) = 1 AS passed FROM ({_LOG})))
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)"""


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk, turn, conv = table(spark, sf_dir, "conversations"), F.col("turn"), F.col("conv_id")
    line = F.when(F.col("role") == "user", F.concat(F.lit("Section "), turn.cast("string"))).otherwise(F.concat(F.lit("frame_"), (turn * 20 + conv % 13).cast("string"), F.lit(".png "), F.col("role")))
    lines = talk.select("conv_id", "turn", "role", line.alias("line"))
    header = F.col("role") == "user"
    return catalog.log_sections(lines, ["conv_id"], "turn", "line", header, header & (conv % 4 == 0) & (turn > 4))


@query(f"SELECT conv_id, turn, section::BIGINT AS section, is_header, passed FROM ({_SECTIONS})")
def log_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir).select("conv_id", "turn", F.col("section").cast("long").alias("section"), "is_header", "passed")


_IN = "(num BETWEEN 20 AND 70 AND NOT is_header)"


@query(f"""
WITH s AS (SELECT *, nullif(regexp_extract(line, '_(\\d+)\\.png', 1), '')::BIGINT AS num FROM ({_SECTIONS})),
m AS (SELECT *, coalesce{_IN[:-1]}, false) AS kept, section > 0 AND NOT passed AS body FROM s),
e AS (SELECT *, min(CASE WHEN kept THEN turn END) OVER w AS f, max(CASE WHEN kept THEN turn END) OVER w AS l, min(CASE WHEN NOT is_header THEN turn END) OVER w AS lo, max(CASE WHEN NOT is_header THEN turn END) OVER w AS hi FROM m WINDOW w AS (PARTITION BY conv_id, section, passed))
SELECT conv_id, section::BIGINT AS section, turn, 1 AS pos, '   ... snipped' AS out FROM e WHERE body AND turn = f AND f > lo
UNION ALL SELECT conv_id, section::BIGINT, turn, 2, line FROM e WHERE NOT body OR kept OR (is_header AND f IS NOT NULL)
UNION ALL SELECT conv_id, section::BIGINT, turn, 3, '   ... snipped' FROM e WHERE body AND turn = l AND l < hi
""")
def log_snip(spark: SparkSession, sf_dir: str) -> DataFrame:
    snipped = catalog.log_snip(_sections(spark, sf_dir), ["conv_id"], "turn", "line", text.frame_number(F.col("line")), 20, 70)
    return snipped.select("conv_id", F.col("section").cast("long").alias("section"), "turn", "pos", "out")


@query("SELECT p_brand, count(*) FILTER (p_size % 4 = 0) AS dirs, count(*) FILTER (p_size % 4 <> 0) AS files, count(*) + 1 AS total FROM part WHERE contains(lower(p_name), 're') GROUP BY p_brand")
def listing_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("is_dir", F.col("p_size") % 4 == 0)
    return catalog.listing_counts(catalog.matching(parts, "p_name", "is_dir", "RE"), ["p_brand"], "is_dir", True)


@query("SELECT lang, count(*) AS total, count(*) FILTER (quality = 0) AS synthesized, count(*) FILTER (toxic = 1) AS deleted FROM labels JOIN documents ON labels.doc_id = documents.doc_id GROUP BY lang")
def review_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return catalog.review_counts(marked, ["lang"], F.col("quality") == 0, F.col("toxic") == 1)


@query("SELECT event_id, ((event_id % 9 - 4 + user_id % 5) % 5 + 5) % 5 AS cursor, CASE WHEN event_id % 9 < 5 THEN event_id % 9 ELSE 0 END AS representative FROM events")
def frame_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames, k = F.array(*(F.lit(f"f{i}") for i in range(5))), F.col("event_id") % 9
    index = catalog.representative_index(frames, F.concat(F.lit("f"), k.cast("string")))
    return table(spark, sf_dir, "events").select("event_id", catalog.moved_cursor(F.col("user_id") % 5, k - 4, F.lit(5)).alias("cursor"), index.cast("long").alias("representative"))


_TEXTY = "CASE l_linenumber % 6 WHEN 0 THEN 'n/a' WHEN 1 THEN l_quantity || 'abc' WHEN 2 THEN ' -' || l_tax WHEN 3 THEN '' WHEN 4 THEN 'NaN' ELSE '.5e1x' END"


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 6 WHEN 1 THEN round(l_quantity, 6) WHEN 2 THEN round(-l_tax, 6) + 0.0 WHEN 5 THEN 5.0 ELSE 0.0 END AS v FROM lineitem""")
def csv_float_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_linenumber") % 6
    raw = F.when(k == 0, "n/a").when(k == 1, F.concat(F.col("l_quantity").cast("string"), F.lit("abc"))).when(k == 2, F.concat(F.lit(" -"), F.col("l_tax").cast("string"))).when(k == 3, "").when(k == 4, "NaN").otherwise(".5e1x")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (r6(text.leading_number(raw)) + 0.0).alias("v"))


@query("""
SELECT p_partkey, p_partkey % 3 <> 0 AS rank_ok, p_partkey % 4 < 2 AS last_ok, p_partkey % 2 = 0 AS id_ok, CASE WHEN p_partkey % 5 < 4 THEN p_partkey * 1000 + 7 END AS n FROM part
""")
def ocr_grammar_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    ranked = F.when(k % 3 == 0, "x1").otherwise(k.cast("string"))
    last = F.when(k % 4 == 0, "new!!").when(k % 4 == 1, F.concat(k.cast("string"), F.lit(" up"))).otherwise("newer")
    name = F.when(k % 2 == 0, F.concat(F.lit("sm"), k.cast("string"))).otherwise(F.concat(F.lit("xx"), k.cast("string")))
    count = F.when(k % 5 == 4, "1,2x").otherwise(F.concat(F.regexp_replace(F.format_number(k * 1000 + 7, 0), "^$", "0")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.follows(ranked, "rank").alias("rank_ok"), text.follows(last, "last").alias("last_ok"), text.follows(name, "id").alias("id_ok"),
        F.when(text.follows(count, "count"), text.parsed_count(count)).alias("n"),
    )


@query("SELECT doc_id, regexp_replace(source || '.' || lang, '\\.[^.]+$', '') AS shown, lang AS file, '/cache/' || CASE WHEN doc_id % 2 = 0 THEN 'purified/' ELSE 'frames/' END || lang AS url FROM documents")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.display_name(F.concat_ws(".", "source", "lang")).alias("shown"), text.file_name(F.concat_ws("/", "source", "lang")).alias("file"), catalog.image_url(F.col("lang"), F.col("doc_id") % 2 == 0).alias("url"))


@query("SELECT s_suppkey, replace(replace(replace('<' || s_name || ' & \"x\">', '&', '&amp;'), '<', '&lt;'), '>', '&gt;').replace('\"', '&quot;') AS safe FROM supplier")
def html_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.html_escape(F.concat(F.lit("<"), F.col("s_name"), F.lit(' & "x">'))).alias("safe"))


@query("SELECT label, count(*) AS n, least(5, count(DISTINCT embedding))::BIGINT AS clusters, sum(vec_id)::BIGINT AS ids FROM embeddings WHERE label IS NOT NULL AND len(embedding) = 64 GROUP BY label")
def issue_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows and clusters each label has; which cluster a row is in depends on the seeds, so tests compare that."""
    vectors = table(spark, sf_dir, "embeddings").where("label is not null and size(embedding) = 64").select("label", "vec_id", F.col("embedding").cast("array<double>").alias("features"))
    found = clusters.issue_clusters(vectors, ["label"], "vec_id", "features")
    return found.groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("cluster_id").alias("clusters"), F.sum("vec_id").alias("ids"))


@query("""
WITH points AS (SELECT p_size % 5 AS issue, p_partkey, p_partkey % 4 AS spot, p_partkey % 4 * 1000.0 + p_size % 7 AS a, (p_partkey % 4) * (p_partkey % 4) % 3 * 500.0 + p_partkey // 4 % 5 AS b FROM part),
means AS (SELECT issue, spot, count(*) AS n, avg(a) AS ma, avg(b) AS mb, min(p_partkey) AS first FROM points GROUP BY issue, spot),
costs AS (SELECT issue, spot, sum((a - ma) * (a - ma) + (b - mb) * (b - mb)) AS cost FROM points JOIN means USING (issue, spot) GROUP BY issue, spot)
SELECT issue::BIGINT AS issue, row_number() OVER (PARTITION BY issue ORDER BY ma, mb) - 1 AS cluster_id, n, first, round(ma, 6) AS a, round(mb, 6) AS b, round(cost, 2) AS cost FROM means JOIN costs USING (issue, spot)
""")
def grouped_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts around four spots of each issue, in four clusters: their numbers, sizes, centres and costs. The spots are far apart, so SQL knows the best clusters."""
    spot = F.col("p_partkey") % 4
    a, b = spot * 1000.0 + F.col("p_size") % 7, spot * spot % 3 * 500.0 + F.floor(F.col("p_partkey") / 4) % 5
    points = table(spark, sf_dir, "part").select((F.col("p_size") % 5).cast("long").alias("issue"), "p_partkey", F.array(a, b.cast("double")).alias("features"))
    found = points.join(clusters.issue_clusters(points, ["issue"], "p_partkey", "features", 4), ["issue", "p_partkey"]).select("issue", "cluster_id", "p_partkey", F.col("features")[0].alias("a"), F.col("features")[1].alias("b"))
    spread = lambda c: F.sum(F.col(c) * F.col(c)) - F.sum(c) * F.sum(c) / F.count("*")
    return found.groupBy("issue", F.col("cluster_id").cast("long").alias("cluster_id")).agg(
        F.count("*").alias("n"), F.min("p_partkey").alias("first"), F.round(F.avg("a"), 6).alias("a"), F.round(F.avg("b"), 6).alias("b"), F.round(spread("a") + spread("b"), 2).alias("cost")
    )


@query()
def colour_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
    return clusters.kmeans(vectors, "features").select("vec_id", "cluster_id")


@query()
def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
    return clusters.pca_project(vectors, "features").select("vec_id", F.transform("projected", lambda x: F.round(F.abs(x), 4)).alias("projected"))


_STAMPED = "CASE event_id % 4 WHEN 0 THEN '2024-01-02 03:04:05,678 - INFO - ' WHEN 1 THEN '2024-01-02 03:04:05 - INFO - ' WHEN 2 THEN '2024-01-02 03:04:05,678 - debug_1 - ' ELSE '' END || event_type || ' f_' || event_id || '.png'"


@query(f"SELECT event_id, regexp_replace({_STAMPED}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}},[0-9]{{3}} - [0-9A-Za-z_]+ - ', '') AS message, event_id AS frame FROM events")
def log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    stamp = F.when(k == 0, "2024-01-02 03:04:05,678 - INFO - ").when(k == 1, "2024-01-02 03:04:05 - INFO - ").when(k == 2, "2024-01-02 03:04:05,678 - debug_1 - ").otherwise("")
    line = F.concat(stamp, F.col("event_type"), F.lit(" f_"), F.col("event_id").cast("string"), F.lit(".png"))
    return table(spark, sf_dir, "events").select("event_id", text.log_message(line).alias("message"), text.frame_number(line).alias("frame"))


@query("SELECT p_partkey, p_name || ' = ' || p_partkey AS line, 'ffmpeg -i video/av' || p_partkey || '.mp4 -vf fps=2 cache/f15_%06d.png' AS command, greatest(1, p_size // 10)::BIGINT AS interval FROM part WHERE NOT contains(p_name, 'VOCAL')")
def format_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = catalog.titles_without(table(spark, sf_dir, "part"), "p_name", "VOCAL")
    return parts.select("p_partkey", text.id_line(F.col("p_name"), F.col("p_partkey")).alias("line"), text.sampling_command(F.col("p_partkey"), "15", "2").alias("command"), text.axis_interval(F.col("p_size")).alias("interval"))


@query("SELECT s_suppkey, s_nationkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def issue_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return catalog.with_video(table(spark, sf_dir, "supplier"), nations, "s_nationkey", "n_name").select("s_suppkey", "s_nationkey", "n_name")


# The markup of a listing's rows.
_ROW = """'<tr><td class="col-name"><a href="' || href || '" class="file-link"><span class="file-type ' || CASE WHEN d THEN 'file-type-dir">D' ELSE 'file-type-file">F' END || '</span><span>' || name || '</span></a></td><td class="col-size">' || size || '</td><td class="col-mtime">' || stamp || '</td><td class="col-action"><a href="' || href || '" class="btn btn-text">' || CASE WHEN d THEN '打开' ELSE '查看' END || '</a></td></tr>'"""
_UP = '<tr><td class="col-name"><a href="../" class="file-link"><span class="file-type file-type-dir">D</span><span>..</span></a></td><td class="col-size">-</td><td class="col-mtime">-</td><td class="col-action"></td></tr>'


@query(f"""
SELECT n_regionkey, CASE WHEN n_regionkey > 0 THEN '{_UP}' || chr(10) ELSE '' END || string_agg({_ROW}, chr(10) ORDER BY d DESC, lower(name), name) AS html FROM (
  SELECT n_regionkey, name, d, name || CASE WHEN d THEN '/' ELSE '' END AS href, CASE WHEN d THEN '-' ELSE n_nationkey * 40 || ' B' END AS size, CASE WHEN d THEN '-' ELSE '2024-01-02 03:04' END AS stamp
  FROM (SELECT n_regionkey, n_nationkey, n_nationkey % 4 = 1 AS d, n_name || '&amp;' AS name FROM nation)) GROUP BY n_regionkey
""")
def listing_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").select("n_regionkey", F.concat("n_name", F.lit("&")).alias("name"), (n % 4 == 1).alias("is_dir"), (n * 40).cast("long").alias("size"), F.lit("2024-01-02 03:04:05").cast("timestamp").alias("mtime"))
    return catalog.listing_rows(rows, ["n_regionkey"], "name", "is_dir", "size", "mtime", F.col("n_regionkey") > 0)


_TEMPLATE = "<h1>__TITLE__</h1><p>__DESCRIPTION__</p>__BREADCRUMB__<table>__FILE_ROWS__</table>__TOTAL_COUNT__/__DIR_COUNT__/__FILE_COUNT__"


@query(f"""
WITH entries AS (SELECT 'r' || n_regionkey AS folder, n_name AS name, n_nationkey % 4 = 1 AS d, n_nationkey * 40 AS bytes FROM nation WHERE n_regionkey <> 4 UNION ALL SELECT '', 'r' || r_regionkey, true, NULL FROM region),
cells AS (SELECT folder, name, d, name || CASE WHEN d THEN '/' ELSE '' END AS href, CASE WHEN d THEN '-' ELSE bytes || ' B' END AS size, CASE WHEN d THEN '-' ELSE '2024-01-02 03:04' END AS stamp FROM entries),
listed AS (SELECT folder, string_agg({_ROW}, chr(10) ORDER BY d DESC, lower(name), name) AS rows, count(*) FILTER (d) AS dirs, count(*) FILTER (NOT d) AS files FROM cells GROUP BY folder),
folders AS (SELECT '' AS folder UNION ALL SELECT 'r' || r_regionkey FROM region)
SELECT folder, '<h1>文件索引' || CASE WHEN folder <> '' THEN ' — ' || folder ELSE '' END || '</h1><p>' || CASE WHEN folder <> '' THEN '目录 ' || folder ELSE '根目录' END || '</p><a href="/">根目录</a>'
  || CASE WHEN folder <> '' THEN chr(10) || '<span class="breadcrumb-sep">/</span>' || chr(10) || '<span class="breadcrumb-current">' || folder || '</span>' ELSE '' END
  || '<table>' || CASE WHEN folder <> '' THEN '{_UP}' || CASE WHEN rows IS NULL THEN '' ELSE chr(10) END ELSE '' END || coalesce(rows, '') || '</table>'
  || (coalesce(dirs + files, 0) + CASE WHEN folder <> '' THEN 1 ELSE 0 END) || '/' || coalesce(dirs, 0) || '/' || coalesce(files, 0) AS html
FROM folders LEFT JOIN listed USING (folder)
""")
def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index pages of a root with a folder for each region and, but for one, files and folders for its nations; written under their names and read back."""
    region, nation = (F.concat(F.lit("r"), F.col(c).cast("string")) for c in ("r_regionkey", "n_regionkey"))
    none = [F.lit(None).cast(k).alias(n) for k, n in (("long", "size"), ("timestamp", "mtime"))]
    folders = table(spark, sf_dir, "region").select(region.alias("folder"))
    inside = table(spark, sf_dir, "nation").where("n_regionkey <> 4").select(
        nation.alias("folder"), F.col("n_name").alias("name"), (F.col("n_nationkey") % 4 == 1).alias("is_dir"), (F.col("n_nationkey") * 40).cast("long").alias("size"), F.lit("2024-01-02 03:04:05").cast("timestamp").alias("mtime")
    )
    entries = inside.unionByName(folders.select(F.lit("").alias("folder"), F.col("folder").alias("name"), F.lit(True).alias("is_dir"), *none))
    pages = catalog.index_pages(folders.unionByName(spark.createDataFrame([("",)], "folder string")), entries, "folder", "name", "is_dir", "size", "mtime", _TEMPLATE)
    root = f"{scratch.shared_folder(spark)}/index-pages-{uuid.uuid4().hex}"
    keyed_files.write_files(pages.select(F.concat(F.when(F.col("folder") == "", "").otherwise(F.concat("folder", F.lit("/"))), F.lit("index.html")).alias("name"), "html"), "name", "html", root)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").load(root)
    return found.select(F.regexp_replace(F.element_at(F.split("path", "/index-pages-[0-9a-f]+/"), -1), "/?index.html$", "").alias("folder"), F.col("content").cast("string").alias("html"))


@query("SELECT p_partkey AS id, p_name AS title FROM part")
def paged_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as pages of twenty in numbered files, read by the source that pages."""
    item = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    pages = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 20).alias("page")).agg(F.array_sort(F.collect_list(item)).alias("medias"))
    root = f"{scratch.shared_folder(spark)}/media-pages-{uuid.uuid4().hex}"
    body = F.to_json(F.struct(F.lit(0).alias("code"), F.struct("medias").alias("data")))
    keyed_files.write_files(pages.select(F.format_string("page-%d.json", F.col("page") + 1).alias("name"), body.alias("body")), "name", "body", root)
    paged.register(spark)
    return spark.read.format("paged").option("page", f"{root}/page-{{page}}.json").load()


_SEP = """chr(10) || '<span class="breadcrumb-sep">/</span>' || chr(10)"""


@query(f"""SELECT doc_id, '<a href="/">根目录</a>' || {_SEP} || '<a href="/x/">x</a>' || {_SEP} || '<a href="/x/' || doc_id || '/">' || doc_id || '</a>' || {_SEP} || '<span class="breadcrumb-current">y</span>' AS html FROM documents""")
def breadcrumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("x\\"), F.col("doc_id").cast("string"), F.lit("/y/"))
    return table(spark, sf_dir, "documents").select("doc_id", text.breadcrumb_html(path).alias("html"))


_VIEW = "SELECT lang, l.doc_id, '{0}' AS view FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE {1}"


@query(" UNION ALL ".join((_VIEW.format("synthesized", "quality = 0"), _VIEW.format("deleted", "toxic = 1"))))
def review_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    views = [catalog.review_view(marked, v, F.col("quality") == 0, F.col("toxic") == 1).select("lang", "doc_id", F.lit(v).alias("view")) for v in ("synthesized", "deleted")]
    return views[0].unionByName(views[1])


@query("SELECT n_nationkey, (n_nationkey // 5)::BIGINT AS row, (n_nationkey % 5)::BIGINT AS col, (n_nationkey % 5 * 175)::BIGINT AS x, (n_nationkey // 5 * 515)::BIGINT AS y FROM nation")
def grid_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = layout.grid_place(F.col("n_nationkey"), F.lit(5), F.lit(172), F.lit(512), 3)
    return table(spark, sf_dir, "nation").select("n_nationkey", place.alias("p")).select("n_nationkey", *(F.col(f"p.{k}").cast("long").alias(k) for k in ("row", "col", "x", "y")))


@query(f"""
SELECT c.k AS n_regionkey, width, height FROM (SELECT n_regionkey AS k, (sum(cw) + (count(*) + 1) * 2 + 8)::BIGINT AS width FROM (SELECT n_regionkey, col_no, coalesce(max(w), 0) AS cw FROM ({_CELLS}) GROUP BY ALL) GROUP BY n_regionkey) c
JOIN (SELECT n_regionkey AS k, (sum(rh) + (count(*) + 1) * 2 + 6)::BIGINT AS height FROM (SELECT n_regionkey, row_no, coalesce(max(h), 0) AS rh FROM ({_CELLS}) GROUP BY ALL) GROUP BY n_regionkey) r ON c.k = r.k
""")
def canvas_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.canvas_size(_nation_cells(spark, sf_dir), ["n_regionkey"], 2, 4, 3)
