"""Filter interaction audit: every order of a set of filters replayed over every document."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frameloom.llm.util import partitions, table, text_of, write_table

#: A word, and the characters of the symbol filter.
WORD, SYMBOL = r"[^\x20\x09-\x0D]+", "[#$%&*|]"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITAL_PERCENT = 50, 65, 5
#: One letter for each filter, in the order of the bits of a document's flags: short, repetitive, capitals, symbols, copy.
FILTERS = "ABCDE"
#: Orders are broadcast, n! of them.
MOST_FILTERS = 6


def text_flags(content: Column) -> list[Column]:
    """Whether a text (not null) fails the filters of words, distinct words, capitals and symbols: those that look at it alone."""
    words = F.regexp_extract_all(content, F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")
    capitals = F.length(F.regexp_replace(content, "[^A-Z]+", "")).cast("long")
    return [
        n < LEAST_WORDS,
        F.size(F.array_distinct(words)).cast("long") * 100 < n * LEAST_DISTINCT_PERCENT,
        capitals * 100 > F.length(content).cast("long") * MOST_CAPITAL_PERCENT,
        content.rlike(SYMBOL),
    ]


def _bits(flags: list[Column]) -> Column:
    """Flags as an int, the first at bit 0."""
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(flags[1:], 1)), F.when(flags[0], 1).otherwise(0))


def document_flags(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """id, part and fails (an int of bits in the order of FILTERS) of each row.

    Texts are read once, for the four filters of a text alone and a SHA-256 digest, and this narrow table is written. A copy is a row whose text also
    has a row of a smaller id: the least id of each digest, combined before its shuffle, is joined back where a digest has several rows, so a
    group of copies is never held by a task, and a join's hot digest can be split.

    A null text counts as empty, a null part as "". A null id counts as greater than all others; of rows that share the smallest id of a text,
    none is a copy. Repeated rows are rows of their own. An empty table gives none. Other columns are not read.
    """
    content = text_of(df[f"`{text_col}`"])
    rows = df.select(df[f"`{id_col}`"].alias("id"), F.coalesce(df[f"`{part_col}`"].cast("string"), F.lit("")).alias("part"), content.alias("content"))
    rows = rows.select("id", "part", _bits(text_flags(F.col("content"))).alias("fails"), F.unhex(F.sha2("content", 256)).alias("digest"))
    rows = write_table(rows, "text-flags")
    shared = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    copy = F.col("first").isNotNull() & F.coalesce(F.col("id") > F.col("first"), F.lit(True))
    return rows.join(shared, "digest", "left").select("id", "part", (F.col("fails") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("fails"))


def with_labels(flags: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """flags and two booleans, good and toxic: whether any label of the row's id is 1. Ids without a label, null ids and null labels: false."""
    per = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{good_col}`"].alias("g"), labels[f"`{toxic_col}`"].alias("t")).where("id is not null and (g = 1 or t = 1)")
    per = per.groupBy("id").agg(F.max(F.coalesce(F.col("g") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("t") == 1, F.lit(False))).alias("toxic"))
    return flags.join(per, "id", "left").select(*flags.columns, F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def replay(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.

    flags: rows of part, fails (bits in the order of filters), good and toxic, none null. Each row meets the broadcast orders (filters! of them,
    whatever the input), its first failure is computed, the steps are exploded and counted where they are made: a task sends
    one row for each (part, order, step) it has seen, so that neither a part of a third of the rows nor the replay's size goes through a shuffle.
    A part without rows has none. A row is a few bytes and makes a row for each order and step, so rows are dealt out evenly first: by size alone, too
    many would be one task's.
    """
    if not 1 <= len(set(filters)) == len(filters) <= MOST_FILTERS:
        raise ValueError(f"filters are 1 to {MOST_FILTERS} different letters")
    k = len(filters)
    turn = [f"b{i}" for i in range(k)]
    orders = flags.sparkSession.createDataFrame(
        [(n, "".join(o), *(1 << filters.index(c) for c in o)) for n, o in enumerate(permutations(filters))], f"o int, filter_order string, {', '.join(f'{b} int' for b in turn)}"
    )
    first = F.lit(k + 1)
    for i in reversed(range(k)):
        first = F.when(F.col("fails").bitwiseAND(F.col(turn[i])) != 0, i + 1).otherwise(first)
    dealt = flags.select("part", "fails", "good", "toxic").repartition(partitions(flags.sparkSession))
    replayed = dealt.crossJoin(F.broadcast(orders.drop("filter_order"))).select("part", "fails", "good", "toxic", "o", first.alias("first"), F.posexplode(F.array(*turn)).alias("before", "bit"))
    step, fails = F.col("before") + 1, F.col("fails").bitwiseAND(F.col("bit")) != 0
    here = F.col("first") == step
    counts = replayed.groupBy("part", "o", "before").agg(
        F.count_if(F.col("first") > step).alias("kept"),
        F.count_if(here).alias("removed"),
        F.count_if(fails & (F.col("first") < step)).alias("redundant"),
        F.count_if(F.col("fails") == F.col("bit")).alias("unique_fails"),
        F.count_if(here & F.col("good")).alias("good_lost"),
        F.count_if(here & F.col("toxic")).alias("toxic_lost"),
    )
    out = counts.join(F.broadcast(orders.select("o", "filter_order")), "o").withColumn("step", step)
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    shapley = F.sum("removed").over(Window.partitionBy("part", letter))  # a window of one row for each order
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))


def audit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """replay of document_flags with_labels; see there for nulls, ties, repeats and empty tables."""
    return replay(with_labels(document_flags(df, id_col, text_col, part_col), labels, id_col))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = """
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
measured AS (
    SELECT doc_id, part, body, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
           length(regexp_replace(body, '[^A-Z]+', '', 'g')) AS capitals
    FROM texts),
failed AS (
    SELECT doc_id, part,
           [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * capitals > 5 * length(body), regexp_matches(body, '[#$%&*|]'),
            doc_id > min(doc_id) OVER (PARTITION BY body)] AS f
    FROM measured),
per_id AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
labelled AS (SELECT part, f, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM failed LEFT JOIN per_id USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE b.l <> a.l AND c.l NOT IN (a.l, b.l) AND d.l NOT IN (a.l, b.l, c.l) AND e.l NOT IN (a.l, b.l, c.l, d.l)),
places AS (SELECT filter_order, [ascii(filter_order[1]) - 64, ascii(filter_order[2]) - 64, ascii(filter_order[3]) - 64, ascii(filter_order[4]) - 64, ascii(filter_order[5]) - 64] AS p FROM orders),
replayed AS (
    SELECT *, CASE WHEN f[p[1]] THEN 1 WHEN f[p[2]] THEN 2 WHEN f[p[3]] THEN 3 WHEN f[p[4]] THEN 4 WHEN f[p[5]] THEN 5 ELSE 6 END AS first
    FROM labelled, places),
stepped AS (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM replayed),
counted AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step,
           count(*) FILTER (first > step) AS kept, count(*) FILTER (first = step) AS removed, count(*) FILTER (f[p[step]] AND first < step) AS redundant,
           count(*) FILTER (f[p[step]] AND len(list_filter(f, lambda x: x)) = 1) AS unique_fails,
           count(*) FILTER (first = step AND good) AS good_lost, count(*) FILTER (first = step AND toxic) AS toxic_lost
    FROM stepped GROUP BY ALL)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM counted
"""
