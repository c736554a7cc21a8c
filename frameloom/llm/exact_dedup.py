"""Exact deduplication by content sort: DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.llm.util import carried, partitions, restored, table, text_of, write_table

#: A content is dealt out in salted parts once it holds more than 1 / (HOT_SHARE * partitions) of all rows, and more than HOT_ROWS.
HOT_SHARE, HOT_ROWS = 4, 1000
#: Characters of a text that a splitter holds, before its digest: the driver gets a sample of splitters, not of texts.
SPLITTER_CHARS = 64


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """Each row of df with keep_id, group_size, kept and text_sha256.

    Sampled splitters (a text's beginning and its digest) range-partition the texts by repartitionByRange, an
    external sort inside each partition places equals adjacent, and the window over them compares neighbouring
    texts in full.

    A content that holds a large share of the rows would be one range. Its digest is found by a count that
    combines before its shuffle; at most HOT_SHARE * partitions digests can pass, so that list may be
    broadcast. Rows of such a content get a salt by id, which the splitters can cut; the parts' results
    (a row for each part) are put together by comparing the texts again.

    keep: "largest" or "smallest" id of equal texts. A null text counts as empty. Null ids lose to all others.
    If a kept (text, id) is repeated, one of those rows is kept. An empty table gives an empty one. Columns
    of df stay, but for those of the four names above, which are replaced.
    """
    spark, names = df.sparkSession, df.columns
    n, total = partitions(spark), df.count()
    at = f"__c{names.index(text_col)}"
    best, order = (F.max, "desc_nulls_last") if keep == "largest" else (F.min, "asc_nulls_last")
    body = text_of(df[f"`{text_col}`"])
    rows = carried(df, id=df[f"`{id_col}`"], content=body, text_sha256=F.sha2(body, 256), null_text=df[f"`{text_col}`"].isNull()).drop(at)
    hot = rows.groupBy("text_sha256").count().where(F.col("count") > F.lit(max(HOT_ROWS, total // (HOT_SHARE * n)))).select("text_sha256", F.lit(True).alias("hot"))
    hot = F.broadcast(write_table(hot, "hot-texts"))
    whole = rows.join(hot, "text_sha256").groupBy("content").agg(best("id").alias("all_keep"), F.count("*").alias("all_size"), F.first("text_sha256").alias("text_sha256"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(2 * n)) + 1).otherwise(F.lit(0))
    ranged = rows.join(hot, "text_sha256", "left").withColumn("salt", salt).drop("hot").withColumn("begin", F.substring("content", 1, SPLITTER_CHARS)).repartitionByRange(n, "begin", "text_sha256", "salt")
    same = Window.partitionBy("begin", "text_sha256", "salt", "content")
    marked = ranged.withColumns({
        "part_keep": best("id").over(same), "part_size": F.count("*").over(same),
        "part_rank": F.row_number().over(same.orderBy(getattr(F.col("id"), order)())),
    })
    joined = marked.join(F.broadcast(whole.drop("content")), "text_sha256", "left")
    out = joined.withColumns({
        "keep_id": F.when(F.col("salt") > 0, F.col("all_keep")).otherwise(F.col("part_keep")),
        "group_size": F.when(F.col("salt") > 0, F.col("all_size")).otherwise(F.col("part_size")),
        at: F.when(~F.col("null_text"), F.col("content")),
    })
    out = out.withColumn("kept", (F.col("part_rank") == 1) & F.col("id").eqNullSafe(F.col("keep_id")))
    return restored(out, names, "keep_id", "group_size", "kept", "text_sha256")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows that exact_dedup keeps, with df's own columns, whatever their names; see there for nulls, ties and repeats."""
    names, own = df.columns, [f"own_{k}" for k in range(len(df.columns))]
    found = exact_dedup(df.toDF(*own), own[names.index(id_col)], own[names.index(text_col)], keep)
    return found.where("kept").select(*own).toDF(*names)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
