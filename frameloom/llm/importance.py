"""Target-distribution importance resampling: hashed n-gram features weighed by how much likelier a target corpus has them."""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.util import TEXT_ROWS, forget, partitions, table, text_of, write_table

#: Fixed value: what a word is made of, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters of texts that a task's DuckDB takes at a time: the bound of its memory, but for a longer single text. No result depends on it.
BLOCK_CHARS = 1 << 20
BUCKETS, LONGEST = 10_000, 2
LEAST_WORDS, DRAWN_PERCENT, SEED = 20, 25, 7

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _features_sql(longest: int, buckets: int) -> str:
    """DuckDB SQL over texts (n, body): n_words and each bucket's count, of each text that has a word. feature_crc is the registered function."""
    runs = " || ' ' || ".join
    steps = ", ".join(f"lead(w0, {k}) OVER (PARTITION BY n ORDER BY place) AS w{k}" for k in range(1, longest))
    grams = " UNION ALL ".join(f"SELECT n, feature_crc({runs(f'w{i}' for i in range(k + 1))}) % {buckets} AS bucket FROM grams WHERE w{k} IS NOT NULL" for k in range(longest))
    return f"""
        WITH found AS (SELECT n, regexp_extract_all(translate(body, '{_LETTERS}', '{_LETTERS.lower()}'), '{WORD}') AS words FROM texts),
        placed AS (SELECT n, unnest(words) AS w0, generate_subscripts(words, 1) AS place FROM found),
        grams AS (SELECT n{", w0" + (", " + steps if steps else "")} FROM placed),
        features AS ({grams}),
        counted AS (SELECT n, bucket, count(*) AS times FROM features GROUP BY n, bucket),
        per_text AS (SELECT n, list(bucket ORDER BY bucket) AS buckets, list(times ORDER BY bucket) AS times FROM counted GROUP BY n)
        SELECT n, len(words) AS n_words, buckets, times FROM found JOIN per_text USING (n) ORDER BY n
    """


def bucket_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """id, n_words, n_features, buckets (those it has, ascending) and times (each one's count) of each row's whole text.

    Features are all runs of 1 to longest consecutive words, joined by a space; a feature's bucket is its CRC-32 modulo buckets. Each task
    hands blocks of its texts to a DuckDB of its own, in memory and with one thread: SQL unnests the words, takes the next ones
    by a window over each text, and calls zlib's CRC-32, registered as a function of Arrow columns. Null texts count as empty; a text without a
    word has no feature and empty lists. Repeated rows and ids stay rows of their own, an empty table gives none, other columns are not read.
    """
    rows = df.select(df[f"`{id_col}`"].alias("id"), text_of(df[f"`{text_col}`"]).alias("body"))
    kind, query = rows.schema["id"].dataType.simpleString(), _features_sql(longest, buckets)

    def crc(column: pa.Array) -> pa.Array:
        """CRC-32 of each text's UTF-8 bytes, cut from the column's buffer: a Python string for each feature would cost more than all else."""
        found = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
        _, ends, body = found.buffers()
        at = np.frombuffer(ends, np.int64)[found.offset : found.offset + len(found) + 1].tolist()
        raw = body.to_pybytes() if body is not None else b""
        return pa.array(map(zlib.crc32, map(raw.__getitem__, map(slice, at, at[1:]))), pa.uint32(), size=len(found))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "temp_directory": ""})  # blocks are small: nothing of it goes to a local disk
        con.create_function("feature_crc", crc, ["VARCHAR"], "UINTEGER", type="arrow")
        empty = pa.scalar([], pa.list_(pa.int32()))
        for batch in batches:
            lengths, at = pa.compute.utf8_length(batch.column("body")).to_pylist(), 0
            while at < len(lengths):
                stop, size = at + 1, lengths[at]
                while stop < len(lengths) and size + lengths[stop] <= BLOCK_CHARS:
                    size, stop = size + lengths[stop], stop + 1
                texts = pa.table({"n": pa.array(range(stop - at), pa.int32()), "body": batch.column("body").slice(at, stop - at)})
                con.register("texts", texts)
                got = con.sql(query).to_arrow_table()
                con.unregister("texts")
                found = dict(zip(got["n"].to_pylist(), range(len(got)), strict=True))
                order = pa.array([found.get(k) for k in range(stop - at)], pa.int64())
                lists = [got[c].combine_chunks().cast(pa.list_(pa.int32())).take(order).fill_null(empty) for c in ("buckets", "times")]
                words = got["n_words"].combine_chunks().cast(pa.int64()).take(order).fill_null(0)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, stop - at), words, *lists], names=["id", "n_words", "buckets", "times"])
                at = stop
        con.close()

    out = rows.mapInArrow(counted, f"id {kind}, n_words long, buckets array<int>, times array<int>")
    features = F.aggregate("times", F.lit(0).cast("long"), lambda a, t: a + t)
    return out.select("id", "n_words", features.alias("n_features"), "buckets", "times")


def corpus_counts(counts: DataFrame) -> DataFrame:
    """bucket and n, over all rows of bucket_counts. A task sends each bucket once."""
    return counts.select(F.explode(F.arrays_zip("buckets", "times")).alias("f")).groupBy(F.col("f.buckets").alias("bucket")).agg(F.sum(F.col("f.times").cast("long")).alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 * ln(target's share of a bucket / source's)) for each bucket, counts smoothed by one: as many numbers as buckets, whatever the corpora."""
    all_ = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = all_.join(corpus_counts(source).withColumnRenamed("n", "s"), "bucket", "left").join(corpus_counts(target).withColumnRenamed("n", "t"), "bucket", "left")
    rows = {r["bucket"]: (float(r["s"] or 0), float(r["t"] or 0)) for r in both.collect()}
    size_s, size_t = (sum(r[k] for r in rows.values()) for k in (0, 1))
    ratio = lambda s, t: (t + 1) * (size_s + buckets) / ((s + 1) * (size_t + buckets))
    return [math.floor(1000 * math.log(ratio(*rows[b]))) for b in range(buckets)]


def weights(counts: DataFrame, gains: list[int]) -> DataFrame:
    """counts and weight: the floored mean of gains over a row's features, 0 if it has none."""
    gain = F.from_json(F.lit(json.dumps(gains)), "array<bigint>")
    per = F.zip_with("buckets", "times", lambda b, t: F.get(gain, b) * t)
    total = F.aggregate(per, F.lit(0).cast("long"), lambda a, x: a + x)
    n = F.col("n_features")
    return counts.withColumn("total", total).withColumn("weight", F.when(n > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(0).cast("long")).drop("total")


def _gumbel(id_: Column, seed: int) -> Column:
    """floor(1000 * a Gumbel number), drawn by a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(weighed: DataFrame, least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """weighed's id, n_features and weight, score and rank: of the N rows with least_words words, the floor(percent * N / 100) of greatest score have ranks 1, 2, 3...

    Adding a Gumbel number to a log weight and taking the greatest draws without replacement in proportion to the weights. Rows are put in order by a
    range partitioning on score and id and written; a row's rank is its place in its range and the sizes of the ranges before, one number for
    each. So no task holds more than a range, rows of one score included. Ties go to the smaller id, a null id last; rows equal in both are told apart by their place.
    """
    able = F.col("n_words") >= least_words
    rows = weighed.select("id", "n_features", "weight", (F.col("weight") + _gumbel(F.col("id"), seed)).alias("score"), able.alias("able"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("able").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row").asc()]
    ordered = rows.repartitionByRange(partitions(weighed.sparkSession), *order).sortWithinPartitions(*order).select("id", "n_features", "weight", "score", "able", F.monotonically_increasing_id().alias("place"))
    ordered = write_table(ordered, "scored")
    range_, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["range"], r["n"], r["able"]) for r in ordered.groupBy(range_.alias("range")).agg(F.count("*").alias("n"), F.count_if("able").alias("able")).collect())
    before, base = 0, []
    for r, n, _ in sizes:
        base.append((r, before))
        before += n
    drawn = percent * sum(n for *_, n in sizes) // 100
    bases = weighed.sparkSession.createDataFrame(base, "range long, base long")
    rank = F.col("base") + within + 1
    return ordered.withColumn("range", range_).join(F.broadcast(bases), "range").select("id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED,
) -> DataFrame:
    """id, n_features, weight, score and rank (null if not drawn) of each row of df, drawn so that its features come near those of target's texts.

    See bucket_counts, weights and draw for nulls, empty texts, ties and repeats. Bucket counts of texts are written once and read twice: for the
    corpus and for the weights. Empty tables count as corpora without features.
    """
    source = write_table(bucket_counts(df, id_col, text_col, longest, buckets), "bucket-counts", TEXT_ROWS)
    of_target = bucket_counts(target.select(F.lit(0).alias("id"), target[f"`{target_text_col}`"].alias("text")), "id", "text", longest, buckets)
    weighed = write_table(weights(source, bucket_gains(source, of_target, buckets)).drop("buckets", "times"), "weights")  # a range partitioning reads its input twice
    forget(source)
    out = draw(weighed, least_words, percent, seed)
    forget(weighed)
    return out.withColumnRenamed("id", id_col)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
