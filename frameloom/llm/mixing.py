"""Mixing sources to target weights by fixed-length blocks that output shards draw by index."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frameloom.llm.util import carried, partitions, restored, table, text_of, write_table

#: Words in a block (of a small source: the BLOCKS-th part of its words, so that its blocks can come near its target too), slots in an output
#: shard, shards whose counts are drawn in one go.
BLOCKS = 256
BLOCK, SHARD_SLOTS, GROUP_SHARDS = 64, 1024, 64
#: Weights of the sources in order, again and again; how much the mix takes of all words; how often it may take a word.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Rows whose offsets are summed in one go.
BUCKET_ROWS = 20_000

WORD = r"[^\x20\x09-\x0D]+"


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 ... size - 1 at the given indexes: a Feistel network that walks cycles back into range."""
    half = max(1, ((max(2, size) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def round_of(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            mixed = (right + np.uint64((key * 4 + r) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(33)) & mask)
        return (left << np.uint64(half)) | right

    out = round_of(np.asarray(index, np.uint64))
    while (far := out >= size).any():
        out[far] = round_of(out[far])
    return out.astype(np.int64)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """s, source, source_size, target of each source in sizes (source, size): s numbers them by code point, null last.

    Sources share `share` of all words by weight; none gets more than `most` times its size, and what is
    over goes to the others by weight. In the order of size per weight the sources at their limit come
    first, so a running sum finds the level that the others share. One row for each source, in one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.withColumn("s", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("s") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * float(most))
    full = Window.orderBy(F.col("cap") / F.col("w"), "s")
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    levelled = ranked.withColumn("level", level).withColumn("over", F.col("cap") <= F.col("level") * F.col("w"))
    shared = levelled.withColumn("shared", F.max(F.when(~F.col("over"), F.col("level"))).over(everything))
    target = F.when(F.col("over") | F.col("shared").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("shared") * F.col("w")))
    return shared.select("s", "source", "source_size", target.alias("target"))


def _draw(seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """For a group of output shards: each shard's multinomial counts given the group's totals, and the blocks of its slots."""
        rows = rows.sort_values("s")
        group, left = int(rows["g"].iloc[0]), rows["quota"].to_numpy().copy()
        draw, next_slot, out = np.random.default_rng([seed, group]), rows["first"].to_numpy().copy(), []
        for shard in range(int(-(-left.sum() // SHARD_SLOTS))):
            n = min(SHARD_SLOTS, int(left.sum()))
            counts = draw.multivariate_hypergeometric(left, n, method="marginals") if len(left) > 1 else np.array([n])
            for k in np.flatnonzero(counts):
                slot, blocks = next_slot[k] + np.arange(counts[k]), int(rows["blocks"].iloc[k])
                epoch, s = slot // blocks, int(rows["s"].iloc[k])
                out.append(pd.DataFrame({"shard": group * GROUP_SHARDS * 2 + shard, "s": s, "pass": epoch, "block": permuted(slot % blocks, blocks, seed * 1_000_003 + s)}))
            left, next_slot = left - counts, next_slot + counts
        return pd.concat(out) if out else pd.DataFrame({"shard": [], "s": [], "pass": [], "block": []}, dtype="int64")

    return run


def block_length(source_size: Column, block: int = BLOCK) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(block), F.floor(source_size / BLOCKS))).cast("long")


def mix_plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, seed: int = 11) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(targets, documents, slots): the sources' targets; each row's place in its source's stream of words; the
    blocks that the output shards draw.

    A source's words stand in the order of a hash of the rows' ids and are cut into blocks; a block may hold the
    end of one document and the start of the next. Offsets are summed in buckets of BUCKET_ROWS or so, first
    over buckets, then inside each, so that no task holds a source. Each output shard draws multinomial
    counts given what is left of its group's share of every source, so that the mix takes target / block
    blocks of it, to within one. Slot k of a source maps to block permutation(k mod blocks): a block is
    repeated only when all have been taken.
    """
    rows = df.select(
        df[f"`{id_col}`"].alias("id"), df[f"`{source_col}`"].cast("string").alias("source"), F.regexp_count(text_of(df[f"`{text_col}`"]), F.lit(WORD)).cast("long").alias("size"),
        row_key(df, id_col, text_col, source_col).alias("key"),
    )
    sized = write_table(rows, "sizes")
    buckets = max(16, -(-sized.count() // BUCKET_ROWS))
    targets = write_table(source_targets(sized).withColumn("length", block_length(F.col("source_size"), block)), "targets")
    numbered = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop("source").withColumn("h", F.xxhash64("key", F.lit(seed))).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    starts = numbered.groupBy("s", "bucket").agg(F.sum("size").alias("n"))
    starts = starts.select("s", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("s", "bucket").orderBy("h", "key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = numbered.withColumn("inside", inside).join(starts, ["s", "bucket"]).withColumn("offset", F.col("start") + F.col("inside")).drop("inside", "start", "bucket", "h")
    size = F.ceil(F.col("source_size") / F.col("length"))
    blocks = targets.where("target > 0").select("s", size.cast("long").alias("blocks"), F.least(size * MOST, F.round(F.col("target") / F.col("length"))).cast("long").alias("all")).where("all > 0")
    total = blocks.agg(F.sum("all")).first()[0] or 0
    groups = max(1, -(-total // (SHARD_SLOTS * GROUP_SHARDS)))
    upto = lambda g: F.floor(F.col("all").cast("decimal(38,0)") * g / groups).cast("long")
    every = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))
    some = F.transform(F.sequence(F.lit(1).cast("long"), F.col("all")), lambda k: F.ceil(k.cast("decimal(38,0)") * groups / F.col("all")).cast("long") - 1)  # groups that get a block
    parts = blocks.withColumn("g", F.explode(F.when(F.col("all") >= groups, every).otherwise(some))).select("g", "s", "blocks", upto(F.col("g")).alias("first"), (upto(F.col("g") + 1) - upto(F.col("g"))).alias("quota"))
    slots = parts.where("quota > 0").repartition(partitions(df.sparkSession), "g").groupBy("g").applyInPandas(_draw(seed), "shard long, s int, pass long, block long")
    return targets, placed, slots


def row_key(df: DataFrame, id_col: str, text_col: str, source_col: str):
    """What tells rows apart; rows of one key are alike and may stand for each other. Each field goes with its length, a null one as a sign, so no two differ in kind only."""
    texts = [df[f"`{c}`"].cast("string") for c in (id_col, source_col, text_col)]
    return F.sha2(F.concat(*(F.when(t.isNull(), "-").otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def _pieces(placed: DataFrame) -> DataFrame:
    """A row for each document and block that share words: from, words (in the document), with the document's columns."""
    length = F.col("length")
    last = F.floor((F.col("offset") + F.col("size") - 1) / length)
    split = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("offset") / length), last)))
    begin, end = F.greatest("offset", F.col("block") * length), F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * length)
    return split.withColumn("from", begin - F.col("offset")).withColumn("words", end - begin)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, seed: int = 11) -> DataFrame:
    """A row of id_col, size, source_size, target and taken (words that the mix takes, repeats counted) for each row.

    A null or empty text has size 0 and is never taken. A null source is one of its own, after all others.
    Repeated rows each have their own place. Ties in the order of places are of equal rows. An empty table gives none. Runs agree: places and draws depend on
    the rows and the seed alone. Other columns are not read.
    """
    _, placed, slots = mix_plan(df, id_col, text_col, source_col, block, seed)
    times = slots.groupBy("s", "block").agg(F.count("*").alias("times")).hint("merge")  # it grows with the words
    taken = _pieces(placed).join(times, ["s", "block"], "left").groupBy("s", "offset", "id", "size", "source_size", "target").agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    names = [F.col("id").alias(id_col), "size", "source_size", "target", "taken"]
    return taken.select(*names).union(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*names))


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, seed: int = 11) -> DataFrame:
    """The mix as documents, with df's columns: a row for each document and pass in which it has taken blocks.

    A pass that takes all of a document returns its text unchanged; else its taken words, in order and
    separated by spaces. n_chars, if df has it, follows the text. A null or empty text is never taken. A null source is one of its own, after
    all others. Repeated rows are taken each for itself, so alike rows may come out as often as all of them are taken. Columns may have any names. An empty table gives none.
    """
    _, placed, slots = mix_plan(df, id_col, text_col, source_col, block, seed)
    got = _pieces(placed).join(slots.select("s", "block", "pass").hint("merge"), ["s", "block"])
    part = got.groupBy("key", "s", "offset", "size", "pass").agg(F.sum("words").alias("n"), F.array_sort(F.collect_list(F.struct("from", "words"))).alias("parts"))
    chosen = part.select("key", (F.col("n") == F.col("size")).alias("whole"), "parts")
    rows = carried(df, key=row_key(df, id_col, text_col, source_col), content=df[f"`{text_col}`"]).dropDuplicates(["key"]).join(chosen, "key")
    words = F.regexp_extract_all("content", F.lit(f"({WORD})"), F.lit(1))
    taken = lambda all_: F.array_join(F.transform("parts", lambda p: F.array_join(F.slice(all_, (p["from"] + 1).cast("int"), p["words"].cast("int")), " ")), " ")
    cut = F.element_at(F.transform(F.array(words), taken), 1)  # binds the words, so that a text is split once, not for each part
    at = {c: f"__c{i}" for i, c in enumerate(df.columns)}
    out = rows.withColumn(at[text_col], F.when(F.col("whole"), F.col("content")).otherwise(cut))
    if "n_chars" in at:
        out = out.withColumn(at["n_chars"], F.length(at[text_col]).cast(df.schema["n_chars"].dataType))
    return restored(out, df.columns)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
