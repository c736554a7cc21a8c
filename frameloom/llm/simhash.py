"""Near-duplicates by SimHash fingerprints: covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.components import connected_components
from frameloom.llm.util import partitions, table, text_of, tidy, write_table

#: Members of a bucket that are compared at a time; a larger bucket is compared block by block, in several tasks.
BLOCK = 512


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str, words: int = 3, seed: int = 42, count: int = 1) -> list[int]:
    """The SimHash of a text's word shingles as count signed 64-bit integers.

    A-Z count as a-z; words are what ASCII white space separates; a text of fewer words is one shingle, one
    of none has fingerprint zero. A bit is set if more than half of the shingles' hashes have it: XXH64 for the
    first integer, a mix of it for each further one.
    """
    return simhash(shingle_hashes(text, words, seed), count)


def shingle_hashes(text: str, words: int, seed: int) -> np.ndarray:
    """XXH64 of each of a text's word shingles."""
    from xxhash import xxh64_intdigest

    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False)) if len(found) >= words else [b" ".join(found)]
    return np.fromiter((xxh64_intdigest(s, seed) for s in shingles), np.uint64)


def simhash(hashes: np.ndarray, count: int) -> list[int]:
    total = np.zeros(64 * count, np.int64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096]
        wide = np.stack([part, *(_mixed(part + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))) for k in range(1, count))], axis=1)
        total += np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(total * 2 > len(hashes), bitorder="little").view(np.int64).tolist()


def _signed(m: int) -> int:
    return m - (1 << 64) if m >> 63 else m


def covering_masks(radius: int, bits: int = 64, seed: int = 7) -> list[int]:
    """2 ** (radius + 1) - 1 masks of so many of 64 bits of which, for any set of up to radius bits, one has none of these bits.

    Each bit position has a vector of radius + 1 binary coordinates. The mask of a nonzero vector v holds the
    positions whose inner product with v is odd. Up to radius vectors leave some v orthogonal to all.
    """
    vectors = np.random.default_rng(seed).permutation(np.arange(bits) % (1 << (radius + 1)))
    masks = [sum(1 << i for i, x in enumerate(vectors.tolist()) if (x & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))]
    return [_signed(m) for m in masks]


def _fingerprints(shingle_words: int, seed: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle_words, seed, count) for t in batch.column("content").to_pylist()]
            columns = [pa.array([p[k] for p in prints], pa.int64()) for k in range(count)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", *(f"p{k}" for k in range(count))])

    return run


def near(a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Whether fingerprints (integers along the last axis) differ in no more than limit bits."""
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)).sum(axis=-1, dtype=np.int64) <= limit


def stars(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect nodes a (rows) and b (columns) as all the pairs that are near would."""
    i, j = near.nonzero()
    if len(i) <= 2 * (len(a) + len(b)):
        keep = a[i] != b[j]
        return a[i][keep], b[j][keep]
    u, v = [], []
    fresh_a, fresh_b = near.any(axis=1), near.any(axis=0)
    for k in range(len(a)):  # breadth-first over rows and columns; each is reached once
        if not fresh_a[k]:
            continue
        front, fresh_a[k] = np.array([k]), False
        while len(front):
            columns = np.flatnonzero(near[front].any(axis=0) & fresh_b)
            fresh_b[columns] = False
            front = np.flatnonzero(near[:, columns].any(axis=1) & fresh_a)
            fresh_a[front] = False
            for found in (b[columns], a[front]):
                u.append(np.full(len(found), a[k])), v.append(found)
    u, v = np.concatenate(u), np.concatenate(v)
    return u[u != v], v[u != v]


BLOCK_KEY = ["key", "mask", "print", "i", "j"]


def links(columns: list[str], alike: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """Over partitions sorted by block (BLOCK_KEY): edges that connect the nodes of a block as all pairs whose columns are alike would."""

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        key, node, side = rows[BLOCK_KEY].to_numpy(), rows["node"].to_numpy(), rows["side"].to_numpy()
        x = np.ascontiguousarray(rows[columns].to_numpy(np.int64))
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        size = np.diff(np.r_[start, len(key)])
        pairs = start[size == 2]
        pairs = pairs[alike(x[pairs], x[pairs + 1])]
        out = [(node[pairs], node[pairs + 1])]
        for s, n in zip(start[size > 2], size[size > 2], strict=True):
            left = s + np.flatnonzero(side[s : s + n] == 0)
            right = s + np.flatnonzero(side[s : s + n] == 1) if side[s : s + n].any() else left
            out.append(stars(alike(x[left][:, None], x[right][None, :]), node[left], node[right]))
        return pd.DataFrame({"u": np.concatenate([o[0] for o in out]), "v": np.concatenate([o[1] for o in out])})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            cut = len(rows) - int((rows[BLOCK_KEY] == rows[BLOCK_KEY].iloc[-1]).all(axis=1).sum())
            if cut:
                yield compared(rows.iloc[:cut])
            held = rows.iloc[cut:]
        if held is not None and len(held):
            yield compared(held)

    return run


def sorted_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), *BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)


def linked_fingerprints(nodes: DataFrame, prints: list[str], radius: int, limit: int) -> DataFrame:
    """Edges (u, v) that connect nodes (node long, prints long) as all pairs within `limit` bits that the tables bring together would.

    Covering tables of each fingerprint of 64 bits: a pair within the radius in any of them agrees under one of its masks at
    least. Buckets of one are left out by a count that combines before its shuffle. A bucket of more than BLOCK members is dealt
    into parts by hash, and each pair of parts is a block that any task can compare. A bucket of more parts than there are masks
    is covered again instead, by masks of the bits that its own mask leaves out, which hold all the bits in which its near pairs differ: so
    a member is copied no more often than there are masks at any size. Each such level halves the bits that are left, and fingerprints are
    distinct, so the buckets end. A block returns no more than a few edges for each member, never its pairs.
    """
    at, found, masks, bucket = F.array(*prints), [], covering_masks(radius), ["key", "mask", "print"]
    every = F.array(*(F.struct(F.lit(m).alias("mask"), F.lit(k).alias("print")) for k in range(len(prints)) for m in masks))
    level = nodes.select("node", *prints, F.explode(every).alias("e")).select("node", *prints, "e.*")
    while True:
        level = level.withColumn("key", F.element_at(at, F.col("print") + 1).bitwiseAND(F.col("mask")))
        full = write_table(level.groupBy(*bucket).count().where("count > 1"), "buckets")
        parts = F.ceil(F.col("count") / BLOCK).cast("int")
        ends = (parts <= len(masks)) | (F.bit_count("mask") >= 56)
        shared = level.join(full, bucket)
        part = shared.where(ends).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        met = part.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            *bucket, F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") > F.col("other")).cast("int").alias("side"), "node", *prints
        )
        found.append(sorted_blocks(met).mapInPandas(tidy(links(prints, lambda a, b: near(a, b, limit))), "u long, v long"))
        large = [r["mask"] for r in full.where(~ends).select("mask").distinct().collect()]
        if not large:
            return reduce(DataFrame.union, found)
        wider = F.create_map(*(x for m in large for x in (F.lit(m), F.array(*map(F.lit, _wider(m, radius))))))
        level = shared.where(~ends).select("node", *prints, "print", F.explode(wider[F.col("mask")]).alias("mask"))


def _wider(mask: int, radius: int) -> list[int]:
    """Masks that hold `mask` and, of the bits outside it, covering ones."""
    left = [i for i in range(64) if not mask >> i & 1]
    more = covering_masks(radius, len(left))
    return sorted({mask | _signed(sum(1 << left[i] for i in range(len(left)) if m >> i & 1)) for m in more})


def least_ids(classes: DataFrame, stars: DataFrame) -> DataFrame:
    """node, component_id: the smallest id of the component of each node (node, least_id)."""
    star = classes.join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return star.join(star.groupBy("component").agg(F.min("least_id").alias("component_id")), "component").select("node", "component_id")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """A row of id_col, fingerprint (16 hex digits) and component_id for each row of df.

    Rows whose fingerprints differ in up to radius bits are linked; component_id is the smallest id that
    links reach. Rows of equal fingerprints are one node, so copies cost nothing beyond the first. A null
    text counts as empty, an empty one has fingerprint zero and is linked like any other. A null id is
    a component's only if it has no other. Repeated rows give repeated results; an empty table gives none.
    """
    rows = df.select(df[f"`{id_col}`"].alias("id"), text_of(df[f"`{text_col}`"]).alias("content"))
    kind = rows.schema["id"].dataType.simpleString()
    prints = write_table(rows.mapInArrow(_fingerprints(shingle_words, seed, 1), f"id {kind}, p0 long"), "fingerprints")
    classes = write_table(prints.groupBy("p0").agg(F.min("id").alias("least_id")).withColumn("node", F.col("p0")), "classes")
    stars = connected_components(linked_fingerprints(classes.select("node", "p0"), ["p0"], radius, radius))
    found = prints.join(least_ids(classes, stars).select(F.col("node").alias("p0"), "component_id"), "p0")
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("p0"), 16, "0")).alias("fingerprint"), "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
