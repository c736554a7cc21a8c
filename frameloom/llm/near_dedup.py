"""Near-duplicates by word shingles: covering SimHash tables first, then exactly the pairs that these can't guarantee."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameloom.llm import simhash
from frameloom.llm.components import connected_components
from frameloom.llm.util import TEXT_ROWS, forget, partitions, text_of, tidy, write_table

#: Shingles that a part of a block holds, or so, and leading shingles that a task keeps before it lets them go; neither changes a result.
PART_SHINGLES, HELD = 500_000, 500_000
#: How much further than needed a set's leading shingles go, as a share of it, so that sets that share less with all others can leave.
EXTRA = 0.1


def shingle_set(text: str, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of a text's shingles, those in order and once each). A text without words has the empty shingle."""
    from xxhash import xxh64_intdigest

    hashes = simhash.shingle_hashes(text, words, seed)
    if not len(hashes):
        hashes = np.array([xxh64_intdigest(b"", seed)], np.uint64)
    return hashes, np.unique(hashes.view(np.int64))


def leading(size: int, similarity: float) -> int:
    """How many elements lead a set: in any order, such leads of two sets of the similarity share max(1, EXTRA * the smaller size) elements."""
    return min(size, size - math.ceil(similarity * size - 1e-9) + max(1, math.ceil(EXTRA * size - 1e-9)))


def _leads(words: int, seed: int, similarity: float):
    """Of each text (node, content) the leading hashes of its set. Of equal hashes that a task holds together, one goes on.

    kind 0: a hash of node; 1: a hash that several nodes have; 2: key is how many such hashes node has, or less what it needs to have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[int] = []
        needs: list[int] = []
        sets: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            key, node = np.concatenate([*sets, np.empty(0, np.int64)]), np.repeat(np.array(nodes, np.int64), [len(s) for s in sets])
            all_, at = np.unique(np.array(nodes, np.int64), return_index=True)
            less = -np.array(needs, np.int64)[at]
            nodes.clear(), sets.clear(), needs.clear()
            order = np.lexsort((node, key))
            key, node = key[order], node[order]
            fresh = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[: len(key)]
            key, node = key[fresh], node[fresh]
            head = np.append(True, key[1:] != key[:-1])[: len(key)]
            many = np.diff(np.append(np.flatnonzero(head), len(key)))
            own, count = np.unique(node[np.repeat(many > 1, many)], return_counts=True)
            kind = np.append((many > 1).astype(np.int32), np.full(len(own) + len(all_), 2, np.int32))
            return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([key[head], count, less])), pa.array(np.concatenate([node[head], own, all_]))], names=["kind", "key", "node"])

        held = 0
        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("content").to_pylist(), strict=True):
                own = shingle_set(text, words, seed)[1]
                sets.append(own[: leading(len(own), similarity)].copy())
                nodes.append(node), needs.append(max(1, math.ceil(EXTRA * math.ceil(similarity * len(own) - 1e-9) - 1e-9)))
                held += len(sets[-1])
                if held > HELD:
                    yield flush()
                    held = 0
        yield flush()

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over partitions sorted by key and kind, larger first: (node, n), n of whose keys are another node's too. Only the last row is kept between batches."""
    last = None  # the last row: key, node, kind of its key's first row, whether it has been counted
    for batch in batches:
        kind, key, node = (batch.column(c).to_numpy() for c in ("kind", "key", "node"))
        told = kind == 2
        found = [(node[told], key[told])]
        kind, key, node = kind[~told], key[~told], node[~told]
        if len(key):
            if last is not None:
                key, node, kind = np.append(last[0], key), np.append(last[1], node), np.append(last[2], kind)
            head = np.append(True, key[1:] != key[:-1])
            first = kind[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
            several = (first == 1) | ~head | np.append(~head[1:], False)
            counts = several & (kind == 0)
            counts[0] &= last is None or not last[3]
            found.append((node[counts], np.ones(counts.sum(), np.int64)))
            last = key[-1], node[-1], first[-1], several[-1]
        who, at = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
        n = np.bincount(at, np.concatenate([x[1] for x in found]), len(who)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(n)], names=["node", "n"])


def _sets(words: int, seed: int, count: int):
    """Of each text its fingerprints, and the hashes of its shingles as a sorted set with a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sets = [], []
            for text in batch.column("content").to_pylist():
                hashes, own = shingle_set(text, words, seed)
                prints.append(simhash.simhash(hashes, count)), sets.append(own)
            digests = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
            offsets = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))
            columns = [pa.array([p[k] for p in prints], pa.int64()) for k in range(count)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), digests, *columns, pa.array([len(s) for s in sets], pa.int64()), lists], names=["id", "digest", *(f"p{k}" for k in range(count)), "size", "shingles"])

    return run


def _alike(similarity: float):
    """The pairs (u, v) whose sets a and b have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, at_a), (b, at_b) = ((batch.column(c).values.to_numpy(), batch.column(c).offsets.to_numpy()) for c in ("a", "b"))
            good = []
            for k in range(batch.num_rows):
                x, y = a[at_a[k] : at_a[k + 1]], b[at_b[k] : at_b[k + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    return run


def _similar(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """Whether each of the sorted sets in left has the similarity, or more, with each in right."""
    if len(left) > len(right):
        return _similar(right, left, similarity).T
    sizes = np.array([len(x) for x in right])
    flat, owner = np.concatenate(right), np.repeat(np.arange(len(right)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    near = np.zeros((len(left), len(right)), bool)
    for k, own in enumerate(left):
        first = np.searchsorted(flat, own)
        many = np.searchsorted(flat, own, side="right") - first
        at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        both = np.bincount(owner[at], minlength=len(right))
        near[k] = both >= similarity * (len(own) + sizes - both)
    return near


def _verified(similarity: float):
    """Over partitions sorted by block: edges that connect the nodes of a block as all similar pairs of different classes would."""

    def compared(rows: list[tuple[int, int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        left, right = ([r for r in rows if r[0] == s] for s in (0, 1))
        right = right or left
        if left and len(rows) > 1:
            class_l, class_r = (np.array([r[2] for r in x], np.int64) for x in (left, right))
            near = _similar([r[3] for r in left], [r[3] for r in right], similarity) & (class_l[:, None] != class_r)
            u, v = simhash.stars(near, *(np.array([r[1] for r in x], np.int64) for x in (left, right)))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in simhash.BLOCK_KEY), strict=True)
            flat, ends = batch.column("shingles").values.to_numpy(), batch.column("shingles").offsets.to_numpy()
            for k, (key, *row) in enumerate(zip(keys, *(batch.column(c).to_pylist() for c in ("side", "node", "class")), strict=True)):
                if key != at:
                    yield from compared(held)
                    at, held = key, []
                held.append((*row, flat[ends[k] : ends[k + 1]].copy()))
        yield from compared(held)

    return run


def _dealt(rows: DataFrame, weight: Column | None = None) -> DataFrame:
    """Blocks of the rows (key, node, class and others) of each key in which all pairs of different classes meet.

    The class of most rows of a key is dealt into parts, the others into parts of their own. Each part of the others meets each part of the large class
    and of the others; rows of the large class don't meet each other, so that a large group that is linked already is copied only as often
    as the rest has parts. Keys of one class are left out, by counts that combine before their shuffle.
    """
    per = rows.groupBy("key", "class").agg(F.count("*").alias("n"), F.sum(F.lit(0) if weight is None else weight).alias("w"))
    most = per.groupBy("key").agg(F.max(F.struct("n", "w", "class")).alias("own"), F.sum("n").alias("n"), F.sum("w").alias("w")).where("n > own.n")
    parts = lambda n, w: F.greatest(F.ceil(n / simhash.BLOCK), F.ceil(w / PART_SHINGLES)).cast("int")
    rest = F.col("n") - F.col("own.n")
    told = most.select("key", F.col("own.class").alias("own"), parts(F.col("own.n"), F.col("own.w")).alias("p"), parts(rest, F.col("w") - F.col("own.w")).alias("q"), (rest > 1).alias("several"))
    met = rows.join(told, "key").withColumn("mine", F.col("class") == F.col("own"))
    met = met.withColumn("part", F.pmod(F.xxhash64("node"), F.when(F.col("mine"), F.col("p")).otherwise(F.col("q"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    block = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).cast("int").alias("side") if isinstance(side, int) else side.cast("int").alias("side"))
    part = F.col("part")
    own = F.transform(upto("q"), lambda j: block(part, j, 0))
    other = F.transform(upto("p"), lambda i: block(i, part, 1))
    among = F.when(F.col("several"), F.transform(upto("q"), lambda x: block(F.col("p") + F.least(x, part), F.greatest(x, part), part > x))).otherwise(F.array().cast("array<struct<i:int,j:int,side:int>>"))
    blocks = met.withColumn("e", F.explode(F.when(F.col("mine"), own).otherwise(F.concat(other, among))))
    kept = [c for c in rows.columns if c != "key"]
    return blocks.select("key", F.lit(0).alias("mask"), F.lit(0).alias("print"), "e.*", *kept)


def _near_copies(df: DataFrame, id_col: str, text_col: str, shingle_words: int, similarity: float, count: int, seed: int, radius: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(found, rows, known): id and component_id of the rows that may have near copies, a written table; id and node of all rows; the nodes of found."""
    # Joins are by merge where both sides grow with the rows.
    n, names = partitions(df.sparkSession), [f"p{k}" for k in range(count)]
    content = text_of(df[f"`{text_col}`"])
    rows = df.select(df[f"`{id_col}`"].alias("id"), content.alias("content"), F.xxhash64(content).alias("node"))
    kind = rows.schema["id"].dataType.simpleString()

    leads = rows.select("node", "content").mapInArrow(tidy(_leads(shingle_words, seed, similarity)), "kind int, key long, node long")
    met = leads.repartition(n, "key").sortWithinPartitions("key", F.desc("kind")).mapInArrow(tidy(_repeated), "node long, n long")
    known = write_table(met.groupBy("node").agg(F.sum("n").alias("n")).where("n >= 0").select("node"), "shared-leads", TEXT_ROWS)

    columns = f"id {kind}, digest binary, {', '.join(f'{p} long' for p in names)}, size long, shingles array<long>"
    made = rows.join(known.hint("merge"), "node", "left_semi").select("id", "content").mapInArrow(tidy(_sets(shingle_words, seed, count)), columns)
    sets = write_table(made.withColumn("row", F.monotonically_increasing_id()), "shingle-sets", TEXT_ROWS)
    firsts = write_table(sets.groupBy("digest").agg(F.min("row").alias("node"), F.min("id").alias("least_id")), "distinct-sets")
    nodes = write_table(firsts.hint("merge").join(sets.select(F.col("row").alias("node"), *names, "size", "shingles"), "node").drop("digest", "least_id"), "nodes")

    share = math.acos(2 * similarity / (1 + similarity)) / math.pi  # of bits that differ, on average, at the similarity
    slack = lambda k: int(64 * count * share + k * math.sqrt(64 * count * share * (1 - share)))
    edges = simhash.linked_fingerprints(nodes.select("node", *names), names, radius, slack(3))
    pairs = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    sides = [nodes.select(F.col("node").alias(x), F.col("shingles").alias(y)) for x, y in ("ua", "vb")]
    covered = write_table(pairs.hint("merge").join(sides[0], "u").hint("merge").join(sides[1], "v").mapInArrow(tidy(_alike(similarity)), "u long, v long"), "covered-links", TEXT_ROWS)
    classes = write_table(nodes.select("node").join(connected_components(covered), "node", "left").select("node", F.coalesce("component", "node").alias("class")), "classes")

    shingles = nodes.select("node", F.explode("shingles").alias("key"))
    often = shingles.groupBy("key").count().where("count > 1").hint("merge")
    shared = shingles.join(often, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "key"))).alias("shared")).join(nodes.select("node", "size"), "node")
    first = F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1 - (F.col("size") - F.size("shared"))  # sets of its own lead
    rarest = shared.select("node", F.explode(F.slice("shared", F.lit(1), F.greatest(first, F.lit(0)).cast("int"))).alias("e")).select("node", "e.key")
    rarest = write_table(rarest.join(classes, "node").join(nodes.select("node", "size", *names), "node"), "rarest-shingles")

    def may_be(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        sizes = np.minimum(a[..., -2], b[..., -2]) >= similarity * np.maximum(a[..., -2], b[..., -2])
        return sizes & (a[..., -1] != b[..., -1]) & simhash.near(a[..., :count], b[..., :count], slack(8))

    columns = [*names, "size", "class"]
    # Written before they are contracted: else a task has a Python worker for either, and both stay.
    candidates = write_table(simhash.sorted_blocks(_dealt(rarest)).mapInPandas(tidy(simhash.links(columns, may_be)), "u long, v long"), "candidate-links")
    linked = classes.where("node <> class").select(F.col("node").alias("u"), F.col("class").alias("v"))
    groups = connected_components(candidates.union(linked)).select("node", F.col("component").alias("key"))
    forget(candidates)
    placed = write_table(groups.join(classes, "node").join(nodes.select("node", "size"), "node"), "candidates")
    blocks = simhash.sorted_blocks(_dealt(placed, F.col("size")).drop("size").hint("merge").join(nodes.select("node", "shingles"), "node"))
    verified = write_table(blocks.mapInArrow(tidy(_verified(similarity)), "u long, v long"), "verified-links", TEXT_ROWS)
    stars = connected_components(linked.union(verified))
    told = sets.select("id", "digest").join(firsts.select("digest", "node"), "digest").join(simhash.least_ids(firsts.select("node", "least_id"), stars), "node")
    found = write_table(told.select("id", "component_id"), "near-copies")
    forget(sets, firsts, nodes, covered, classes, rarest, placed, verified)
    return found, rows.select("id", "node"), known


def similar_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8, count: int = 4, seed: int = 42, radius: int = 3) -> DataFrame:
    """id, component_id of each row: the smallest id that links of texts whose sets of shingles have that Jaccard similarity, or more, reach.

    A text of fewer words is one shingle; null, empty and white texts have the empty shingle, and so link with each other. Shingles are compared by hashes of 64 bits,
    sets that are equal by a digest of 128. A null id is a component's only if it has no other. Repeated rows give repeated results, ties
    in similarity (exactly 0.8) are links, an empty table gives none; other columns are not read.

    1. A text shares its leading shingles (by hash) with others as far as the similarity asks for, or leaves: it has no near copy.
    2. Of the rest, covering tables bring together all pairs within the radius in any of count fingerprints of 64 bits. Those that are near by
       all bits are verified by their shingles; their components are classes, which hold most links and all dense groups.
    3. Similar pairs may differ in more bits than tables can cover. They share one of their leading shingles, the rarest first, so those of
       different classes that do, and whose sizes and fingerprints (eight standard deviations of slack) allow it, are candidates.
       Each component of candidates is compared exactly, block by block, but for pairs of its largest class.
    """
    found, rows, known = _near_copies(df, id_col, text_col, shingle_words, similarity, count, seed, radius)
    alone = rows.join(known, "node", "left_anti").select("id", F.col("id").alias("component_id"))
    return found.union(alone)


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8, count: int = 4, seed: int = 42, radius: int = 3) -> DataFrame:
    """The rows of df, one document of each component of similar_components: that of the smallest id.

    Rows that share an id are one document and go together; rows of a null id stay. Texts, ties and repeated rows as in similar_components.
    """
    found, _, known = _near_copies(df, id_col, text_col, shingle_words, similarity, count, seed, radius)
    forget(known)
    dropped = found.where(F.col("id") != F.col("component_id")).select(F.col("id").alias("__dropped")).distinct()
    return df.join(dropped, df[f"`{id_col}`"] == dropped["__dropped"], "left_anti")
