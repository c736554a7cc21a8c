"""Near-duplicate embeddings by a pivot-permutation index."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm.components import connected_components, forest
from frameloom.llm.util import forget, partitions, table, write_table

#: Reference points (a sample of the vectors, by hash): the square root of the vectors' number, so that lists keep their length, but as many at least and
#: at most (beyond about 64,000,000 vectors), and no more numbers in all than so many: the driver holds them, and each task gets them.
LEAST_PIVOTS, MOST_PIVOTS, MOST_NUMBERS = 256, 8192, 1 << 21
#: How many nearest pivots may describe a vector: the first of these by which pairs at the threshold, made from the sample, are found at least that
#: often, or the last; and how many of them a pair must share.
NEAREST, LEAST_RECALL, SHARED = (8, 10, 12, 16), 0.98, 3
#: Pairs that the recall is measured on.
MEASURED = 1024
_LOG = logging.getLogger(__name__)

#: Members of a list that are compared at a time; a longer list is compared block by block, in several tasks.
BLOCK = 512


def pivots_of(sample: list[list[float]], dims: int, count: int, seed: int = 3) -> np.ndarray:
    """count unit vectors: the sample's of that many dimensions, topped up by random directions."""
    own = [v for v in sample if len(v) == dims][:count]
    more = np.random.default_rng([seed, dims]).standard_normal((count - len(own), dims))
    points = np.vstack([np.asarray(own, float).reshape(-1, dims), more])
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by their largest component first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def measured_recall(sample: list[list[float]], dims: int, count: int, threshold: float, seed: int = 5) -> dict[int, float]:
    """For each number of NEAREST, the share of pairs at a cosine of the threshold that share SHARED of so many pivots.

    A pair is a vector of the sample (it is no pivot of its own) and one turned from it, towards a random direction or, every second, along the difference of two vectors of
    the sample, so that vectors with a common mean or in clusters are measured as they lie. A sample of fewer than three such vectors is measured on random ones.
    """
    draw = np.random.default_rng([seed, dims])
    points, own = pivots_of(sample, dims, count), [v for v in sample if len(v) == dims][:count]
    some = len(own) if len(own) > 2 else 0
    base = unit(np.array(own, float)) if some else unit(draw.standard_normal((MEASURED, dims)))
    at = draw.integers(0, len(base), MEASURED)
    v, turn = base[at], draw.standard_normal((MEASURED, dims))
    if some:
        turn[::2] = base[draw.integers(0, some, MEASURED)][::2] - base[draw.integers(0, some, MEASURED)][::2] + 1e-9 * turn[::2]
    turn -= (turn * v).sum(axis=1, keepdims=True) * v
    other = threshold * v + math.sqrt(max(0.0, 1 - threshold**2)) * turn / np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-300)
    orders = []
    for x in (v, other):
        likeness = x @ points.T
        if some:
            likeness[np.arange(MEASURED), at] = -np.inf
        orders.append(np.argsort(-likeness, axis=1, kind="stable")[:, : max(NEAREST)])
    return {k: float(((orders[0][:, :k, None] == orders[1][:, None, :k]).any(axis=2).sum(axis=1) >= SHARED).mean()) for k in NEAREST}


def nearest_for(sample: list[list[float]], count: int, threshold: float) -> tuple[int, float]:
    """(how many nearest pivots describe a vector, the least measured recall with them): enough for the vectors of each length in the sample."""
    told = [measured_recall(sample, dims, count, threshold) for dims in sorted({len(v) for v in sample})]
    need = [next((k for k in NEAREST if r[k] >= LEAST_RECALL), max(NEAREST)) for r in told]
    most = max(need, default=NEAREST[0])
    return most, min((r[most] for r in told), default=1.0)


def _described(sample: list[list[float]], count: int, near: int):
    """node, label, dims and the numbers of its nearest pivots, in order of nearness, of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = batch.column("embedding").to_pylist()
            nearest: list[list[int]] = [[] for _ in vectors]
            for dims in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == dims]
                if dims not in known:
                    known[dims] = pivots_of(sample, dims, count)
                likeness = unit(np.array([vectors[i] for i in at], float)) @ known[dims].T
                for i, order in zip(at, np.argsort(-likeness, axis=1, kind="stable")[:, :near].tolist(), strict=True):
                    nearest[i] = order
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("label"), pa.array(map(len, vectors), pa.int32()), pa.array(nearest, pa.list_(pa.int32()))], names=["node", "label", "dims", "pivots"])

    return run


_KEY = ["label", "dims", "a", "b", "i", "j"]


def shared_here(left: np.ndarray, right: np.ndarray, a: int, b: int) -> np.ndarray:
    """Of vectors by their pivots in order of number (rows of left and of right, all of which have a and b): whether they share SHARED, of which a and b are the first two."""
    both = np.zeros((len(left), len(right)), np.int16)
    first = np.zeros((len(left), len(right)), np.int16)
    for x in left.T:
        hit = (x[:, None, None] == right[None]).any(axis=2)
        both += hit
        first += hit & (x <= b)[:, None]
    return (both >= SHARED) & (first == 2)


def _by_block(settled: Callable[[pd.DataFrame], pd.DataFrame]):
    """Over partitions sorted by block (_KEY): settled, over whole blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            cut = len(rows) - int((rows[_KEY] == rows[_KEY].iloc[-1]).all(axis=1).sum())
            if cut:
                yield settled(rows.iloc[:cut])
            held = rows.iloc[cut:]
        if held is not None and len(held):
            yield settled(held)

    return run


def _sides(rows: pd.DataFrame) -> tuple[np.ndarray, Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]]:
    """(the first rows of blocks of two that meet; a, b, rows of the one side, of the other, whether they are the same, of each larger block)."""
    key, side = rows[_KEY], rows["side"].to_numpy()
    whole = key.to_numpy()
    start = np.flatnonzero(np.r_[True, (whole[1:] != whole[:-1]).any(axis=1)])
    size = np.diff(np.r_[start, len(rows)])
    a, b, own = key["a"].to_numpy(), key["b"].to_numpy(), key["i"].to_numpy() == key["j"].to_numpy()
    two = start[size == 2]
    two = two[own[two] | (side[two] != side[two + 1])]

    def larger() -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
        for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            if own[s]:
                yield int(a[s]), int(b[s]), np.arange(s, s + n), np.arange(s, s + n), True
            elif 0 < side[s : s + n].sum() < n:
                yield int(a[s]), int(b[s]), s + np.flatnonzero(side[s : s + n] == 0), s + np.flatnonzero(side[s : s + n] == 1), False

    return two, larger()


def _pairs_here(rows: pd.DataFrame, pivots: np.ndarray, two: np.ndarray) -> np.ndarray:
    """shared_here of the pairs of rows (two, two + 1)."""
    hit = (pivots[two][:, :, None] == pivots[two + 1][:, None, :]).any(axis=2)
    first = (hit & (pivots[two] <= rows["b"].to_numpy()[two][:, None])).sum(axis=1)
    return (hit.sum(axis=1) >= SHARED) & (first == 2)


def _met(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows that meet another in their block, by their pivots alone."""
    pivots, keep = np.sort(np.array(rows["pivots"].tolist()), axis=1), np.zeros(len(rows), bool)
    two, larger = _sides(rows)
    two = two[_pairs_here(rows, pivots, two)]
    keep[two] = keep[two + 1] = True
    for a, b, left, right, same in larger:
        here = shared_here(pivots[left], pivots[right], a, b)
        if same:
            np.fill_diagonal(here, False)
        keep[left] |= here.any(axis=1)
        keep[right] |= here.any(axis=0)
    return rows[keep]


def _verified(threshold: float):
    """Link counts (u = v) and edges (u, v) of the pairs that a block settles."""

    def settled(rows: pd.DataFrame) -> pd.DataFrame:
        pivots, node, copies = np.sort(np.array(rows["pivots"].tolist()), axis=1), rows["node"].to_numpy(), rows["copies"].to_numpy()
        vectors = lambda at: unit(np.array(rows["embedding"].iloc[at].tolist(), float))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        two, larger = _sides(rows)
        two = two[_pairs_here(rows, pivots, two)]
        for length in np.unique(rows["dims"].to_numpy()[two]):
            some = two[rows["dims"].to_numpy()[two] == length]
            some = some[np.einsum("ij,ij->i", vectors(some), vectors(some + 1)) >= threshold]
            found.append((some, some + 1))
        for a, b, left, right, same in larger:
            one = vectors(left)
            alike = (one @ (one if same else vectors(right)).T >= threshold) & shared_here(pivots[left], pivots[right], a, b)
            x, y = (np.triu(alike, 1) if same else alike).nonzero()
            found.append((left[x], right[y]))
        x, y = (np.concatenate([np.empty(0, np.int64), *z]) for z in (zip(*found, strict=True) if found else ((), ())))
        who, at = np.unique(np.append(node[x], node[y]), return_inverse=True)
        links = np.bincount(at, np.append(copies[y], copies[x]), len(who)).astype(np.int64)
        u, v = zip(*forest(zip(node[x].tolist(), node[y].tolist(), strict=True)), strict=True) if len(x) else ((), ())
        counts = pd.DataFrame({"u": who, "v": who, "links": links})
        return pd.concat([counts, pd.DataFrame({"u": u, "v": v, "links": 0})]).astype("int64")

    return settled


def embedding_links(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row, for links of cosine >= threshold between rows of one label.

    Equal vectors of a label (by 128 bits of hash) are one node with a count. A node is described by its nearest pivots in order of
    nearness, as many as the recall measured on the sample asks for, and stands in the inverted list of each pair of them. A list of more than BLOCK members is dealt into parts by hash and
    each pair of parts is a block of its own. Lists hold pivots only: of the members of a block, those that share SHARED pivots with
    another, of which the list's are the first two by number, so that a pair is settled once, get their vectors. Then a block
    verifies cosines in double precision and returns counts and a spanning forest, never its pairs.

    A vector that is null, empty or zero, or has a null or non-finite component, links with nothing, nor does
    one of a null label; its component is itself. Labels are compared as text. Vectors of different lengths are not compared. Repeated rows
    are links of each other. A null id is a component's only if it has no other. An empty table gives none.
    """
    n = partitions(df.sparkSession)
    vector = df[f"`{vector_col}`"].cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(vector, lambda x: x != 0)
    valid = df[f"`{label_col}`"].isNotNull() & ~F.coalesce(bad, F.lit(True))
    rows = df.select(df[f"`{id_col}`"].alias("vec_id"), df[f"`{label_col}`"].cast("string").alias("label"), vector.alias("embedding"), valid.alias("valid"))
    rows = rows.withColumns({"h1": F.when(F.col("valid"), F.xxhash64("label", "embedding")), "h2": F.when(F.col("valid"), F.xxhash64(F.lit(1), "label", "embedding"))})
    same = rows.where("valid").groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    nodes = write_table(same.withColumn("node", F.monotonically_increasing_id()), "vectors")
    size = nodes.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    count = min(MOST_PIVOTS, max(LEAST_PIVOTS, min(math.isqrt(size["n"]), MOST_NUMBERS // (size["dims"] or 1))))
    sample = [r["embedding"] for r in nodes.orderBy("h1", "h2").limit(count).select("embedding").collect()]
    near, recall = nearest_for(sample, count, threshold)
    _LOG.info("%d pivots, %d for each vector: recall %.3f on pairs made from the sample", count, near, recall)
    described = write_table(nodes.select("node", "label", "embedding").mapInArrow(_described(sample, count, near), "node long, label string, dims int, pivots array<int>"), "pivots")
    pair = F.array(*(F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")) for x, y in combinations([F.element_at("pivots", i + 1) for i in range(near)], 2)))
    lists = described.withColumn("e", F.explode(pair)).select("label", "dims", "e.a", "e.b", "node", "pivots")
    full = write_table(lists.groupBy("label", "dims", "a", "b").count().where("count > 1"), "lists")
    dealt = lists.join(full.hint("merge"), ["label", "dims", "a", "b"]).withColumn("parts", F.ceil(F.col("count") / BLOCK).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = dealt.select("label", "dims", "a", "b", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "pivots")
    sorted_by = lambda x: x.repartition(n, *_KEY).sortWithinPartitions(*_KEY)
    met = write_table(sorted_by(blocks).mapInPandas(_by_block(_met), blocks.schema), "members")
    whole = met.hint("merge").join(nodes.select("node", "copies", "embedding"), "node")
    found = write_table(sorted_by(whole).mapInPandas(_by_block(_verified(threshold)), "u long, v long, links long"), "links")
    stars = connected_components(found.where("u <> v").select("u", "v"))
    links = found.where("u = v").groupBy("u").agg(F.sum("links").alias("others")).withColumnRenamed("u", "node")
    known = nodes.select("h1", "h2", "node", "least", "copies").join(links, "node", "left").join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = known.join(known.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    known = write_table(known.select("h1", "h2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"), "known")
    forget(nodes, described, full, met, found)
    out = rows.select("vec_id", "valid", "h1", "h2").join(known, ["h1", "h2"], "left")
    component = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))
