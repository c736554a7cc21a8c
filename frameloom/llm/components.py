"""Connected components of a large edge table by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.llm.util import forget, tidy, write_table

#: Edges that one task contracts at a time; bounds its memory, changes no result.
EDGES_AT_ONCE = 500_000


def forest(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Star edges (node, smallest node of its component) that connect what the pairs connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, r) for x in list(parent) if (r := root(x)) != x]


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pairs: list[tuple[int, int]] = []
    for batch in batches:
        pairs += zip(batch["u"].tolist(), batch["v"].tolist(), strict=True)
        if len(pairs) > EDGES_AT_ONCE:
            yield pd.DataFrame(forest(pairs), columns=["u", "v"], dtype="int64")
            pairs = []
    yield pd.DataFrame(forest(pairs), columns=["u", "v"], dtype="int64")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (u long, v long); component is the smallest node that it reaches.

    Each round is two joins and two map-side-combined minima over a written edge table. A hub's rows may
    be split between tasks: minima combine before their shuffle and the joins are of the kind that AQE splits.
    Rounds follow the logarithm of the component's diameter. Tasks contract what they read before the first round, and once no more than
    EDGES_AT_ONCE edges are left one task contracts them to the end; either gives the same components.
    Self-loops and repeated edges change nothing; an empty table gives an empty one.
    """
    kept = write_table(edges.select("u", "v").mapInPandas(tidy(_contract), "u long, v long").distinct(), "edges")
    seen = None
    while True:
        state = kept.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == seen:
            break
        seen, last = (state["n"], state["h"]), kept
        if state["n"] <= EDGES_AT_ONCE:
            kept = write_table(kept.repartition(1).mapInPandas(tidy(_contract), "u long, v long"), "edges")
            forget(last)
            break
        both = kept.union(kept.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        kept = write_table(small.where("u <> v").distinct(), "edges")
        forget(last)
    stars = kept.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(kept.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
