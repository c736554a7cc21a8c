"""k-means of many groups at once: all groups and restarts move on together, in one plan for each step.

Rows are put into blocks of bounded size, so that no group is one task's. A step joins blocks with their group's centres, takes the nearest centres in numpy,
and sums what blocks found by group, restart and centre, combined before the shuffle. A group that is one block has all its rows in that block: it
goes through all its steps there, by the same functions, and doesn't wait for others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameloom.sources.scratch import written

CLUSTERS, RESTARTS, SEED, MOST_STEPS = 5, 10, 42, 300
#: A fit ends when its centres move by less than this share of the rows' mean squared distance to them.
TOLERANCE = 1e-4
#: Rows of a block.
BLOCK_ROWS = 1 << 14


def uniform(hashes: np.ndarray, seed: int, restart: int, step: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on a row's hash, the seed, the restart and the step alone."""
    with np.errstate(over="ignore"):
        x = hashes.view(np.uint64) + np.uint64(seed * 1_000_003 + restart * 1009 + step + 1) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x[:, None] - centres) ** 2).sum(axis=2)


def candidate(x: np.ndarray, hashes: np.ndarray, centres: np.ndarray, seed: int, restart: int) -> tuple[float, int]:
    """(key, row) of the row with the smallest key. Over all rows of a group that row is drawn in proportion to its squared distance to the centres so far, the
    first uniformly: exponential numbers of these rates race. A row on a centre has no finite key."""
    u = uniform(hashes, seed, restart, len(centres))
    if not len(centres):
        keys = u
    else:
        far = squared(x, centres).min(axis=1)
        keys = np.where(far > 0, -np.log(u) / np.where(far > 0, far, 1.0), np.inf)
    k = int(np.lexsort((hashes, keys))[0])
    return float(keys[k]), k


def gathered(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(rows, sum of rows) of each centre, and the squared distances' sum."""
    far = squared(x, centres)
    label = far.argmin(axis=1)
    sums = np.zeros_like(centres)
    np.add.at(sums, label, x)
    return np.bincount(label, minlength=len(centres)), sums, float(far[np.arange(len(x)), label].sum())


def moved(centres: np.ndarray, counts: np.ndarray, sums: np.ndarray, cost: float) -> tuple[np.ndarray, bool]:
    """The centres' next places (a centre without rows stays), and whether the fit goes on."""
    new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return new, bool(((new - centres) ** 2).sum() > TOLERANCE * cost / max(1, counts.sum()))


def numbered(fits: list[np.ndarray], costs: list[float]) -> np.ndarray:
    """The centres of the fit of least cost, the first of equals, in order of their coordinates."""
    least = min(costs)
    best = fits[next(r for r, c in enumerate(costs) if c <= least + 1e-9 * (1 + least))]
    return best[np.lexsort(best.T[::-1])]


def solved(x: np.ndarray, hashes: np.ndarray, clusters: int, restarts: int, seed: int) -> np.ndarray:
    """The centres of a group whose rows are all here."""
    fits, costs = [], []
    for r in range(restarts):
        centres = np.empty((0, x.shape[1]))
        while len(centres) < clusters:
            key, k = candidate(x, hashes, centres, seed, r)
            if not np.isfinite(key):
                break
            centres = np.vstack([centres, x[k]])
        for _ in range(MOST_STEPS):
            counts, sums, cost = gathered(x, centres)
            centres, on = moved(centres, counts, sums, cost)
            if not on:
                break
        fits.append(centres)
        costs.append(gathered(x, centres)[2])
    return numbered(fits, costs)


def _matrix(column: pa.ListArray, k: int) -> np.ndarray:
    rows = column[k].values
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1)


def _fits(state) -> list[np.ndarray]:
    return [np.array(c, float).reshape(len(c), -1) for c in state]


def _batch(rows: list[tuple], types: list[tuple[str, pa.DataType]], keys: pa.Array, at: list[int]) -> pa.RecordBatch:
    """The key of each row (the one at those places), then its values."""
    columns = list(zip(*rows, strict=True)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True))], names=["key", *(n for n, _ in types)])


_CENTRES = "array<array<array<double>>>"


def grouped_kmeans(
    df: DataFrame, keys: list[str], row: str, array_col: str, clusters: int = CLUSTERS, restarts: int = RESTARTS, seed: int = SEED, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """keys, row, cluster_id (from 0): each group's rows in min(clusters, different rows) clusters of their own, those of the best of several fits.

    Seeds are drawn by hashes of row, so a run repeats whatever the partitioning; clusters are numbered by their centres' coordinates, so that labels don't
    depend on the draw. Rows without a vector, or whose vector holds null or NaN, are left out; vectors of a group are of one length. Rows of one number are rows of
    their own. An empty table gives none.
    """
    group = F.struct(*(F.col(k) for k in keys)) if keys else F.struct(F.lit(0).alias("all"))
    sound = F.col(array_col).isNotNull() & (F.size(array_col) > 0) & ~F.exists(array_col, lambda v: v.isNull() | F.isnan(v.cast("double")))
    rows = df.where(sound).select(group.alias("key"), F.col(row).alias("row"), F.xxhash64(F.col(row)).alias("h"), F.col(array_col).cast("array<double>").alias("x"))
    parts = rows.groupBy("key").agg(F.ceil(F.count("*") / block_rows).alias("parts")).withColumnRenamed("key", "of")
    placed = rows.join(parts, F.col("key").eqNullSafe(F.col("of"))).withColumn("part", F.pmod(F.xxhash64("h", "x"), F.col("parts")))
    inside = F.array_sort(F.collect_list(F.struct("h", "row", "x")))
    blocks = placed.groupBy("key", "part").agg(F.first("parts").alias("parts"), inside.alias("r"))
    blocks = written(blocks.select("key", "parts", F.col("r.row").alias("rows"), F.col("r.h").alias("h"), F.col("r.x").alias("x")), "blocks")
    key_type = blocks.schema["key"].dataType.simpleString()

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(solved(_matrix(b.column("x"), k), np.array(b.column("h")[k].as_py(), np.int64), clusters, restarts, seed).tolist(),) for k in range(len(b))]
            yield _batch(found, [("centres", pa.list_(pa.list_(pa.float64())))], b.column("key"), list(range(len(b))))

    settled = [blocks.where("parts = 1").select("key", "h", "x").mapInArrow(alone, f"key {key_type}, centres array<array<double>>")]
    many = blocks.where("parts > 1").select("key", "h", "x")
    if not many.isEmpty():
        settled.append(_steps(many, key_type, clusters, restarts, seed))
    centres = settled[0] if len(settled) == 1 else settled[0].unionByName(settled[1])
    centres = written(centres, "centres").withColumnRenamed("key", "of")

    @F.pandas_udf("array<int>")
    def labels(x, c):
        import pandas as pd

        return pd.Series([squared(np.stack(a), np.stack(b)).argmin(axis=1).astype(np.int32) for a, b in zip(x, c, strict=True)])

    told = blocks.join(centres, F.col("key").eqNullSafe(F.col("of"))).select("key", F.explode(F.arrays_zip("rows", labels("x", "centres").alias("c"))).alias("z"))
    return told.select(*(F.col(f"key.{k}").alias(k) for k in keys), F.col("z.rows").alias(row), F.col("z.c").alias("cluster_id"))


def _steps(blocks: DataFrame, key_type: str, clusters: int, restarts: int, seed: int) -> DataFrame:
    """key, centres of groups of several blocks: a job for each seed and each step, over the groups and restarts that go on."""
    same = lambda state: F.col("key").eqNullSafe(F.col("of"))

    def with_state(state: DataFrame) -> DataFrame:
        return blocks.join(state.withColumnRenamed("key", "of"), same(state)).drop("of")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, at = [], []
            for k in range(len(b)):
                x, h = _matrix(b.column("x"), k), np.array(b.column("h")[k].as_py(), np.int64)
                for r, c in enumerate(b.column("centres")[k].as_py()):
                    key, i = candidate(x, h, np.array(c, float).reshape(-1, x.shape[1]), seed, r)
                    if np.isfinite(key):
                        found.append((r, key, int(h[i]), x[i].tolist()))
                        at.append(k)
            yield _batch(found, [("r", pa.int32()), ("race", pa.float64()), ("h", pa.int64()), ("x", pa.list_(pa.float64()))], b.column("key"), at)

    state = blocks.select("key").distinct().select("key", F.array(*[F.array().cast("array<array<double>>")] * restarts).alias("centres"))
    for step in range(clusters):
        state = written(state, f"seeds-{step}")
        race = with_state(state).mapInArrow(candidates, f"key {key_type}, r int, race double, h long, x array<double>").groupBy("key", "r").agg(F.min(F.struct("race", "h", "x")).alias("first"))
        won = race.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("r", F.col("first.x").alias("x")))).alias("won")).withColumnRenamed("key", "of")
        grown = F.transform("centres", lambda c, r: F.concat(c, F.when(F.col("won")[r].isNotNull(), F.array(F.col("won")[r])).otherwise(F.array().cast("array<array<double>>"))))
        state = state.join(won, same(won), "left").select("key", F.when(F.col("won").isNull(), F.col("centres")).otherwise(grown).alias("centres"))

    size = blocks.select(F.size(F.element_at("x", 1)).alias("n")).first()["n"]
    total = [F.sum(F.element_at("s", i + 1)) for i in range(size)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [("r", pa.int32()), ("c", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.float64())), ("cost", pa.float64())]
        for b in batches:
            found, at = [], []
            for k in range(len(b)):
                x = _matrix(b.column("x"), k)
                for r, (c, on) in enumerate(zip(_fits(b.column("centres")[k].as_py()), b.column("live")[k].as_py(), strict=True)):
                    if on:
                        counts, own, cost = gathered(x, c)
                        found += [(r, i, int(counts[i]), own[i].tolist(), cost if i == 0 else 0.0) for i in range(len(c))]
                        at += [k] * len(c)
            yield _batch(found, types, b.column("key"), at)

    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for centres, live, costs, seen in zip(*(b.column(n).to_pylist() for n in ("centres", "live", "costs", "seen")), strict=True):
                for r in {s["r"] for s in seen}:
                    own = sorted((s["c"], s["n"], s["s"], s["cost"]) for s in seen if s["r"] == r)
                    costs[r] = sum(o[3] for o in own)
                    new, live[r] = moved(np.array(centres[r], float), np.array([o[1] for o in own]), np.array([o[2] for o in own], float), costs[r])
                    centres[r] = new.tolist()
                found.append((centres, live, costs))
            yield _batch(found, [("centres", pa.list_(pa.list_(pa.list_(pa.float64())))), ("live", pa.list_(pa.bool_())), ("costs", pa.list_(pa.float64()))], b.column("key"), list(range(len(b))))

    going = state.select("key", "centres", F.array_repeat(F.lit(True), restarts).alias("live"), F.array_repeat(F.lit(0.0), restarts).alias("costs"))
    shape, ended = f"key {key_type}, centres {_CENTRES}, live array<boolean>, costs array<double>", []
    for step in range(MOST_STEPS):
        going = written(going, f"centres-{step}")
        ended.append(going.where(~F.exists("live", lambda on: on)))
        going = going.where(F.exists("live", lambda on: on))
        if going.isEmpty():
            break
        seen = with_state(going).mapInArrow(sums, f"key {key_type}, r int, c int, n long, s array<double>, cost double").groupBy("key", "r", "c").agg(F.sum("n").alias("n"), F.array(*total).alias("s"), F.sum("cost").alias("cost"))
        per = seen.groupBy("key").agg(F.collect_list(F.struct("r", "c", "n", "s", "cost")).alias("seen")).withColumnRenamed("key", "of")  # restarts * clusters of a group
        going = going.join(per, same(per)).drop("of").mapInArrow(moves, shape)
    else:
        ended.append(going)
    all_ = ended[0]
    for e in ended[1:]:
        all_ = all_.unionByName(e)

    @F.pandas_udf("array<array<double>>")
    def best(fits, costs):
        import pandas as pd

        return pd.Series([numbered([np.stack([np.asarray(v, float) for v in c]) for c in f], list(k)).tolist() for f, k in zip(fits, costs, strict=True)])

    return all_.select("key", best("centres", "costs").alias("centres"))
