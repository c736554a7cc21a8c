"""An image classifier that is trained where the images are: gradients are summed over partitions, weights go out for each step."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.functions import pixels
from frameloom.functions.network import Network, standardised, varied
from frameloom.sources.scratch import written

#: Rows that gradients of many partitions are summed in before they come to the driver, each as long as the weights.
SUMS = 8
#: Images whose gradient is taken at a time.
TOGETHER = 32


def prepared(frames: DataFrame, label: str, side: int, variants: int = 0, seed: int = 42) -> DataFrame:
    """label, variant, row (a number of the image and variant), image (side x side BGR bytes) of frames (height, width, bgr), the images as they are
    and, as rows of their own, so many variants of each: mirrored, turned, brightness and contrast changed.

    Rows without a label or pixels are left out. A variant depends on the image's bytes and its number alone.
    """
    number = F.xxhash64("bgr", F.lit(seed))
    rows = frames.where(F.col(label).isNotNull() & F.col("bgr").isNotNull()).select(F.col(label).cast("int").alias("label"), "height", "width", "bgr", number.alias("h"), F.explode(F.sequence(F.lit(0), F.lit(variants))).alias("variant"))
    rows = rows.withColumn("row", F.xxhash64("h", "variant"))

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples():
                x = pixels.resized(np.frombuffer(r.bgr, np.uint8).reshape(r.height, r.width, 3), side, side)
                out.append((varied(x, r.row) if r.variant else x).tobytes())
            yield b[["label", "variant", "row"]].assign(image=out)

    return rows.mapInPandas(made, "label int, variant int, row long, image binary")


def _images(column: pa.Array, side: int) -> np.ndarray:
    return standardised(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, side, side, 3))


def summed_gradient(rows: DataFrame, network: Network, weights: np.ndarray, side: int, step: int = 0) -> tuple[np.ndarray, float, int]:
    """(gradient, loss, images) over all rows. A partition sends one vector; those are summed in SUMS tasks before they come to the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    kind = "part int, g array<double>, loss double, n long"
    names = ["part", "g", "loss", "n"]

    def batch(parts: list[int], vectors: list[np.ndarray], losses: list[float], counts: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(vectors, pa.list_(pa.float64())), pa.array(losses, pa.float64()), pa.array(counts, pa.int64())], names=names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, loss, n = np.zeros(network.size), 0.0, 0
        for b in batches:
            for at in range(0, len(b), TOGETHER):
                part = b.slice(at, TOGETHER)
                kept = network.kept(part.column("row").to_numpy() ^ np.int64(step)) if network.dropout else None
                g, own = network.gradient(shared.value, _images(part.column("image"), side), part.column("label").to_numpy(), kept)
                total, loss, n = total + g, loss + own, n + len(part)
        if n:
            yield batch([TaskContext.get().partitionId() % SUMS], [total], [loss], [n])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, n = np.zeros(network.size), 0.0, 0
        for b in batches:
            for g in b.column("g"):
                total += g.values.to_numpy()
            loss, n = loss + sum(b.column("loss").to_pylist()), n + sum(b.column("n").to_pylist())
        if n:
            yield batch([0], [total], [loss], [n])

    got = rows.select("label", "row", "image").mapInArrow(partial, kind).repartition(SUMS, "part").mapInArrow(added, kind).collect()
    shared.destroy()
    return sum((np.array(r["g"]) for r in got), np.zeros(network.size)), sum(r["loss"] for r in got), sum(r["n"] for r in got)


def predicted(rows: DataFrame, network: Network, weights: np.ndarray, side: int) -> DataFrame:
    """rows and predicted, the class of the greatest score, the first of equals."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("int")
    def best(image: pd.Series) -> pd.Series:
        found = [network.forward(shared.value, _images(pa.array(image[at : at + TOGETHER], pa.binary()), side))[0].argmax(axis=1) for at in range(0, len(image), TOGETHER)]
        return pd.Series(np.concatenate(found) if found else [], dtype="int32")

    return rows.withColumn("predicted", best("image"))


def train_network(
    train: DataFrame, val: DataFrame, label: str, path: str, side: int = 32, channels: tuple[int, ...] = (8, 16, 32), hidden: int = 32, variants: int = 2, epochs: int = 20, batches: int = 4,
    rate: float = 1e-3, decay_every: int = 7, decay: float = 0.1, dropout: float = 0.5, seed: int = 42,
) -> tuple[np.ndarray, float]:
    """Train on frames (height, width, bgr and a label of 0 or 1); the weights of the best accuracy on val are saved at path and returned with it.

    Each epoch deals the images and their variants into so many batches by a hash; a step sums one batch's gradients and takes an Adam step; the rate falls by decay every
    decay_every epochs. Weights depend on the rows and the seed, not on their partitioning, but for the order of sums in the last digits. No training row, or no row to judge on, raises.
    """
    network = Network(channels, hidden, dropout=dropout)
    rows, judged = written(prepared(train, label, side, variants, seed), "training-images"), written(prepared(val, label, side), "validation-images")
    if rows.isEmpty() or judged.isEmpty():
        raise ValueError("no labelled image to train on, or none to judge on")
    weights, best, top = network.start(seed), None, -1.0
    mean, square, step = np.zeros(network.size), np.zeros(network.size), 0
    for epoch in range(epochs):
        for b in range(batches):
            own = rows.where(F.pmod(F.xxhash64("row", F.lit(epoch), F.lit(seed)), F.lit(batches)) == b)
            g, _, n = summed_gradient(own, network, weights, side, step * 7919 + seed)
            if not n:
                continue
            step += 1
            g /= n
            mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
            weights = weights - rate * decay ** (epoch // decay_every) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        accuracy = predicted(judged, network, weights, side).agg(F.avg((F.col("predicted") == F.col("label")).cast("double"))).first()[0]
        if accuracy > top:
            best, top = weights, accuracy
            save_network(train.sparkSession, network, best, side, path)
    return best, top


def save_network(spark: SparkSession, network: Network, weights: np.ndarray, side: int, path: str) -> None:
    shape = json.dumps({"channels": network.channels, "hidden": network.hidden, "classes": network.classes, "dropout": network.dropout, "side": side})
    spark.createDataFrame([(shape, weights.tolist())], "shape string, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def load_network(spark: SparkSession, path: str) -> tuple[Network, np.ndarray, int]:
    row = spark.read.parquet(path).first()
    told = json.loads(row["shape"])
    side = told.pop("side")
    return Network(**told), np.array(row["weights"]), side


def classified(frames: DataFrame, network: Network, weights: np.ndarray, side: int) -> DataFrame:
    """frames and predicted, from a trained network."""
    shared = frames.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("int")
    def best(bgr: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
        out = []
        for x, h, w in zip(bgr, height, width, strict=True):
            image = pixels.resized(np.frombuffer(x, np.uint8).reshape(h, w, 3), side, side)
            out.append(int(network.forward(shared.value, standardised(image[None]))[0].argmax()))
        return pd.Series(out, dtype="int32")

    return frames.withColumn("predicted", best("bgr", "height", "width"))
