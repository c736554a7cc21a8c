"""The network's gradient, its training over partitions, and what it can tell that a linear model can't."""

import numpy as np
from pyspark.sql import functions as F

from frameloom.functions.network import Network, varied
from frameloom.operators import classifier, clusters


def frames(spark, seed, n, size=20):
    """Gray noise with twelve bright pixels: of label 1 they are a block, of label 0 scattered."""
    draw, rows = np.random.default_rng(seed), []
    for i in range(n):
        x = draw.integers(0, 60, (size, size, 3), np.uint8)
        if i % 2:
            r, c = draw.integers(0, size - 4, 2)
            x[r : r + 3, c : c + 4] = 255
        else:
            x.reshape(-1, 3)[draw.choice(size * size, 12, replace=False)] = 255
        rows.append((i, i % 2, size, size, bytearray(x.tobytes())))
    return spark.createDataFrame(rows, "i int, y int, height int, width int, bgr binary")


def test_gradient_is_that_of_the_loss():
    network, draw = Network((3, 4), 5), np.random.default_rng(1)
    weights = network.start(1) + draw.normal(0, 0.05, network.size)
    images, labels = draw.normal(0, 1, (6, 9, 8, 3)), np.array([0, 1, 1, 0, 1, 0])
    kept = network.kept(np.arange(6))
    slope, loss = network.gradient(weights, images, labels, kept)
    assert loss > 0 and set(np.unique(kept)) == {0.0, 2.0}
    for k in draw.choice(network.size, 60, replace=False):
        step = np.zeros(network.size)
        step[k] = 1e-5
        near = (network.gradient(weights + step, images, labels, kept)[1] - network.gradient(weights - step, images, labels, kept)[1]) / 2e-5
        assert abs(near - slope[k]) < 1e-4 * max(1, abs(near))


def test_gradients_add_up_whatever_the_partitions(spark):
    network = Network((3, 4), 5)
    rows = classifier.prepared(frames(spark, 2, 50), "y", 12, variants=1)
    one, many = (classifier.summed_gradient(rows.repartition(n), network, network.start(3), 12, 5) for n in (1, 13))
    assert one[2] == many[2] == 100 and np.allclose(one[0], many[0], rtol=1e-9, atol=1e-9) and abs(one[1] - many[1]) < 1e-9


def test_variants_are_told_by_their_seed():
    x = np.random.default_rng(0).integers(0, 255, (10, 12, 3), np.uint8)
    assert np.array_equal(varied(x, 5), varied(x, 5)) and not np.array_equal(varied(x, 5), varied(x, 6)) and varied(x, -7).shape == x.shape
    assert {bool(np.array_equal(varied(x, s, 0, 0), x)) for s in range(20)} == {True, False}  # without turn and jitter: mirrored or not


def test_network_beats_the_linear_model(spark, tmp_path):
    train, val = frames(spark, 4, 160).repartition(4), frames(spark, 5, 80)
    path = str(tmp_path / "network")
    weights, accuracy = classifier.train_network(train, val, "y", path, side=20, channels=(6, 12), hidden=12, variants=0, epochs=14, batches=4, rate=1e-2, dropout=0.0)
    numbers = lambda d: d.select("y", F.transform(F.split(F.hex("bgr"), "(?<=\\G..)"), lambda h: F.conv(h, 16, 10).cast("double")).alias("f")).withColumn("f", F.slice("f", 1, 1200))
    _, linear = clusters.train_keep_best(numbers(train), numbers(val), "f", "y", str(tmp_path / "linear"), rounds=2)
    assert accuracy >= 0.9 and accuracy > linear + 0.1
    network, loaded, side = classifier.load_network(spark, path)
    assert side == 20 and np.array_equal(loaded, weights)
    told = classifier.classified(val, network, loaded, side).agg(F.avg((F.col("predicted") == F.col("y")).cast("double"))).first()[0]
    assert told == accuracy
