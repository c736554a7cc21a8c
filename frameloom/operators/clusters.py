"""Clusters by colour and a classifier, with Spark ML."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.functions.names import unused
from frameloom.operators.kmeans import CLUSTERS, RESTARTS, SEED, grouped_kmeans

COMPONENTS = 4


def pca_project(df: DataFrame, array_col: str, components: int = COMPONENTS) -> DataFrame:
    """Add projected (array): the leading principal components. The fit is a sum over rows; only it comes to the driver."""
    v, p = unused(df, "v", "p")
    vectors = df.withColumn(v, array_to_vector(F.col(array_col)))
    model = PCA(k=components, inputCol=v, outputCol=p).fit(vectors)
    return model.transform(vectors).withColumn("projected", vector_to_array(p)).drop(v, p)


def kmeans(df: DataFrame, array_col: str, clusters: int = CLUSTERS, restarts: int = RESTARTS, seed: int = SEED) -> DataFrame:
    """Add cluster_id: of several seeds the fit of least cost over all rows, its clusters numbered by their centres."""
    v, c = unused(df, "v", "c")
    vectors = df.withColumn(v, array_to_vector(F.col(array_col))).persist()
    fits = (KMeans(k=clusters, seed=seed + i, featuresCol=v, predictionCol=c).fit(vectors) for i in range(restarts))
    best: KMeansModel = min(fits, key=lambda m: m.summary.trainingCost)
    vectors.unpersist()
    order = sorted(range(len(best.clusterCenters())), key=lambda i: best.clusterCenters()[i].tolist())
    number = F.element_at(F.array(*(F.lit(order.index(i)) for i in range(len(order)))), F.col(c) + 1)
    return best.transform(vectors).withColumn("cluster_id", number).drop(v, c)


def issue_clusters(df: DataFrame, keys: list[str], order: str, array_col: str, clusters: int = CLUSTERS) -> DataFrame:
    """keys, order, cluster_id: each issue's rows in min(clusters, different rows) clusters of their own.

    All issues and restarts are fitted together. The components that are kept are as many as the numbers, so a projection on them would only turn the points; it is
    left out.
    """
    return grouped_kmeans(df, keys, order, array_col, clusters, RESTARTS, SEED)


def cluster_colours(df: DataFrame, keys: list[str], channels: list[str]) -> DataFrame:
    """The mean of each channel, cut to whole numbers."""
    return df.groupBy(*keys).agg(*(F.avg(c).cast("int").alias(c) for c in channels))


def train_keep_best(train: DataFrame, val: DataFrame, array_col: str, label_col: str, path: str, rounds: int = 5) -> tuple[LogisticRegressionModel, float]:
    """Fit with less and less regularisation; the model of the best accuracy on val is saved at path and returned with it.

    A model is scored as it is read back from a draft beside path: a fresh one holds its training summary, and by that the session, which may have
    parts that can't be sent to executors.
    """
    as_vector = lambda d: d.select(array_to_vector(F.col(array_col)).alias("features"), F.col(label_col).cast("double").alias("label"))
    score, best, top = MulticlassClassificationEvaluator(metricName="accuracy"), None, -1.0
    fit_on, judged_on = as_vector(train).persist(), as_vector(val).persist()
    for k in range(rounds):
        LogisticRegression(regParam=0.1 / 10**k, maxIter=50).fit(fit_on).write().overwrite().save(f"{path}-draft")
        model = LogisticRegressionModel.load(f"{path}-draft")
        accuracy = score.evaluate(model.transform(judged_on))
        if accuracy > top:
            best, top = model, accuracy
            model.write().overwrite().save(path)
    fit_on.unpersist(), judged_on.unpersist()
    draft = train.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}-draft")
    draft.getFileSystem(train.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(draft, True)
    return best, top


def item_numbers(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.withColumn("id", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
