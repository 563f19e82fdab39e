"""Random-forest regression (train, predict, importances, store).

Without a depth limit trees are grown by :mod:`wattspark.operators.learn.grower`; with
one, by MLlib.  MLlib grows trees level by level over the whole distributed training set
(one aggregation pass per level), so nothing is collected to the driver but
split statistics and the finished trees.  The training set is checkpointed
first: every level re-reads it, and a reliable checkpoint also survives the
loss of the executors that computed it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspark.operators.learn import grower
from wattspark.session import checkpoint_dir, path_exists

FEATURES_VEC = "features"
#: Bytes of a training partition in MLlib's cache, where a row holds a draw and a node id
#: (4 bytes each) per tree, and a bin per feature.
PARTITION_BYTES = 96 << 20


def _spread(train: DataFrame, num_trees: int, width: int) -> DataFrame:
    """``train`` (materialised), dealt anew if a partition would outgrow ``PARTITION_BYTES``.

    Few features are small on disk, so a partition may hold millions of rows, each of
    which MLlib expands by the number of trees and reads again at every level."""
    most = max(PARTITION_BYTES // (8 * num_trees + 4 * width + 64), 1)
    sizes = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    if max(sizes, default=0) <= most:
        return train
    return train.repartition(-(-sum(sizes) // most)).checkpoint(eager=True)


def fit_random_forest(df: DataFrame, features: Sequence[str], label: str, *,
                      max_depth: int | None, num_trees: int = 100, seed: int = 42,
                      feature_subset: str = "all", min_instances_per_node: int = 1,
                      max_bins: int = 32, subsampling_rate: float = 1.0,
                      checkpoint: bool = True, max_memory_mb: int = 512):
    """Fit a forest on ``df``.

    ``max_depth=None`` grows every tree until its leaves are pure (100 trees,
    seed 42, every feature tried at each split, bootstrap rows).  With a depth
    (MLlib: at most 30) it is ``VectorAssembler + RandomForestRegressor``.

    Node ids are cached on the executors (``cacheNodeIds``) and that cache is
    checkpointed every 10 iterations, so each level does not re-route every
    row from the root; this halves training time and keeps lineage short.
    """
    checkpoint_dir(df.sparkSession)
    if max_depth is None:
        if (feature_subset, min_instances_per_node, subsampling_rate) != ("all", 1, 1.0):
            raise ValueError("trees without a depth limit try all features on all drawn rows")
        return grower.fit_grown_forest(df, features, label, num_trees=num_trees, seed=seed)
    train = df.select(*features, label).na.drop("any")
    if checkpoint:
        train = _spread(train.checkpoint(eager=True), num_trees, len(features))
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES_VEC)
    rf = RandomForestRegressor(featuresCol=FEATURES_VEC, labelCol=label, predictionCol="prediction",
                               numTrees=num_trees, seed=seed, maxDepth=max_depth,
                               featureSubsetStrategy=feature_subset,
                               minInstancesPerNode=min_instances_per_node, maxBins=max_bins,
                               subsamplingRate=subsampling_rate, bootstrap=True,
                               cacheNodeIds=True, checkpointInterval=10,
                               maxMemoryInMB=max_memory_mb)
    return Pipeline(stages=[assembler, rf]).fit(train)


def predict(model, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    """Batch prediction: the input columns plus ``prediction``."""
    if isinstance(model, grower.GrownForest):
        return grower.predict_grown(df, model, prediction_col)
    out = model.transform(df).drop(FEATURES_VEC)
    if prediction_col != "prediction":
        out = out.withColumnRenamed("prediction", prediction_col)
    return out


def feature_importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """``feature, importance`` (normalised, sums to 1) of the fitted forest."""
    if isinstance(model, grower.GrownForest):
        return grower.importances(model)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double")


def save_model(model, path: str) -> None:
    if isinstance(model, grower.GrownForest):
        grower.save_forest(model, path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str):
    spark = SparkSession.active()
    if path_exists(spark, f"{path}/forest"):
        return grower.load_forest(spark, path)
    return PipelineModel.load(path)


def true_vs_predicted(scored: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """The table behind a true-vs-predicted plot."""
    return scored.select(*keys, F.col(label).alias("y_true"), F.col("prediction").alias("y_pred"))
