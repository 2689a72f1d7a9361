"""Feature preparation, parameter rules and Spark ML training.

Exact, SQL-checkable parts (standardisation, label encoding, class
weights, parameter rules, label cleaning) are plain DataFrame operators.
The specified models are in ``network`` and ``squared_hinge``; here are the
Spark ML alternatives on a ``Pipeline``:

* SVM: ``StandardScaler -> LinearSVC`` (hinge loss, L2, ``weightCol`` with
  balanced class weights, ``regParam = 1 / (C * n)``);
* MLP: ``StandardScaler -> MultilayerPerceptronClassifier`` with layers
  ``[d, *hidden, 2]`` (sigmoid hidden units, softmax output, L-BFGS).

Both are distributed by Spark ML (tree-aggregated gradients); the training
frame is persisted once before ``fit`` because the optimisers scan it once
per iteration.
"""
from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, MultilayerPerceptronClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import attach_row

R = 6
# Fixed value: stopping tolerance of the linear SVM (liblinear's default).
SVM_TOL = 1e-4
ROWS_PER_PARTITION = 200_000
MIN_ROWS_PER_PARTITION = 500


# -- exact preparation steps ----------------------------------------------------------

def clean_labels(df: DataFrame, label_col: str = "label") -> DataFrame:
    """-1 -> 0; with more than two distinct values, > 0.5 -> 1 else 0."""
    base = df.withColumn(label_col, F.when(F.col(label_col) == -1, 0).otherwise(F.col(label_col)))
    k = base.agg(F.count_distinct(label_col).alias("__k"))
    out = attach_row(base, k)
    return out.withColumn(label_col, F.when(F.col("__k") > 2, (F.col(label_col) > 0.5).cast("int"))
                          .otherwise(F.col(label_col))).drop("__k")


def standardize_entries(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, dim, value)``: (x - mean) / population std per dimension;
    a zero-variance dimension is only centred."""
    long = df.select(F.col(id_col).alias("id"), F.posexplode(vec_col).alias("dim", "x"))
    long = long.withColumn("x", F.col("x").cast("double"))
    stats = long.groupBy("dim").agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"))
    z = F.when(F.col("sd") > 0, (F.col("x") - F.col("mu")) / F.col("sd")).otherwise(F.col("x") - F.col("mu"))
    # one row per dimension: bounded by the vector width
    return long.join(F.broadcast(stats), "dim").select("id", "dim", F.round(z, R).alias("value"))


def label_encode(df: DataFrame, label_col: str) -> DataFrame:
    """Codes 0..k-1 in sorted label order; rows without a label are left out.
    The classes are one sorted array, summed up in the tasks: an encoder has
    them all in any case, and no window orders them."""
    classes = df.agg(F.array_sort(F.collect_set(label_col)).alias("__classes"))
    rows = attach_row(df.filter(F.col(label_col).isNotNull()), classes)
    return rows.withColumn("code", (F.array_position("__classes", F.col(label_col)) - 1).cast("int")).drop("__classes")


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` per class."""
    per = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    tot = per.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    return attach_row(per, tot).select("label", "n_c", F.round(F.col("n") / (F.col("k") * F.col("n_c")), R)
                                       .alias("weight"))


def svm_params(stats: DataFrame) -> DataFrame:
    """SVM rules over ``(total_samples, feature_dim)``."""
    n, d = F.col("total_samples"), F.col("feature_dim")
    c = F.when(n < 100, 0.1).otherwise(1.0)
    c = F.when(d > 1000, F.least(c, F.lit(0.1))).otherwise(c)
    it = F.when(n < 100, 5000).when(n < 1000, 10000).when(n > 10000, 20000).otherwise(10000)
    return stats.select("total_samples", "feature_dim", c.alias("C"), it.alias("max_iter"),
                        F.lit("balanced").alias("class_weight"),
                        F.round(1.0 / (c * n), 12).alias("reg_param"))


def mlp_params(stats: DataFrame) -> DataFrame:
    """MLP rules over ``(total_samples, feature_dim)``; hidden sizes as text."""
    n, d = F.col("total_samples"), F.col("feature_dim")
    small, medium, large = n < 100, n < 1000, n > 10000

    def h(a, b, c=None):
        return F.array(*[F.lit(x) for x in (a, b, c) if x is not None])
    hidden = F.when(small, h(64, 32)).when(medium, h(128, 64)).when(large, h(512, 256, 128)).otherwise(h(256, 128))
    hidden = F.when(d < 200, F.transform(hidden, lambda x: F.floor(x / 2).cast("int"))) \
              .when(d > 1000, F.transform(hidden, lambda x: x * 2)).otherwise(hidden)
    hidden = F.transform(hidden, lambda x: F.greatest(F.lit(16), x))
    dropout = F.when(small, 0.1).when(medium, 0.2).when(large, 0.4).otherwise(0.3)
    dropout = F.when(d > 1000, dropout + 0.1).otherwise(dropout)
    lr = F.when(small, 0.01).otherwise(0.001)
    batch = F.when(small, F.least(F.lit(8), F.floor(n / 4))).when(medium, F.least(F.lit(16), F.floor(n / 8))) \
             .when(large, F.lit(64)).otherwise(F.lit(32))
    batch = F.greatest(F.lit(1), F.least(batch, F.floor(n / 4))).cast("int")
    epochs = F.when(small, 30).when(medium, 40).when(large, 100).otherwise(50)
    patience = F.when(small, 5).when(medium, 7).when(large, 15).otherwise(10)
    runner_epochs = F.least(F.lit(50), F.greatest(F.lit(10), F.floor(n / 20))).cast("int")
    return stats.select("total_samples", "feature_dim",
                        F.array_join(F.transform(hidden, lambda x: x.cast("string")), ",").alias("hidden_dims"),
                        F.round(dropout, R).alias("dropout"), lr.alias("learning_rate"), batch.alias("batch_size"),
                        epochs.alias("epochs"), patience.alias("patience"), runner_epochs.alias("runner_epochs"))


def feature_stats(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_samples"),
                  F.max(F.size(vec_col)).cast("long").alias("feature_dim"))


# -- Spark ML training ---------------------------------------------------------------

def _features(df: DataFrame, vec_col: str) -> DataFrame:
    return df.withColumn("features_raw", array_to_vector(F.col(vec_col).cast("array<double>")))


def with_class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    w = class_weights(df, label_col).select(F.col("label").alias(label_col), F.col("weight").alias("weight"))
    return df.join(F.broadcast(w), label_col)  # one row per class


def _sized(df: DataFrame, n: int) -> DataFrame:
    """Training frames are scanned once per optimiser iteration, and every
    scan is one job.  Partitions hold at most ROWS_PER_PARTITION rows (large
    frames use the whole cluster) and at least MIN_ROWS_PER_PARTITION rows
    (small frames are not spread over hundreds of near-empty tasks), but a
    small frame still uses every task slot, since gradient work per row is
    large for the MLP."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    parts = max(min(slots, math.ceil(n / MIN_ROWS_PER_PARTITION)), math.ceil(n / ROWS_PER_PARTITION), 1)
    return df.repartition(parts)


def population_scaler(n: int, data: DataFrame) -> list:
    """Stages that standardise with the population deviation (E4): Spark's
    scaler divides by the sample deviation, sqrt(n / (n - 1)) times as large."""
    d = data.select(F.max(F.size(vector_to_array("features_raw")))).first()[0] or 0
    ratio = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    return [StandardScaler(inputCol="features_raw", outputCol="features_sample", withMean=True, withStd=True),
            ElementwiseProduct(scalingVec=Vectors.dense([ratio] * d), inputCol="features_sample", outputCol="features")]


def train_svm(train: DataFrame, vec_col: str = "embedding", label_col: str = "label",
              C: float = 1.0, max_iter: int = 10000) -> PipelineModel:
    n = train.count()
    data = _sized(with_class_weights(_features(train, vec_col), label_col).withColumn(
        "label_d", F.col(label_col).cast("double")), n).persist()
    try:
        svc = LinearSVC(featuresCol="features", labelCol="label_d", weightCol="weight",
                        regParam=1.0 / (C * max(n, 1)), maxIter=max_iter,
                        tol=SVM_TOL, standardization=False)
        pipe = Pipeline(stages=[*population_scaler(n, data), svc])
        return pipe.fit(data)
    finally:
        data.unpersist()


def train_mlp(train: DataFrame, hidden: list[int], vec_col: str = "embedding", label_col: str = "label",
              max_iter: int = 50, block_size: int = 128, seed: int = 42) -> PipelineModel:
    """MLP on the training frame.  L-BFGS is full-batch: the reference's
    mini-batch size has no counterpart (``block_size`` only sets how many
    rows are stacked into one matrix product)."""
    st = train.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec_col)).alias("d")).first()
    d = int(st["d"] or 0)
    data = _sized(_features(train, vec_col).withColumn("label_d", F.col(label_col).cast("double")),
                  int(st["n"])).persist()
    try:
        mlp = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label_d",
                                             layers=[d, *hidden, 2], maxIter=max_iter,
                                             blockSize=max(1, block_size), seed=seed)
        pipe = Pipeline(stages=[*population_scaler(int(st["n"]), data), mlp])
        return pipe.fit(data)
    finally:
        data.unpersist()


def training_history(model: PipelineModel, spark) -> DataFrame:
    """``(iteration, loss)`` from the last stage's training summary."""
    last = model.stages[-1]
    hist = list(last.summary().objectiveHistory if hasattr(last, "summary") else [])
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


def score(model: PipelineModel, df: DataFrame, name: str, vec_col: str = "embedding",
          id_col: str = "id", label_col: str = "label") -> DataFrame:
    """``(id, model, label, prediction, probability, raw_margin)``.

    MLP: probability of class 1, prediction = p > 0.5.  SVM: the reference
    reports a constant confidence 0.5; the real margin is ``raw_margin``.
    """
    out = model.transform(_features(df, vec_col))
    raw = vector_to_array(F.col("rawPrediction"))
    if "probability" in out.columns:
        p = vector_to_array(F.col("probability"))[1]
        pred = (p > 0.5).cast("int")
        margin = raw[1] - raw[0]
    else:
        p = F.lit(0.5)
        pred = F.col("prediction").cast("int")
        margin = raw[1]
    return out.select(F.col(id_col).alias("id"), F.lit(name).alias("model"), F.col(label_col).alias("label"),
                      pred.alias("prediction"), p.alias("probability"), margin.alias("raw_margin"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

