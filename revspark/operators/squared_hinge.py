"""Linear SVM with the squared hinge loss (E10), by Newton's method.

The objective is 0.5 |v|^2 + C sum c_i max(0, 1 - y_i v.x_i)^2 over
standardised features and a constant 1 (the intercept is regularised like the
weights), with c_i the balanced class weight.  It is convex and piecewise
quadratic; each Newton step needs one pass for the value, the gradient and,
up to ``GRAM`` features, the curvature matrix of the active rows, summed by
tree.  With more features the step comes from conjugate gradients, one
pass per Hessian-vector product.  One more pass gives the objective at all
step lengths of the line search at once.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, gathered, moments, summed
from .training import class_weights

#: Rows of a block; features up to which the curvature matrix is summed.
ROWS, GRAM = 4096, 1024
LENGTHS = 0.5 ** np.arange(20)


@dataclass
class LinearModel:
    """v (weights, then intercept) over standardised features."""
    v: np.ndarray
    mean: np.ndarray
    sd: np.ndarray
    C: float
    steps: int
    objective: float
    gradient: float  # relative to the first one

    @property
    def architecture(self) -> dict:
        return {"model_type": "linear_svm", "loss": "squared_hinge", "input_dim": len(self.mean), "C": self.C,
                "parameters": len(self.v)}


def _one(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    return np.column_stack([(x - mean) / sd, np.ones(len(x))])


def objective(blocks: Blocks, points: np.ndarray, mean, sd, C: float) -> np.ndarray:
    """The objective at each row of ``points``."""
    def f(_, x, y, w):
        gap = np.maximum(0, 1 - (2 * y - 1)[:, None] * (_one(x, mean, sd) @ points.T))
        return C * (w[:, None] * gap * gap).sum(0)

    return 0.5 * (points * points).sum(1) + summed(blocks, f)


def slope(blocks: Blocks, v: np.ndarray, mean, sd, C: float, curved: bool):
    """Gradient at v and, if ``curved``, the Hessian."""
    k = len(v)

    def f(_, x, y, w):
        x, sign = _one(x, mean, sd), 2 * y - 1
        gap = 1 - sign * (x @ v)
        on = gap > 0
        x, c = x[on], 2 * C * w[on]
        grad = -(c * gap[on] * sign[on]) @ x
        return np.concatenate([grad, ((x * c[:, None]).T @ x).ravel()]) if curved else grad

    found = summed(blocks, f)
    return v + found[:k], np.eye(k) + found[k:].reshape(k, k) if curved else None


def curvature(blocks: Blocks, v: np.ndarray, along: np.ndarray, mean, sd, C: float) -> np.ndarray:
    """Hessian at v times ``along``."""
    def f(_, x, y, w):
        x = _one(x, mean, sd)
        on = 1 - (2 * y - 1) * (x @ v) > 0
        return (2 * C * w[on] * (x[on] @ along)) @ x[on]

    return along + summed(blocks, f)


def conjugate(blocks: Blocks, v, grad, mean, sd, C: float, tol: float = 1e-2, most: int = 100) -> np.ndarray:
    """An approximate solution of Hessian x step = -gradient."""
    step, left = np.zeros_like(v), -grad
    way, size = left, left @ left
    for _ in range(most):
        if np.sqrt(size) <= tol * np.linalg.norm(grad):
            break
        bent = curvature(blocks, v, way, mean, sd, C)
        a = size / (way @ bent)
        step, left = step + a * way, left - a * bent
        size, before = left @ left, size
        way = left + size / before * way
    return step


def train_squared_hinge(train: DataFrame, C: float = 1.0, balanced: bool = True, tol: float = 1e-6, max_iter: int = 100,
                        gram: int = GRAM, vec_col: str = "embedding", label_col: str = "label", id_col: str = "id") -> LinearModel:
    """Minimise until the gradient is ``tol`` times the first one.  Labels
    are 0 and 1; rows with others are left out."""
    df = train.filter(F.col(label_col).isin(0, 1))
    weight = None
    if balanced:
        w = {r["label"]: r["weight"] for r in class_weights(df, label_col).collect()}  # two rows
        weight = F.when(F.col(label_col) == 1, w.get(1, 1.0)).otherwise(w.get(0, 1.0))
    blocks = gathered(df, ROWS, vec_col, label_col, id_col, weight)
    try:
        if not blocks.n:
            raise ValueError("training needs labelled rows")
        mean, sd = moments(blocks)
        v, first, steps = np.zeros(blocks.d + 1), None, 0
        curved = blocks.d <= gram
        value = objective(blocks, v[None, :], mean, sd, C)[0]
        while True:
            grad, hessian = slope(blocks, v, mean, sd, C, curved)
            size = float(np.linalg.norm(grad))
            first = size if first is None else first
            if size <= tol * first or steps >= max_iter:
                return LinearModel(v, mean, sd, C, steps, float(value), size / first if first else 0.0)
            step = -np.linalg.solve(hessian, grad) if curved else conjugate(blocks, v, grad, mean, sd, C)
            values = objective(blocks, v + LENGTHS[:, None] * step, mean, sd, C)
            enough = np.flatnonzero(values <= value + 1e-4 * LENGTHS * (grad @ step))
            if not len(enough):  # no length gains: rounding
                return LinearModel(v, mean, sd, C, steps, float(value), size / first)
            v, value, steps = v + LENGTHS[enough[0]] * step, values[enough[0]], steps + 1
    finally:
        blocks.unpersist()


def score_linear(model: LinearModel, df: DataFrame, name: str = "svm", vec_col: str = "embedding", id_col: str = "id",
                 label_col: str = "label", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, model, label, prediction, probability, raw_margin)`` and the
    columns ``keep``: the probability is the constant 0.5, the margin is real."""
    weights = model.v[:-1] / model.sd
    shared = df.sparkSession.sparkContext.broadcast((weights, float(model.v[-1] - weights @ model.mean)))

    @F.pandas_udf("double")
    def margin(x: pd.Series) -> pd.Series:
        w, b = shared.value
        return pd.Series([float(np.asarray(r, dtype=np.float64) @ w) + b if r is not None and len(r) == len(w) else None for r in x],
                         dtype="float64")

    scored = df.withColumn("__z", F.nullif(margin(F.col(vec_col).cast("array<double>")), F.lit(float("nan"))))
    return scored.select(F.col(id_col).alias("id"), F.lit(name).alias("model"), F.col(label_col).alias("label"),
                         (F.col("__z") > 0).cast("int").alias("prediction"), F.lit(0.5).alias("probability"),
                         F.col("__z").alias("raw_margin"), *keep)
