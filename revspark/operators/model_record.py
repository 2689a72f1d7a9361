"""Trained models as a record and a table of arrays.

``save_model`` writes the parameters as rows (name, shape, values) and then a
one-line JSON record: architecture, names and shapes, a digest of the values,
and what the caller adds (metrics, sizes).  The record comes last, so a folder
with a record is complete.  ``load_model`` checks the arrays against the record
before it builds a model.
"""
from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from ..functions.documents import safe_value
from .network import Network, shapes
from .squared_hinge import LinearModel

Model = Network | LinearModel


def _arrays(model: Model) -> dict[str, np.ndarray]:
    if isinstance(model, LinearModel):
        return {"v": model.v, "mean": model.mean, "sd": model.sd}
    out = {"theta": model.theta, "mean": model.mean, "sd": model.sd}
    return out | {f"running{i}": x for i, x in enumerate(model.running)}


def _digest(arrays: dict[str, np.ndarray]) -> str:
    h = hashlib.sha256()
    for name in sorted(arrays):
        h.update(name.encode() + np.ascontiguousarray(arrays[name], dtype="<f8").tobytes())
    return h.hexdigest()


def save_model(model: Model, spark: SparkSession, path: str, **more) -> dict:
    """Write the model below ``path``; returns its record."""
    arrays = _arrays(model)
    rows = [(name, list(x.shape), x.ravel().tolist()) for name, x in arrays.items()]
    spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/arrays")
    extra = {"history": model.history} if isinstance(model, Network) else {"steps": model.steps, "objective": model.objective,
                                                                          "gradient": model.gradient}
    record = safe_value({"architecture": model.architecture, "arrays": {n: list(x.shape) for n, x in arrays.items()},
                         "sha256": _digest(arrays), **extra, **more})
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/record")
    return record


def read_record(spark: SparkSession, path: str) -> dict:
    try:
        return json.loads(spark.read.text(f"{path}/record").first()["value"])
    except AnalysisException as e:
        raise ValueError(f"{path} has no model record") from e


def load_model(spark: SparkSession, path: str) -> Model:
    """The model of a folder; ValueError where its arrays are not those of
    the record, or do not fit its architecture."""
    record = read_record(spark, path)
    arrays = {r["name"]: np.array(r["values"], dtype=np.float64).reshape(r["shape"])
              for r in spark.read.parquet(f"{path}/arrays").collect()}  # of the model's size
    if {n: list(x.shape) for n, x in arrays.items()} != record["arrays"] or _digest(arrays) != record["sha256"]:
        raise ValueError(f"{path}: the arrays are not those of the record")
    made = record["architecture"]
    mean, sd, wide = arrays["mean"], arrays["sd"], made["input_dim"]
    if made["model_type"] == "linear_svm":
        fits = len(arrays["v"]) == wide + 1
        model: Model = LinearModel(arrays["v"], mean, sd, made["C"], record["steps"], record["objective"], record["gradient"])
    else:
        sizes = [wide, *made["hidden_dims"]]
        running = [arrays[f"running{i}"] for i in range(2 * len(made["hidden_dims"]))]
        fits = (sum(int(np.prod(s)) for s in shapes(sizes)) == len(arrays["theta"])
                and [len(x) for x in running] == [h for h in made["hidden_dims"] for _ in (0, 1)])
        model = Network(sizes, made["dropout"], arrays["theta"], running, mean, sd, [tuple(r) for r in record["history"]])
    if not fits or not len(mean) == len(sd) == wide or model.architecture != made:
        raise ValueError(f"{path}: the arrays do not fit the architecture {made}")
    return model
