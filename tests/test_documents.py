"""JSON documents and model records."""
import datetime
import json
import pathlib

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from revspark.functions import documents as D
from revspark.operators import model_record as MR
from revspark.operators import network as N
from revspark.operators import squared_hinge as H


def test_values():
    x = {"a": np.float32("nan"), "b": [np.int64(3), float("inf"), (1, {"c": np.array([1.5, -np.inf])})], 5: pathlib.Path("x/y"),
         "v": Vectors.sparse(3, [1], [2.0]), "d": datetime.date(2024, 1, 2), "s": {2, 1}, "t": np.bool_(True), "raw": b"\x00"}
    got = json.loads(json.dumps(D.safe_value(x), allow_nan=False))
    assert got == {"a": None, "b": [3, None, [1, {"c": [1.5, None]}]], "5": "x/y", "v": [0.0, 2.0, 0.0], "d": "2024-01-02",
                   "s": [1, 2], "t": True, "raw": "AA=="}


def test_documents_keep_fields_and_depth(spark, tmp_dir):
    rows = [(1, float("nan"), [1.0, float("-inf")], {"k": float("inf")}, (2.5, None), Vectors.dense([1.0, float("nan")]), "tab\t\"q\""),
            (2, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema=_schema())
    df = df.withColumn("odd name", F.lit(1.5)).withColumn("day", F.lit(datetime.date(2024, 1, 2)))
    back = [json.loads(r["value"]) for r in D.write_documents(df, f"{tmp_dir}/docs").collect()]
    first = next(r for r in back if r["id"] == 1)
    assert first == {"id": 1, "x": None, "xs": [1.0, None], "m": {"k": None}, "s": {"p": 2.5, "q": None}, "v": [1.0, None],
                     "t": "tab\t\"q\"", "odd name": 1.5, "day": "2024-01-02"}
    second = next(r for r in back if r["id"] == 2)
    assert set(second) == set(first) and all(second[k] is None for k in ("x", "xs", "m", "s", "v", "t"))


def _schema():
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import (ArrayType, DoubleType, FloatType, LongType, MapType, StringType, StructField, StructType)
    inner = StructType([StructField("p", DoubleType()), StructField("q", FloatType())])
    kinds = [("id", LongType()), ("x", DoubleType()), ("xs", ArrayType(DoubleType())), ("m", MapType(StringType(), DoubleType())),
             ("s", inner), ("v", VectorUDT()), ("t", StringType())]
    return StructType([StructField(n, k) for n, k in kinds])


def models():
    rng = np.random.default_rng(0)
    sizes = [3, 4, 2]
    net = N.Network(sizes, 0.2, N.initial(sizes, 1), [rng.random(h) for h in (4, 4, 2, 2)], rng.random(3), rng.random(3) + 1,
                    [(1, 0.5, 0.6, 0.7, 0.8, 0.01, True)])
    return net, H.LinearModel(rng.random(4), rng.random(3), rng.random(3) + 1, 1.0, 3, 2.5, 1e-7)


def test_models_round_trip(spark, tmp_dir):
    for i, model in enumerate(models()):
        path = f"{tmp_dir}/m{i}"
        record = MR.save_model(model, spark, path, metrics={"accuracy": float("nan"), "n": np.int64(5)})
        assert MR.read_record(spark, path) == record and record["metrics"] == {"accuracy": None, "n": 5}
        again = MR.load_model(spark, path)
        assert again.architecture == model.architecture
        for name, x in MR._arrays(model).items():
            assert np.array_equal(MR._arrays(again)[name], x)


def test_models_are_verified(spark, tmp_dir):
    net, svm = models()
    with pytest.raises(ValueError, match="no model record"):
        MR.load_model(spark, f"{tmp_dir}/none")
    MR.save_model(net, spark, f"{tmp_dir}/a")
    MR.save_model(svm, spark, f"{tmp_dir}/b")
    record = MR.read_record(spark, f"{tmp_dir}/a")
    spark.read.parquet(f"{tmp_dir}/b/arrays").write.mode("overwrite").parquet(f"{tmp_dir}/c/arrays")
    write = lambda r: spark.createDataFrame([(json.dumps(r),)], "value string").write.mode("overwrite").text(f"{tmp_dir}/c/record")
    write(record)
    with pytest.raises(ValueError, match="not those of the record"):
        MR.load_model(spark, f"{tmp_dir}/c")
    other = MR.read_record(spark, f"{tmp_dir}/b")
    other["architecture"]["input_dim"] = 7
    write(other)
    with pytest.raises(ValueError, match="do not fit"):
        MR.load_model(spark, f"{tmp_dir}/c")
