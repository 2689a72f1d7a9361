"""Embeddings, training smoke, save/load."""
import random

from pyspark.sql import functions as F

from revspark.operators import embedding as EM
from revspark.operators import training as TR


def test_batch_encoder_equals_native(spark):
    from tests.conftest import SF001
    from revspark.operators.filters import valid_texts
    from revspark.sources.tables import table
    docs = valid_texts(table(spark, SF001, "documents").select(F.col("doc_id").alias("id"), "text"), "embed")
    a = {r["id"]: r["embedding"] for r in EM.hash_embeddings(docs).collect()}
    b = {r["id"]: r["embedding"] for r in EM.embed_texts(docs).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert max(abs(x - y) for x, y in zip(a[k], b[k])) < 1e-6


def _toy(spark, n=200, d=8):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        y = i % 2
        v = [rnd.gauss(2.0 if y else -2.0, 1.0) if j == 0 else rnd.gauss(0, 1) for j in range(d)]
        rows.append((i, v, y))
    return spark.createDataFrame(rows, "id long, embedding array<float>, label int")


def test_svm_and_mlp_beat_majority(spark, tmp_dir):
    df = _toy(spark)
    for kind in ("svm", "mlp"):
        model = TR.train_svm(df) if kind == "svm" else TR.train_mlp(df, [8, 4], max_iter=50)
        sc = TR.score(model, df, kind)
        acc = sc.select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
        # majority class is 0.5; the toy set is nearly separable
        assert acc > 0.9, (kind, acc)
    path = f"{tmp_dir}/svm"
    TR.save_model(model, path)
    again = TR.load_model(path)
    a = {r["id"]: r["prediction"] for r in TR.score(model, df, "m").collect()}
    b = {r["id"]: r["prediction"] for r in TR.score(again, df, "m").collect()}
    assert a == b


def test_clean_labels(spark):
    df = spark.createDataFrame([(1, -1), (2, 0), (3, 4), (4, 9)], "id long, label int")
    got = sorted((r["id"], r["label"]) for r in TR.clean_labels(df).collect())
    assert got == [(1, 0), (2, 0), (3, 1), (4, 1)]


def test_embeddings_not_recreated_unless_forced(spark, tmp_dir):
    import pytest
    from revspark.sources import sinks
    df = spark.createDataFrame([(1, [0.1, 0.2], 1)], "id long, embedding array<float>, label int")
    path = f"{tmp_dir}/emb"
    sinks.write_embeddings(df, path)
    with pytest.raises(Exception):
        sinks.write_embeddings(df, path)  # exists: kept
    assert sinks.write_embeddings(df, path, mode="overwrite").count() == 1
