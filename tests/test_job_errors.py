"""A failing model is a row of the job's result; training data, carve-out, texts with scores."""
import pytest
from pyspark.sql import functions as F

from revspark.operators import modes, network, squared_hinge
from revspark.plans import job
from tests.test_job import _reviews


def test_a_failed_model_does_not_end_the_job(spark, monkeypatch):
    def fail(*args, **kwargs):
        raise ArithmeticError("no convergence")

    monkeypatch.setattr(network, "train_network", fail)
    out = job.run_job(_reviews(spark), "class_key", models=("mlp", "svm"), force_text="body", force_label="verdict")
    got = {r["model"]: r for r in out["metrics"].collect()}
    assert (got["svm"]["status"], got["svm"]["reason"]) == ("evaluated", None) and got["svm"]["accuracy"] > 0.9
    assert (got["mlp"]["status"], got["mlp"]["reason"], got["mlp"]["n"]) == ("error", "ArithmeticError: no convergence", 0)
    assert out["best_model"].first()["best_model"] == "svm"
    monkeypatch.setattr(squared_hinge, "train_squared_hinge", fail)
    out = job.run_job(_reviews(spark), "class_key", models=("mlp", "svm"), force_text="body", force_label="verdict")
    assert [r["status"] for r in out["metrics"].collect()] == ["error", "error"] and out["scored"].count() == 0
    assert out["best_model"].first()["best_model"] is None


def test_whole_job_scores_texts(spark):
    out = job.run_job(_reviews(spark), "class_key", force_text="body", force_label="verdict")
    assert {r["model"]: r["status"] for r in out["metrics"].collect()} == {"mlp": "evaluated", "svm": "evaluated"}
    rows = out["reviews"].collect()
    assert len(rows) == 2 * out["splits"].count() and all(r["full_text"].startswith("this film") for r in rows)
    assert all(r["prediction"] in (0, 1) and 0 <= r["probability"] <= 1 for r in rows)
    stats = {r["split"]: r for r in out["training_stats"].collect()}
    assert stats["total"]["samples"] == stats["train"]["samples"] + stats["val"]["samples"]
    assert stats["train"]["label_set"] == "0,1" and stats["train"]["feature_dim"] == 384


@pytest.mark.parametrize("n,left", [(4, 3), (6, 5), (19, 16), (20, 16), (21, 16), (100, 80)])
def test_rows_left_after_carving(spark, n, left):
    df = spark.createDataFrame([(i, i % 2, "train") for i in range(n)], "id long, label int, split string")
    train, val = modes.training_data(df)
    assert train.count() == left and val.count() == n - left
    row = spark.createDataFrame([(n, 2)], "valid_train long, n_classes long").withColumn(
        "left_train", modes.left_after_carving(F.col("valid_train")))
    assert row.first()["left_train"] == left
    assert modes.training_status(row, min_samples=2).first()["reason"] == ("training_set_too_small" if left < 5 else None)


def test_existing_val_rows_are_taken(spark):
    df = spark.createDataFrame([(1, 0, "train"), (2, 1, "train"), (3, 1, "val"), (4, -1, "val"), (5, None, "train")],
                               "id long, label int, split string")
    train, val = modes.training_data(df)
    assert (train.count(), val.count()) == (2, 1)
    stats = {r["split"]: tuple(r)[1:] for r in modes.training_data_stats(train, val, None).collect()}
    assert stats == {"train": (2, None, "0,1", 1, 1), "val": (1, None, "1", 0, 1), "total": (3, None, "0,1", 1, 2)}
    none = modes.training_data_stats(train.limit(0), val.limit(0), None).collect()
    assert sorted(r["split"] for r in none) == ["total", "train", "val"] and all(r["samples"] == 0 for r in none)
