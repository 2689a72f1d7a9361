"""The whole job: which rows reach training, and tables it must survive."""
import pytest
from pyspark.sql import functions as F

from revspark.operators import squared_hinge
from revspark.plans import job
from tests.conftest import SF001


def _reviews(spark):
    rows = [(i, f"this film was {'good and fine' if i % 2 else 'bad and dull'} in part {i}", None if i % 3 == 0 else ["neg", "pos"][i % 2])
            for i in range(120)]
    return spark.createDataFrame(rows, "class_key long, body string, verdict string")


def test_no_unlabelled_row_reaches_fit(spark, monkeypatch):
    seen = []

    def fit(train, *args, **kwargs):
        seen.append({r["label"] for r in train.select("label").distinct().collect()})
        raise InterruptedError

    monkeypatch.setattr(squared_hinge, "train_squared_hinge", fit)
    with pytest.raises(InterruptedError):
        job.run_job(_reviews(spark), "class_key", models=("svm",), force_text="body", force_label="verdict")
    assert seen == [{0, 1}]
    splits = job.prepare(_reviews(spark), "class_key", "body", "verdict")["splits"]
    by = {(r["split"], r["label"]): r["count"] for r in splits.groupBy("split", "label").count().collect()}
    assert by[("inference", -1)] == 40 and all(lab in (0, 1) for s, lab in by if s != "inference")


def test_unlabelled_table_is_inference(spark):
    out = job.run_job(spark.read.parquet(f"{SF001}/benchmark.parquet"), "item_id")
    assert {r["split"] for r in out["splits"].collect()} == {"inference"}
    assert out["status"].first()["status"] == "skipped" and "scored" not in out


def test_trained_job(spark):
    out = job.run_job(_reviews(spark), "class_key", models=("svm",), force_text="body", force_label="verdict")
    m = out["metrics"].first()
    assert (m["eval_split"], m["status"]) == ("test", "evaluated") and m["accuracy"] > 0.9
    assert out["report"].filter(F.col("row") == "accuracy").count() == 1
    assert out["best_model"].first()["best_model"] == "svm"
