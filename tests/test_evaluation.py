"""Metrics on a hand-checked example."""
import pytest

from revspark.operators import evaluation as EV


def test_metrics(spark):
    # label, prediction: TP=3 FN=1 FP=2 TN=4
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame([(i, "m", l, p) for i, (l, p) in enumerate(pairs)],
                               "id long, model string, label int, prediction int")
    m = EV.eval_metrics(df).first()
    assert m["accuracy"] == pytest.approx(0.7)
    p1, r1 = 3 / 5, 3 / 4
    p0, r0 = 4 / 5, 4 / 6
    f1 = 2 * p1 * r1 / (p1 + r1)
    f0 = 2 * p0 * r0 / (p0 + r0)
    assert m["f1_weighted"] == pytest.approx(round((f1 * 4 + f0 * 6) / 10, 6))
    cm = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion_matrix(df).collect()}
    assert cm == {(1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 4}
    assert sum(cm.values()) == len(pairs)


def test_best_model_tie_goes_to_first_listed(spark):
    metrics = spark.createDataFrame([("svm", 0.8, 0.7), ("mlp", 0.8, 0.6)], "model string, accuracy double, f1_weighted double")
    order = spark.createDataFrame([("mlp", 1), ("svm", 2)], "model string, model_order int")
    assert EV.best_model(metrics, order).first()["best_model"] == "mlp"


def test_quality_band(spark):
    metrics = spark.createDataFrame([("a", 0.9, 0.8), ("b", 0.6, 0.6), ("c", 0.5, 0.5)],
                                    "model string, accuracy double, f1_weighted double")
    got = {r["model"]: r["band"] for r in EV.quality_band(metrics).collect()}
    assert got == {"a": "excellent", "b": "sufficient", "c": "needs_improvement"}


def test_min_rows_guard(spark):
    from revspark.operators.quality import require_rows
    df = spark.createDataFrame([(1, "abc"), (2, "def")], "id long, text string")
    with pytest.raises(ValueError, match="are needed"):
        require_rows(df, 3)
    assert require_rows(df, 1) == 2
    with pytest.raises(ValueError, match="no usable text"):
        require_rows(df.filter("id > 5"), 1)


def test_insight_codes(spark):
    metrics = spark.createDataFrame([("a", 0.9, 0.8), ("b", 0.82, 0.8)], "model string, accuracy double, f1_weighted double")
    order = spark.createDataFrame([("a", 1), ("b", 2)], "model string, model_order int")
    test_rows = spark.createDataFrame([(10, False)], "samples long, labelled boolean")
    got = [r["code"] for r in EV.insights(metrics, order, test_rows, "data_analysis").orderBy("seq").collect()]
    assert got == ["multiple_models", "excellent_performance", "significant_gap", "test_data",
                   "test_unlabelled", "train_models"]


def test_a_model_without_scores_gets_an_error_row(spark):
    from revspark.operators import evaluation as EV
    scored = spark.createDataFrame([(1, "svm", 1, 1, "test"), (2, "svm", -1, 1, "test"), (3, "svm", 0, 0, "train")],
                                   "id long, model string, label int, prediction int, split string")
    profile = spark.createDataFrame([("test",), ("train",)], "split string")
    got = {r["model"]: (r["eval_split"], r["status"], r["n"]) for r in EV.evaluate_on(scored, profile, ["svm", "mlp"]).collect()}
    assert got == {"svm": ("test", "evaluated", 1), "mlp": ("test", "error", 0)}
    report = {r["row"]: r for r in EV.classification_report(scored.filter("label IN (0, 1)"), with_accuracy=True).collect()}
    assert report["accuracy"]["f1"] == 1.0 and report["accuracy"]["support"] == 2
