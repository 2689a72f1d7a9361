"""Evaluation of scored reviews.

Input: a scored table ``(id, model, label, prediction[, probability])``
with binary labels.  Every metric derives from one row of four counts per
model: one aggregate with map-side partial sums, one shuffle of a row per
model and task.  The confusion grid, the class metrics, the report and the
averages are expressions over that row.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

R = 6
# Class names and quality / accuracy bands.
CLASS_NAMES = {0: "Negative", 1: "Positive"}
QUALITY_BANDS = [(0.8, "excellent"), (0.7, "good"), (0.6, "sufficient")]
ACCURACY_BANDS = [(0.85, "excellent_performance"), (0.80, "good_performance"),
                  (0.75, "acceptable_performance")]
GAP = 0.05
REPORT_MODE_ADVICE = {"minimal_report": "limited_analysis", "data_analysis": "train_models"}


def counts(scored: DataFrame) -> DataFrame:
    """``(model, tp, fp, fn, tn)`` with class 1 as positive; rows with another
    label or prediction than 0 or 1 count nowhere."""
    def cell(label, prediction):
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))
    return scored.groupBy("model").agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
                                       cell(0, 0).alias("tn"))


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _classes(m: DataFrame) -> DataFrame:
    """``counts`` with ``c0`` and ``c1``: precision, recall, f1 (0 where
    undefined) and support of each class."""
    def metrics(hit, wrong, missed):
        p, r = _ratio(F.col(hit), F.col(hit) + F.col(wrong)), _ratio(F.col(hit), F.col(hit) + F.col(missed))
        return F.struct(p.alias("precision"), r.alias("recall"), _ratio(2 * p * r, p + r).alias("f1"),
                        (F.col(hit) + F.col(missed)).alias("support"))
    return m.withColumn("c0", metrics("tn", "fn", "fp")).withColumn("c1", metrics("tp", "fp", "fn"))


def _average(name: str, weighted: bool):
    a, b = F.col(f"c0.{name}"), F.col(f"c1.{name}")
    if not weighted:
        return (a + b) / 2
    n, k = F.col("c0.support"), F.col("c1.support")
    return (a * n + b * k) / F.nullif(n + k, F.lit(0))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """``(model, label, prediction, n)`` over the full 2 x 2 grid."""
    grid = F.array(*[F.struct(F.lit(lab).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n"))
                     for lab, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return counts(scored).select("model", F.explode(grid).alias("g")).select("model", "g.*")


def eval_metrics(scored: DataFrame, eval_split: str = "test") -> DataFrame:
    """``(model, eval_split, n, accuracy, f1_weighted)`` per model."""
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return _classes(counts(scored)).select(
        "model", F.lit(eval_split).alias("eval_split"), n.alias("n"),
        F.round((F.col("tp") + F.col("tn")) / F.nullif(n, F.lit(0)), R).alias("accuracy"),
        F.round(_average("f1", True), R).alias("f1_weighted"))


def classification_report(scored: DataFrame, with_accuracy: bool = False) -> DataFrame:
    """Rows per class (Negative / Positive) plus macro and weighted averages;
    ``with_accuracy`` adds the accuracy row (accuracy in the f1 column)."""
    names = ("precision", "recall", "f1", "support")
    total = F.col("c0.support") + F.col("c1.support")

    def row(title, values):
        return F.struct(F.lit(title).alias("row"), *[F.round(v.cast("double"), R).alias(n) for v, n in zip(values, names[:3])],
                        values[3].cast("long").alias("support"))
    rows = [row(CLASS_NAMES[c], [F.col(f"c{c}.{n}") for n in names]) for c in (0, 1)]
    if with_accuracy:
        none = F.lit(None).cast("double")
        rows.append(row("accuracy", [none, none, (F.col("tp") + F.col("tn")) / F.nullif(total, F.lit(0)), total]))
    rows += [row(title, [*[_average(n, w) for n in names[:3]], total])
             for title, w in (("macro avg", False), ("weighted avg", True))]
    return _classes(counts(scored)).select("model", F.explode(F.array(*rows)).alias("r")).select("model", "r.*")


def evaluate_on(scored: DataFrame, profile: DataFrame, models: list[str], errors: dict[str, str] | None = None) -> DataFrame:
    """Metrics of every model of the list on the evaluation split (the first
    present of test, inference, train, val), valid labels only: ``(model,
    eval_split, status, reason, n, accuracy, f1_weighted)``.  A model without
    scored valid rows gets an ``error`` row, so none is missing from the
    result; ``errors`` has the messages of those that failed.  ``scored`` has
    the column ``split``."""
    order = {s: i for i, s in enumerate(("test", "inference", "train", "val"))}
    present = [r["split"] for r in profile.select("split").distinct().collect()]  # at most four rows
    chosen = min((s for s in present if s in order), key=order.__getitem__, default=None)
    valid = scored.filter((F.col("split") == chosen) & F.col("label").isin(0, 1))
    found = eval_metrics(valid, chosen).drop("eval_split")
    listed = scored.sparkSession.createDataFrame([(m, (errors or {}).get(m)) for m in models], "model string, error string")
    good = F.col("n") > 0
    return listed.join(found, "model", "left").select(
        "model", F.lit(chosen).cast("string").alias("eval_split"), F.when(good, "evaluated").otherwise("error").alias("status"),
        F.when(~F.coalesce(good, F.lit(False)), F.coalesce("error", F.lit("no_valid_rows"))).alias("reason"), F.coalesce("n", F.lit(0)).alias("n"), "accuracy", "f1_weighted")


def best_model(metrics: DataFrame, model_order: DataFrame) -> DataFrame:
    """Best model by accuracy; the first listed model wins ties.

    ``model_order``: ``(model, model_order)`` of all models found, one row
    per model.  One aggregate over the metrics, no window.
    """
    known = metrics.join(F.broadcast(model_order), "model", "right")  # one row per model
    best = F.max_by(F.struct("model", "accuracy", "f1_weighted"),
                    F.when(F.col("accuracy").isNotNull(), F.struct("accuracy", (-F.col("model_order")).alias("o"))))
    return known.agg(F.count(F.lit(1)).alias("models_found"), F.count("accuracy").alias("models_evaluated"),
                     best.alias("b")).select("models_found", "models_evaluated", F.col("b.model").alias("best_model"),
                                             F.col("b.accuracy").alias("best_accuracy"), F.col("b.f1_weighted").alias("best_f1"))


def quality_band(metrics: DataFrame) -> DataFrame:
    """Dashboard quality band of (accuracy + F1) / 2 per model."""
    score = (F.col("accuracy") + F.col("f1_weighted")) / 2
    band = F.lit("needs_improvement")
    for lo, name in reversed(QUALITY_BANDS):
        band = F.when(score >= lo, F.lit(name)).otherwise(band)
    band = F.when((F.col("accuracy") > 0) & (F.col("f1_weighted") > 0), band)
    return metrics.select("model", F.round(score, R).alias("quality_score"), band.alias("band"))


def _item(seq, code, value):
    return F.struct(F.lit(seq).alias("seq"), code.cast("string").alias("code"), value.cast("double").alias("value"))


def insights(metrics: DataFrame, model_order: DataFrame, test_rows: DataFrame,
             report_mode: str | None = None) -> DataFrame:
    """Insight codes of the report: model availability, accuracy band, gap
    between models, test data, and a recommendation for the limited report
    modes.  ``test_rows``: one row ``(samples, labelled)``; ``report_mode``
    as computed by ``modes.stage_modes``."""
    s = (model_order.agg(F.count(F.lit(1)).alias("found"))
         .withColumn("__k", F.lit(1))
         .join(metrics.agg(F.max("accuracy").alias("best"), F.min("accuracy").alias("worst"),
                           F.count(F.lit(1)).alias("evaluated")).withColumn("__k", F.lit(1)), "__k")
         .join(test_rows.withColumn("__k", F.lit(1)), "__k", "left").drop("__k"))
    acc_band = F.lit("below_expectations")
    for lo, name in reversed(ACCURACY_BANDS):
        acc_band = F.when(F.col("best") >= lo, F.lit(name)).otherwise(acc_band)
    items = F.array(
        _item(1, F.when(F.col("found") == 0, "no_models").when(F.col("found") == 1, "single_model")
                 .otherwise("multiple_models"), F.col("found")),
        _item(2, F.when(F.col("evaluated") > 0, acc_band), F.col("best")),
        _item(3, F.when(F.col("evaluated") > 1,
                        F.when(F.col("best") - F.col("worst") > GAP, "significant_gap")
                         .otherwise("similar_performance")),
              F.round(F.col("best") - F.col("worst"), R)),
        _item(4, F.when(F.col("samples").isNotNull(), "test_data").otherwise("no_test_data"),
              F.col("samples").cast("double")),
        _item(5, F.when(F.col("samples").isNotNull() & ~F.col("labelled"), "test_unlabelled"),
              F.lit(None).cast("double")),
        _item(6, F.lit(REPORT_MODE_ADVICE.get(report_mode)), F.lit(None).cast("double")))
    return (s.select(F.explode(items).alias("i")).select("i.*")
             .toDF("seq", "code", "value").filter(F.col("code").isNotNull()))


def model_comparison(metrics: DataFrame, models: list[str] | None = None) -> DataFrame:
    """Metric rows side by side: ``(metric, <model columns>)``, always one row
    for each of the two metrics.

    ``models`` fixes the output columns (a model without metrics gives
    nulls); without it the models present in ``metrics`` are used.  One
    aggregate without a key, so a table without any metrics gives nulls."""
    if models is None:  # one row per model: a small collect
        models = [r[0] for r in metrics.select("model").distinct().orderBy("model").collect()]
    names = ("accuracy", "f1_weighted")
    one = metrics.agg(*[F.max(F.when(F.col("model") == m, F.col(n))).alias(f"{n}_{i}")
                        for n in names for i, m in enumerate(models)], F.count(F.lit(1)).alias("__n"))
    rows = [F.struct(F.lit(n).alias("metric"), *[F.col(f"{n}_{i}").alias(m) for i, m in enumerate(models)]) for n in names]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
