"""The whole flow on one review table, as composable DataFrame steps.

reviews -> detect text/label columns -> clean (standard) -> map labels
(extended) -> length filter -> stratified split of the rows with a class,
the others are ``inference`` -> training data and status -> hashed vectors
(embed cleaning and length filter) -> SVM + network on train, val -> score
every row -> metrics, report rows, best model, texts with their scores.

A model whose training or scoring fails ends with an ``error`` row and its
message; the others go on.  Collected are planning facts only: class counts of
the split, the training size and width, the training status, the split names.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..operators import (detection, embedding, evaluation, filters, modes, network, quality, splits, squared_hinge,
                         training)
from ..operators.rows import attach_row
from ..session import ensure_checkpoint_dir, kept

MIN_ROWS = 3


def prepare(raw: DataFrame, key: str, force_text: str | None = None, force_label: str | None = None) -> dict:
    """Columns, processed rows and splits: the part that SQL can check.

    The key is no candidate for text or label.  A table without a label
    column has label -1 in every row.  Rows without a class never enter
    train, val or test: a table without any goes to ``inference`` whole."""
    detected = detection.detect_columns(raw, key, exclude=(key,))
    picks = detection.resolve_columns(raw, key, force_text, force_label, exclude=(key,))
    label = F.col(f"`{picks['label']}`") if picks.get("label") else F.lit(None).cast("string")
    base = raw.select(F.col(f"`{key}`").alias("id"), F.col(f"`{picks['text']}`").alias("text"), label.alias("label_raw"))
    processed = filters.with_labels(filters.valid_texts(base, "standard"), "extended").select("id", "text", "label")
    processed = kept(processed, "processed")  # cleaned once: counts, splits, profile and vectors read it
    labelled = filters.labelled_only(processed)
    rest = processed.filter(~F.col("label").isin(0, 1)).withColumn("split", F.lit("inference"))
    counts = splits.class_counts(labelled)
    if sum(c for _, c in counts) < MIN_ROWS:
        quality.require_rows(processed, MIN_ROWS)
        split = processed.withColumn("split", F.lit("inference"))
    else:
        split = splits.split(labelled, "standard").unionByName(rest)
    return {"detection": detected, "columns": picks, "processed": processed, "splits": split}


def fit_and_score(model: str, train: DataFrame, val: DataFrame, data: DataFrame, params: Row) -> DataFrame:
    """All rows of ``data`` scored by a newly trained model, with ``split``."""
    if model == "svm":
        fitted = squared_hinge.train_squared_hinge(train, C=float(params["C"]), max_iter=int(params["max_iter"]))
        return squared_hinge.score_linear(fitted, data, model, keep=("split",))
    if model == "mlp":
        fitted = network.train_network(train, val, [int(x) for x in params["hidden_dims"].split(",")], params["dropout"],
                                       params["learning_rate"], params["batch_size"], params["epochs"], params["patience"])
        return network.score_network(fitted, data, model, keep=("split",))
    raise ValueError(f"unknown model {model!r}")


def run_job(raw: DataFrame, key: str, models=("mlp", "svm"), force_text: str | None = None,
            force_label: str | None = None) -> dict[str, DataFrame]:
    spark = raw.sparkSession
    ensure_checkpoint_dir(spark)
    out = prepare(raw, key, force_text, force_label)
    split = out["splits"]
    profile = out["profile"] = modes.split_profile(split).checkpoint()  # four rows
    texts = filters.valid_texts(split.select("id", "label", "split", "text"), "embed")
    # vectors without text, scanned by every optimiser iteration: lineage is cut once
    data = embedding.hash_embeddings(texts, keep=["label", "split"]).filter(F.col("embedding").isNotNull()).checkpoint()
    train, val = modes.training_data(data)
    out["training_stats"] = modes.training_data_stats(train, val)
    whole = filters.labelled_only(data.filter(F.col("split") == "train"))  # before anything is carved out for validation
    facts = attach_row(whole.agg(F.count(F.lit(1)).alias("valid_train"), F.count_distinct("label").alias("n_classes")),
                       train.agg(F.count(F.lit(1)).alias("left_train")))
    out["status"] = modes.training_status(facts)
    ready = out["status"].first()["status"] == "ready"
    stats = training.feature_stats(train)
    out["svm_params"], out["mlp_params"] = training.svm_params(stats), training.mlp_params(stats)
    out["modes"] = modes.stage_modes(profile, models_found=len(models) if ready else 0)
    if not ready:
        return out
    scored, errors = None, {}
    for m in models:
        try:
            rows = fit_and_score(m, train, val, data, (out["svm_params"] if m == "svm" else out["mlp_params"]).first()).checkpoint()
        except InterruptedError:
            raise
        except Exception as e:  # noqa: BLE001 - one model's failure is a row of the result
            errors[m] = f"{type(e).__name__}: {e}"[:500]
            continue
        scored = rows if scored is None else scored.unionByName(rows)
    if scored is None:
        scored = spark.createDataFrame([], "id long, model string, label int, prediction int, probability double, raw_margin double, "
                                           "split string")
    evaluated = evaluation.evaluate_on(scored, profile, list(models), errors).checkpoint()  # a row per model
    order = spark.createDataFrame([(m, i + 1) for i, m in enumerate(models)], "model string, model_order int")
    on_split = scored.join(F.broadcast(evaluated.select("eval_split").distinct().withColumnRenamed("eval_split", "split")), "split")
    out.update({"scored": scored, "metrics": evaluated,
                "report": evaluation.classification_report(filters.labelled_only(on_split), with_accuracy=True),
                "best_model": evaluation.best_model(evaluated.select("model", "accuracy", "f1_weighted"), order),
                "reviews": filters.scored_reviews(split.select("id", "text", "label"), scored)})
    return out
