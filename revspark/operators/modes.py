"""Per-split profile and the stage-mode rules.

The profile has one row per split; every rule reads a single row built
from it with conditional aggregates, so the rules are plain ``when``
chains over at most four split rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import splits

R = 6
SPLITS = ["train", "val", "test", "inference"]
# Fixed values of the rules: labelled file needs > 5 valid labels; SVM
# training needs > 10 valid training labels.
MIN_LABELLED_FILE = 5
MIN_SVM_LABELS = 10
# Fixed value: rows that must be left for training after the carve-out.
MIN_LEFT = 5


def split_profile(df: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """``(split, samples, has_labels, valid_labels, label_ratio, avg_text_length)``."""
    lab = F.col(label_col)
    return (df.groupBy("split").agg(
        F.count(F.lit(1)).alias("samples"),
        (F.count(lab) > 0).alias("has_labels"),
        F.sum(F.when(lab.isin(0, 1), 1).otherwise(0)).alias("valid_labels"),
        F.round(F.avg(F.length(F.col(text_col))), R).alias("avg_text_length"))
        .withColumn("label_ratio", F.round(F.col("valid_labels") / F.col("samples"), R)))


def training_stats(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Label distribution per split: ``(split, label, n)``."""
    return df.groupBy("split", F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def _flags(profile: DataFrame, by: tuple = ()) -> DataFrame:
    aggs = []
    for s in SPLITS:
        is_s = F.col("split") == s
        aggs += [F.max(F.when(is_s, 1).otherwise(0)).alias(f"has_{s}"),
                 F.max(F.when(is_s & F.col("has_labels"), 1).otherwise(0)).alias(f"lab_{s}"),
                 F.max(F.when(is_s, F.col("valid_labels")).otherwise(0)).alias(f"valid_{s}")]
    aggs += [F.sum(F.when(F.col("has_labels") & (F.col("valid_labels") > MIN_LABELLED_FILE), 1).otherwise(0))
             .alias("n_labelled_files"),
             F.sum(F.when(~F.col("has_labels"), 1).otherwise(0)).alias("n_unlabelled_files")]
    # of several labelled splits the largest one; the first name of equal ones
    file = F.col("has_labels") & (F.col("valid_labels") > MIN_LABELLED_FILE)
    aggs += [F.min(F.when(file, F.struct((-F.col("samples")).alias("n"), F.col("split").alias("split"))))["split"]
             .alias("largest_labelled"),
             F.min(F.when(~F.col("has_labels"), F.col("split"))).alias("first_unlabelled")]
    return profile.groupBy(*by).agg(*aggs)


def stage_modes(profile: DataFrame, models_found: int = 0, by: tuple = (), embedded: bool = False,
                force_inference: bool = False) -> DataFrame:
    """One row (per value of the columns ``by``): embedding-stage, SVM, MLP
    and report modes, the split used for evaluation, the splits recommended
    for embedding, the largest labelled split and the report's advice codes.

    ``embedded``: one embedded table with labels exists beside the splits;
    ``force_inference``: the embedding stage runs as inference on the splits
    it would have taken anyway."""
    f = _flags(profile, by)
    c = F.col
    train, val = c("lab_train") == 1, c("lab_val") == 1
    embed = (F.when(train & val, "training_standard").when(train, "training_single")
              .when(c("has_inference") == 1, "inference")
              .when((c("n_labelled_files") == 1) & ~train, "single_file_training")
              .when(c("n_unlabelled_files") >= 1, "inference_unlabeled")
              .when(c("n_labelled_files") > 1, "multi_file_training").otherwise("unknown"))
    has_train, has_val = c("has_train") == 1, c("has_val") == 1
    tested = F.when(c("has_test") == 1, F.array(F.lit("test"))).otherwise(F.array().cast("array<string>"))
    chosen = (F.when(embed == "training_standard", F.concat(F.array(F.lit("train"), F.lit("val")), tested))
               .when(embed == "training_single", F.concat(F.array(F.lit("train")), tested))
               .when(embed == "inference", F.array(F.lit("inference")))
               .when(embed.isin("single_file_training", "multi_file_training"), F.array("largest_labelled"))
               .when(embed == "inference_unlabeled", F.array("first_unlabelled")))
    if force_inference:
        embed = F.lit("inference")
    svm = (F.when(has_train & (c("valid_train") > MIN_SVM_LABELS), "training")
            .when(has_train, "insufficient_labels").when(c("has_inference") == 1, "inference")
            .when(c("has_test") == 1, "test_only").otherwise("no_files"))
    mlp = (F.when(has_train & has_val, "training_standard").when(has_train, "training_single")
            .when(F.lit(embedded), "training_embedded")
            .when(c("has_test") == 1, "inference_test").when(c("has_inference") == 1, "inference_only")
            .otherwise("unknown"))
    any_split = (c("has_train") + c("has_val") + c("has_test") + c("has_inference")) > 0
    test_data = (c("has_test") == 1) | (c("has_inference") == 1)
    m = F.lit(models_found > 0)
    report = (F.when(m & test_data & any_split, "full_evaluation").when(m & any_split, "model_evaluation")
               .when(test_data, "data_analysis").when(m, "model_summary").otherwise("minimal_report"))
    ev = (F.when(c("has_test") == 1, "test").when(c("has_inference") == 1, "inference")
           .when(c("has_train") == 1, "train").when(c("has_val") == 1, "val"))
    training_possible = F.when(svm == "training", True).otherwise(False)
    advice = F.array_compact(F.array(report, F.when(~m, "train_models"), F.when(~test_data, "add_test_data")))
    return f.select(*by, F.array_join(chosen, ",").alias("recommended_splits"), "largest_labelled",
                    F.array_join(advice, ",").alias("advice"), embed.alias("embed_mode"), svm.alias("svm_mode"), mlp.alias("mlp_mode"),
                    report.alias("report_mode"), ev.alias("eval_split"),
                    training_possible.alias("svm_training_possible"))


def training_data(df: DataFrame, label_col: str = "label", id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Train and val rows with a class, from a table with ``split``.  Without
    any val row a fifth of the train rows is carved out (stratified; random
    where a class is too small; the first fifth by id below 20 rows)."""
    rows = df.filter(F.col(label_col).isin(0, 1))
    train, val = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "val")
    if val.isEmpty() and not train.isEmpty():
        carved = splits.split(train.drop("split"), "train_val", label_col, id_col)
        train, val = (carved.filter(F.col("split") == s) for s in ("train", "val"))
    return train, val


def left_after_carving(n):
    """Rows left for training after the carve-out from ``n`` rows."""
    return F.when(n >= splits.SVM_MIN_SPLIT_ROWS, n - F.ceil(F.lit(splits.TRAIN_VAL[0]) * n)).otherwise(
        n - F.greatest(F.lit(1), F.floor(n / 5))).cast("long")


def training_data_stats(train: DataFrame, val: DataFrame, vec_col: str | None = "embedding", label_col: str = "label") -> DataFrame:
    """``(split, samples, feature_dim, label_set, n_negative, n_positive)`` of
    both parts and their ``total``; three rows whatever they hold."""
    n = F.count_if
    rows = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    width = F.max(F.size(vec_col)).cast("long") if vec_col else F.lit(None).cast("long")
    sums = [F.count(F.lit(1)).alias("samples"), width.alias("feature_dim"),
            F.array_join(F.array_sort(F.collect_set(F.col(label_col).cast("string"))), ",").alias("label_set"),
            n(F.col(label_col) == 0).alias("n_negative"), n(F.col(label_col) == 1).alias("n_positive")]
    parts = rows.groupBy("split").agg(*sums).unionByName(rows.agg(*sums).withColumn("split", F.lit("total")))
    listed = rows.sparkSession.createDataFrame([(s,) for s in ("train", "val", "total")], "split string")
    zero = {"samples": 0, "n_negative": 0, "n_positive": 0, "label_set": ""}
    return listed.join(F.broadcast(parts), "split", "left").fillna(zero)  # three rows


def training_status(stats_row: DataFrame, min_samples: int = 10, by: tuple = ()) -> DataFrame:
    """Skip-or-train decision before ``fit``: ``(status, reason)`` of each row.

    ``stats_row`` has ``valid_train`` and ``n_classes``, columns ``by`` and, where a part was
    carved out before, ``left_train``: fewer than ``MIN_LEFT`` rows left for
    training are too few.
    """
    c = F.col
    few = c("left_train") < MIN_LEFT if "left_train" in stats_row.columns else F.lit(False)
    status = F.when((c("valid_train") < min_samples) | (c("n_classes") < 2) | few, "skipped").otherwise("ready")
    reason = (F.when(c("valid_train") < min_samples, "insufficient_labels")
               .when(c("n_classes") < 2, "single_class").when(few, "training_set_too_small"))
    extra = ["left_train"] if "left_train" in stats_row.columns else []
    return stats_row.select(*by, "valid_train", "n_classes", *extra, status.alias("status"), reason.alias("reason"))
