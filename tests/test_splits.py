"""Split sizes, class quotas, fallback and scale-independence (FIXTURES §6)."""
import pytest
from pyspark.sql import functions as F

from revspark.operators import splits


def _counts(df):
    return {(r["split"], r["label"]): r["n"] for r in df.groupBy("split", "label").agg(F.count("*").alias("n")).collect()}


def _frame(spark, labels):
    return spark.createDataFrame([(i, lab) for i, lab in enumerate(labels)], "id long, label int")


def test_labels_table_golden(spark):
    from tests.conftest import SF01
    df = spark.read.parquet(f"{SF01}/labels.parquet").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    c = _counts(splits.split(df, "standard"))
    assert (c[("train", 0)], c[("train", 1)]) == (41, 238)
    assert (c[("val", 0)], c[("val", 1)]) == (9, 51)
    assert (c[("test", 0)], c[("test", 1)]) == (8, 52)


def test_fewer_than_three_rows(spark):
    with pytest.raises(ValueError, match="at least 3 rows"):
        splits.split(_frame(spark, [0, 1]), "standard")


def test_null_labels_are_a_stratum(spark):
    out = splits.split(_frame(spark, [0, 1, None, 1] * 30), "standard", with_strategy=True)
    c = _counts(out)
    assert sum(c.values()) == 120 and c[("train", None)] == 21 and c[("train", 1)] == 42
    assert {r["strategy"] for r in out.collect()} == {"train_val_test"}


@pytest.mark.parametrize("n,expected", [(9, {"train": 6, "test": 3}), (20, {"train": 12, "val": 4, "test": 4}),
                                        (50, {"train": 35, "val": 7, "test": 8})])
def test_standard_sizes(spark, n, expected):
    out = splits.split(_frame(spark, [i % 2 for i in range(n)]), "standard")
    got = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == expected


def test_extended_small_copies_test_to_val(spark):
    out = splits.split(_frame(spark, [i % 2 for i in range(50)]), "extended")
    got = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 35, "test": 15, "val": 15}
    v = {r["id"] for r in out.filter("split = 'val'").collect()}
    t = {r["id"] for r in out.filter("split = 'test'").collect()}
    assert v == t


def test_extended_and_runner_inference(spark):
    assert {r["split"] for r in splits.split(_frame(spark, [0, 1] * 4 + [1]), "extended").collect()} == {"inference"}
    assert {r["split"] for r in splits.split(_frame(spark, [0, 1] * 25), "runner").collect()} == {"inference"}
    assert {r["split"] for r in splits.split(_frame(spark, [-1] * 30), "standard").collect()} == {"inference"}


def test_fallback_random_when_class_has_one_row(spark):
    out = splits.split(_frame(spark, [0] * 59 + [1]), "standard")
    got = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 42, "val": 9, "test": 9}


def test_disjoint_cover_and_bucket_independence(spark):
    df = _frame(spark, [i % 3 - 1 for i in range(1000)])
    a = splits.split(df, "standard")
    b = splits.split(df, "standard", rows_per_bucket=37)   # many hash buckets
    ra = {r["id"]: r["split"] for r in a.collect()}
    rb = {r["id"]: r["split"] for r in b.collect()}
    assert len(ra) == 1000 and ra == rb


def test_approximate_mode_ties_to_smaller_label():
    assert splits.approximate_mode([(0, 17), (1, 103)], 60) == {0: 9, 1: 51}


def test_train_val_small_rules(spark):
    svm = splits.split(_frame(spark, [0, 1] * 6), "train_val")       # 12 rows < 20
    got = {r["split"]: r["n"] for r in svm.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"val": 2, "train": 10}
    assert {r["id"] for r in svm.filter("split = 'val'").collect()} == {0, 1}
    mlp = splits.split(_frame(spark, [0, 1, 0, 1, 0, 1]), "train_val_mlp")   # 6 rows < min_samples
    got = {r["split"]: r["n"] for r in mlp.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 6, "val": 5}
    big = splits.split(_frame(spark, [0, 1, -1] * 20), "train_val_mlp")    # 40 labelled
    got = {r["split"]: r["n"] for r in big.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 32, "val": 8}
