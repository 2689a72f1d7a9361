"""Golden vectors of the label mappers (FIXTURES §4)."""
import pytest
from pyspark.sql import functions as F

from revspark.functions.labels import normalize_label
from revspark.operators.filters import normalize_label_filter

# (input, standard, extended, strict)
GOLDEN = [
    (None, 0, -1, -1), ("Positive", 1, 1, 1), (" neg ", 0, 0, -1), ("love", -1, 1, -1),
    ("terrible", -1, 0, -1), ("neutral", 0, 0, -1), ("mixed", 0, 0, -1), ("0.5", 0, 0, -1),
    ("1.0", 1, 1, -1), ("5", 1, 1, -1), ("0.51", 1, 1, -1), ("inf", 1, 1, -1), ("TRUE", 1, 1, -1),
    ("-1", 0, 0, -1), ("nan", -1, -1, -1), ("yes", -1, -1, -1), ("", -1, -1, -1),
    ("5d", -1, -1, -1), ("0x1p3", -1, -1, -1), ("1_0", 1, 1, -1), ("1__0", -1, -1, -1), ("١٢", 1, 1, -1), ("٠", 0, 0, -1), ("0_2", 1, 1, -1),
]


@pytest.mark.parametrize("policy,col", [("standard", 1), ("extended", 2), ("strict", 3)])
def test_golden(spark, policy, col):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "id long, v string")
    out = {r["id"]: r["l"] for r in df.select("id", normalize_label(F.col("v"), policy).alias("l")).collect()}
    for i, g in enumerate(GOLDEN):
        assert out[i] == g[col], (policy, g[0], out[i])


def test_int_labels(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id long, v int")
    got = [r["l"] for r in df.orderBy("id").select(normalize_label(F.col("v"), "standard").alias("l")).collect()]
    assert got == [1, 0, 0]


def test_runner_filter(spark):
    df = spark.createDataFrame([(1, "positive"), (2, "neg"), (3, "Positive"), (4, "1"), (5, None)],
                               "id long, label_raw string")
    got = sorted((r["id"], r["label"]) for r in normalize_label_filter(df).collect())
    assert got == [(1, 1), (2, 0), (4, 1)]
