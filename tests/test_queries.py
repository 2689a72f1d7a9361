"""Every registered query matches its SQL at sf0.001, or gives rows where it has none; batch == stream; results do not
depend on the shuffle partition count."""
import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001
from tools.check import digest

SLOW = {"job_metrics", "evaluate_trained_models", "save_load_model", "train_svm", "train_mlp", "training_history"}


ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{SF001}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, key):
    df = E.queries()[key](spark, SF001)
    assert len(df.columns) == len(set(df.columns))
    got = digest(df.columns, [tuple(r) for r in df.collect()])[1]
    want = duck.execute(ORACLES[key])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == digest(columns, want.fetchall())[1]


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if k not in ORACLES and k not in SLOW))
def test_query_without_sql_gives_rows(spark, key):
    df = E.queries()[key](spark, SF001)
    assert df.count() > 0
    assert len(df.columns) == len(set(df.columns))


@pytest.mark.parametrize("key", sorted(SLOW))
def test_training_query_gives_rows(spark, key):
    rows = E.queries()[key](spark, SF001).collect()
    assert rows and all(r["same"] for r in rows if "same" in r.asDict())
    if key == "job_metrics":
        assert {(r["model"], r["status"]) for r in rows} == {("mlp", "evaluated"), ("svm", "evaluated")}


def test_entry(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"label", "n", "avg_length", "avg_words"} and df.count() >= 1


def test_every_oracle_has_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stream_equals_batch(spark):
    q = E.queries()
    a = {tuple(r) for r in q["stream_clean"](spark, SF001).select("id", "text", "label").collect()}
    from revspark.operators import filters
    from revspark.sources.tables import reviews
    b = filters.with_labels(filters.valid_texts(reviews(spark, SF001), "standard"), "standard")
    assert a == {tuple(r) for r in b.select("id", "text", "label").collect()}


def test_shuffle_partitions_independent(spark):
    q = E.queries()
    keys = ["top_words", "split_standard_reviews", "duplicate_texts", "length_histogram"]
    first = {k: sorted(map(tuple, q[k](spark, SF001).collect())) for k in keys}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        for k in keys:
            assert sorted(map(tuple, q[k](spark, SF001).collect())) == first[k], k
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_input_order_independent(spark):
    from revspark.operators import corpus, filters, splits
    from revspark.sources.tables import reviews
    base = filters.with_labels(filters.valid_texts(reviews(spark, SF001), "standard"), "standard")
    shuffled = base.orderBy(F.col("id").desc()).repartition(5)
    a = {r["id"]: r["split"] for r in splits.split(base.select("id", "label"), "standard").collect()}
    b = {r["id"]: r["split"] for r in splits.split(shuffled.select("id", "label"), "standard").collect()}
    assert a == b
    wa = sorted(map(tuple, corpus.top_words(base).collect()))
    wb = sorted(map(tuple, corpus.top_words(shuffled).collect()))
    assert wa == wb
