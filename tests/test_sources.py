"""CSV fixtures written to a temp dir (FIXTURES §1)."""
import os

import pytest

from revspark.sources import csv


def _write(dir_, name, content, encoding="utf-8"):
    p = os.path.join(dir_, name)
    with open(p, "w", encoding=encoding, newline="") as f:
        f.write(content)
    return p


@pytest.mark.parametrize("sep", [",", ";", "\t"])
def test_separators_most_columns(spark, tmp_dir, sep):
    p = _write(tmp_dir, "a.csv", f"text{sep}label\nI loved this movie!{sep}positive\nTerrible acting and boring.{sep}negative\n")
    df = csv.read_reviews(spark, p, "most_columns")
    assert df.columns == ["text", "label"]
    assert sorted(r["label"] for r in df.collect()) == ["negative", "positive"]


def test_semicolon_file_reads_as_one_column_in_reference_order(spark, tmp_dir):
    p = _write(tmp_dir, "b.csv", "text;label\nnice;1\nbad;0\n")
    assert len(csv.read_reviews(spark, p, "reference_order").columns) == 1


def test_latin1_and_quoted_newline(spark, tmp_dir):
    p = _write(tmp_dir, "c.csv", 'text,label\n"un café ""très"" bon\nvraiment",1\n', encoding="latin-1")
    df = csv.read_reviews(spark, p)
    row = df.first()
    assert row["text"] == 'un café "très" bon\nvraiment' and row["label"] == "1"


def test_na_values_and_header_only(spark, tmp_dir):
    p = _write(tmp_dir, "d.csv", "text,label\nhello world,NA\n")
    assert csv.read_reviews(spark, p).first()["label"] is None
    h = _write(tmp_dir, "e.csv", "text,label\n")
    with pytest.raises(ValueError):
        csv.read_reviews(spark, h)


def test_header_normalisation(spark):
    df = spark.createDataFrame([(1, "x", " Positive ")], "`Review ID` long, `Content` string, `Sentiment` string")
    out = csv.normalize_headers(df)
    assert out.columns == ["text id", "text", "label"] and out.first()["label"] == "1"
    ex = csv.normalize_headers_exact(spark.createDataFrame([(1, "x", "1")], "id long, review string, class string"))
    assert ex.columns == ["id", "text", "label"]
    with pytest.raises(ValueError):
        csv.normalize_headers(spark.createDataFrame([("a", "b")], "review string, content string"))


@pytest.mark.parametrize("sep", [";", "\t"])
def test_latin1_other_separators(spark, tmp_dir, sep):
    p = _write(tmp_dir, "l.csv", f"text{sep}label\nun café, très bon{sep}1\nmauvais, élu{sep}0\n", encoding="latin-1")
    layout = csv.find_layout(spark, p, "most_columns")
    assert (layout["encoding"], layout["sep"], layout["columns"]) == ("iso-8859-1", sep, ["text", "label"])
    assert csv.read_reviews(spark, p, "most_columns").first()["text"] == "un café, très bon"


def test_short_and_long_rows(spark, tmp_dir):
    p = _write(tmp_dir, "s.csv", "a,b,c\n1,2,3\n4,5\n")
    got = csv.read_reviews(spark, p)
    assert got.columns == ["a", "b", "c"] and sorted(tuple(r) for r in got.collect()) == [("1", "2", "3"), ("4", "5", None)]
    p = _write(tmp_dir, "t.csv", "a,b\n1,2,3\n")
    with pytest.raises(ValueError):
        csv.read_reviews(spark, p, "simple")


def test_genuine_replacement_character_is_utf8(spark, tmp_dir):
    p = _write(tmp_dir, "u.csv", "text,label\nbad \ufffd but café,1\n")
    assert csv.find_layout(spark, p)["encoding"] == "utf-8"
    assert csv.read_reviews(spark, p).first()["text"] == "bad \ufffd but café"


def test_missing_path_is_its_own_error(spark, tmp_dir):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        csv.read_reviews(spark, os.path.join(tmp_dir, "none.csv"))


def test_label_white_space(spark):
    df = spark.createDataFrame([("x", "positive\t"), ("y", "\u00a0neg\n")], "text string, label string")
    assert [r["label"] for r in csv.normalize_headers(df).orderBy("text").collect()] == ["1", "0"]


def test_writers_check_what_they_wrote(spark, tmp_dir):
    from revspark.sources import sinks
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "id long, split string")
    got = {r["split"]: r["n"] for r in sinks.write_splits(df, os.path.join(tmp_dir, "w")).collect()}
    assert got == {"train": 2, "test": 1}
    with pytest.raises(ValueError, match="expected"):
        sinks.write_splits(df, os.path.join(tmp_dir, "v"), expected=4)


@pytest.mark.parametrize("folder", [False, True])
def test_stream_of_a_table_in_one_file_or_a_folder_of_files(spark, tmp_dir, folder):
    import pandas as pd

    from revspark.plans.io_queries import stream_clean
    path = os.path.join(tmp_dir, "documents.parquet")
    if folder:
        spark.createDataFrame([(i, f"text number {i}") for i in range(7)], "doc_id long, text string").repartition(3).write.parquet(path)
    else:
        pd.DataFrame([(i, f"text number {i}") for i in range(7)], columns=["doc_id", "text"]).to_parquet(path)
    pd.DataFrame([(1, 1), (2, 0)], columns=["doc_id", "quality"]).to_parquet(os.path.join(tmp_dir, "labels.parquet"))
    pd.DataFrame([(9, "another table")], columns=["doc_id", "text"]).to_parquet(os.path.join(tmp_dir, "benchmark.parquet"))
    rows = {tuple(r) for r in stream_clean(spark, tmp_dir).select("id", "text", "label").collect()}
    assert rows == {(i, f"text number {i}", 1 if i == 1 else 0) for i in range(7)}


def test_windows_source_is_cut_fast(spark):
    """The class of read_reviews_windows takes the characters of its SQL, and asks ASCII once."""
    import time

    from pyspark.sql import functions as F

    from revspark.plans import io_queries as Q

    every = spark.range(0x80, 0x110000).filter("id NOT BETWEEN 55296 AND 57343 AND id <> 65279").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c")).unionByName(spark.range(128).select(F.char("id").alias("c")))
    count = lambda p: F.count_if(F.col("c").rlike(p))
    row = every.agg(count(Q._OTHER).alias("a"), count(Q._OTHER_JAVA).alias("b"),
                    F.count_if(F.col("c").rlike(Q._OTHER) != F.col("c").rlike(Q._OTHER_JAVA)).alias("d")).first()
    assert row["a"] == row["b"] == 0x110000 - 2048 - 1 - 128 - 96 - 27 and row["d"] == 0
    plan = Q.read_reviews_windows.__code__.co_names
    assert "_OTHER_JAVA" in plan and "_OTHER" not in plan
    texts = spark.range(2000, numPartitions=4).select(F.repeat(F.concat(F.lit("plain words "), "id"), 300).alias("c")).cache()
    texts.count()
    took = []
    for pattern in (Q._OTHER, Q._OTHER_JAVA) * 2:
        begun = time.perf_counter()
        texts.agg(F.sum(F.length(F.regexp_replace("c", pattern, "?")))).first()
        took.append(time.perf_counter() - begun)
    assert took[3] < took[2] / 2
