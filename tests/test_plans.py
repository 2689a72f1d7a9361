"""Plan-shape checks of the scale properties the README claims."""
import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_split_never_moves_the_text(spark):
    """Only ids of border buckets are ordered; no exchange carries the text."""
    from revspark.operators import splits
    df = spark.range(500).selectExpr("id", "cast(id % 2 as int) AS label", "repeat('x', 50) AS text").repartition(4)
    text = _plan(splits.split(df, "standard"), "extended").split("== Physical Plan ==")[1]
    windows = [ln for ln in text.splitlines() if "row_number()" in ln]
    assert windows and all("hb#" in ln for ln in windows), text[:2000]  # inside (class, bucket), never a whole class
    plan = _plan(splits.split(df, "standard"))
    moved = [blk for blk in plan.split("\n\n") if ") Exchange" in blk and "hashpartitioning" in blk]
    assert moved and not any("text#" in blk for blk in moved)


def test_split_cleans_once(spark):
    """Narrow rows are cleaned before the split; only a table with texts is cleaned once more to be assigned."""
    narrow = _plan(E.queries()["split_standard_reviews"](spark, SF001), "extended").split("== Physical Plan ==")[1]
    assert "regexp_replace" not in narrow
    from revspark.plans.ml_queries import split_reviews
    whole = _plan(split_reviews(spark, SF001), "extended").split("== Physical Plan ==")[1]
    assert whole.count("Scan parquet") <= 2  # the texts and the labels, one time each


def test_hashed_vectors_do_not_shuffle(spark):
    from revspark.operators import embedding
    df = spark.createDataFrame([(1, "a b a", 0), (2, "", 1), (3, None, 1)], "id long, text string, label int")
    out = embedding.hash_embeddings(df, keep=["label"])
    assert "Exchange" not in _plan(out)
    got = {r["id"]: r["embedding"] for r in out.collect()}
    assert got[2] is None and got[3] is None and abs(sum(x * x for x in got[1]) - 1) < 1e-6


def test_cleaning_not_copied_into_filters(spark):
    text = _plan(E.queries()["valid_texts_standard"](spark, SF001))
    filters = [blk for blk in text.split("\n\n") if blk.lstrip().startswith("(") and ") Filter" in blk]
    assert not any("regexp_replace" in blk for blk in filters)
    assert "Generate" in text


def test_label_only_queries_do_not_read_text(spark):
    text = _plan(E.queries()["labelled_only"](spark, SF001))
    schemas = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert schemas and all("text" not in ln for ln in schemas)


def test_top_words_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in _plan(E.queries()["top_words"](spark, SF001))


def test_duplicates_shuffle_digests(spark):
    from revspark.operators import filters, quality
    from revspark.sources.tables import table
    docs = table(spark, SF001, "documents").select(F.col("doc_id").alias("id"), "text")
    valid = filters.valid_texts(docs, "standard")
    assert "sha2" in _plan(quality.duplicate_texts(valid, cut_lineage=False), "extended")
    physical = _plan(quality.duplicate_texts(valid), "formatted")
    assert "ExistingRDD" in physical and "text" not in physical   # joins read (id, digest) only
