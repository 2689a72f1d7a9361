"""Encoders, vocabulary sketches, and a saved model on a stream."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from revspark.operators import corpus, embedding, filters, network, squared_hinge
from revspark.operators import model_record as MR
from revspark.sources.tables import table
from revspark.streaming.score_stream import score_texts, start_score_stream
from tests.conftest import SF001


def docs(spark, sf=SF001):
    return filters.valid_texts(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), "embed")


def test_stage_equals_the_native_vectors(spark):
    """Any order and batch size, long texts cut at 512 tokens."""
    rows = docs(spark)
    cut = rows.withColumn("text", embedding.truncated(F.col("text"), 512))
    want = {r["id"]: r["embedding"] for r in embedding.hash_embeddings(cut).collect()}
    for df, size in ((rows, 32), (rows.repartition(5).orderBy(F.desc("id")), 7)):
        vectors, record = embedding.embed_with(df, batch_size=size)
        got = {r["id"]: r["embedding"] for r in vectors.collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-6) for k in want if want[k] is not None)
    assert record["model_used"] == embedding.FALLBACK and record["model_requested"] == "all-MiniLM-L6-v2"
    assert "Error" in record["fallback_reason"]


def test_registry(spark, monkeypatch):
    def two():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])
    monkeypatch.setitem(embedding.ENCODERS, "two", two)
    assert embedding.find_encoder("two")[::2] == ("two", None)
    assert embedding.find_encoder("none of these")[2] == "unknown encoder 'none of these'"
    df = spark.createDataFrame([("a", "one two three"), ("b", ""), ("c", None)], "id string, text string")
    vectors, record = embedding.embed_with(df, "two", max_tokens=2)
    assert {r["id"]: r["embedding"][0] for r in vectors.collect()} == {"a": 7.0, "b": 0.0, "c": 0.0}
    assert record == {"model_requested": "two", "model_used": "two", "fallback_reason": None, "max_tokens": 2}


def test_sketches_merge(spark):
    words = spark.range(60_000).select((F.col("id") % 3).alias("part"), F.concat_ws(" ", (F.col("id") % 20_011).cast("string"), F.lit("a")).alias("text"))
    parts = corpus.vocabulary_sketches(words, ("part",)).checkpoint()
    whole = corpus.vocabulary_stats(words, approx=True).first()
    merged = corpus.merged_vocabulary(parts).first()
    assert whole == merged and whole["total_words"] == 120_000
    assert whole["unique_words"] == pytest.approx(20_012, rel=0.02)
    assert corpus.vocabulary_stats(words.limit(0), approx=True).first() == (0, 0)
    assert parts.select(F.max(F.octet_length("sketch"))).first()[0] < 40_000


@pytest.mark.parametrize("kind", ["svm", "mlp"])
def test_stream_scores_equal_batch_scores(spark, tmp_dir, kind):
    """Also after a restart between two sets of files."""
    rows = [(i, f"this film was {'good and fine' if i % 2 else 'bad and dull'} in part {i} of it", i % 2) for i in range(60)]
    rows += [(100, "", 1), (101, None, None), (102, "  ", 0)]
    texts = spark.createDataFrame(rows, "id long, text string, label int")
    vectors = embedding.hash_embeddings(filters.valid_texts(texts, "embed"), keep=["label"], dim=32).filter("embedding IS NOT NULL")
    model = (squared_hinge.train_squared_hinge(vectors) if kind == "svm" else
             network.train_network(vectors, vectors, [8], 0.1, 0.05, 16, epochs=3))
    MR.save_model(model, spark, f"{tmp_dir}/model")
    go = lambda: start_score_stream(spark, f"{tmp_dir}/in", "id long, text string, label int", f"{tmp_dir}/model",
                                    f"{tmp_dir}/out", f"{tmp_dir}/ckpt", kind).awaitTermination(300)
    texts.filter("id % 2 = 0").coalesce(1).write.parquet(f"{tmp_dir}/in")
    go()
    first = spark.read.parquet(f"{tmp_dir}/out").count()
    texts.filter("id % 2 = 1").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    go()
    stream = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out").collect()))
    batch = sorted(map(tuple, score_texts(texts, model, kind).collect()))
    assert 0 < first < len(stream) and len(stream) == len(batch) == 60
    for a, b in zip(stream, batch):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:])


def test_a_filter_on_the_vectors_sums_no_vector_up_again(spark):
    """The norm comes from the Arrow batches: no aggregate stands in the plan."""
    from revspark.operators import embedding

    df = spark.createDataFrame([(1, "one two two"), (2, ""), (3, None)], "id long, text string")
    rows = embedding.hash_embeddings(df).filter("embedding IS NOT NULL")
    assert "aggregate(" not in rows._jdf.queryExecution().optimizedPlan().toString()
    found = rows.collect()
    assert [r["id"] for r in found] == [1] and abs(sum(v * v for v in found[0]["embedding"]) - 1) < 1e-6


def test_tokens_are_looked_up_in_batches(spark, monkeypatch):
    """Every distinct token is hashed once in a while, none by an expression for each; blanks, bytes that are
    no text, texts without tokens and a full table of codes change nothing."""
    odd = [(1, "a b\x85c　d\x1ce a a"), (2, ""), (3, None), (4, " \t "), (5, "été 日本 \U0001f600 ﻿q"), (6, "x​y x")]
    odd += [(i, " ".join(f"w{i * j}" for j in range(i))) for i in range(7, 60)]
    df = spark.createDataFrame(odd, "id long, text string").repartition(2)
    broken = spark.sql("SELECT 99L AS id, CAST(x'61ff6220c328' AS STRING) AS text")
    assert "md5" not in embedding.hash_counts(df)._jdf.queryExecution().toString()

    def vector(text):
        out = [0] * 384
        for w in (text or "").split():
            h = hashlib.md5(w.encode()).hexdigest()
            out[int(h[:7], 16) % 384] += 1 if int(h[7], 16) < 8 else -1
        return out if (text or "").split() else None

    want = {i: vector(t) for i, t in [*odd, (99, "a�b �(")]}
    for rows, codes in ((1024, 1 << 18), (5, 3)):
        monkeypatch.setattr(embedding, "ROWS_AT_ONCE", rows)
        monkeypatch.setattr(embedding, "MAX_CODES", codes)
        got = {r["id"]: r["counts"] for r in embedding.hash_counts(df.union(broken)).collect()}
        assert got == want
    vectors = {r["id"]: r["embedding"] for r in embedding.hash_embeddings(df).collect()}
    for i, _ in odd:
        if want[i] is None or not any(want[i]):
            assert vectors[i] is None
        else:
            norm = sum(v * v for v in want[i]) ** 0.5
            assert vectors[i] == [float(np.float32(v / norm)) for v in want[i]]
