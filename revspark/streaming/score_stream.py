"""A saved model applied to a stream of texts.

Cleaning, vectors and scores are row-local, so the batch functions run
unchanged on a streaming frame.  The model is read once, checked against its
record, and broadcast; a restarted query goes on from its checkpoint, and the
file sink commits each batch exactly once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import embedding, filters
from ..operators.model_record import Model, load_model
from ..operators.network import Network, score_network
from ..operators.squared_hinge import score_linear


def score_texts(df: DataFrame, model: Model, name: str | None = None) -> DataFrame:
    """``(id, model, label, prediction, probability, raw_margin)`` of (id,
    text, label) rows, static or streaming; texts that the embedding filter
    leaves out, or without tokens, have no row."""
    texts = filters.valid_texts(df.select("id", "text", "label"), "embed")
    vectors = embedding.hash_embeddings(texts, keep=["label"], dim=model.architecture["input_dim"]).filter(F.col("embedding").isNotNull())
    score = score_network if isinstance(model, Network) else score_linear
    return score(model, vectors, name or model.architecture["model_type"])


def start_score_stream(spark: SparkSession, source_dir: str, schema: str, model_path: str, sink_path: str, checkpoint: str,
                       name: str | None = None, available_now: bool = True, files_per_trigger: int = 100):
    """Score the Parquet files of a folder, those there and, unless
    ``available_now``, those to come, into a Parquet sink."""
    model = load_model(spark, model_path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    writer = (score_texts(source, model, name).writeStream.format("parquet").option("path", sink_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
