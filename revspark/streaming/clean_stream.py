"""Cleaning and label mapping on a stream.

Cleaning, label mapping and the length filter are row-local, so the same
DataFrame functions run unchanged on a streaming DataFrame.  Labels are a
static table joined to the stream (stream-static left outer join; no state
is kept).  Progress lives in the checkpoint folder, so a restarted query
resumes where it stopped and the file sink commits each batch exactly once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters


def clean_stream_frame(stream: DataFrame, labels: DataFrame, policy: str = "standard",
                       label_policy: str = "standard") -> DataFrame:
    """``(id, text, label)`` of a stream of ``(id, text)`` rows."""
    df = stream.join(labels, "id", "left")
    df = filters.valid_texts(df, policy)
    return filters.with_labels(df, label_policy).select("id", "text", "label")


def start_clean_stream(spark: SparkSession, source_dir: str, file_glob: str, labels: DataFrame,
                       sink_path: str, checkpoint: str, available_now: bool = True,
                       policy: str = "standard"):
    """Start the cleaning stream from Parquet files to a Parquet sink.

    ``file_glob`` selects the files of ``source_dir`` (e.g. the documents
    table), or folders of such files.  With ``available_now`` the query
    processes what is there and stops.
    """
    path = f"{source_dir.rstrip('/')}/{file_glob}"
    schema = spark.read.parquet(path).schema
    if not any(c in file_glob for c in "*?[{"):
        # a stream's path is a folder or a pattern: the pattern of this one name, be it a file or a folder
        path = f"{path[:-1]}[{path[-1]}]"
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(path)
                .select(F.col("doc_id").alias("id"), "text"))
    out = clean_stream_frame(src, labels, policy)
    w = (out.writeStream.format("parquet").option("path", sink_path)
            .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
