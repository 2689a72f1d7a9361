"""Queries of the readers, writers, the stream and the whole job.

Writers and the stream write below the session's shared checkpoint folder
(``spark.checkpoint.dir``) and read back what they wrote; each run uses a
fresh sub-folder.
"""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import documents
from ..operators import filters
from ..operators import embedding as EM
from ..operators.rows import attach_row
from ..session import scratch_path
from ..sources import csv, positions, sinks, stages
from ..sources.tables import reviews, table
from ..streaming.clean_stream import start_clean_stream
from .ml_queries import SPLIT_STD_SQL, split_reviews
from .oracle_text import cleaned_cte
from .registry import query
from .split_queries import STANDARD_GUARD, STANDARD_R1, STANDARD_R2, split_sql
from .text_queries import REVIEWS_SQL, _label_sql


def _fresh(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


RAW_REVIEWS_SQL = ("SELECT CAST(d.doc_id AS VARCHAR) AS id, d.text, CAST(l.quality AS VARCHAR) AS label "
                   "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")


@query("read_reviews", RAW_REVIEWS_SQL)
def read_reviews(spark, sf):
    """Reviews written as a ``;`` CSV, read back with the candidate list
    (``most_columns``: the ``;`` candidate wins)."""
    path = _fresh(spark, "reviews-csv")
    src = reviews(spark, sf).select(F.col("id").cast("string").alias("id"), "text",
                                    F.col("label_raw").cast("string").alias("label"))
    csv.write_reviews_csv(src, path, sep=";")
    return csv.read_reviews(spark, path, "most_columns")


def _policy_query(policy):
    def run(spark, sf):
        path = _fresh(spark, f"reviews-{policy}")
        src = reviews(spark, sf).select(F.col("id").cast("string").alias("id"), "text",
                                        F.col("label_raw").cast("string").alias("label"))
        csv.write_reviews_csv(src, path)
        return csv.read_reviews(spark, path, policy)
    return run


for _p in ("reference_order", "extended", "simple"):
    query(f"read_reviews_{_p}", RAW_REVIEWS_SQL)(_policy_query(_p))


@query("read_reviews_auto", RAW_REVIEWS_SQL)
def read_reviews_auto(spark, sf):
    """Reviews written with tabs; encoding and separator from the profile."""
    path = _fresh(spark, "reviews-auto")
    src = reviews(spark, sf).select(F.col("id").cast("string").alias("id"), "text",
                                    F.col("label_raw").cast("string").alias("label"))
    csv.write_reviews_csv(src, path, sep="\t")
    return csv.read_reviews(spark, path, "auto")


_OTHER = "[^\\x00-\\x7f\\x{a0}-\\x{ff}" + "".join(f"\\x{{{ord(c):x}}}" for c in csv.CP1252.values()) + "]"
#: The same characters for Java, which asks every character for all parts of a long class: ASCII is told by the first part.
_OTHER_JAVA = f"[\\x{{80}}-\\x{{10ffff}}&&{_OTHER}]"


@query("read_reviews_windows",
       RAW_REVIEWS_SQL.replace("d.text", f"regexp_replace('“' || d.text || '” 5 €', '{_OTHER}', '?', 'g') AS text"))
def read_reviews_windows(spark, sf):
    """Reviews in cp1252 bytes (curly quotes and a euro sign put around every
    text), which no UTF-8 or Latin-1 reader gets right."""
    path = _fresh(spark, "reviews-windows")
    text = F.regexp_replace(F.concat(F.lit("“"), "text", F.lit("” 5 €")), _OTHER_JAVA, "?")
    control = F.translate(text, "".join(csv.CP1252.values()), "".join(map(chr, csv.CP1252)))
    src = reviews(spark, sf).select(F.col("id").cast("string").alias("id"), control.alias("text"),
                                    F.col("label_raw").cast("string").alias("label"))
    csv.write_reviews_csv(src, path, encoding="iso-8859-1")
    return csv.read_reviews(spark, path, "auto")


HEADER_SRC_SQL = ("SELECT d.doc_id AS \" Review_ID\", d.text AS \"Review Content\", l.quality AS \"Sentiment\" "
                  "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")


def _header_src(spark, sf):
    return reviews(spark, sf).select(F.col("id").alias(" Review_ID"), F.col("text").alias("Review Content"),
                                     F.col("label_raw").alias("Sentiment"))


@query("normalize_headers",
       "SELECT \" Review_ID\" AS text_id, \"Review Content\" AS \"text text\", "
       "CASE lower(trim(coalesce(CAST(\"Sentiment\" AS VARCHAR), 'nan'))) WHEN 'positive' THEN '1' WHEN 'pos' THEN '1' "
       "WHEN 'negative' THEN '0' WHEN 'neg' THEN '0' ELSE lower(trim(coalesce(CAST(\"Sentiment\" AS VARCHAR), 'nan'))) END "
       f"AS label FROM ({HEADER_SRC_SQL})")
def normalize_headers(spark, sf):
    return csv.normalize_headers(_header_src(spark, sf))


@query("normalize_headers_exact",
       "SELECT \" Review_ID\" AS review_id, \"Review Content\" AS \"review content\", \"Sentiment\" AS label, "
       f"\"Review Content\" AS text FROM ({HEADER_SRC_SQL})")
def normalize_headers_exact(spark, sf):
    return csv.normalize_headers_exact(_header_src(spark, sf))


@query("write_splits", f"SELECT split, count(*) AS n FROM ({SPLIT_STD_SQL}) GROUP BY split")
def write_splits(spark, sf):
    return sinks.write_splits(split_reviews(spark, sf), _fresh(spark, "splits"))


@query("write_embeddings",
       "SELECT count(*) AS rows, max(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim, "
       "CAST(0 AS BIGINT) AS null_vectors FROM embeddings")
def write_embeddings(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    back = sinks.write_embeddings(e, _fresh(spark, "embeddings"))
    return EM.embedding_profile(back)


_STD = cleaned_cte(REVIEWS_SQL, "standard", keep="id, label_raw")


@query("preprocess_metadata",
       f"WITH {_STD[0]}, v AS (SELECT t, CAST({_label_sql('standard')} AS INTEGER) AS label, length(t) >= 3 AS ok FROM c), "
       "a AS (SELECT count(*) AS original_count, count(*) FILTER (WHERE ok) AS final_count, "
       "count(*) FILTER (WHERE ok AND label IN (0, 1)) > 0 AS has_labels, "
       "(CASE WHEN count(*) FILTER (WHERE ok AND length(t) < 5) > 0 THEN 1 ELSE 0 END) + "
       "(CASE WHEN count(*) FILTER (WHERE ok AND length(t) > 1000) > 0 THEN 1 ELSE 0 END) + "
       "(CASE WHEN count(*) FILTER (WHERE ok) - count(DISTINCT t) FILTER (WHERE ok) > 0 THEN 1 ELSE 0 END) AS n_quality_issues FROM v) "
       "SELECT original_count, final_count, has_labels, n_quality_issues, NOT has_labels AS inference_only, "
       "array_to_string(list_filter([CASE WHEN final_count < 100 THEN 'small_dataset' END, "
       "CASE WHEN NOT has_labels THEN 'inference_only' END, CASE WHEN n_quality_issues > 0 THEN 'quality_issues' END], "
       "lambda x: x IS NOT NULL), '|') AS recommendations FROM a")
def preprocess_metadata(spark, sf):
    from ..operators.quality import text_digest
    df = filters.with_labels(filters.clean_reviews(reviews(spark, sf), "standard"), "standard")
    n = F.length("text")
    ok = n >= 3
    # one aggregate over the cleaned rows: counts, labels and the three
    # quality counters of the kept rows
    stats = df.agg(
        F.count(F.lit(1)).alias("original_count"),
        F.sum(F.when(ok, 1).otherwise(0)).alias("final_count"),
        (F.sum(F.when(ok & F.col("label").isin(0, 1), 1).otherwise(0)) > 0).alias("has_labels"),
        F.sum(F.when(ok & (n < 5), 1).otherwise(0)).alias("short"),
        F.sum(F.when(ok & (n > 1000), 1).otherwise(0)).alias("long"),
        (F.sum(F.when(ok, 1).otherwise(0)) - F.count_distinct(F.when(ok, text_digest("text")))).alias("dups"))
    n_issues = sum((F.col(c) > 0).cast("int") for c in ("short", "long", "dups"))
    return sinks.preprocess_metadata(stats.withColumn("n_quality_issues", n_issues))


_STREAM = cleaned_cte(REVIEWS_SQL, "standard", keep="id, label_raw")


@query("stream_clean",
       f"WITH {_STREAM[0]} SELECT id, t AS text, CAST({_label_sql('standard')} AS INTEGER) AS label "
       "FROM c WHERE length(t) >= 3")
def stream_clean(spark, sf):
    """The documents table as a file stream (availableNow) -> cleaning,
    labels, length filter -> Parquet sink; returns the sink contents."""
    sink, ckpt = _fresh(spark, "stream-sink"), _fresh(spark, "stream-ckpt")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label_raw"))
    q = start_clean_stream(spark, sf, "documents.parquet", labels, sink, ckpt)
    q.awaitTermination()
    return spark.read.parquet(sink)


@query("job_metrics")
def job_metrics(spark, sf):
    """Whole flow on documents + labels: detection, cleaning, split, hashed
    embeddings, SVM and MLP, metrics on the test split."""
    from .job import run_job
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lbl = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return run_job(docs.join(lbl, "doc_id", "left"), "doc_id")["metrics"]


_JOB = f"WITH {_STD[0]} SELECT id, CAST({_label_sql('extended')} AS INTEGER) AS label FROM c WHERE length(t) >= 3"


def _reviews_table(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("sentiment")), "doc_id", "left")


@query("job_splits",
       f"SELECT * FROM ({split_sql(f'SELECT * FROM ({_JOB}) WHERE label IN (0, 1)', STANDARD_R1, STANDARD_R2, STANDARD_GUARD)}) "
       f"UNION ALL SELECT id, label, 'inference' FROM ({_JOB}) WHERE label NOT IN (0, 1)")
def job_splits(spark, sf):
    """Rows, labels and splits of the whole job on reviews with labels for some."""
    from .job import prepare
    return prepare(_reviews_table(spark, sf), "doc_id")["splits"].select("id", "label", "split")


_BENCH = cleaned_cte("SELECT item_id AS id, coalesce(text, '') AS raw FROM benchmark", "standard")


@query("job_unlabelled",
       f"WITH {_BENCH[0]} SELECT 'inference' AS split, count(*) AS n, CAST(0 AS BIGINT) AS valid_train, 'skipped' AS status, "
       "'insufficient_labels' AS reason FROM c WHERE length(t) >= 3")
def job_unlabelled(spark, sf):
    """The whole job on a table without labels: everything is inference and
    training is skipped with a reason."""
    from .job import run_job
    out = run_job(table(spark, sf, "benchmark"), "item_id")
    per_split = out["splits"].groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return attach_row(per_split, out["status"].select("valid_train", "status", "reason"))


@query("normalize_label_filter_unlabelled", "SELECT item_id AS id, CAST(-1 AS INTEGER) AS label FROM benchmark")
def normalize_label_filter_unlabelled(spark, sf):
    docs = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    return filters.normalize_label_filter(docs).select("id", "label")


@query("align_by_position",
       "SELECT vec_id AS id, len(embedding) AS dim, label, TRUE AS same FROM embeddings")
def align_by_position(spark, sf):
    """Vectors and labels written apart, in files of different sizes, side by
    side again by position (J1); ``same``: the ids of both sides agree."""
    x, y = _fresh(spark, "positions-x"), _fresh(spark, "positions-y")
    rows = table(spark, sf, "embeddings").orderBy("vec_id")
    rows.select("vec_id", "embedding").write.option("maxRecordsPerFile", 700).parquet(x)
    rows.select(F.col("vec_id").alias("other"), "label").write.option("maxRecordsPerFile", 300).parquet(y)
    return positions.aligned(spark, x, y).select(F.col("vec_id").alias("id"), F.size("embedding").cast("long").alias("dim"), "label",
                                                 (F.col("vec_id") == F.col("other")).alias("same"))


_DOCUMENTS = ("WITH g AS (SELECT quality, count(*) AS n, count(*) FILTER (WHERE toxic = 1) AS t, min(doc_id) AS a, max(doc_id) AS b "
              "FROM labels GROUP BY quality) SELECT quality, CAST(to_json({'quality': quality, 'n': n, 'toxic': {'n': t, 'share': "
              "round(t::DOUBLE / n, 3)}, 'ids': [a, b], 'undefined': NULL::DOUBLE, 'infinite': NULL::DOUBLE}) AS VARCHAR) AS document FROM g")


@query("json_documents", _DOCUMENTS)
def json_documents(spark, sf):
    """Nested results as JSON documents (T3); NaN and infinity are null."""
    rows = table(spark, sf, "labels").groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") == 1).alias("t"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    nested = rows.select("quality", "n", F.struct(F.col("t").alias("n"), F.round(F.col("t") / F.col("n"), 3).alias("share")).alias("toxic"),
                         F.array("a", "b").alias("ids"), F.lit(float("nan")).alias("undefined"), F.lit(float("inf")).alias("infinite"))
    return documents.json_documents(nested).select(F.get_json_object("document", "$.quality").cast("int").alias("quality"), "document")


@query("stage_runs",
       "WITH n AS (SELECT count(*) AS r FROM labels) SELECT * FROM (SELECT 1 AS run, 'written' AS status, 'no_result' AS reason, r AS rows FROM n "
       "UNION ALL SELECT 2, 'exists', NULL, r FROM n UNION ALL SELECT 3, 'written', 'inputs_or_parameters_changed', r FROM n "
       "UNION ALL SELECT 4, 'written', 'forced', r FROM n)")
def stage_runs(spark, sf):
    """A stage over the labels table, run again as it was, with another
    parameter, and by force (E3)."""
    out, source = _fresh(spark, "stage"), f"{sf.rstrip('/')}/labels.parquet"
    rows = []
    for run, (seed, force) in enumerate([(1, False), (1, False), (2, False), (2, True)], 1):
        made = stages.run_stage(spark, out, lambda: table(spark, sf, "labels"), [source], {"seed": seed}, force)
        rows.append((run, made.status, made.reason, made.rows))
    return spark.createDataFrame(rows, "run int, status string, reason string, rows long")
