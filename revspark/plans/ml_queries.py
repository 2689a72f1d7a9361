"""Queries of the embedding, stage-mode and training operators."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import embedding as EM
from ..operators import evaluation as EV
from ..operators import filters, modes, splits
from ..operators import model_record as MR
from ..operators import network as NET
from ..operators import squared_hinge as SH
from ..operators import training as TR
from ..operators.rows import attach_row
from ..session import kept, scratch_path
from ..sources.tables import reviews, table
from .oracle_text import SPACE, cleaned_cte, rr
from .registry import query
from .split_queries import LABELS_SRC, PROCESSED_STD, STANDARD_GUARD, STANDARD_R1, STANDARD_R2, _train_val_sql, split_sql
from .text_queries import REVIEWS_SQL, _label_sql

R = 6

# -- hashed embeddings (E2) and the batch encoder path (E1) ----------------------------

_EMB = cleaned_cte("SELECT doc_id AS id, coalesce(text, '') AS raw FROM documents", "embed")
HASH_SQL = (f"WITH {_EMB[0]}, v AS (SELECT id, t FROM c WHERE length(t) > 5), "
            f"tok AS (SELECT id, unnest(list_filter(string_split(trim({rr('t', f'[{SPACE}]+', ' ')}), ' '), "
            "lambda w: length(w) > 0)) AS w FROM v), "
            "h AS (SELECT id, CAST(CAST(('0x' || substr(md5(w), 1, 7)) AS BIGINT) % 384 AS INTEGER) AS dim, "
            "CASE WHEN CAST(('0x' || substr(md5(w), 8, 1)) AS INTEGER) < 8 THEN 1 ELSE -1 END AS s FROM tok), "
            "cnt AS (SELECT id, dim, sum(s) AS v FROM h GROUP BY id, dim HAVING sum(s) <> 0), "
            "nrm AS (SELECT id, sqrt(sum(v * v)) AS norm FROM cnt GROUP BY id) "
            f"SELECT cnt.id, cnt.dim, round(v / norm, {R}) AS value FROM cnt JOIN nrm ON cnt.id = nrm.id")


def _embed_docs(spark, sf):
    return filters.valid_texts(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), "embed")


@query("hash_embeddings", HASH_SQL)
def hash_embeddings(spark, sf):
    e = EM.hash_embedding_entries(_embed_docs(spark, sf))
    return e.select("id", "dim", F.round("value", R).alias("value"))


@query("embed_texts")
def embed_texts(spark, sf):
    return EM.embed_texts(_embed_docs(spark, sf))


_CUT = HASH_SQL.replace("unnest(list_filter(", "unnest(list_slice(list_filter(").replace(
    "lambda w: length(w) > 0)) AS w FROM v)", "lambda w: length(w) > 0), 1, 512)) AS w FROM v)").replace(
    f"round(v / norm, {R})", "v / norm")


@query("encoder_entries",
       f"SELECT id, dim, CAST(floor(1000 * value / max(abs(value)) OVER (PARTITION BY id) + 0.5001) AS INTEGER) AS per_mille FROM ({_CUT})")
def encoder_entries(spark, sf):
    """The encoder stage (E1): the asked encoder or the fallback, texts cut to
    512 tokens, batches of similar lengths.  Non-zero entries of the single
    precision vectors in thousandths of the largest."""
    vectors, _ = EM.embed_with(_embed_docs(spark, sf))
    largest = F.array_max(F.transform("embedding", F.abs)).cast("double")
    rows = vectors.select("id", largest.alias("m"), F.posexplode("embedding").alias("dim", "value")).filter("value <> 0")
    return rows.select("id", "dim", F.floor(1000 * F.col("value").cast("double") / F.col("m") + 0.5001).cast("int").alias("per_mille"))


# -- embedding table ------------------------------------------------------------------

@query("embedding_profile",
       "SELECT count(*) AS rows, min(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim, "
       "CAST(sum(CASE WHEN embedding IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_vectors FROM embeddings")
def embedding_profile(spark, sf):
    return EM.embedding_profile(table(spark, sf, "embeddings"))


@query("join_embeddings_labels",
       "SELECT x.vec_id AS id, len(x.embedding) AS dim, y.label FROM embeddings x JOIN embeddings y ON x.vec_id = y.vec_id")
def join_embeddings_labels(spark, sf):
    e = table(spark, sf, "embeddings")
    x = e.select(F.col("vec_id").alias("id"), "embedding")
    y = e.select(F.col("vec_id").alias("id"), "label")
    return x.join(y, "id").select("id", F.size("embedding").cast("long").alias("dim"), "label")


@query("clean_labels",
       "WITH b AS (SELECT vec_id, CASE WHEN label = -1 THEN 0 ELSE label END AS label FROM embeddings), "
       "k AS (SELECT count(DISTINCT label) AS k FROM b) "
       "SELECT vec_id, CAST(CASE WHEN k > 2 THEN CASE WHEN label > 0.5 THEN 1 ELSE 0 END ELSE label END AS INTEGER) AS label "
       "FROM b, k")
def clean_labels(spark, sf):
    return TR.clean_labels(table(spark, sf, "embeddings").select("vec_id", "label")).select(
        "vec_id", F.col("label").cast("int").alias("label"))


@query("standardize",
       "WITH l AS (SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim, "
       "CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), "
       "s AS (SELECT dim, avg(x) AS mu, stddev_pop(x) AS sd FROM l GROUP BY dim) "
       f"SELECT id, l.dim, round(CASE WHEN sd > 0 THEN (x - mu) / sd ELSE x - mu END, {R}) AS value "
       "FROM l JOIN s ON l.dim = s.dim")
def standardize(spark, sf):
    return TR.standardize_entries(table(spark, sf, "embeddings"), "vec_id", "embedding")


@query("label_encode",
       "WITH c AS (SELECT role, CAST(row_number() OVER (ORDER BY role) - 1 AS INTEGER) AS code "
       "FROM (SELECT DISTINCT role FROM conversations)) "
       "SELECT conv_id, turn, x.role, code FROM conversations x JOIN c ON x.role = c.role")
def label_encode(spark, sf):
    df = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return TR.label_encode(df, "role").select("conv_id", "turn", "role", F.col("code").cast("int"))


_EXT = cleaned_cte(REVIEWS_SQL, "extended", keep="id, label_raw")
LABELLED_EXT = (f"WITH {_EXT[0]}, v AS (SELECT id, CAST({_label_sql('extended')} AS INTEGER) AS label FROM c "
                f"WHERE length({rr('t', f'^[{SPACE}]+|[{SPACE}]+$', '')}) > 3) SELECT * FROM v WHERE label IN (0, 1)")


def labelled_ext(spark, sf):
    df = filters.with_labels(filters.valid_texts(reviews(spark, sf), "extended"), "extended")
    return filters.labelled_only(df)


@query("class_weights",
       f"WITH p AS (SELECT label, count(*) AS n_c FROM ({LABELLED_EXT}) GROUP BY label), "
       "t AS (SELECT sum(n_c) AS n, count(*) AS k FROM p) "
       f"SELECT label, n_c, round(n / (k * n_c), {R}) AS weight FROM p, t")
def class_weights(spark, sf):
    return TR.class_weights(labelled_ext(spark, sf))


@query("labels_of_valid_texts",
       f"SELECT doc_id, quality FROM labels WHERE doc_id IN (SELECT id FROM ({LABELLED_EXT.replace(' WHERE label IN (0, 1)', '')}))")
def labels_of_valid_texts(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    # only labelled documents are cleaned
    docs = table(spark, sf, "documents").select("doc_id", "text").join(labels.select("doc_id"), "doc_id", "left_semi")
    return labels.join(filters.valid_texts(docs, "extended").select("doc_id"), "doc_id", "left_semi")


@query("unlabelled_reviews",
       f"SELECT id FROM ({LABELLED_EXT.replace(' WHERE label IN (0, 1)', '')}) v "
       "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = v.id)")
def unlabelled_reviews(spark, sf):
    lbl = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text").join(lbl, "id", "left_anti")
    return filters.valid_texts(docs, "extended").select("id")


# -- parameter rules (E7-E9) and training status (E17) -----------------------------------

STATS_SQL = "SELECT count(*) AS total_samples, max(len(embedding)) AS feature_dim FROM embeddings"


def _stats(spark, sf):
    return TR.feature_stats(table(spark, sf, "embeddings"))


@query("svm_params",
       "WITH s AS (" + STATS_SQL + "), c AS (SELECT *, CASE WHEN total_samples < 100 THEN 0.1 ELSE 1.0 END AS c0 FROM s), "
       "d AS (SELECT *, CASE WHEN feature_dim > 1000 THEN least(c0, 0.1) ELSE c0 END AS cc FROM c) "
       "SELECT total_samples, feature_dim, CAST(cc AS DOUBLE) AS C, CASE WHEN total_samples < 100 THEN 5000 "
       "WHEN total_samples < 1000 THEN 10000 WHEN total_samples > 10000 THEN 20000 ELSE 10000 END AS max_iter, "
       "'balanced' AS class_weight, round(1.0 / (cc * total_samples), 12) AS reg_param FROM d")
def svm_params(spark, sf):
    return TR.svm_params(_stats(spark, sf))


@query("mlp_params",
       "WITH s AS (" + STATS_SQL + "), b AS (SELECT *, total_samples < 100 AS sm, total_samples < 1000 AS md, "
       "total_samples > 10000 AS lg FROM s), "
       "h AS (SELECT *, CASE WHEN sm THEN [64, 32] WHEN md THEN [128, 64] WHEN lg THEN [512, 256, 128] ELSE [256, 128] END AS h0 FROM b), "
       "h2 AS (SELECT *, list_transform(CASE WHEN feature_dim < 200 THEN list_transform(h0, lambda x: x // 2) "
       "WHEN feature_dim > 1000 THEN list_transform(h0, lambda x: x * 2) ELSE h0 END, lambda x: greatest(16, x)) AS hd FROM h) "
       "SELECT total_samples, feature_dim, array_to_string(hd, ',') AS hidden_dims, "
       "CAST(round(CASE WHEN sm THEN 0.1 WHEN md THEN 0.2 WHEN lg THEN 0.4 ELSE 0.3 END + CASE WHEN feature_dim > 1000 THEN 0.1 ELSE 0 END, 6) AS DOUBLE) AS dropout, "
       "CAST(CASE WHEN sm THEN 0.01 ELSE 0.001 END AS DOUBLE) AS learning_rate, "
       "CAST(greatest(1, least(CASE WHEN sm THEN least(8, total_samples // 4) WHEN md THEN least(16, total_samples // 8) "
       "WHEN lg THEN 64 ELSE 32 END, total_samples // 4)) AS INTEGER) AS batch_size, "
       "CASE WHEN sm THEN 30 WHEN md THEN 40 WHEN lg THEN 100 ELSE 50 END AS epochs, "
       "CASE WHEN sm THEN 5 WHEN md THEN 7 WHEN lg THEN 15 ELSE 10 END AS patience, "
       "CAST(least(50, greatest(10, total_samples // 20)) AS INTEGER) AS runner_epochs FROM h2")
def mlp_params(spark, sf):
    return TR.mlp_params(_stats(spark, sf))


@query("training_status",
       "WITH b AS (SELECT CASE WHEN label = -1 THEN 0 ELSE label END AS label FROM embeddings), "
       "k AS (SELECT count(DISTINCT label) AS k FROM b), "
       "c AS (SELECT CASE WHEN k > 2 THEN CASE WHEN label > 0.5 THEN 1 ELSE 0 END ELSE label END AS label FROM b, k), "
       "s AS (SELECT count(*) FILTER (WHERE label IN (0, 1)) AS valid_train, count(DISTINCT label) AS n_classes FROM c) "
       "SELECT valid_train, n_classes, CASE WHEN valid_train < 10 OR n_classes < 2 THEN 'skipped' ELSE 'ready' END AS status, "
       "CASE WHEN valid_train < 10 THEN 'insufficient_labels' WHEN n_classes < 2 THEN 'single_class' END AS reason FROM s")
def training_status(spark, sf):
    lab = TR.clean_labels(table(spark, sf, "embeddings").select("vec_id", "label"))
    row = lab.agg(F.sum(F.when(F.col("label").isin(0, 1), 1).otherwise(0)).alias("valid_train"),
                  F.count_distinct("label").alias("n_classes"))
    return modes.training_status(row)


_BINARY = ("WITH b AS (SELECT vec_id AS id, len(embedding) AS d, CASE WHEN label = -1 THEN 0 ELSE label END AS label FROM embeddings), "
           "k AS (SELECT count(DISTINCT label) AS k FROM b) SELECT id, d, CAST(CASE WHEN k > 2 THEN CASE WHEN label > 0.5 THEN 1 ELSE 0 END "
           "ELSE label END AS INTEGER) AS label FROM b, k")
_CARVED = _train_val_sql(f"SELECT id, label FROM ({_BINARY})")


@query("training_data_stats",
       f"WITH s AS (SELECT v.split, b.d, b.label FROM ({_CARVED}) v JOIN ({_BINARY}) b ON v.id = b.id), "
       "p AS (SELECT split, d, label FROM s UNION ALL SELECT 'total', d, label FROM s), "
       "n AS (SELECT split, count(*) AS samples, CAST(max(d) AS BIGINT) AS feature_dim, string_agg(DISTINCT CAST(label AS VARCHAR), ',' ORDER BY "
       "CAST(label AS VARCHAR)) AS label_set, count(*) FILTER (WHERE label = 0) AS n_negative, count(*) FILTER (WHERE label = 1) AS n_positive "
       "FROM p GROUP BY split) SELECT l.split, coalesce(samples, 0) AS samples, feature_dim, coalesce(label_set, '') AS label_set, "
       "coalesce(n_negative, 0) AS n_negative, coalesce(n_positive, 0) AS n_positive FROM (VALUES ('train'), ('val'), ('total')) l(split) "
       "LEFT JOIN n ON l.split = n.split")
def training_data_stats(spark, sf):
    """Sizes, width and labels of the training data (A12): the embeddings
    table with a fifth carved out for validation."""
    lab = TR.clean_labels(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label"))
    return modes.training_data_stats(*modes.training_data(lab.withColumn("split", F.lit("train"))))


@query("training_status_by_source",
       "WITH g AS (SELECT d.source, d.lang, count(*) FILTER (WHERE l.quality IN (0, 1)) AS valid_train, "
       "count(DISTINCT CASE WHEN l.quality IN (0, 1) THEN l.quality END) AS n_classes FROM documents d JOIN labels l "
       "ON d.doc_id = l.doc_id GROUP BY ALL), c AS (SELECT *, CAST(CASE WHEN valid_train >= 20 THEN valid_train - "
       "ceil(0.2::DOUBLE * valid_train) ELSE valid_train - greatest(1, valid_train // 5) END AS BIGINT) AS left_train FROM g) "
       "SELECT *, CASE WHEN valid_train < 6 OR n_classes < 2 OR left_train < 5 THEN 'skipped' ELSE 'ready' END AS status, "
       "CASE WHEN valid_train < 6 THEN 'insufficient_labels' WHEN n_classes < 2 THEN 'single_class' WHEN left_train < 5 THEN "
       "'training_set_too_small' END AS reason FROM c")
def training_status_by_source(spark, sf):
    """Which sources have enough labelled rows for a model of their own (E17),
    at least five of them left after the carve-out."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    valid = F.col("quality").isin(0, 1)
    rows = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id").groupBy("source", "lang").agg(
        F.count_if(valid).alias("valid_train"), F.count_distinct(F.when(valid, F.col("quality"))).alias("n_classes"))
    rows = rows.withColumn("left_train", modes.left_after_carving(F.col("valid_train")))
    return modes.training_status(rows, min_samples=6, by=("source", "lang"))


# -- split profile, stage modes (A11, A12, M5-M9) ------------------------------------------

_STD = cleaned_cte(REVIEWS_SQL, "standard", keep="id, label_raw")
SPLIT_STD_SQL = split_sql(PROCESSED_STD, STANDARD_R1, STANDARD_R2, STANDARD_GUARD)
SPLIT_TEXT_SQL = (f"SELECT s.id, s.label, s.split, c.t AS text FROM ({SPLIT_STD_SQL}) s "
                  f"JOIN (WITH {_STD[0]} SELECT id, t FROM c) c ON s.id = c.id")


def split_reviews(spark, sf):
    df = filters.with_labels(filters.valid_texts(reviews(spark, sf), "standard"), "standard")
    return splits.split(kept(df.select("id", "label", "text"), "reviews"), "standard")  # read for the keys and for the rows


PROFILE_SQL = (f"SELECT split, count(*) AS samples, count(label) > 0 AS has_labels, "
               "CAST(sum(CASE WHEN label IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) AS valid_labels, "
               f"round(avg(length(text)), {R}) AS avg_text_length, "
               f"round(sum(CASE WHEN label IN (0, 1) THEN 1 ELSE 0 END) / count(*), {R}) AS label_ratio "
               f"FROM ({SPLIT_TEXT_SQL}) GROUP BY split")


@query("split_profile", PROFILE_SQL)
def split_profile(spark, sf):
    return modes.split_profile(split_reviews(spark, sf))


@query("training_stats", f"SELECT split, label, count(*) AS n FROM ({SPLIT_STD_SQL}) GROUP BY split, label")
def training_stats(spark, sf):
    df = filters.with_labels(filters.valid_texts(reviews(spark, sf), "standard"), "standard")
    return modes.training_stats(splits.split(df.select("id", "label"), "standard"))


def _flags_sql():
    parts = []
    for s in modes.SPLITS:
        parts += [f"max(CASE WHEN split = '{s}' THEN 1 ELSE 0 END) AS has_{s}",
                  f"max(CASE WHEN split = '{s}' AND has_labels THEN 1 ELSE 0 END) AS lab_{s}",
                  f"max(CASE WHEN split = '{s}' THEN valid_labels ELSE 0 END) AS valid_{s}"]
    parts += ["sum(CASE WHEN has_labels AND valid_labels > 5 THEN 1 ELSE 0 END) AS nl",
              "sum(CASE WHEN NOT has_labels THEN 1 ELSE 0 END) AS nu"]
    return f"SELECT {', '.join(parts)} FROM ({PROFILE_SQL})"


MODES_SQL = (
    f"WITH f AS ({_flags_sql()}) SELECT "
    "CASE WHEN lab_train = 1 AND lab_val = 1 THEN 'training_standard' WHEN lab_train = 1 THEN 'training_single' "
    "WHEN has_inference = 1 THEN 'inference' WHEN nl = 1 AND lab_train = 0 THEN 'single_file_training' "
    "WHEN nu >= 1 THEN 'inference_unlabeled' WHEN nl > 1 THEN 'multi_file_training' ELSE 'unknown' END AS embed_mode, "
    "CASE WHEN has_train = 1 AND valid_train > 10 THEN 'training' WHEN has_train = 1 THEN 'insufficient_labels' "
    "WHEN has_inference = 1 THEN 'inference' WHEN has_test = 1 THEN 'test_only' ELSE 'no_files' END AS svm_mode, "
    "CASE WHEN has_train = 1 AND has_val = 1 THEN 'training_standard' WHEN has_train = 1 THEN 'training_single' "
    "WHEN has_test = 1 THEN 'inference_test' WHEN has_inference = 1 THEN 'inference_only' ELSE 'unknown' END AS mlp_mode, "
    "CASE WHEN has_test = 1 OR has_inference = 1 THEN 'data_analysis' ELSE 'minimal_report' END AS report_mode, "
    "CASE WHEN has_test = 1 THEN 'test' WHEN has_inference = 1 THEN 'inference' WHEN has_train = 1 THEN 'train' "
    "WHEN has_val = 1 THEN 'val' END AS eval_split, "
    "has_train = 1 AND valid_train > 10 AS svm_training_possible FROM f")


def _modes(spark, sf):
    return modes.stage_modes(modes.split_profile(split_reviews(spark, sf)), models_found=0)


for _k, _cols in {"split_mode": ["embed_mode"], "svm_mode": ["svm_mode", "svm_training_possible"],
                  "mlp_mode": ["mlp_mode"], "report_mode": ["report_mode"], "eval_split": ["eval_split"]}.items():
    query(_k, f"SELECT {', '.join(_cols)} FROM ({MODES_SQL})")(
        (lambda cols: lambda spark, sf: _modes(spark, sf).select(*cols))(_cols))


# -- the mode rules over several tables of splits (L4, M5-M9) -----------------------------------

_PROFILES = {"standard": "TRUE", "no_val": "split <> 'val'", "train_only": "split = 'train'", "test_only": "split = 'test'",
             "val_test": "split IN ('val', 'test')"}


def _stage_modes_sql() -> str:
    per = (f"SELECT split, count(*) AS samples, count(label) > 0 AS has_labels, CAST(sum(CASE WHEN label IN (0, 1) THEN 1 "
           f"ELSE 0 END) AS BIGINT) AS valid_labels FROM ({split_sql(LABELS_SRC, STANDARD_R1, STANDARD_R2, STANDARD_GUARD)}) "
           "GROUP BY split")
    rows = " UNION ALL ".join(f"SELECT '{name}' AS profile, * FROM t WHERE {cond}" for name, cond in _PROFILES.items())
    rows += " UNION ALL SELECT 'unlabelled', 'inference', count(*), FALSE, 0 FROM benchmark"
    flags = ", ".join(f"max(CASE WHEN split = '{s}' THEN 1 ELSE 0 END) AS has_{s}, max(CASE WHEN split = '{s}' AND has_labels "
                      f"THEN 1 ELSE 0 END) AS lab_{s}, max(CASE WHEN split = '{s}' THEN valid_labels ELSE 0 END) AS valid_{s}"
                      for s in modes.SPLITS)
    file = "has_labels AND valid_labels > 5"
    return (
        f"WITH t AS ({per}), p AS ({rows}), f AS (SELECT profile, {flags}, count(*) FILTER (WHERE {file}) AS nl, "
        "count(*) FILTER (WHERE NOT has_labels) AS nu, "
        f"first(split ORDER BY samples DESC, split) FILTER (WHERE {file}) AS largest_labelled, "
        "min(split) FILTER (WHERE NOT has_labels) AS first_unlabelled FROM p GROUP BY profile), "
        "m AS (SELECT *, CASE WHEN lab_train = 1 AND lab_val = 1 THEN 'training_standard' WHEN lab_train = 1 THEN "
        "'training_single' WHEN has_inference = 1 THEN 'inference' WHEN nl = 1 THEN 'single_file_training' "
        "WHEN nu >= 1 THEN 'inference_unlabeled' WHEN nl > 1 THEN 'multi_file_training' ELSE 'unknown' END AS embed_mode, "
        "has_test = 1 OR has_inference = 1 AS tested FROM f) "
        "SELECT profile, embed_mode, CASE embed_mode WHEN 'training_standard' THEN 'train,val' || CASE WHEN has_test = 1 "
        "THEN ',test' ELSE '' END WHEN 'training_single' THEN 'train' || CASE WHEN has_test = 1 THEN ',test' ELSE '' END "
        "WHEN 'inference' THEN 'inference' WHEN 'inference_unlabeled' THEN first_unlabelled WHEN 'unknown' THEN NULL "
        "ELSE largest_labelled END AS recommended_splits, largest_labelled, "
        "CASE WHEN tested THEN 'full_evaluation' ELSE 'model_evaluation,add_test_data' END AS advice, "
        "CASE WHEN has_train = 1 AND valid_train > 10 THEN 'training' WHEN has_train = 1 THEN 'insufficient_labels' "
        "WHEN has_inference = 1 THEN 'inference' WHEN has_test = 1 THEN 'test_only' ELSE 'no_files' END AS svm_mode, "
        "CASE WHEN has_train = 1 AND has_val = 1 THEN 'training_standard' WHEN has_train = 1 THEN 'training_single' "
        "ELSE 'training_embedded' END AS mlp_mode, "
        "CASE WHEN tested THEN 'full_evaluation' ELSE 'model_evaluation' END AS report_mode, "
        "CASE WHEN has_test = 1 THEN 'test' WHEN has_inference = 1 THEN 'inference' WHEN has_train = 1 THEN 'train' "
        "ELSE 'val' END AS eval_split, has_train = 1 AND valid_train > 10 AS svm_training_possible FROM m")


@query("stage_modes", _stage_modes_sql())
def stage_modes(spark, sf):
    """All mode rules, with two models and one embedded table found, for six
    tables of splits made from the labels and the benchmark."""
    df = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    whole = modes.split_profile(splits.split(df, "standard").withColumn("text", F.lit("")))
    bench = table(spark, sf, "benchmark").select(F.lit("").alias("text"), F.lit(None).cast("int").alias("label"),
                                                 F.lit("inference").alias("split"))
    rows = modes.split_profile(bench).withColumn("profile", F.lit("unlabelled"))
    for name, cond in _PROFILES.items():
        rows = rows.unionByName(whole.filter(F.expr(cond)).withColumn("profile", F.lit(name)))
    return modes.stage_modes(rows, models_found=2, by=("profile",), embedded=True)


# -- training on the embeddings table (E10-E16, rows-only checks) -----------------------------

def _train_val(spark, sf):
    lab = TR.clean_labels(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label"))
    return splits.split(lab, "train_val")


def _parts(spark, sf):
    """Train and val rows, and the parameter rules' answers for them: split once for all models."""
    tv = _train_val(spark, sf)
    tr, va = tv.filter(F.col("split") == "train"), tv.filter(F.col("split") == "val")
    stats = TR.feature_stats(tr)
    return tr, va, {"svm": TR.svm_params(stats).first(), "mlp": TR.mlp_params(stats).first()}


def _fit(parts, kind):
    tr, va, params = parts
    p = params[kind]
    if kind == "svm":
        return SH.train_squared_hinge(tr, C=p["C"], max_iter=p["max_iter"])
    return NET.train_network(tr, va, [int(x) for x in p["hidden_dims"].split(",")], p["dropout"], p["learning_rate"],
                             p["batch_size"], p["epochs"], p["patience"])


def _scored(parts, kind):
    model = _fit(parts, kind)
    return SH.score_linear(model, parts[1]) if kind == "svm" else NET.score_network(model, parts[1])


@query("train_svm")
def train_svm(spark, sf):
    return _scored(_parts(spark, sf), "svm")


@query("train_mlp")
def train_mlp(spark, sf):
    return _scored(_parts(spark, sf), "mlp")


@query("training_history")
def training_history(spark, sf):
    return NET.history(_fit(_parts(spark, sf), "mlp"), spark)


@query("evaluate_trained_models")
def evaluate_trained_models(spark, sf):
    parts = _parts(spark, sf)
    return EV.eval_metrics(_scored(parts, "mlp").unionByName(_scored(parts, "svm")), eval_split="val")


_FACTS = ("WITH t AS (SELECT count(*) AS n, max(len(embedding)) AS d FROM embeddings), "
          "k AS (SELECT n - CAST(ceil(0.2::DOUBLE * n) AS BIGINT) AS train_rows, CAST(ceil(0.2::DOUBLE * n) AS BIGINT) AS val_rows, d FROM t), "
          "h AS (SELECT *, CASE WHEN train_rows < 100 THEN [64, 32] WHEN train_rows < 1000 THEN [128, 64] WHEN train_rows > 10000 "
          "THEN [512, 256, 128] ELSE [256, 128] END AS h0 FROM k), "
          "w AS (SELECT *, list_prepend(d, list_transform(CASE WHEN d < 200 THEN list_transform(h0, lambda x: x // 2) WHEN d > 1000 "
          "THEN list_transform(h0, lambda x: x * 2) ELSE h0 END, lambda x: greatest(16, x))) AS s FROM h) "
          "SELECT 'mlp' AS model, train_rows, val_rows, CAST(d AS BIGINT) AS input_dim, CAST(list_sum(list_transform(range(1, len(s)), "
          "lambda i: s[i] * s[i + 1] + 3 * s[i + 1])) + s[len(s)] + 1 AS BIGINT) AS parameters, TRUE AS holds FROM w UNION ALL "
          "SELECT 'svm', train_rows, val_rows, CAST(d AS BIGINT), CAST(d + 1 AS BIGINT), TRUE FROM w")


@query("training_facts", _FACTS)
def training_facts(spark, sf):
    """What SQL can tell of both trainings: rows, width and parameters of each
    model.  ``holds``: the network was kept at its lowest validation loss and
    ended by rule, the SVM is stationary and below the zero solution."""
    parts = _parts(spark, sf)
    net, svm, rule = _fit(parts, "mlp"), _fit(parts, "svm"), parts[2]["mlp"]
    h = net.history
    best = min(range(len(h)), key=lambda i: h[i][2])
    kept = h[best][6] and not any(r[6] for r in h[best + 1:]) and len(h) == min(rule["epochs"], best + 1 + rule["patience"])
    still = svm.gradient < 1e-4 and svm.objective < svm.C * parts[0].count()  # balanced weights add up to the rows
    rows = [(m, x.architecture["input_dim"], x.architecture["parameters"], bool(ok))
            for m, x, ok in (("mlp", net, kept), ("svm", svm, still))]
    sizes = attach_row(parts[0].agg(F.count(F.lit(1)).alias("train_rows")), parts[1].agg(F.count(F.lit(1)).alias("val_rows")))
    known = spark.createDataFrame(rows, "model string, input_dim long, parameters long, holds boolean")
    return attach_row(known, sizes).select("model", "train_rows", "val_rows", "input_dim", "parameters", "holds")


@query("save_load_model")
def save_load_model(spark, sf):
    """Predictions of both models before and after a round trip through the
    shared folder."""
    parts, out = _parts(spark, sf), None
    for kind in ("mlp", "svm"):
        model = _fit(parts, kind)
        path = scratch_path(spark, f"{kind}-model-{uuid.uuid4().hex}")
        MR.save_model(model, spark, path)
        again = MR.load_model(spark, path)
        score = SH.score_linear if kind == "svm" else NET.score_network
        a = score(model, parts[1], kind).select("model", "id", F.col("prediction").alias("p1"), F.col("raw_margin").alias("m1"))
        b = score(again, parts[1], kind).select(F.col("id").alias("id2"), F.col("prediction").alias("p2"), F.col("raw_margin").alias("m2"))
        rows = a.join(b, F.col("id") == F.col("id2")).select("model", "id", "p1", "p2", ((F.col("p1") == F.col("p2"))
                                                                                         & (F.col("m1") == F.col("m2"))).alias("same"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("embedding_metadata",
       "WITH b AS (SELECT vec_id AS id, embedding, CASE WHEN label = -1 THEN 0 ELSE label END AS label FROM embeddings), "
       "k AS (SELECT count(DISTINCT label) AS k FROM b) , c AS (SELECT id, embedding, CASE WHEN k > 2 THEN "
       "CASE WHEN label > 0.5 THEN 1 ELSE 0 END ELSE label END AS label FROM b, k) "
       "SELECT 'all' AS split, count(*) AS samples, max(len(embedding)) AS dim, "
       "CAST(sum(CASE WHEN label IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) AS labelled FROM c")
def embedding_metadata(spark, sf):
    lab = TR.clean_labels(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label"))
    return EM.embedding_metadata(lab.withColumn("split", F.lit("all")))
