"""Queries of the evaluation operators.

The scored table comes from the real flow: runner-filtered reviews, split
by the ``runner`` policy, the ``test`` part cleaned (standard) and scored by
two fixed rule models (so the oracle can recompute every prediction):

* ``rule_length``: p = min(1, length / 1000)
* ``rule_words``:  p = min(1, words / 160)

prediction = p > 0.5, as the MLP threshold.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import word_count
from ..operators import evaluation as EV
from ..operators import filters, splits
from ..sources.tables import reviews, table
from .oracle_text import SPACE, cleaned_cte, rr
from .registry import query
from .split_queries import RUNNER_SRC, split_sql

R = 6
MODELS = [("rule_length", 1), ("rule_words", 2)]

_CLEAN = cleaned_cte("SELECT doc_id AS id, coalesce(text, '') AS raw FROM documents", "standard")
_WORDS = f"len(list_filter(string_split(trim({rr('t', f'[{SPACE}]+', ' ')}), ' '), lambda w: length(w) > 0))"
SCORED_SQL = (
    f"SELECT s.id, m.model, s.label, CASE WHEN p.p > 0.5 THEN 1 ELSE 0 END AS prediction, p.p AS probability "
    f"FROM ({split_sql(RUNNER_SRC, '0.3', '0.5', 'CASE WHEN n < 100 OR has = 0 THEN ' + chr(39) + 'inference' + chr(39) + ' ELSE', strat_only=True)}) s "
    f"JOIN (WITH {_CLEAN[0]} SELECT id, t FROM c) c ON s.id = c.id "
    f"CROSS JOIN (VALUES ('rule_length', 1), ('rule_words', 2)) m(model, model_order) "
    f"CROSS JOIN LATERAL (SELECT round(CASE WHEN m.model = 'rule_length' THEN least(1.0, length(c.t) / 1000.0) "
    f"ELSE least(1.0, {_WORDS.replace('(t,', '(c.t,')} / 160.0) END, {R}) AS p) p "
    f"WHERE s.split = 'test'")


def scored(spark, sf):
    df = filters.normalize_label_filter(filters.valid_texts_raw(reviews(spark, sf)))
    test = splits.split(df.select("id", "label"), "runner").filter(F.col("split") == "test")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    # join first, then clean: only the test rows are cleaned
    x = filters.clean_reviews(test.join(docs, "id"))
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(o).alias("model_order")) for m, o in MODELS])
    x = x.withColumn("m", F.explode(models)).select("id", "label", "text", "m.model")
    p = F.round(F.when(F.col("model") == "rule_length", F.least(F.lit(1.0), F.length("text") / 1000.0))
                 .otherwise(F.least(F.lit(1.0), word_count(F.col("text")) / 160.0)), R)
    out = x.select("id", "model", "label", F.when(p > 0.5, 1).otherwise(0).alias("prediction"),
                   p.alias("probability"))
    # every metric reads the scored rows in several branches (counts, model
    # list, totals): write them once to the shared checkpoint folder
    return out.checkpoint()


def model_order(spark):
    return spark.createDataFrame(MODELS, "model string, model_order int")


@query("score_reviews", SCORED_SQL)
def score_reviews(spark, sf):
    return scored(spark, sf)


@query("filter_scored", f"SELECT * FROM ({SCORED_SQL}) WHERE prediction = 1 AND probability >= 0.6")
def filter_scored(spark, sf):
    return filters.filter_scored(scored(spark, sf), prediction=1, min_probability=0.6)


CM_SQL = (f"WITH s AS ({SCORED_SQL}), g AS (SELECT model, l.label, pr.prediction FROM (SELECT DISTINCT model FROM s), "
          "(VALUES (0), (1)) l(label), (VALUES (0), (1)) pr(prediction)), "
          "c AS (SELECT model, label, prediction, count(*) AS n FROM s GROUP BY ALL) "
          "SELECT g.model, g.label, g.prediction, coalesce(c.n, 0) AS n FROM g LEFT JOIN c "
          "ON g.model = c.model AND g.label = c.label AND g.prediction = c.prediction")


@query("confusion_matrix", CM_SQL)
def confusion_matrix(spark, sf):
    return EV.confusion_matrix(scored(spark, sf))


CLS_SQL = (f"WITH cm AS ({CM_SQL}), k AS (SELECT model, cl.c, "
           "sum(CASE WHEN label = cl.c AND prediction = cl.c THEN n ELSE 0 END) AS tp, "
           "sum(CASE WHEN prediction = cl.c THEN n ELSE 0 END) AS pp, "
           "sum(CASE WHEN label = cl.c THEN n ELSE 0 END) AS support FROM cm, (VALUES (0), (1)) cl(c) GROUP BY model, cl.c), "
           "pr AS (SELECT model, c AS label, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision, "
           "CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM k), "
           "cls AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) "
           "ELSE 0.0 END AS f1 FROM pr)")
METRICS_SQL = (CLS_SQL + ", acc AS (SELECT model, sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n) AS accuracy "
               "FROM cm GROUP BY model), w AS (SELECT model, sum(f1 * support) / sum(support) AS f1w, CAST(sum(support) AS BIGINT) AS n "
               "FROM cls GROUP BY model) "
               f"SELECT w.model, 'test' AS eval_split, n, round(accuracy, {R}) AS accuracy, round(f1w, {R}) AS f1_weighted "
               "FROM w JOIN acc ON w.model = acc.model")


@query("eval_metrics", METRICS_SQL)
def eval_metrics(spark, sf):
    return EV.eval_metrics(scored(spark, sf))


@query("classification_report",
       CLS_SQL + " SELECT model, CASE WHEN label = 0 THEN 'Negative' ELSE 'Positive' END AS row, "
       f"round(precision, {R}) AS precision, round(recall, {R}) AS recall, round(f1, {R}) AS f1, CAST(support AS BIGINT) AS support FROM cls "
       f"UNION ALL SELECT model, 'macro avg', round(avg(precision), {R}), round(avg(recall), {R}), round(avg(f1), {R}), "
       "CAST(sum(support) AS BIGINT) FROM cls GROUP BY model "
       f"UNION ALL SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), {R}), "
       f"round(sum(recall * support) / sum(support), {R}), round(sum(f1 * support) / sum(support), {R}), "
       "CAST(sum(support) AS BIGINT) FROM cls GROUP BY model")
def classification_report(spark, sf):
    return EV.classification_report(scored(spark, sf))


MO_SQL = "(VALUES ('rule_length', 1), ('rule_words', 2)) mo(model, model_order)"


@query("best_model",
       f"WITH m AS ({METRICS_SQL}), r AS (SELECT m.*, mo.model_order, row_number() OVER "
       f"(ORDER BY accuracy DESC, mo.model_order) AS r FROM m JOIN {MO_SQL} ON m.model = mo.model) "
       f"SELECT (SELECT count(*) FROM {MO_SQL}) AS models_found, (SELECT count(*) FROM m) AS models_evaluated, "
       "model AS best_model, accuracy AS best_accuracy, f1_weighted AS best_f1 "
       "FROM (SELECT 1) LEFT JOIN (SELECT * FROM r WHERE r = 1) ON TRUE")
def best_model(spark, sf):
    return EV.best_model(EV.eval_metrics(scored(spark, sf)), model_order(spark))


@query("quality_band",
       f"SELECT model, round((accuracy + f1_weighted) / 2, {R}) AS quality_score, "
       "CASE WHEN accuracy > 0 AND f1_weighted > 0 THEN CASE WHEN (accuracy + f1_weighted) / 2 >= 0.8 THEN 'excellent' "
       "WHEN (accuracy + f1_weighted) / 2 >= 0.7 THEN 'good' WHEN (accuracy + f1_weighted) / 2 >= 0.6 THEN 'sufficient' "
       f"ELSE 'needs_improvement' END END AS band FROM ({METRICS_SQL})")
def quality_band(spark, sf):
    return EV.quality_band(EV.eval_metrics(scored(spark, sf)))


@query("model_comparison",
       f"WITH m AS ({METRICS_SQL}) SELECT 'accuracy' AS metric, max(CASE WHEN model = 'rule_length' THEN accuracy END) AS rule_length, "
       "max(CASE WHEN model = 'rule_words' THEN accuracy END) AS rule_words FROM m UNION ALL "
       "SELECT 'f1_weighted', max(CASE WHEN model = 'rule_length' THEN f1_weighted END), "
       "max(CASE WHEN model = 'rule_words' THEN f1_weighted END) FROM m")
def model_comparison(spark, sf):
    return EV.model_comparison(EV.eval_metrics(scored(spark, sf)), [m for m, _ in MODELS])


@query("insights",
       f"WITH m AS ({METRICS_SQL}), a AS (SELECT 2 AS found, max(accuracy) AS best, min(accuracy) AS worst, "
       f"count(*) AS evaluated FROM m), t AS (SELECT count(*) AS samples FROM ({SCORED_SQL}) WHERE model = 'rule_length'), "
       "x AS (SELECT 1 AS seq, CASE WHEN found = 0 THEN 'no_models' WHEN found = 1 THEN 'single_model' ELSE 'multiple_models' END AS code, "
       "CAST(found AS DOUBLE) AS value FROM a UNION ALL "
       "SELECT 2, CASE WHEN evaluated > 0 THEN CASE WHEN best >= 0.85 THEN 'excellent_performance' WHEN best >= 0.80 THEN "
       "'good_performance' WHEN best >= 0.75 THEN 'acceptable_performance' ELSE 'below_expectations' END END, best FROM a UNION ALL "
       "SELECT 3, CASE WHEN evaluated > 1 THEN CASE WHEN best - worst > 0.05 THEN 'significant_gap' ELSE 'similar_performance' END END, "
       f"round(best - worst, {R}) FROM a UNION ALL "
       "SELECT 4, 'test_data', CAST(samples AS DOUBLE) FROM t) SELECT * FROM x WHERE code IS NOT NULL")
def insights(spark, sf):
    sc = scored(spark, sf)
    test_rows = (sc.filter(F.col("model") == "rule_length")
                   .agg(F.count(F.lit(1)).alias("samples")).withColumn("labelled", F.lit(True)))
    return EV.insights(EV.eval_metrics(sc), model_order(spark), test_rows)


@query("evaluate_models",
       f"SELECT m.model, 'evaluated' AS status, m.eval_split, m.n, m.accuracy, m.f1_weighted FROM ({METRICS_SQL}) m")
def evaluate_models(spark, sf):
    return EV.eval_metrics(scored(spark, sf)).select("model", F.lit("evaluated").alias("status"), "eval_split",
                                                      "n", "accuracy", "f1_weighted")


@query("classification_report_accuracy",
       CLS_SQL + " SELECT model, CASE WHEN label = 0 THEN 'Negative' ELSE 'Positive' END AS row, "
       f"round(precision, {R}) AS precision, round(recall, {R}) AS recall, round(f1, {R}) AS f1, CAST(support AS BIGINT) AS support FROM cls "
       f"UNION ALL SELECT model, 'accuracy', NULL, NULL, round(sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n), {R}), "
       "CAST(sum(n) AS BIGINT) FROM cm GROUP BY model "
       f"UNION ALL SELECT model, 'macro avg', round(avg(precision), {R}), round(avg(recall), {R}), round(avg(f1), {R}), "
       "CAST(sum(support) AS BIGINT) FROM cls GROUP BY model "
       f"UNION ALL SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), {R}), "
       f"round(sum(recall * support) / sum(support), {R}), round(sum(f1 * support) / sum(support), {R}), "
       "CAST(sum(support) AS BIGINT) FROM cls GROUP BY model")
def classification_report_accuracy(spark, sf):
    """The report with its accuracy row."""
    return EV.classification_report(scored(spark, sf), with_accuracy=True)


@query("evaluate_on_split",
       f"SELECT l.model, s.eval_split, CASE WHEN m.n > 0 THEN 'evaluated' ELSE 'error' END AS status, "
       "CASE WHEN coalesce(m.n, 0) > 0 THEN NULL WHEN l.model = 'mlp' THEN 'ValueError: no weights' ELSE 'no_valid_rows' END AS reason, "
       f"coalesce(m.n, 0) AS n, m.accuracy, m.f1_weighted FROM (VALUES ('rule_length'), ('rule_words'), ('mlp')) l(model) "
       f"LEFT JOIN ({METRICS_SQL}) m ON l.model = m.model CROSS JOIN "
       f"(SELECT CASE WHEN count(*) > 0 THEN 'test' END AS eval_split FROM ({SCORED_SQL})) s")
def evaluate_on_split(spark, sf):
    """Every listed model has a row (E15): two with scores, and one whose
    loading failed with a message."""
    sc = scored(spark, sf).withColumn("split", F.lit("test"))
    return EV.evaluate_on(sc, sc.select("split").distinct(), [*[m for m, _ in MODELS], "mlp"], {"mlp": "ValueError: no weights"})


@query("scored_reviews",
       "SELECT t.id, CASE WHEN length(t.full_text) > 100 THEN substr(t.full_text, 1, 100) || '...' ELSE t.full_text END AS preview, t.full_text, t.label, s.model, s.prediction, s.probability "
       "FROM (SELECT d.doc_id AS id, d.text AS full_text, CAST(l.quality AS INTEGER) AS label FROM documents d "
       f"LEFT JOIN labels l ON d.doc_id = l.doc_id) t LEFT JOIN ({SCORED_SQL}) s ON t.id = s.id")
def scored_reviews(spark, sf):
    """All reviews beside the scores of both rule models (F10); those outside
    of the test part have none."""
    texts = reviews(spark, sf).select("id", "text", F.col("label_raw").cast("int").alias("label"))
    return filters.scored_reviews(texts, scored(spark, sf))
