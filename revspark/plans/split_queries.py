"""Queries of the split operators, with SQL oracles that re-derive sizes,
class quotas, the stratification fallback and the md5 ranking."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters, splits
from ..sources.tables import reviews, table
from .oracle_text import SPACE, cleaned_cte, rr
from .registry import query
from .text_queries import REVIEWS_SQL, _label_sql


def split_sql(src: str, r1: str, r2: str, guard: str = "", strat_only: bool = False,
              copy_val: bool = False) -> str:
    """SQL of a one- or two-step split of ``src(id, label)``.

    ``r1``/``r2`` are SQL expressions of ``n`` (``r2`` may be NULL = one
    step).  ``guard`` is a CASE prefix deciding whole-table outcomes.
    """
    ok = "TRUE" if strat_only else "ok"
    body = f"""
WITH src AS ({src}),
cc AS (SELECT label, count(*) AS c FROM src GROUP BY label),
t AS (SELECT sum(c) AS n, count(*) AS k, min(c) AS minc,
             max(CASE WHEN label IN (0, 1) THEN 1 ELSE 0 END) AS has FROM cc),
p AS (SELECT n, k, minc, has, CAST({r1} AS DOUBLE) AS r1, CAST({r2} AS DOUBLE) AS r2 FROM t),
s1 AS (SELECT *, CAST(ceil(r1 * n) AS BIGINT) AS nt1 FROM p),
a1 AS (SELECT cc.label, cc.c, CAST(cc.c AS DOUBLE) / s1.n * (s1.n - s1.nt1) AS cont FROM cc, s1),
b1 AS (SELECT label, c, floor(cont) AS fl, cont - floor(cont) AS rem FROM a1),
n1 AS (SELECT (SELECT n - nt1 FROM s1) - sum(fl) AS need FROM b1),
q1 AS (SELECT label, c, CAST(fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
              <= (SELECT need FROM n1) THEN 1 ELSE 0 END AS BIGINT) AS qtrain FROM b1),
tmp AS (SELECT label, c - qtrain AS tc FROM q1),
t2 AS (SELECT sum(tc) AS n2, count(*) FILTER (WHERE tc > 0) AS k2, min(tc) FILTER (WHERE tc > 0) AS minc2 FROM tmp),
s2 AS (SELECT n2, k2, minc2, r2, CAST(ceil(r2 * n2) AS BIGINT) AS nt2 FROM t2, p),
a2 AS (SELECT tmp.label, tc, CASE WHEN tc > 0 THEN CAST(tc AS DOUBLE) / n2 * (n2 - nt2) END AS cont FROM tmp, s2),
b2 AS (SELECT label, tc, coalesce(floor(cont), 0) AS fl, coalesce(cont - floor(cont), -1) AS rem FROM a2),
n2x AS (SELECT (SELECT n2 - nt2 FROM s2) - sum(fl) AS need FROM b2),
q2 AS (SELECT label, CASE WHEN (SELECT r2 FROM p) IS NULL THEN 0 ELSE CAST(fl + CASE WHEN tc > 0 AND
              row_number() OVER (ORDER BY rem DESC, label) <= (SELECT need FROM n2x) THEN 1 ELSE 0 END AS BIGINT) END AS qval
       FROM b2),
so AS (SELECT (minc >= 2 AND n - nt1 >= k AND nt1 >= k) AND
              (s1.r2 IS NULL OR (minc2 >= 2 AND n2 - nt2 >= k2 AND nt2 >= k2)) AS ok,
              n - nt1 AS gt, CASE WHEN s1.r2 IS NULL THEN 0 ELSE nt1 - CAST(ceil(s1.r2 * nt1) AS BIGINT) END AS gv,
              n, has FROM s1, s2),
rk AS (SELECT id, label,
              row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(id AS VARCHAR)), id) - 1 AS rs,
              row_number() OVER (ORDER BY md5('42|' || CAST(id AS VARCHAR)), id) - 1 AS rg FROM src),
res AS (
SELECT rk.id, rk.label, {guard} CASE WHEN {ok} THEN
         (CASE WHEN rs < qtrain THEN 'train' WHEN rs < qtrain + qval THEN 'val' ELSE 'test' END)
       ELSE (CASE WHEN rg < gt THEN 'train' WHEN rg < gt + gv THEN 'val' ELSE 'test' END) END
       {"END" if guard else ""} AS split
FROM rk JOIN q1 ON rk.label = q1.label JOIN q2 ON rk.label = q2.label, so)
"""
    if copy_val:
        return body + "SELECT * FROM res UNION ALL SELECT id, label, 'val' FROM res WHERE split = 'test'"
    return body + "SELECT * FROM res"


STANDARD_GUARD = "CASE WHEN n < 3 THEN 'test' WHEN has = 0 THEN 'inference' ELSE"
STANDARD_R1 = "CASE WHEN n < 10 THEN 0.3 WHEN n < 50 THEN 0.4 ELSE 0.3 END"
STANDARD_R2 = "CASE WHEN n < 10 THEN NULL ELSE 0.5 END"

LABELS_SRC = "SELECT doc_id AS id, quality AS label FROM labels"


@query("split_standard", split_sql(LABELS_SRC, STANDARD_R1, STANDARD_R2, STANDARD_GUARD))
def split_standard(spark, sf):
    df = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return splits.split(df, "standard").select("id", "label", "split")


_STD = cleaned_cte(REVIEWS_SQL, "standard", keep="id, label_raw")
PROCESSED_STD = (f"WITH {_STD[0]} SELECT id, CAST({_label_sql('standard')} AS INTEGER) AS label "
                 f"FROM c WHERE length(t) >= 3")


@query("split_standard_reviews", split_sql(PROCESSED_STD, STANDARD_R1, STANDARD_R2, STANDARD_GUARD))
def split_standard_reviews(spark, sf):
    df = filters.with_labels(filters.valid_texts(reviews(spark, sf), "standard"), "standard")
    return splits.split(df.select("id", "label"), "standard")


_EXT = cleaned_cte(REVIEWS_SQL, "extended", keep="id, label_raw")
PROCESSED_EXT = (f"WITH {_EXT[0]} SELECT id, CAST({_label_sql('extended')} AS INTEGER) AS label FROM c "
                 f"WHERE length({rr('t', f'^[{SPACE}]+|[{SPACE}]+$', '')}) > 3")


@query("split_extended", split_sql(PROCESSED_EXT, "0.3", "CASE WHEN n >= 100 THEN 0.5 ELSE NULL END",
                                   "CASE WHEN n < 10 OR has = 0 THEN 'inference' ELSE", strat_only=True))
def split_extended(spark, sf):
    df = filters.with_labels(filters.valid_texts(reviews(spark, sf), "extended"), "extended")
    return splits.split(df.select("id", "label"), "extended")


RUNNER_SRC = ("SELECT d.doc_id AS id, CAST(l.quality AS INTEGER) AS label FROM documents d "
              "LEFT JOIN labels l ON d.doc_id = l.doc_id "
              "WHERE d.text IS NOT NULL AND length(d.text) > 5 AND l.quality IN (0, 1)")


@query("split_runner", split_sql(RUNNER_SRC, "0.3", "0.5", "CASE WHEN n < 100 OR has = 0 THEN 'inference' ELSE",
                                 strat_only=True))
def split_runner(spark, sf):
    df = filters.normalize_label_filter(filters.valid_texts_raw(reviews(spark, sf)))
    return splits.split(df.select("id", "label"), "runner")


@query("split_train_val", split_sql(LABELS_SRC, "0.2", "NULL").replace("'test' END)", "'val' END)")
       .replace("WHEN rs < qtrain + qval THEN 'val' ELSE 'val'", "ELSE 'val'")
       .replace("WHEN rg < gt + gv THEN 'val' ELSE 'val'", "ELSE 'val'"))
def split_train_val(spark, sf):
    df = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return splits.split(df, "train_val").select("id", "label", "split")


def _train_val_sql(src: str) -> str:
    return (split_sql(src, "0.2", "NULL").replace("'test' END)", "'val' END)")
            .replace("WHEN rs < qtrain + qval THEN 'val' ELSE 'val'", "ELSE 'val'")
            .replace("WHEN rg < gt + gv THEN 'val' ELSE 'val'", "ELSE 'val'"))


@query("split_train_val_mlp", _train_val_sql(f"SELECT * FROM ({PROCESSED_EXT}) WHERE label <> -1"))
def split_train_val_mlp(spark, sf):
    """MLP carve-out on extended-processed reviews: the labelled rows
    (label != -1) are split 80/20, stratified."""
    df = filters.with_labels(filters.valid_texts(reviews(spark, sf), "extended"), "extended")
    return splits.split(df.select("id", "label"), "train_val_mlp")
