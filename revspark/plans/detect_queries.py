"""Queries of the column detection operators, on driver tables."""
from __future__ import annotations

from ..operators import detection as D
from ..sources.tables import table
from .oracle_text import SPACE, q, rr
from .registry import query

WORD = r"\p{L}\p{N}_"
# schemas of the driver tables the oracles are written for
SCHEMAS = {
    "documents": (["doc_id", "text", "lang", "source", "n_chars"], "doc_id",
                  {"text", "lang", "source"}),
    "conversations": (["conv_id", "turn", "role", "text"], "conv_id, turn", {"role", "text"}),
}
KEYS = {"documents": "doc_id", "conversations": "conv_key"}


def _name_case(candidates, n="n") -> str:
    exact = " ".join(f"WHEN {n} = {q(c)} THEN {float(s)}" for c, s in candidates)
    partial = " ".join(f"WHEN contains({n}, {q(c)}) THEN {round(s * D.PARTIAL_FACTOR, 10)}"
                       for c, s in reversed(candidates))
    return f"CASE {exact} ELSE CASE {partial} ELSE 0.0 END END"


def _words(v: str) -> str:
    return f"len(list_filter(string_split(trim({rr(v, f'[{SPACE}]+', ' ')}), ' '), lambda w: length(w) > 0))"


def _text_content_sql(tbl, col, i, key, policy):
    values = f"SELECT CAST(\"{col}\" AS VARCHAR) AS v FROM {tbl} WHERE \"{col}\" IS NOT NULL"
    if policy == "extended":
        hits = " + ".join(f"max(CASE WHEN contains(lower(v), {q(w)}) THEN 1 ELSE 0 END)" for w in D.COMMON_WORDS_EXT)
        bonus = f"CASE WHEN {hits} > 2 THEN 10 ELSE 0 END"
    else:
        pat = f"(^|[^{WORD}])(" + "|".join(D.ENGLISH_WORDS) + f")([^{WORD}]|$)"
        bonus = f"CASE WHEN max(CASE WHEN regexp_matches(lower(v), {q(pat)}) THEN 1 ELSE 0 END) = 1 THEN 10 ELSE 0 END"
    return (f"SELECT {q(col)} AS \"column\", {i} AS ordinal, round(avg(length(v)), 6) AS avg_length, "
            f"round(avg({_words('v')}), 6) AS avg_words, {bonus} AS bonus, "
            f"avg(length(v)) AS al, avg({_words('v')}) AS aw FROM ({values})")


def _text_scores_sql(tbl, policy="standard"):
    cols, key, _ = SCHEMAS[tbl]
    parts = " UNION ALL ".join(_text_content_sql(tbl, c, i, key, policy) for i, c in enumerate(cols))
    return (f"SELECT \"column\", ordinal, avg_length, avg_words, bonus, CAST(CASE WHEN al > 50 AND aw > 5 THEN 25 "
            f"WHEN al > 20 AND aw > 3 THEN 15 WHEN al > 10 THEN 5 ELSE 0 END + bonus AS DOUBLE) AS content_score "
            f"FROM ({parts})")


def _label_scores_sql(tbl):
    cols, _, _ = SCHEMAS[tbl]
    parts = []
    for i, c in enumerate(cols):
        v = f"lower(CAST(\"{c}\" AS VARCHAR))"
        parts.append(
            f"SELECT {q(c)} AS \"column\", {i} AS ordinal, count(DISTINCT \"{c}\") AS n_unique, "
            f"max(CASE WHEN {v} IN ('0','1','true','false','yes','no') THEN 1 ELSE 0 END) AS b, "
            f"max(CASE WHEN {v} IN ('positive','negative','pos','neg') THEN 1 ELSE 0 END) AS p, "
            f"max(CASE WHEN {v} IN ('good','bad','neutral') THEN 1 ELSE 0 END) AS qq FROM {tbl}")
    return (f"SELECT \"column\", ordinal, n_unique, CAST(CASE WHEN n_unique = 0 THEN 0 WHEN b = 1 THEN 20 "
            f"WHEN p = 1 THEN 30 WHEN qq = 1 THEN 25 WHEN n_unique BETWEEN 2 AND 10 THEN 15 "
            f"WHEN n_unique = 1 THEN 1 ELSE 0 END AS DOUBLE) AS content_score FROM ({' UNION ALL '.join(parts)})")


def _detect_sql(tbl, policy="standard"):
    cols, _, _ = SCHEMAS[tbl]
    clean = "replace(lower(trim(c)), ' ', '_')" if policy == "extended" else "lower(trim(c))"
    names = " UNION ALL ".join(f"SELECT {q(c)} AS c, {i} AS ordinal" for i, c in enumerate(cols))
    return (
        f"WITH m AS (SELECT c AS \"column\", ordinal, {clean} AS n FROM ({names})), "
        f"nm AS (SELECT \"column\", ordinal, {_name_case(D.TEXT_CANDIDATES)} AS text_name, "
        f"{_name_case(D.LABEL_CANDIDATES)} AS label_name FROM m), "
        f"ts AS ({_text_scores_sql(tbl, policy)}), ls AS ({_label_scores_sql(tbl)}), "
        "b AS (SELECT nm.\"column\", nm.ordinal, 'text' AS role, text_name AS name_score, "
        "CASE WHEN text_name = 0 THEN ts.content_score END AS content_score FROM nm LEFT JOIN ts ON nm.\"column\" = ts.\"column\" "
        "UNION ALL SELECT nm.\"column\", nm.ordinal, 'label', label_name, "
        "CASE WHEN label_name = 0 THEN ls.content_score END FROM nm LEFT JOIN ls ON nm.\"column\" = ls.\"column\"), "
        "s AS (SELECT *, CASE WHEN name_score > 0 THEN name_score ELSE coalesce(content_score, 0.0) END AS score FROM b) "
        "SELECT role, \"column\", CAST(ordinal AS INTEGER) AS ordinal, CAST(round(name_score, 6) AS DOUBLE) AS name_score, "
        "round(content_score, 6) AS content_score, round(score, 6) AS score, "
        "row_number() OVER (PARTITION BY role ORDER BY score DESC, ordinal) AS rank FROM s WHERE score > 0")


def _conversations(spark, sf):
    return table(spark, sf, "conversations")


def _ordered(tbl):
    """Driver tables with a single ordering key for 'first rows' rules."""
    def run(spark, sf):
        df = table(spark, sf, tbl)
        if tbl == "conversations":
            # key: (conv_id, turn) packed in one sortable long
            from pyspark.sql import functions as F
            df = df.withColumn("__key", F.col("conv_id") * F.lit(1 << 20) + F.col("turn"))
            return df, "__key"
        return df, SCHEMAS[tbl][1]
    return run


@query("detect_columns", _detect_sql("documents"))
def detect_columns(spark, sf):
    df, key = _ordered("documents")(spark, sf)
    return D.detect_columns(df, key)


@query("detect_columns_extended", _detect_sql("documents", "extended"))
def detect_columns_extended(spark, sf):
    df, key = _ordered("documents")(spark, sf)
    return D.detect_columns(df, key, "extended")


@query("text_content_score", _text_scores_sql("documents"))
def text_content_score(spark, sf):
    df, key = _ordered("documents")(spark, sf)
    return D.text_content_scores(df, key, SCHEMAS["documents"][0])


@query("text_content_score_ext", _text_scores_sql("documents", "extended"))
def text_content_score_ext(spark, sf):
    df, key = _ordered("documents")(spark, sf)
    return D.text_content_scores(df, key, SCHEMAS["documents"][0], "extended")


@query("label_content_score", _label_scores_sql("conversations"))
def label_content_score(spark, sf):
    return D.label_content_scores(_conversations(spark, sf))


def _fallback_sql(tbl):
    cols, key, str_cols = SCHEMAS[tbl]
    tot = " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", {i} AS ordinal, CAST(sum(length(coalesce(CAST(\"{c}\" AS VARCHAR), 'nan'))) AS BIGINT) AS total_chars FROM {tbl}"
        for i, c in enumerate(cols))
    firsts = " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", avg(length(v)) AS a FROM (SELECT \"{c}\" AS v FROM {tbl} "
        f"WHERE \"{c}\" IS NOT NULL)" for c in cols if c in str_cols)
    return (f"SELECT t.\"column\", CAST(t.ordinal AS INTEGER) AS ordinal, t.total_chars, round(f.a, 6) AS first_avg_length, "
            f"f.a > 10 AS usable_text FROM ({tot}) t LEFT JOIN ({firsts}) f ON t.\"column\" = f.\"column\"")


@query("detect_fallback", _fallback_sql("documents"))
def detect_fallback(spark, sf):
    df, key = _ordered("documents")(spark, sf)
    return D.detect_fallback(df, key)


@query("detect_columns_simple",
       "SELECT 'text' AS role, 'text' AS \"column\" UNION ALL "
       "SELECT 'label', CASE WHEN count(DISTINCT role) + max(CASE WHEN role IS NULL THEN 1 ELSE 0 END) <= 5 "
       "AND max(CASE WHEN lower(role) IN ('0','1','positive','negative','pos','neg') THEN 1 ELSE 0 END) = 1 "
       "THEN 'role' END FROM conversations")
def detect_columns_simple(spark, sf):
    df = _conversations(spark, sf).select("text", "role")
    return D.detect_columns_simple(df, "text")
