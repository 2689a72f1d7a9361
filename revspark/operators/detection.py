"""Column detection of review tables of unknown layout.

Name scores are computed from the schema (metadata, on the driver).
Content scores are aggregates over the data:

* text content (C2-C4) is one aggregate over all non-null values of all
  columns in one scan.  The reference looks at the first values only (100 for
  lengths, 10 for words, 50 in the fallback); ``sample_rows`` asks for such a
  prefix by key order explicitly, per column a ``orderBy(key).limit(n)``;
* label content (C6) unpivots the columns in one scan and groups by (column,
  digest), so distinct values are counted with one shuffle of digests.

The result is a small table ``(column, role, name_score, content_score,
score, rank)``; ``rank`` orders by score descending, ties by column position.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WORD, word_count

# Name candidates and their scores, in the reference's order.
TEXT_CANDIDATES = [
    ("text", 100), ("review", 95), ("comment", 90), ("content", 85),
    ("description", 80), ("message", 75), ("body", 70), ("post", 65),
    ("review_text", 60), ("comment_text", 55), ("user_review", 50),
    ("product_review", 45), ("feedback", 40), ("opinion", 35),
    ("title", 30), ("summary", 25), ("abstract", 20), ("notes", 15),
]
LABEL_CANDIDATES = [
    ("label", 100), ("sentiment", 95), ("class", 90), ("target", 85),
    ("rating", 80), ("score", 75), ("category", 70),
    ("sentiment_label", 65), ("class_label", 60), ("star_rating", 55),
    ("review_score", 50), ("polarity", 45),
    ("outcome", 40), ("result", 35), ("type", 30), ("group", 25),
]
PARTIAL_FACTOR = 0.7
# Content rules.
ENGLISH_WORDS = ["the", "and", "is", "was", "good", "bad", "love", "hate"]
COMMON_WORDS_EXT = ["the", "and", "is", "was", "good", "bad", "love", "hate", "great", "nice"]
BINARY_VALUES = ["0", "1", "true", "false", "yes", "no"]
POLARITY_VALUES = ["positive", "negative", "pos", "neg"]
QUALITY_VALUES = ["good", "bad", "neutral"]
SIMPLE_TEXT_NAMES = ["text", "review", "comment", "content", "description", "message"]
SIMPLE_LABEL_NAMES = ["label", "sentiment", "class", "target", "rating"]
SIMPLE_LABEL_VALUES = ["0", "1", "positive", "negative", "pos", "neg"]
#: The reference's prefixes: (lengths, words) and the fallback's; pass them as ``sample_rows`` to get its results.
REFERENCE_SAMPLE, REFERENCE_FALLBACK_SAMPLE = (100, 10), 50


def clean_name(name: str, policy: str = "standard") -> str:
    n = name.strip().lower()
    return n.replace(" ", "_") if policy == "extended" else n


def name_score(name: str, candidates, policy: str = "standard") -> float:
    """Exact match -> its score (stop); substring -> 0.7 x score, a later
    substring match overwriting an earlier one."""
    n = clean_name(name, policy)
    score = 0.0
    for cand, s in candidates:
        if n == cand:
            return float(s)
        if cand in n:
            score = s * PARTIAL_FACTOR
    return score


def _as_text(df: DataFrame, name: str):
    """``str(value)`` of a cell: strings as they are, numbers printed."""
    return F.col(f"`{name}`").cast("string")


def _first_values(df: DataFrame, name: str, key: str, n: int) -> DataFrame:
    """The first ``n`` non-null values of a column by ``key`` order."""
    c = F.col(f"`{name}`")
    return (df.where(c.isNotNull()).orderBy(F.col(key)).limit(n)
              .select(F.lit(name).alias("column"), F.col(key).alias("k"), _as_text(df, name).alias("v")))


def _word_hit(words) -> str:
    return "(?<![" + WORD + "])(?:" + "|".join(words) + ")(?![" + WORD + "])"


def _text_aggregates(v, policy: str, for_bonus=None) -> tuple:
    """Average length, average words and the word bonus of the values ``v``;
    ``for_bonus`` limits the values that count for the bonus."""
    inside = v.isNotNull() if for_bonus is None else for_bonus & v.isNotNull()
    low = F.lower(v)
    if policy == "extended":
        hits = [F.coalesce(F.max(F.when(inside & low.contains(w), 1).otherwise(0)), F.lit(0)) for w in COMMON_WORDS_EXT]
        bonus = F.when(reduce(lambda a, b: a + b, hits) > 2, 10).otherwise(0)
    else:
        bonus = F.when(F.max(F.when(inside & low.rlike(_word_hit(ENGLISH_WORDS)), 1).otherwise(0)) == 1, 10).otherwise(0)
    return F.avg(F.length(v)), F.avg(F.when(v.isNotNull(), word_count(v))), bonus


def text_content_scores(df: DataFrame, key: str, columns=None, policy: str = "standard",
                        sample_rows: tuple[int, int] | None = None) -> DataFrame:
    """Per column: avg length / words of all non-null values, the
    English-word bonus, and the content score.  ``sample_rows`` = (values for
    the lengths, values for the bonus) takes the first ones by ``key``."""
    cols = [c for c in (columns or df.columns)]
    if sample_rows is None:
        rows = []
        for i, name in enumerate(cols):
            length, words, bonus = _text_aggregates(_as_text(df, name), policy)
            rows.append(F.struct(F.lit(name).alias("column"), F.lit(i).alias("ordinal"), length.alias("avg_length"),
                                 words.alias("avg_words"), bonus.alias("bonus")))
        agg = (df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
                 .filter(F.col("avg_length").isNotNull()))
    else:
        parts = []
        for i, name in enumerate(cols):
            first = _first_values(df, name, key, sample_rows[0])
            pos = F.row_number().over(Window.partitionBy("column").orderBy("k"))
            length, words, bonus = _text_aggregates(F.col("v"), policy, F.col("pos") <= sample_rows[1])
            parts.append(first.withColumn("pos", pos).groupBy("column").agg(
                length.alias("avg_length"), words.alias("avg_words"), bonus.alias("bonus")).withColumn("ordinal", F.lit(i)))
        agg = reduce(DataFrame.unionByName, parts)
    base = (F.when((F.col("avg_length") > 50) & (F.col("avg_words") > 5), 25)
             .when((F.col("avg_length") > 20) & (F.col("avg_words") > 3), 15)
             .when(F.col("avg_length") > 10, 5).otherwise(0))
    return agg.select("column", "ordinal", F.round("avg_length", 6).alias("avg_length"),
                      F.round("avg_words", 6).alias("avg_words"), "bonus",
                      (base + F.col("bonus")).cast("double").alias("content_score"))


def label_content_scores(df: DataFrame, columns=None) -> DataFrame:
    """Per column, over all non-null values: distinct count and label score.

    One scan unpivots the columns; values are grouped by (column, digest)
    with partial sums in the tasks, so long strings are not shuffled."""
    cols = list(columns or df.columns)

    def cell(i, name):
        raw, v = F.col(f"`{name}`"), F.lower(_as_text(df, name))
        return F.struct(F.lit(i).alias("ordinal"), F.sha2(raw.cast("string"), 256).alias("d"), *[
            F.when(v.isin(*values), 1).otherwise(0).alias(flag)
            for flag, values in (("b", BINARY_VALUES), ("p", POLARITY_VALUES), ("q", QUALITY_VALUES))])
    cells = df.select(F.explode(F.array(*[cell(i, c) for i, c in enumerate(cols)])).alias("x")).select("x.*")
    flags = ("b", "p", "q")
    seen = cells.filter(F.col("d").isNotNull()).groupBy("ordinal", "d").agg(*[F.max(c).alias(c) for c in flags])
    per = seen.groupBy("ordinal").agg(F.count(F.lit(1)).alias("n"), *[F.max(c).alias(c) for c in flags])
    every = df.sparkSession.createDataFrame(list(enumerate(cols)), "ordinal int, column string")
    n, b, p, q = F.coalesce("n", F.lit(0)), F.col("b"), F.col("p"), F.col("q")
    score = (F.when(n == 0, 0).when(b == 1, 20).when(p == 1, 30).when(q == 1, 25)
              .when((n >= 2) & (n <= 10), 15).when(n == 1, 1).otherwise(0))
    return every.join(per, "ordinal", "left").select("column", "ordinal", n.alias("n_unique"),
                                                     score.cast("double").alias("content_score"))


def detect_columns(df: DataFrame, key: str, policy: str = "standard", exclude: tuple = (),
                   sample_rows: tuple[int, int] | None = None) -> DataFrame:
    """Scored and ranked text / label candidates (score > 0) among the
    columns that are not in ``exclude``."""
    spark = df.sparkSession
    cols = [c for c in df.columns if c not in exclude]
    names = [(c, i, name_score(c, TEXT_CANDIDATES, policy), name_score(c, LABEL_CANDIDATES, policy))
             for i, c in enumerate(cols)]
    meta = spark.createDataFrame(names, "column string, ordinal int, text_name double, label_name double")
    empty = spark.createDataFrame([], "column string, content_score double")
    tcols = [c for c, _, t, _ in names if t == 0]
    lcols = [c for c, _, _, lab in names if lab == 0]
    text_cs = text_content_scores(df, key, tcols, policy, sample_rows) if tcols else empty
    label_cs = label_content_scores(df, lcols) if lcols else empty
    t = (meta.join(text_cs.select("column", "content_score"), "column", "left")
             .select("column", "ordinal", F.lit("text").alias("role"), F.col("text_name").alias("name_score"),
                     F.when(F.col("text_name") == 0, F.col("content_score")).alias("content_score")))
    lab = (meta.join(label_cs.select("column", "content_score"), "column", "left")
               .select("column", "ordinal", F.lit("label").alias("role"), F.col("label_name").alias("name_score"),
                       F.when(F.col("label_name") == 0, F.col("content_score")).alias("content_score")))
    both = t.unionByName(lab).withColumn(
        "score", F.when(F.col("name_score") > 0, F.col("name_score")).otherwise(F.coalesce("content_score", F.lit(0.0))))
    w = Window.partitionBy("role").orderBy(F.col("score").desc(), F.col("ordinal").asc())
    return (both.filter(F.col("score") > 0)
                .withColumn("rank", F.row_number().over(w))
                .select("role", "column", "ordinal", F.round("name_score", 6).alias("name_score"),
                        F.round("content_score", 6).alias("content_score"),
                        F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank")))


def detect_fallback(df: DataFrame, key: str, exclude: tuple = (), sample_rows: int | None = None) -> DataFrame:
    """Fallback evidence: avg length of the non-null values of each string
    column, and total printed characters of every column (null counts as the
    3 characters of ``nan``), in one scan.  ``sample_rows`` limits the average
    to the first values by ``key``."""
    cols = [c for c in df.columns if c not in exclude]
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    none = F.lit(None).cast("double")
    out = df.agg(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(i).alias("ordinal"),
        F.sum(F.length(F.coalesce(_as_text(df, c), F.lit("nan")))).alias("total_chars"),
        (F.avg(F.length(F.col(f"`{c}`"))) if c in strings else none).alias("a"))
        for i, c in enumerate(cols)]).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    if sample_rows is not None and strings:
        firsts = reduce(DataFrame.unionByName, [
            _first_values(df, c, key, sample_rows).groupBy("column").agg(F.avg(F.length("v")).alias("a"))
            for c in cols if c in strings])
        out = out.drop("a").join(firsts, "column", "left")
    return out.select("column", "ordinal", "total_chars", F.round("a", 6).alias("first_avg_length"),
                      (F.col("a") > 10).alias("usable_text"))


def detect_columns_simple(df: DataFrame, key: str) -> DataFrame:
    """Dashboard detection: one row per role with the chosen column (or null)."""
    spark = df.sparkSession
    cols = df.columns

    def by_name(names):
        for c in cols:
            if c.lower().strip() in names:
                return c
        for c in cols:
            for n in names:
                if n in c.lower():
                    return c
        return None

    text = by_name(SIMPLE_TEXT_NAMES)
    label = by_name(SIMPLE_LABEL_NAMES)
    rows = []
    if text is None:
        # first string column whose values average more than 10 characters; the reference looks at one row
        str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        pick = F.lit(cols[0] if cols else None)
        for c in reversed(str_cols):
            pick = F.when(F.avg(F.length(F.coalesce(F.col(f"`{c}`"), F.lit("nan")))) > 10, F.lit(c)).otherwise(pick)
        text_df = df.agg(pick.alias("column")).select(F.lit("text").alias("role"), "column")
    else:
        text_df = spark.createDataFrame([("text", text)], "role string, column string")
    if label is None:
        aggs = []
        for i, c in enumerate(cols):
            v = F.lower(_as_text(df, c))
            aggs += [(F.count_distinct(F.col(f"`{c}`")) + F.max(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0))).alias(f"n{i}"),
                     F.max(F.when(v.isin(*SIMPLE_LABEL_VALUES), 1).otherwise(0)).alias(f"h{i}")]
        row = df.agg(*aggs)
        pick = F.lit(None).cast("string")
        for i, c in reversed(list(enumerate(cols))):
            pick = F.when((F.col(f"n{i}") <= 5) & (F.col(f"h{i}") == 1), F.lit(c)).otherwise(pick)
        label_df = row.select(F.lit("label").alias("role"), pick.alias("column"))
    else:
        label_df = spark.createDataFrame([("label", label)], "role string, column string")
    rows.append(text_df)
    rows.append(label_df)
    return reduce(DataFrame.unionByName, rows)



def resolve_columns(df: DataFrame, key: str, force_text: str | None = None, force_label: str | None = None,
                    policy: str = "standard", exclude: tuple = ()) -> dict:
    """Text / label columns to use: forced names win (confidence 100), else
    the best detected candidates.  When the best text score is below 10 the
    fallback applies: the first string column whose non-null values
    average more than 10 characters (confidence 5), else the column
    with the most printed characters (confidence 1).  A forced or detected
    text column that is not in the table raises ``ValueError`` listing the
    available columns.  Collected: at most two detection rows and one
    fallback row per column."""
    if force_text or force_label:
        picks = {"text": force_text, "label": force_label}
        confidence = 100 if force_text else 0
    else:
        best = sorted(detect_columns(df, key, policy, exclude).select("role", "column", "score", "rank").collect(),
                      key=lambda r: r["rank"])
        texts, labels = ([r for r in best if r["role"] == role] for role in ("text", "label"))
        picks = {"text": texts[0]["column"] if texts else None}
        confidence = texts[0]["score"] if texts else 0
        if confidence < 10:
            rows = sorted(detect_fallback(df, key, exclude).collect(), key=lambda r: r["ordinal"])
            usable = [r for r in rows if r["usable_text"]]
            if usable:
                picks["text"], confidence = usable[0]["column"], 5
            else:
                top = max(rows, key=lambda r: (r["total_chars"] or 0, -r["ordinal"]), default=None)
                if top is not None and (top["total_chars"] or 0) > 0:
                    picks["text"], confidence = top["column"], 1
        # the text column is no label of itself
        picks["label"] = next((r["column"] for r in labels if r["column"] != picks["text"]), None)
    text = picks.get("text")
    if not text or text not in df.columns:
        raise ValueError(f"no usable text column among {list(df.columns)}")
    label = picks.get("label")
    if label is not None and label not in df.columns:
        raise ValueError(f"label column {label!r} is not among {list(df.columns)}")
    return {"text": text, "label": label, "text_confidence": confidence}
