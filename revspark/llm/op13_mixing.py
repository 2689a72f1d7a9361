"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

1. Sources.  One aggregate gives each source its size in words.  In code
   point order (null last) they weigh 5, 2, 1, repeating, and share the words
   of all of them.  A target stops at ``CAP`` times its source's size and the
   excess goes to the others by weight.  The outcome is
   ``min(cap_i, weight_i * level)`` for one level, and a source is capped
   where ``cap_i / weight_i`` is below it; so the sources are put in the order
   of that ratio, and with running sums of caps and weights the level is read
   off where the caps end.  Both orders come from ``ranks.numbered``: no task
   sees all sources and none is collected.  Targets are fractions of whole
   numbers; budgets in words are their integer part.
2. Keys.  A document's key is -ln(u) / weight, exponential with its quality
   weight as rate; u is a digest of seed, doc_id and text, so that reruns agree
   and neither partitions nor order of the input matter.  Ascending keys are
   the order of weighted sampling without replacement.
3. Budgets.  A source's complete epochs (target / size, whole part) take every
   document that often.  What is left is filled in the order of the keys: a
   running sum of sizes takes documents as long as they fit, and the one that
   crosses the budget gives its first words up to it (``partial``; no text is
   a part of more than one such cut per source).  So a source gives exactly
   its budget and no document more than ``CAP`` times its words.

The sort is by range over (source, key): a source with a third of all rows
spreads like any other.  Texts are read once and never shuffled: sizes,
weights and keys are narrow rows.

Quality weight: the square of the share of a text's characters that are
neither digits nor ASCII punctuation, 0.05 at least; any column can be given.

Defined results: a null or blank text has size 0 and takes 0.  Rows are judged
one by one, so repeated rows and rows that share a doc_id or have none are
documents of their own; equal rows in the order of keys take their places in
any order.  A source of size 0 has target 0.  An empty table gives an empty
result.  Other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.sources.tables import table

from .common import stored
from .ranks import numbered

#: Shares of the sources in code point order, repeating.
SHARES = (5, 2, 1)
#: A source gives at most so many times its words.
CAP = 3
SEED = 13
#: 13 hexadecimal digits of the digest: u has 52 bits.
DIGITS, STEPS = 13, float(1 << 52)


def word_count(text) -> F.Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality_weight(text) -> F.Column:
    """Share of characters that are neither digits nor ASCII punctuation, squared."""
    plain = F.length(F.regexp_replace(text, r"[!-@\[-`{-~]", "")) / F.length(text)
    return F.when(F.length(text) > 0, F.greatest(F.lit(0.05), plain * plain)).otherwise(F.lit(0.05))


def exponential_key(weight, *identity, seed: int = SEED) -> F.Column:
    """-ln(u) / weight with u from a digest of ``identity``."""
    told = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("-")) for c in identity])
    u = (F.conv(F.substring(F.md5(told), 1, DIGITS), 16, 10).cast("double") + 0.5) / STEPS
    return -F.log(u) / weight


def targets(sizes: DataFrame, shares=SHARES, cap: int = CAP) -> DataFrame:
    """(source, source_size, budget, target) of every source in ``sizes``
    (source, source_size)."""
    known = sizes.withColumn("none", F.col("source").isNull()).withColumn("all", F.lit(0))
    share = F.element_at(F.array(*map(F.lit, shares)), (F.col("position") % len(shares) + 1).cast("int")).cast("long")
    ranked = numbered(known, "all", ["none", "source"], name="op13-sources").withColumn("share", share).drop("position")
    # ratios of cap to share as whole numbers: every share divides their product
    whole = 1
    for s in shares:
        whole *= s
    ranked = ranked.withColumn("cap", F.col("source_size") * cap)
    ranked = ranked.withColumn("ratio", F.expr(f"cap * ({whole} div share)"))
    by_cap = numbered(ranked, "all", ["ratio", "none", "source"], "cap", "op13-caps").drop("position")
    by_cap = by_cap.withColumnRenamed("running", "caps_before")
    by_cap = numbered(by_cap, "all", ["ratio", "none", "source"], "share", "op13-shares").drop("position")
    total, open_shares = by_cap.agg(F.sum("source_size"), F.sum("share")).first()  # two numbers
    # a source is capped when the level that all from it on would have is at least its ratio
    left, on = F.lit(total or 0) - F.col("caps_before"), F.lit(open_shares or 0) - F.col("running")
    capped = left * whole >= F.col("ratio") * on
    first = by_cap.filter(~capped).agg(F.max(left), F.max(on)).first()  # of the first one not capped: two numbers
    level, over = (F.lit(first[0] or 0), F.lit(first[1] or 1))
    free = F.col("share") * level
    return by_cap.select(
        "source", "source_size",
        F.when(capped, F.col("cap")).otherwise(F.expr(f"share * {first[0] or 0}L div {first[1] or 1}L")).alias("budget"),
        F.when(capped, F.col("cap").cast("double")).otherwise(free / over).alias("target"))


def mix(docs: DataFrame, weight: F.Column | None = None, shares=SHARES, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size,
    source, source_size, target, epochs (complete ones), partial (words that
    the last, fractional one takes from the document's start; the size where
    it takes it whole), taken, weight, key."""
    text = F.col("text")
    given = quality_weight(text) if weight is None else weight
    narrow = docs.select("doc_id", "source", word_count(text).alias("size"), given.cast("double").alias("weight"),
                         F.md5(F.coalesce(text, F.lit(""))).alias("told"))
    narrow = narrow.withColumn("key", exponential_key(F.col("weight"), F.col("doc_id"), F.col("told"), seed=seed))
    narrow = narrow.withColumn("tie", F.substring("told", 1, 8)).drop("told")
    narrow = stored(narrow, "op13-rows")  # ranges are sampled: texts would be read twice
    ranked = numbered(narrow, "source", ["key", "doc_id", "tie"], "size", "op13-keys")
    sizes = ranked.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = stored(targets(sizes, shares, cap), "op13-targets")
    joined = ranked.join(goal.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of")))
    joined = joined.withColumn("epochs", F.expr("CASE WHEN source_size > 0 THEN budget div source_size ELSE 0 END"))
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("running")
    joined = joined.withColumn("partial", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest)))
    return joined.select("doc_id", "size", "source", "source_size", "target", "epochs", "partial",
                         (F.col("epochs") * F.col("size") + F.col("partial")).alias("taken"), "weight", "key")


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` once per complete epoch and, where
    the last one takes part of it, once more with ``words`` below its size:
    (epoch, words, doc_id, source, size).  A reader joins texts as it needs."""
    chosen = mix(docs, **options)
    copies = F.expr("CASE WHEN partial > 0 THEN epochs + 1 ELSE epochs END")
    out = chosen.filter("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return out.select("epoch", F.when(F.col("epoch") > F.col("epochs"), F.col("partial")).otherwise(F.col("size")).alias("words"),
                      "doc_id", "source", "size")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "epochs", "partial")


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
k AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS size, md5(t) AS told,
         CASE WHEN length(t) > 0 THEN greatest(0.05::DOUBLE,
           (length(regexp_replace(t, '[!-@\[-`{{-~]', '', 'g'))::DOUBLE / length(t))
           * (length(regexp_replace(t, '[!-@\[-`{{-~]', '', 'g'))::DOUBLE / length(t))) ELSE 0.05::DOUBLE END AS weight
  FROM d),
r AS (
  SELECT *, -ln((('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '-') || '|' || told), 1, {DIGITS}))::BIGINT::DOUBLE
             + 0.5) / {STEPS:.1f}) / weight AS key
  FROM k),
o AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, substr(told, 1, 8)
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS running
  FROM r),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_extract([5, 2, 1], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT)::BIGINT AS share
  FROM k GROUP BY source),
c AS (
  SELECT *, {CAP} * source_size AS cap, {CAP} * source_size * (10 // share) AS ratio,
         sum(source_size) OVER ()::BIGINT AS total FROM s),
b AS (
  SELECT *, total - coalesce(sum(cap) OVER w, 0)::BIGINT AS rest,
         (sum(share) OVER () - coalesce(sum(share) OVER w, 0))::BIGINT AS open_shares
  FROM c WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (
  SELECT *, rest * 10 >= ratio * open_shares AS capped FROM b),
l AS (
  SELECT max(rest) AS rest, max(open_shares) AS open_shares FROM f WHERE NOT capped),
g AS (
  SELECT f.source, f.source_size,
         CASE WHEN capped THEN cap ELSE share * l.rest // l.open_shares END AS budget,
         CASE WHEN capped THEN cap::DOUBLE ELSE (share * l.rest)::DOUBLE / l.open_shares END AS target
  FROM f CROSS JOIN l),
e AS (
  SELECT o.doc_id, o.size, g.source_size, g.target, o.source, g.budget, o.running,
         CASE WHEN g.source_size > 0 THEN g.budget // g.source_size ELSE 0 END AS epochs
  FROM o JOIN g ON o.source IS NOT DISTINCT FROM g.source),
p AS (
  SELECT *, greatest(0, least(size, budget - epochs * source_size - running)) AS partial FROM e)
SELECT doc_id, size, source_size, target, epochs * size + partial AS taken, source, epochs, partial FROM p
"""
