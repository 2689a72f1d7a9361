"""Reproducible (stratified) train / val / test splits (M1-M4).

Contract (not sklearn's seed-42 permutation, which cannot be reproduced):

* sizes: ``n_test = ceil(ratio * n)`` in doubles, ``n_train = n - n_test``;
* per-class quotas of the first part: floor of the proportional share,
  remaining rows to the largest fractional parts, ties to the smaller label
  (null is a label of its own, after all others);
* membership: rows ordered inside their class by ``md5('42|' || id)`` then
  ``id``; the first ``q_train`` rows are train, the next ``q_val`` val, the
  rest test.  If stratifying is impossible (a class with < 2 rows, or a side
  with fewer rows than classes) the policy falls back to the same order over
  all rows.  Rows that repeat an id go to the same part.

Scale: the input plan, which may clean every text, runs once for the narrow
rows (id, label) that are kept in the checkpoint folder, and once more only to
assign parts to rows that have further columns.  Rows are never ranked as a
whole and their other columns never move.  Class sizes per md5 bucket (map-side partial counts) tell which bucket holds
each quota border; only the ids of these buckets, at most two per class, are
ordered to read off the border key.  Every row is then assigned where it is,
by comparing its key with the borders of its class (a broadcast of one row
per class; class sizes are the only thing collected).
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SEED = "42"
ROWS_PER_BUCKET = 1_000_000

# Split schedules (test ratio of each successive split).
STANDARD_SMALL = [0.3]            # n < 10: train / test
STANDARD_MEDIUM = [0.4, 0.5]      # n < 50: train / val / test
STANDARD_LARGE = [0.3, 0.5]       # otherwise
TRAIN_VAL = [0.2]
SVM_MIN_SPLIT_ROWS = 20
MLP_SMALL_VAL_ROWS = 5


class StratifyError(ValueError):
    pass


def label_key(label) -> tuple:
    """Sort key of labels: null comes last."""
    return label is None, label if label is not None else 0


def in_order(counts) -> list[tuple]:
    return sorted(((lab, c) for lab, c in counts if c > 0), key=lambda lc: label_key(lc[0]))


def approximate_mode(counts: list[tuple[int, int]], n_draws: int) -> dict[int, int]:
    """Largest-remainder allocation of ``n_draws`` over ``(label, count)``."""
    total = sum(c for _, c in counts)
    cont = {lab: c / total * n_draws for lab, c in counts}
    fl = {lab: math.floor(v) for lab, v in cont.items()}
    need = int(n_draws - sum(fl.values()))
    order = sorted(counts, key=lambda lc: (-(cont[lc[0]] - fl[lc[0]]), *label_key(lc[0])))
    for lab, _ in order[:max(need, 0)]:
        fl[lab] += 1
    return fl


def _split_sizes(n: int, ratio: float) -> tuple[int, int]:
    n_test = math.ceil(ratio * n)
    return n - n_test, n_test


def plan_quotas(counts: list[tuple[int, int]], ratios: list[float], stratify: bool = True):
    """Per-label quotas for the parts produced by successive splits.

    ``ratios`` holds the test ratio of each split; split ``i`` cuts the test
    side of split ``i-1``.  Returns ``(parts, stratified)`` where ``parts``
    maps label -> list of part sizes (len(ratios) + 1 entries).  In the
    random fallback the single label key is ``None``.
    """
    counts = in_order(counts)
    if stratify:
        try:
            return _stratified(counts, ratios), True
        except StratifyError:
            pass
    n = sum(c for _, c in counts)
    sizes, rest = [], n
    for r in ratios:
        first, rest = _split_sizes(rest, r)
        sizes.append(first)
    sizes.append(rest)
    return {None: sizes}, False


def _stratified(counts, ratios):
    parts = {lab: [] for lab, _ in counts}
    cur = list(counts)
    for r in ratios:
        present = [(lab, c) for lab, c in cur if c > 0]
        n = sum(c for _, c in present)
        n_train, n_test = _split_sizes(n, r)
        k = len(present)
        if min(c for _, c in present) < 2 or n_train < k or n_test < k:
            raise StratifyError("cannot stratify")
        q = approximate_mode(present, n_train)
        nxt = []
        for lab, c in cur:
            take = q.get(lab, 0)
            parts[lab].append(take)
            nxt.append((lab, c - take))
        cur = nxt
    for lab, c in cur:
        parts[lab].append(c)
    return parts


def _rank_key(id_col: str):
    return F.md5(F.concat(F.lit(SEED + "|"), F.col(id_col).cast("string")))


def borders(df: DataFrame, stratum, positions: dict, id_col: str, n_rows: int, rows_per_bucket: int) -> DataFrame:
    """``(s, borders)``: per stratum the keys ``(md5, id)`` of the rows at
    ``positions[stratum]`` (0-based, in key order); a position after the last
    row has none."""
    spark = df.sparkSession
    nb = max(1, math.ceil(n_rows / rows_per_bucket))
    bucket = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.lit(nb) / F.lit(1 << 32)).cast("long")
    keys = df.select(stratum.alias("s"), _rank_key(id_col).alias("h"), F.col(id_col).alias("i")).withColumn("b", bucket)
    sizes = keys.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("s").orderBy("b").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    wanted = spark.createDataFrame([(lab, int(p)) for lab, ps in positions.items() for p in ps],
                                   f"s {df.select(stratum.alias('s')).schema[0].dataType.simpleString()}, p long")
    held = sizes.withColumn("before", before).join(F.broadcast(wanted).withColumnRenamed("s", "ws"), F.col("s").eqNullSafe(F.col("ws"))
                                                   & (F.col("p") >= F.col("before")) & (F.col("p") < F.col("before") + F.col("n")))
    held = held.select(F.col("s").alias("hs"), F.col("b").alias("hb"), "before", "p")
    at = F.row_number().over(Window.partitionBy("hs", "hb", "p").orderBy("h", "i")) - 1 + F.col("before")
    found = keys.join(F.broadcast(held), F.col("s").eqNullSafe(F.col("hs")) & (F.col("b") == F.col("hb"))).withColumn("at", at)
    return found.filter(F.col("at") == F.col("p")).groupBy("s").agg(F.collect_list(F.struct("h", "i")).alias("borders"))


def _assign(spark: SparkSession, df: DataFrame, keys: DataFrame, parts: dict, stratified: bool, names: list[str],
            label_col: str, id_col: str, rows_per_bucket: int) -> DataFrame:
    """``df`` with ``split``; ``keys``: its ids and labels alone."""
    n_rows = sum(sum(v) for v in parts.values())
    stratum = F.col(label_col) if stratified else F.lit(0)
    positions, first = {}, []
    for lab, sizes in parts.items():
        ends = [sum(sizes[: i + 1]) for i in range(len(names) - 1)]
        positions[lab if stratified else 0] = [p for p in ends if 0 < p < sum(sizes)]
        # parts before the first row of the class, and the names of the others in order
        filled = [(n, size) for n, size in zip(names, sizes) if size > 0]
        first.append((lab if stratified else 0, [n for n, _ in filled] or [names[-1]]))
    kind = df.select(stratum.alias("s")).schema[0].dataType.simpleString()
    named = spark.createDataFrame(first, f"fs {kind}, part_names array<string>")
    found = borders(keys, stratum, positions, id_col, n_rows, rows_per_bucket)
    per_class = named.join(found, F.col("fs").eqNullSafe(F.col("s")), "left").select(
        "fs", "part_names", F.coalesce("borders", F.array().cast(found.schema["borders"].dataType)).alias("borders"))
    key = F.struct(_rank_key(id_col).alias("h"), F.col(id_col).alias("i"))
    part = F.element_at("part_names", F.lit(1) + F.size(F.filter("borders", lambda b: b <= key)))
    return df.join(F.broadcast(per_class), stratum.eqNullSafe(F.col("fs"))).withColumn("split", part).drop(
        "fs", "part_names", "borders")


def class_counts(df: DataFrame, label_col: str = "label") -> list[tuple[int, int]]:
    """The only collected data of a split: one row per label."""
    return [(r[0], r[1]) for r in df.groupBy(label_col).count().collect()]


def split(df: DataFrame, policy: str = "standard", label_col: str = "label", id_col: str = "id",
          rows_per_bucket: int = ROWS_PER_BUCKET, min_samples: int = 10,
          with_strategy: bool = False) -> DataFrame:
    """Add a ``split`` column (train / val / test / inference) by ``policy``.

    * ``standard``: no valid label -> inference; n < 10: 70/30; n < 50:
      60/20/20; else 70/15/15; stratified on the label, random fallback.
    * ``extended``: n < 10 or no valid label -> inference; n >= 100:
      70/15/15; else 70/30 with val a copy of test; no fallback (error).
    * ``runner``: n >= 100 with labels -> 70/15/15, else inference.
    * ``train_val`` (SVM carve-out): 80/20 train / val, stratified, random
      fallback; below 20 rows the first fifth by id is val.
    * ``train_val_mlp``: labelled rows (label != -1) stratified 80/20 when
      there are two classes and more than ``min_samples`` of them; else a
      random 80/20 over all rows when ``n >= min_samples``; else all rows
      train and the first 5 by id also form val.

    The row-count rules above are the reference's schedules; which one was
    taken is the column ``strategy`` of the result if ``with_strategy``.
    ``standard`` raises ValueError below 3 rows.
    """
    out, strategy = _split(df, policy, label_col, id_col, rows_per_bucket, min_samples)
    return out.withColumn("strategy", F.lit(strategy)) if with_strategy else out


def _split(df: DataFrame, policy: str, label_col: str, id_col: str, rows_per_bucket: int, min_samples: int):
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = df.select(id_col, label_col).checkpoint()  # counts, bucket sizes and borders read these
    if set(df.columns) == set(keys.columns):
        df = keys.select(*df.columns)
    counts = class_counts(keys, label_col)
    n = sum(c for _, c in counts)
    has = any(lab in (0, 1) for lab, c in counts if c > 0)
    three = ["train", "val", "test"]
    if policy == "standard":
        if n < 3:
            raise ValueError(f"a split needs at least 3 rows, got {n}")
        if not has:
            return df.withColumn("split", F.lit("inference")), "inference"
        ratios = STANDARD_SMALL if n < 10 else STANDARD_MEDIUM if n < 50 else STANDARD_LARGE
        strategy = "train_test" if n < 10 else "train_val_test_small" if n < 50 else "train_val_test"
        names = ["train", "test"] if n < 10 else three
        parts, strat = plan_quotas(counts, ratios)
        return _assign(spark, df, keys, parts, strat, names, label_col, id_col, rows_per_bucket), (
            strategy if strat else f"{strategy}_random")
    if policy == "extended":
        if n < 10 or not has:
            return df.withColumn("split", F.lit("inference")), "inference"
        ratios = STANDARD_LARGE if n >= 100 else STANDARD_SMALL
        parts = _stratified(in_order(counts), ratios)
        if n >= 100:
            return _assign(spark, df, keys, parts, True, three, label_col, id_col, rows_per_bucket), "train_val_test"
        out = _assign(spark, df, keys, parts, True, ["train", "test"], label_col, id_col, rows_per_bucket)
        return out.unionByName(out.filter(F.col("split") == "test").withColumn("split", F.lit("val"))), "train_test_as_val"
    if policy == "runner":
        if n < 100 or not has:
            return df.withColumn("split", F.lit("inference")), "inference"
        parts = _stratified(in_order(counts), STANDARD_LARGE)
        return _assign(spark, df, keys, parts, True, three, label_col, id_col, rows_per_bucket), "train_val_test"
    if policy == "train_val":
        if n < SVM_MIN_SPLIT_ROWS:
            # fewer than 20 rows: the first fifth (by id) is validation
            return _first_rows(df, id_col, max(1, n // 5), copy=False), "first_fifth"
        parts, strat = plan_quotas(counts, TRAIN_VAL)
        return _assign(spark, df, keys, parts, strat, ["train", "val"], label_col, id_col, rows_per_bucket), (
            "train_val" if strat else "train_val_random")
    if policy == "train_val_mlp":
        labelled = [(lab, c) for lab, c in counts if lab is not None and lab != -1 and c > 0]
        n_lab = sum(c for _, c in labelled)
        if len(labelled) > 1 and n_lab > min_samples:
            parts = _stratified(in_order(labelled), TRAIN_VAL)
            labelled = F.col(label_col) != -1
            return _assign(spark, df.filter(labelled), keys.filter(labelled), parts, True, ["train", "val"],
                           label_col, id_col, rows_per_bucket), "train_val"
        if n >= min_samples:
            parts, _ = plan_quotas(counts, TRAIN_VAL, stratify=False)
            return _assign(spark, df, keys, parts, False, ["train", "val"], label_col, id_col, rows_per_bucket), "train_val_random"
        # very small: everything trains, the first 5 rows (by id) also validate
        return _first_rows(df, id_col, min(MLP_SMALL_VAL_ROWS, n), copy=True), "train_copy_val"
    raise ValueError(f"unknown split policy {policy!r}")


def _first_rows(df: DataFrame, id_col: str, k: int, copy: bool) -> DataFrame:
    """Small-data carve-out: the first ``k`` rows by id are ``val``.

    Only reached below 20 rows (SVM) or below ``min_samples`` rows (MLP), so
    the global id order is over a bounded row count.  With ``copy`` the
    rows stay in ``train`` as well.
    """
    first = F.row_number().over(Window.orderBy(F.col(id_col))) <= k
    marked = df.withColumn("__first", first)
    if copy:
        return (marked.withColumn("split", F.lit("train")).drop("__first")
                .unionByName(marked.filter("__first").withColumn("split", F.lit("val")).drop("__first")))
    return marked.withColumn("split", F.when(F.col("__first"), "val").otherwise("train")).drop("__first")
