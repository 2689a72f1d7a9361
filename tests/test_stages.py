"""Stages run again only when they must."""
import os
import shutil

from pyspark.sql import functions as F

from revspark.sources.stages import run_stage


def test_stage_runs_once(spark, tmp_dir):
    source, out, made = f"{tmp_dir}/in", f"{tmp_dir}/out", []
    spark.range(50).write.parquet(source)

    def build(k=1):
        def run():
            made.append(k)
            return spark.read.parquet(source).withColumn("x", F.col("id") * k)
        return run

    def go(k=1, **options):
        s = run_stage(spark, out, build(k), [source], {"k": k}, **options)
        return s.status, s.reason, s.rows, s.table.count()

    assert go() == ("written", "no_result", 50, 50)
    before = sorted((f, os.stat(f"{out}/data/{f}").st_mtime_ns) for f in os.listdir(f"{out}/data"))
    assert go() == ("exists", None, 50, 50) and made == [1]
    assert sorted((f, os.stat(f"{out}/data/{f}").st_mtime_ns) for f in os.listdir(f"{out}/data")) == before  # nothing was written
    assert go(force=True) == ("written", "forced", 50, 50)
    assert go(2) == ("written", "inputs_or_parameters_changed", 50, 50) and go(2)[0] == "exists"
    spark.range(50, 60).write.mode("append").parquet(source)
    assert go(2) == ("written", "inputs_or_parameters_changed", 60, 60)
    assert made == [1, 1, 2, 2]


def test_broken_results_are_made_anew(spark, tmp_dir):
    source, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    spark.range(40).repartition(4).write.parquet(source)
    go = lambda: run_stage(spark, out, lambda: spark.read.parquet(source), [source])
    go()
    part = next(f for f in os.listdir(f"{out}/data") if f.startswith("part-"))
    os.remove(f"{out}/data/{part}")
    assert go().reason == "rows_missing" and go().status == "exists"
    shutil.rmtree(f"{out}/data")
    assert go().reason == "no_result"
    # a run that dies while it writes leaves no manifest
    try:
        run_stage(spark, out, lambda: spark.read.parquet(f"{tmp_dir}/none"), [source], {"p": 1})
    except Exception:  # noqa: BLE001
        pass
    assert go().reason == "no_result"
