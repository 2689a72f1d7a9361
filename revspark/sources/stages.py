"""Stages that are left out when their result is there.

A stage writes its table and then a manifest: the fingerprint of the input
files and the parameters it was made from, and its rows.  The manifest comes
last, so a run that died leaves none.  A later run with the same fingerprint
and an unharmed table (as many rows in the footers) returns ``exists`` and
reads what is there; a changed input or parameter, a missing or broken result,
or ``force`` makes it anew.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import safe_value

EXISTS, WRITTEN = "exists", "written"


@dataclass
class Stage:
    """``status``: ``exists`` or ``written``; ``reason``: why it was written."""
    status: str
    reason: str | None
    rows: int
    table: DataFrame


def fingerprint(spark: SparkSession, inputs: list[str], parameters: dict) -> str:
    """A digest of names, sizes and times of all input files, which one
    aggregate sums up without reading any, and of the parameters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(inputs).select("path", "length", "modificationTime")
    told = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    facts = files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(told)).first() if inputs else ()
    return hashlib.sha256(json.dumps([[str(x) for x in facts], safe_value(parameters)], sort_keys=True).encode()).hexdigest()


def _manifest(spark: SparkSession, path: str) -> dict | None:
    try:
        return json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    except (PySparkException, TypeError, ValueError):  # none, or not a whole one
        return None


def _present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{path}/data")
    except PySparkException:
        return None


def run_stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], inputs: list[str], parameters: dict | None = None,
              force: bool = False) -> Stage:
    """The table that ``build`` makes from the files ``inputs`` with
    ``parameters``, kept below ``path``."""
    wanted, found = fingerprint(spark, inputs, parameters or {}), _manifest(spark, path)
    there = _present(spark, path) if found else None
    reason = ("forced" if force else "no_result" if found is None or there is None else
              "inputs_or_parameters_changed" if found["fingerprint"] != wanted else
              "rows_missing" if there.count() != found["rows"] else None)
    if reason is None:
        return Stage(EXISTS, None, found["rows"], there)
    # the old manifest must not stand beside new data: it is emptied first
    spark.createDataFrame([("",)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    build().write.mode("overwrite").parquet(f"{path}/data")
    table = spark.read.parquet(f"{path}/data")
    rows = table.count()  # from the footers
    record = json.dumps({"fingerprint": wanted, "rows": rows, "parameters": safe_value(parameters or {})})
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return Stage(WRITTEN, reason, rows, table)
