"""JSON documents of results (T3): what JSON has no word for becomes what a
reader expects, driven by the schema for tables and by the type for values.

NaN and the infinities are null, vectors are arrays, dates and decimals are
strings, byte strings are base64; structs, arrays and maps are converted in
depth, and null fields are kept.
"""
from __future__ import annotations

import base64
import datetime
import decimal
import math
import pathlib
from typing import Any

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vector, VectorUDT
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DataType, DateType, DecimalType, DoubleType, FloatType, MapType, StructType,
                               TimestampNTZType, TimestampType)


def safe_value(x: Any) -> Any:
    """A value of the driver (a row, numpy data, nested lists) for ``json``."""
    if isinstance(x, (bool, str, int)) or x is None:
        return x
    if isinstance(x, (float, np.floating)):
        return float(x) if math.isfinite(x) else None
    if isinstance(x, (np.integer, np.bool_)):
        return x.item()
    if isinstance(x, Row):
        return safe_value(x.asDict())
    if isinstance(x, dict):
        return {str(k): safe_value(v) for k, v in x.items()}
    if isinstance(x, Vector):
        return safe_value(x.toArray())
    if isinstance(x, np.ndarray):
        return safe_value(x.tolist())
    if isinstance(x, (list, tuple)):
        return [safe_value(v) for v in x]
    if isinstance(x, (set, frozenset)):
        return [safe_value(v) for v in sorted(x, key=lambda v: (str(type(v)), str(v)))]
    if isinstance(x, (bytes, bytearray)):
        return base64.b64encode(bytes(x)).decode()
    if isinstance(x, (datetime.date, datetime.datetime)):
        return x.isoformat()
    if isinstance(x, (decimal.Decimal, pathlib.Path)):
        return str(x)
    return str(x)


def _needs(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_needs(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _needs(kind.elementType)
    if isinstance(kind, MapType):
        return True  # keys become strings
    return isinstance(kind, (DoubleType, FloatType, VectorUDT, BinaryType, DecimalType, DateType, TimestampType, TimestampNTZType))


def safe_column(c: Column, kind: DataType) -> Column:
    """The same for a column of type ``kind``, in depth."""
    if not _needs(kind):
        return c
    if isinstance(kind, (DoubleType, FloatType)):
        infinite = F.abs(c) == F.lit(float("inf")).cast(kind)
        return F.when(F.isnan(c) | infinite, F.lit(None).cast(kind)).otherwise(c)
    if isinstance(kind, VectorUDT):
        return F.when(c.isNotNull(), safe_column(vector_to_array(c), ArrayType(DoubleType())))
    if isinstance(kind, BinaryType):
        return F.base64(c)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda v: safe_column(v, kind.elementType))
    if isinstance(kind, MapType):
        entry = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string").alias("key"),
                                                                 safe_column(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(entry)
    if isinstance(kind, StructType):
        fields = F.struct(*[safe_column(c.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), fields)
    return c.cast("string")


def json_documents(df: DataFrame, name: str = "document") -> DataFrame:
    """One JSON document per row, null fields kept."""
    fields = [safe_column(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(name))


def write_documents(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write the rows as JSON lines; return what a reader gets back."""
    json_documents(df, "value").write.mode(mode).text(path)
    return df.sparkSession.read.text(path)
