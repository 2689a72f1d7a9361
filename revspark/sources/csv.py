"""Review CSV readers.

A review CSV has unknown layout: any columns, ``,`` ``;`` or tab as
separator, UTF-8 or Latin-1, quoted fields with embedded newlines and
doubled quotes; every column is read as a string.

One splittable pass over the raw lines makes a profile: are the bytes valid
UTF-8 (a genuine U+FFFD is valid), are there bytes 0x80-0x9F, may a quoted
field span lines (a line with an odd number of quotes), and how often does
each separator occur per line.  Files with fields over lines are read record by
record (``records``), many tasks per file; only files whose quotes do not pair
up are left to ``multiLine``, one task each.  UTF-8 candidates are out if the
bytes are not valid.  A candidate separator is out if any row has more fields
than the header or there is no row; missing fields of short rows are null.

The policy ``auto`` takes both from the profile: UTF-8 if valid, else cp1252 if
there are bytes 0x80-0x9F (control characters in Latin-1, quotes, dashes and the
euro sign in cp1252), else Latin-1; and of the separators in the header the one that most lines have
equally often.  Spark decodes no cp1252, so its 27 characters are put in after
Latin-1.  A missing path or a lost executor is an error of its own and not taken
for an unreadable layout.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import _strip
from . import records as RC

# Candidate lists per policy, in the reference's order
# (``latin-1`` / ``iso-8859-1`` / ``cp1252`` all map to ISO-8859-1).
CANDIDATES = {
    "reference_order": [("utf-8", ","), ("iso-8859-1", ","), ("utf-8", ";"), ("utf-8", "\t")],
    "most_columns": [("utf-8", ","), ("iso-8859-1", ","), ("utf-8", ";"), ("utf-8", "\t"), ("iso-8859-1", ";"),
                     ("iso-8859-1", "\t")],
    "extended": [("utf-8", ","), ("iso-8859-1", ","), ("utf-8", ";"), ("iso-8859-1", ";"),
                 ("utf-8", "\t")],
    "simple": [("utf-8", ","), ("iso-8859-1", ",")],
}
SEPARATORS = (",", ";", "\t", "|")
# What cp1252 has at 0x80-0x9F, where Latin-1 has control characters (five places are empty).
CP1252 = {0x80: "\u20ac", 0x82: "\u201a", 0x83: "\u0192", 0x84: "\u201e", 0x85: "\u2026", 0x86: "\u2020", 0x87: "\u2021",
          0x88: "\u02c6", 0x89: "\u2030", 0x8A: "\u0160", 0x8B: "\u2039", 0x8C: "\u0152", 0x8E: "\u017d", 0x91: "\u2018",
          0x92: "\u2019", 0x93: "\u201c", 0x94: "\u201d", 0x95: "\u2022", 0x96: "\u2013", 0x97: "\u2014", 0x98: "\u02dc",
          0x99: "\u2122", 0x9A: "\u0161", 0x9B: "\u203a", 0x9C: "\u0153", 0x9E: "\u017e", 0x9F: "\u0178"}
# Cell texts pandas reads as missing by default.
NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
EXTRA = "__extra"


def _reader(spark: SparkSession, encoding: str, sep: str, multi_line: bool):
    return (spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
                 .option("encoding", "iso-8859-1" if encoding == "cp1252" else encoding).option("sep", sep))


def _windows(c):
    """Latin-1 text as cp1252 reads it."""
    return F.translate(c, "".join(map(chr, CP1252)), "".join(CP1252.values()))


def _read(spark: SparkSession, path: str, encoding: str, sep: str, multi_line: bool, balanced: bool = True) -> DataFrame:
    """All columns as strings, and one more that only too long rows fill."""
    reader = _reader(spark, encoding, sep, multi_line)
    names = [*reader.csv(path).columns, EXTRA]
    if multi_line and balanced:
        df = RC.read_records(spark, path, names, sep, "UTF-8" if encoding == "utf-8" else "ISO-8859-1")
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        df = reader.option("mode", "PERMISSIVE").schema(schema).csv(path)
    if encoding != "cp1252":
        return df
    return df.select(*[_windows(F.col(f"`{c}`")).alias(a) for c, a in zip(names, [c.translate(CP1252) for c in names])])


def profile(spark: SparkSession, path: str) -> dict:
    """What one pass over the raw lines tells: ``valid`` UTF-8, ``c1`` (lines
    with bytes 0x80-0x9F), ``multi_line``, ``balanced`` quotes, and per
    separator ``header``: how often it is in a first line, and ``counts``:
    quartiles of its number per line."""
    line = F.col("value")
    quotes = F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))
    latin = F.decode(line.cast("binary"), "ISO-8859-1")
    lines = spark.read.text(path).filter(F.octet_length(line) > 0)
    row = lines.agg(F.min(F.is_valid_utf8(line)).alias("valid"), F.max(quotes % 2 == 1).alias("odd"),
                    F.count_if(latin.rlike("[\x80-\x9f]")).alias("c1"),
                    *[F.percentile(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(s), F.lit(""))),
                                   F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"n{i}")
                      for i, s in enumerate(SEPARATORS)]).first()
    odd = bool(row["odd"])
    head = spark.read.text(path).filter(F.col("_metadata.file_block_start") == 0).select(F.decode(line.cast("binary"), "ISO-8859-1")).first()
    return {"valid": row["valid"] is not False, "c1": row["c1"] or 0, "multi_line": odd,
            "balanced": not odd or RC.balanced(RC.block_states(RC.raw_lines(spark, path))),
            "header": {s: head[0].count(s) if head else 0 for s in SEPARATORS},
            "counts": {s: tuple(row[f"n{i}"] or (0, 0, 0)) for i, s in enumerate(SEPARATORS)}}


def automatic(found: dict) -> tuple[str, str]:
    """(encoding, separator) of a profile: of the separators in the header the
    one that as many lines as possible have equally often; of equal ones the
    more frequent in the header, then the first."""
    encoding = "utf-8" if found["valid"] else "cp1252" if found["c1"] else "iso-8859-1"
    def worth(s):
        low, middle, high = found["counts"][s]
        return middle > 0, -(high - low) / max(middle, 1), found["header"][s], -SEPARATORS.index(s)
    return encoding, max([s for s in SEPARATORS if found["header"][s]] or SEPARATORS[:1], key=worth)


def _na_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(F.col(f"`{c}`").isin(*NA_VALUES), F.lit(None)).otherwise(F.col(f"`{c}`"))
                       .alias(c) for c in df.columns])


def find_layout(spark: SparkSession, path: str, policy: str = "reference_order") -> dict:
    """``encoding``, ``sep``, ``multi_line`` and ``columns`` of a review CSV.

    ``reference_order``/``extended``/``simple``: the first candidate giving
    >= 1 column, >= 1 row and no too long row wins (so a ``;`` file read with
    ``,`` comes back as one column, as in the reference).  ``most_columns``:
    of all candidates that one with the most columns.  ``auto``: encoding and
    separator of the profile.
    """
    facts = profile(spark, path)
    multi_line, balanced = facts["multi_line"], facts["balanced"]
    best = None
    for encoding, sep in ([automatic(facts)] if policy == "auto" else CANDIDATES[policy]):
        if encoding == "utf-8" and not facts["valid"]:
            continue
        if encoding == "iso-8859-1" and facts["c1"] and not facts["valid"] and policy != "simple":
            encoding = "cp1252"  # the candidate after Latin-1, which has no such characters
        df = _read(spark, path, encoding, sep, multi_line, balanced)
        names = df.columns[:-1]
        if not names or (best and len(names) <= len(best["columns"])):
            continue
        rows = df.agg(F.count(F.lit(1)).alias("n"), F.count(EXTRA).alias("long")).first()
        if not rows["n"] or rows["long"]:
            continue
        best = {"encoding": encoding, "sep": sep, "multi_line": multi_line, "balanced": balanced, "columns": names}
        if policy != "most_columns":
            break
    if best is None:
        raise ValueError(f"could not read {path} with any candidate of policy {policy!r}")
    return best


def read_reviews(spark: SparkSession, path: str, policy: str = "reference_order", layout: dict | None = None) -> DataFrame:
    """Read a review CSV by its ``layout`` (see :func:`find_layout`)."""
    found = layout or find_layout(spark, path, policy)
    df = _read(spark, path, found["encoding"], found["sep"], found["multi_line"], found.get("balanced", True))
    return _na_to_null(df.drop(EXTRA))


def write_reviews_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "utf-8") -> None:
    """Write a review table as CSV the way the readers expect it (header,
    quotes doubled, whitespace kept)."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", encoding)
       .option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


# -- header normalisation (S4, S5) ---------------------------------------------------------

# Substring renames of the embedding reader, applied in order.
HEADER_SUBSTRINGS = [("review", "text"), ("content", "text"), ("sentiment", "label"), ("class", "label")]
# Exact renames of the runner.
HEADER_EXACT = {"review": "text", "content": "text", "sentiment": "label", "class": "label"}
LABEL_WORDS = {"positive": "1", "negative": "0", "pos": "1", "neg": "0"}


def normalize_headers(df: DataFrame) -> DataFrame:
    """strip + lower every name, then substring renames; the ``label``
    column's values become stripped, lower-cased text with the four label
    words mapped to ``1``/``0`` (a null prints as ``nan``)."""
    names = []
    for c in df.columns:
        n = c.strip().lower()
        for a, b in HEADER_SUBSTRINGS:
            n = n.replace(a, b)
        names.append(n)
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"header normalisation makes duplicate columns {sorted(dup)} from {df.columns}")
    out = df.toDF(*names)
    if "label" in names:
        v = F.lower(_strip(F.coalesce(F.col("label").cast("string"), F.lit("nan"))))
        mapped = v
        for k, val in LABEL_WORDS.items():
            mapped = F.when(v == k, F.lit(val)).otherwise(mapped)
        out = out.withColumn("label", mapped)
    return out


def normalize_headers_exact(df: DataFrame) -> DataFrame:
    """strip + lower every name, exact renames; without a ``text`` column the
    first string column is copied to ``text``."""
    names = [c.strip().lower() for c in df.columns]
    names = [HEADER_EXACT.get(n, n) for n in names]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"header renames make duplicate columns {sorted(dup)} from {df.columns}")
    out = df.toDF(*names)
    if "text" not in names:
        first = next((f.name for f in out.schema.fields if f.dataType.simpleString() == "string"), None)
        if first is not None:
            out = out.withColumn("text", F.col(f"`{first}`"))
    return out
