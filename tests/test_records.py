"""Records over lines, encodings, separators, and tables aligned by position."""
import contextlib
import random

import pytest
from pyspark.sql import functions as F

from revspark.sources import csv, positions
from revspark.sources import records as RC
from tests.test_sources import _write


@contextlib.contextmanager
def blocks_of(spark, n):
    keys = {"spark.sql.files.maxPartitionBytes": str(n), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fuzzed(rng, rows, end="\n"):
    """A CSV and its rows: quotes, separators and line breaks inside fields, some over many lines."""
    out, text = [], "text,label" + end
    for i in range(rows):
        value = "".join(rng.choice(['a', 'b ', 'é', '"', ',', '\n', '\n\n', '\r\n', 'word ']) for _ in range(rng.randint(1, 12)))
        if rng.random() < 0.05:
            value += "\nline of a long field" * rng.randint(5, 40)
        value = "x" + value + "y"
        quoted = '"' + value.replace('"', '""') + '"' if any(c in value for c in '",\n\r') else value
        text += f"{quoted},{i}{end}"
        out.append((value, str(i)))
        if rng.random() < 0.1:
            text += end
    return text, sorted(out)


@pytest.mark.parametrize("seed,size,end,limit", [(1, 40, "\n", RC.BROADCAST_BLOCKS), (2, 97, "\r\n", RC.BROADCAST_BLOCKS), (3, 64, "\n", 0)])
def test_records_equal_the_rows(spark, tmp_dir, seed, size, end, limit):
    rng, want = random.Random(seed), []
    for k in range(3):
        text, rows = fuzzed(rng, 60, end)
        _write(tmp_dir, f"f{k}.csv", text if k else text.rstrip("\r\n"))
        want += rows
    with blocks_of(spark, size):
        lines = RC.raw_lines(spark, tmp_dir)
        assert lines.rdd.getNumPartitions() > 50 and RC.balanced(RC.block_states(lines))
        got = RC.read_records(spark, tmp_dir, ["text", "label"], broadcast_blocks=limit).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    layout = csv.find_layout(spark, tmp_dir)
    assert layout["multi_line"] and layout["balanced"]
    with blocks_of(spark, size):
        read = csv.read_reviews(spark, tmp_dir, layout=layout).collect()
    one = csv._reader(spark, "utf-8", ",", True).csv(tmp_dir).collect()
    assert sorted(map(tuple, read)) == sorted(want)
    if end == "\n":  # the one-task reader changes line ends inside of fields otherwise
        assert sorted((a, b) for a, b in map(tuple, one)) == sorted(want)


def test_unpaired_quotes_are_left_to_one_task(spark, tmp_dir):
    path = _write(tmp_dir, "q.csv", 'text,label\n5" pipe,1\nfine,0\n')
    layout = csv.find_layout(spark, path)
    assert layout["multi_line"] and not layout["balanced"]
    assert [r["label"] for r in csv.read_reviews(spark, path, layout=layout).collect()] == ["1", "0"]


@pytest.mark.parametrize("policy", ["auto", "extended", "reference_order"])
def test_cp1252_characters_survive(spark, tmp_dir, policy):
    text = "text,label,preço\n“très” bon – 5 €,1,a\nl’été… œuvre™,0,b\n"
    path = _write(tmp_dir, "w.csv", text, encoding="cp1252")
    layout = csv.find_layout(spark, path, policy)
    assert layout["encoding"] == "cp1252" and layout["columns"] == ["text", "label", "preço"]
    assert [r["text"] for r in csv.read_reviews(spark, path, policy).orderBy("label").collect()] == ["l’été… œuvre™", "“très” bon – 5 €"]
    many = _write(tmp_dir, "x.csv", 'text,label\n"“a”\nb",1\n', encoding="cp1252")
    assert csv.read_reviews(spark, many, "auto").first()["text"] == "“a”\nb"


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_separator_is_found(spark, tmp_dir, sep):
    rows = [f"nice, really; {'very ' * (i % 4)}good|{sep}{i}{sep}x".replace(f"|{sep}", sep) if sep != "|" else f"nice, a; b{sep}{i}{sep}x"
            for i in range(40)]
    rows = [r if sep not in ",;" else r.replace(", ", " ").replace("; ", " ") for r in rows]
    path = _write(tmp_dir, "s.csv", f"text{sep}label{sep}more\n" + "\n".join(rows) + "\n")
    layout = csv.find_layout(spark, path, "auto")
    assert (layout["encoding"], layout["sep"], layout["columns"]) == ("utf-8", sep, ["text", "label", "more"])
    assert csv.read_reviews(spark, path, "auto").count() == 40


def test_latin1_without_control_bytes(spark, tmp_dir):
    path = _write(tmp_dir, "l.csv", "text;label\ncafé;1\n", encoding="latin-1")
    layout = csv.find_layout(spark, path, "auto")
    assert (layout["encoding"], layout["sep"]) == ("iso-8859-1", ";") and csv.read_reviews(spark, path, "auto").first()["text"] == "café"


def test_tables_align_by_position(spark, tmp_dir):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("key"), (F.col("id") % 2).alias("label"))
    rows = df.orderBy(F.xxhash64("key")).collect()  # an order that no column tells
    x = spark.createDataFrame(rows).coalesce(1)
    x.select("key").write.option("maxRecordsPerFile", 90).parquet(f"{tmp_dir}/x")
    x.select(F.col("key").alias("other"), "label").write.option("maxRecordsPerFile", 7).parquet(f"{tmp_dir}/y")
    with blocks_of(spark, 400):
        got = positions.aligned(spark, f"{tmp_dir}/x", f"{tmp_dir}/y").collect()
    assert len(got) == 500 and all(r["key"] == r["other"] for r in got)
    assert [r["key"] for r in sorted(got, key=lambda r: r["position"])] == [r["key"] for r in rows]
    x.limit(499).select(F.col("key").alias("other")).write.parquet(f"{tmp_dir}/z")
    with pytest.raises(ValueError, match="500 rows .* 499"):
        positions.aligned(spark, f"{tmp_dir}/x", f"{tmp_dir}/z")
    with pytest.raises(ValueError, match="both tables"):
        positions.aligned(spark, f"{tmp_dir}/x", f"{tmp_dir}/x")
    x.limit(0).select("key").write.parquet(f"{tmp_dir}/e")
    x.limit(0).select("label").write.parquet(f"{tmp_dir}/f")
    assert positions.aligned(spark, f"{tmp_dir}/e", f"{tmp_dir}/f").count() == 0
