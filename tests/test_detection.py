"""Column name scores (FIXTURES §5) and content rules."""
import pytest

from revspark.operators import detection as D

NAMES = [("text", 100, 0), ("review_text", 60, 0), ("user_review", 50, 0), ("movie_review", 66.5, 0),
         ("text_description", 56, 0), ("context", 70, 0), ("post_title", 21, 0), ("sentiment_label", 0, 65),
         ("class_name", 0, 63), ("review_score", 66.5, 50), ("scored_type", 0, 21), ("id", 0, 0)]


@pytest.mark.parametrize("name,text,label", NAMES)
def test_name_scores(name, text, label):
    assert D.name_score(name, D.TEXT_CANDIDATES) == pytest.approx(text)
    assert D.name_score(name, D.LABEL_CANDIDATES) == pytest.approx(label)


def test_extended_replaces_spaces():
    assert D.name_score("Review Text", D.TEXT_CANDIDATES, "extended") == 60
    assert D.name_score("Review Text", D.TEXT_CANDIDATES, "standard") == pytest.approx(95 * 0.7)


def test_detect_on_unnamed_columns(spark):
    rows = [(i, f"this is a rather long review number {i} and it was good", ["pos", "neg"][i % 2])
            for i in range(30)]
    df = spark.createDataFrame(rows, "k long, a string, b string")
    out = {(r["role"], r["column"]): (r["score"], r["rank"]) for r in D.detect_columns(df, "k").collect()}
    assert out[("text", "a")] == (35.0, 1)  # 25 for length/words + 10 English-word bonus
    assert out[("label", "b")] == (30.0, 1)


def test_simple_detection(spark):
    df = spark.createDataFrame([(10, "x" * 20, "0"), (20, "y", "1")], "k long, c1 string, c2 string")
    got = {r["role"]: r["column"] for r in D.detect_columns_simple(df, "k").collect()}
    assert got == {"text": "c1", "label": "c2"}


def test_forced_columns(spark):
    df = spark.createDataFrame([(1, "some text here", "1")], "k long, body string, y string")
    got = D.resolve_columns(df, "k", force_text="body", force_label="y")
    assert (got["text"], got["label"], got["text_confidence"]) == ("body", "y", 100)
    with pytest.raises(ValueError, match="no usable text column"):
        D.resolve_columns(df, "k", force_text="missing")


def test_fallback_when_no_clear_text_column(spark):
    rows = [(i, "abcdefghijkl mnop", "x") for i in range(5)]   # names score 0; short content
    df = spark.createDataFrame(rows, "k long, f1 string, f2 string")
    got = D.resolve_columns(df, "k")
    assert (got["text"], got["text_confidence"]) == ("f1", 5)
    tiny = spark.createDataFrame([(1, "ab", "abc")], "k long, f1 string, f2 string")
    got = D.resolve_columns(tiny, "k")
    assert (got["text"], got["text_confidence"]) == ("f2", 1)


def test_all_rows_count_unless_a_prefix_is_asked_for(spark):
    rows = [(i, "ab" if i < 100 else "many more words than the first hundred rows have in them " * 2) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a string")
    whole = D.text_content_scores(df, "k", ["a"]).first()
    first = D.text_content_scores(df, "k", ["a"], sample_rows=D.REFERENCE_SAMPLE).first()
    assert whole["avg_length"] > 80 and first["avg_length"] == 2.0


def test_the_key_is_no_label(spark):
    df = spark.createDataFrame([(i, f"some longer text with words {i}") for i in range(5)], "class_id long, body string")
    assert D.resolve_columns(df, "class_id", exclude=("class_id",)) == {"text": "body", "label": None, "text_confidence": 70.0}
