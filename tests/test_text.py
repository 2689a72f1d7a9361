"""Golden vectors of the three cleaners (FIXTURES §3) and properties."""
import pytest
from pyspark.sql import functions as F

from revspark.functions.text import clean_text, with_clean_text

NBSP, FS = " ", "\x1c"
# (input, standard, extended, embed)
GOLDEN = [
    ("I loved this movie!", "I loved this movie!", "I loved this movie!", "i loved this movie!"),
    ("NaN", "", "", "nan"),
    (" n/a ", "n a", "", "n a"),
    ("Great<br /><br />film", "Greatfilm", "Greatfilm", "greatfilm"),
    ("see https://a.io/x?y=1#frag now", "see [url] frag now", "see [url] now", "see [URL] now"),
    ("go www.site.com/x, ok", "go www.site.com x, ok", "go [url] ok", "go [URL] ok"),
    ("mail me@x.org.", "mail [email]", "mail [email]", "mail [EMAIL]"),
    ("a@b no dot", "a b no dot", "a b no dot", "[EMAIL] no dot"),
    ("WOW this is SOOOO goooood!!!!", "wow this is soo good!!", "wow this is soo good!!",
     "wow this is soooo goooood!!"),
    ("wait.... what?????", "wait... what??", "wait... what??", "wait... what??"),
    ("5/5 ★★★ café ½", "5 5 café ½", "5 5 café ½", "5 5 café ½"),
    ("NASA's HD-TV", "nasa's HD-TV", "nasa's HD-TV", "nasa's hd-tv"),
    ("a" + NBSP + "b" + FS + "c\td\n\ne", "a b c d e", "a b c d e", "a b c d e"),
    ("3 < 4 and 5 > 2", "3 2", "3 2", "3 2"),
    ("hmm....hmm", "hmm...hmm", "hmm...hmm", "hmm...hmm"),
]


@pytest.fixture(scope="module")
def golden_df(spark):
    return spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "id long, text string")


@pytest.mark.parametrize("policy,col", [("standard", 1), ("extended", 2), ("embed", 3)])
def test_golden_staged(golden_df, policy, col):
    out = {r["id"]: r["clean"] for r in with_clean_text(golden_df, "text", policy, "clean").select("id", "clean").collect()}
    for i, g in enumerate(GOLDEN):
        assert out[i] == g[col], (policy, g[0], out[i])


@pytest.mark.parametrize("policy,col", [("standard", 1), ("extended", 2), ("embed", 3)])
def test_golden_single_expression(golden_df, policy, col):
    out = {r["id"]: r["c"] for r in golden_df.select("id", clean_text(F.col("text"), policy).alias("c")).collect()}
    for i, g in enumerate(GOLDEN):
        assert out[i] == g[col], (policy, g[0], out[i])


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(1, None)], "id long, text string")
    for p in ("standard", "extended", "embed"):
        assert with_clean_text(df, "text", p, "c").first()["c"] == ""


def test_properties_on_documents(spark):
    from tests.conftest import SF01
    from revspark.sources.tables import table
    df = table(spark, SF01, "documents").select(F.col("doc_id").alias("id"), "text")
    out = with_clean_text(df, "text", "standard", "c")
    bad = out.filter(F.col("c").contains("  ") | F.col("c").rlike(r"(?d)(.)\1{3,}")
                     | F.col("c").startswith(" ") | F.col("c").endswith(" "))
    assert bad.count() == 0


def test_policies_differ(golden_df):
    rows = {p: [r["c"] for r in with_clean_text(golden_df, "text", p, "c").orderBy("id").collect()]
            for p in ("standard", "extended", "embed")}
    assert rows["standard"] != rows["extended"] != rows["embed"]


def test_preview_first_equals_processing_everything(spark):
    from pyspark.sql import functions as F

    from revspark.operators import filters
    raw = spark.createDataFrame([(i, "short" if i < 300 else f"a long enough text {i}") for i in range(700)], "id long, text string")
    seen = []

    def process(df):
        seen.append(df.count())
        return df.filter(F.length("text") > 10)

    got = filters.preview_first(raw, raw.select("id"), process, 10).collect()
    assert [r["id"] for r in got] == list(range(300, 310)) and seen == [40, 160, 640]
    assert filters.preview_first(raw, raw.select("id"), lambda df: df.filter("id > 695"), 10).count() == 4
    assert filters.preview_first(raw.limit(0), raw.select("id").limit(0), process, 10).collect() == []


def test_steps_keep_the_results_of_the_plain_patterns(spark):
    """The faster forms of the steps against the patterns they stand for."""
    from revspark.functions import text as T

    odd = [" ", "  ", "\t", "\n", "\x0b", FS, "\x85", NBSP, " ", "　", "​", "\x00", "\x7f", "a", "é", "A", "ABC", "HELLO", "Ab", "ABC_", "ÀBC",
           "9", "٣", "²", "_", "<", "<b>", ">", "http://x.y", "www.", "x@y.z", "@", ".", "..", "....", "!", "!!!", "??", "???", "-", "[", "\\", "^", "~",
           "😀", "𝐀", "𠀀", "́", "İ"]
    rows = [(a + b + c,) for a in odd for b in odd for c in odd[::5]]
    plain = {"normalize_spaces": lambda c: F.regexp_replace(c, "[" + T.SPACE + "]+", " "), "strip_html": lambda c: F.regexp_replace(c, T.TAG, ""),
             "mask_emails": lambda c: F.regexp_replace(c, T.EMAIL_STANDARD, "[EMAIL]"),
             "squash_punctuation": lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"[.]{2,}", "..."), "[!]{2,}", "!!"), "[?]{2,}", "??"),
             "strip_specials": lambda c: F.regexp_replace(c, "[^" + T.WORD + T.SPACE + T.KEPT_PUNCT + "]", " "),
             "lower_caps_words": lambda c: F.array_join(F.transform(
                 F.regexp_extract_all(c, F.lit(f"[{T.WORD}]+|[^{T.WORD}]+"), 0), lambda w: F.when(w.rlike("^[A-Z]{3,}$"), F.lower(w)).otherwise(w)), "")}
    df = spark.createDataFrame([*rows, ("",), (None,)], "t string")
    for name, f in plain.items():
        assert df.filter(~getattr(T, name)("t").eqNullSafe(f(F.col("t")))).limit(3).collect() == [], name


def test_texts_without_a_step_s_characters_spare_the_regex_engine(spark):
    """Tags, links, addresses and punctuation runs are looked for by bytes first."""
    from revspark.functions import text as T

    df = spark.createDataFrame([("a",)], "text string")
    for f, literals in ((T.strip_html, "<"), (T.mask_urls, "http"), (T.mask_emails, "@"), (T.squash_punctuation, "!!!")):
        assert f"contains(namedlambdavariable(), {literals})" in df.select(f("text")).columns[0]


def test_cleaners_equal_their_steps_one_by_one(spark):
    """Blanks and specials are replaced in one pass; the texts are those of the single steps in the specified order."""
    import random

    from revspark.functions import text as T

    odd = [" ", "  ", "    ", "\t", "\n", "\r\n", "\x0b", FS, "\x85", NBSP, " ", "　", "​", "\x00", "\x7f", "a", "aaaa", "é", "ABC", "HELLO", "Ab", "_", "9", "²",
           "<", "<b>", "<\n>", ">", "http://x.y", "https://", "www.", "www", "x@y.z", "@", ".", "..", "....", "!!!!", "??", "-", "----", "'", '"', "\\", "^", "~", "*",
           "😀", "𝐀", "𠀀", "́", "İ", "null", "nan"]
    rnd = random.Random(5)
    rows = [("".join(rnd.choices(odd, k=rnd.randrange(1, 10))),) for _ in range(30000)] + [("",), (None,), (" ",), ("NULL",), (" null ",)]
    df = spark.createDataFrame(rows, "t string").repartition(8)
    raw, blank = F.coalesce("t", F.lit("")), "^[" + T.SPACE + "]+|[" + T.SPACE + "]+$"
    for policy in ("standard", "extended", "embed"):
        steps = [F.lower] if policy == "embed" else [T.normalize_spaces]
        steps += [T.strip_html, lambda c: T.mask_urls(c, policy), lambda c: T.mask_emails(c, policy), T.squash_punctuation, T.strip_specials]
        steps += [T.collapse_whitespace] if policy == "embed" else [T.lower_caps_words, T.squeeze_repeats, T.collapse_whitespace]
        want = raw
        for step in steps:
            want = step(want)
        if policy != "embed":
            marker = F.lower(raw if policy == "standard" else F.regexp_replace(raw, blank, "")).isin(*T.NULL_MARKERS)
            want = F.when(marker, "").otherwise(want)
        got = T.with_clean_text(df, "t", policy, "got")
        assert got.filter(~F.col("got").eqNullSafe(want)).limit(3).collect() == [], policy
        assert df.filter(~T.clean_text("t", policy).eqNullSafe(want)).limit(3).collect() == [], policy
        assert T.SPACE_RUN not in got.select("got")._jdf.queryExecution().toString().replace(blank, "")  # no pass of its own
