"""Label mappers: free-form labels -> {1, 0, -1} as native expressions.

Policies (``-1`` means unknown / placeholder):

* ``standard`` – words, then any decimal number (> 0.5 -> 1, else 0, NaN ->
  -1); a null label is first replaced by -1, which is a number <= 0.5, so
  null -> 0.
* ``extended`` – as ``standard`` with more words; null -> -1.
* ``strict``   – only ``positive pos 1`` / ``negative neg 0`` (lower-cased,
  not stripped); everything else, numbers like ``1.0`` included, -> -1.
* ``replace``  – the runner rule: the four words mapped case-sensitively, then
  only values equal to 0 or 1 kept (see ``operators.filters.normalize_label_filter``).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE

# Label words of each policy, in the reference's order.
POSITIVE_STANDARD = ["positive", "pos", "1", "true", "good", "like"]
NEGATIVE_STANDARD = ["negative", "neg", "0", "false", "bad", "dislike"]
NEUTRAL = ["neutral", "mixed", "0.5"]
POSITIVE_EXTENDED = ["positive", "pos", "1", "true", "good", "like", "love", "great"]
NEGATIVE_EXTENDED = ["negative", "neg", "0", "false", "bad", "dislike", "hate", "terrible"]
POSITIVE_STRICT = ["positive", "pos", "1"]
NEGATIVE_STRICT = ["negative", "neg", "0"]
REPLACE_MAP = {"positive": "1", "negative": "0", "pos": "1", "neg": "0"}

# What Python's float() accepts: sign, decimal or exponent form with single
# underscores between digits, inf / infinity / nan, and decimal digits of
# any script (mapped to ASCII first, table below).  Spark's cast accepts
# more (``5d``, hex floats), so the text is checked before it is cast.
DIGITS = r"[0-9](?:_?[0-9])*"
DECIMAL_NUMBER = (r"^[+-]?(?:(?:" + DIGITS + r"(?:\.(?:" + DIGITS + r")?)?|\." + DIGITS + r")(?:e[+-]?"
                  + DIGITS + r")?|inf|infinity|nan)$")


def _decimal_digit_table() -> tuple[str, str]:
    """Every Unicode decimal digit (category Nd) and its ASCII digit, built
    from the Unicode database by rule rather than listed."""
    import unicodedata
    src, dst = [], []
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.digit(ch)))
    return "".join(src), "".join(dst)


UNICODE_DIGITS, ASCII_DIGITS = _decimal_digit_table()


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, "^[" + SPACE + "]+|[" + SPACE + "]+$", "")


def label_text(c) -> Column:
    """The label as text, the way ``str(value)`` prints it for ints and strings.

    Doubles print as Spark prints them; a label column of doubles holding
    whole numbers gives ``1.0``, as Python does.
    """
    return _c(c).cast("string")


def _numeric_rule(s: Column) -> Column:
    s = F.translate(s, UNICODE_DIGITS, ASCII_DIGITS)
    num = F.regexp_replace(s, "_", "").try_cast("double")
    is_num = s.rlike(DECIMAL_NUMBER) & num.isNotNull()
    return (F.when(~is_num, F.lit(-1))
             .when(F.isnan(num), F.lit(-1))
             .when(num > 0.5, F.lit(1))
             .otherwise(F.lit(0)))


def normalize_label(c, policy: str = "extended") -> Column:
    """Map a raw label column to an int in {1, 0, -1}."""
    raw = _c(c)
    s = label_text(raw)
    if policy == "strict":
        low = F.lower(s)
        return (F.when(raw.isNull(), F.lit(-1))
                 .when(low.isin(*POSITIVE_STRICT), F.lit(1))
                 .when(low.isin(*NEGATIVE_STRICT), F.lit(0))
                 .otherwise(F.lit(-1))).cast("int")
    if policy == "standard":
        pos, neg, null_value = POSITIVE_STANDARD, NEGATIVE_STANDARD, 0
    elif policy == "extended":
        pos, neg, null_value = POSITIVE_EXTENDED, NEGATIVE_EXTENDED, -1
    else:
        raise ValueError(f"unknown label policy {policy!r}")
    key = _strip(F.lower(s))
    return (F.when(raw.isNull(), F.lit(null_value))
             .when(key.isin(*pos), F.lit(1))
             .when(key.isin(*neg), F.lit(0))
             .when(key.isin(*NEUTRAL), F.lit(0))
             .otherwise(_numeric_rule(key))).cast("int")


def replace_label_words(c) -> Column:
    """Runner rule: the four label words -> ``1``/``0`` (case-sensitive)."""
    s = label_text(_c(c))
    out = s
    for k, v in REPLACE_MAP.items():
        out = F.when(s == k, F.lit(v)).otherwise(out)
    return out
