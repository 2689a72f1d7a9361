"""Text cleaners as native Spark column expressions (no UDF).

Three cleaning policies exist, each a fixed sequence of regular-expression
steps:

* ``standard`` – full review cleaner (whitespace, tags, URLs with an explicit
  character set, e-mails, punctuation runs, special characters, ALL-CAPS
  words lowered, long character runs squeezed).
* ``extended`` – same steps, but URLs are ``http(s)://`` or ``www.`` followed
  by non-blanks, and null markers are compared after stripping.
* ``embed``    – lower-cases first, masks ``http``/``www`` runs and any
  ``x@y``, no ALL-CAPS or run squeezing.

Regex portability: the JVM engine differs from Python's ``re`` in what
``\\w`` and ``\\s`` match, so both are written out as explicit classes
(``WORD`` and ``SPACE`` below) that give the same sets on Unicode text.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- character classes (fixed values) ---------------------------------------
# Python's Unicode ``\s``: ASCII blanks, VT, the four separators 0x1c-0x1f,
# NEL and every Unicode space/line/paragraph separator.
SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
# Python's Unicode ``\w``: letters, numbers and underscore.
WORD = r"\p{L}\p{N}_"

# Null markers, URL characters, punctuation kept by cleaners.
NULL_MARKERS = ["null", "none", "nan", "n/a", "", " "]
URL_STANDARD = r"http[s]?://[a-zA-Z0-9$-_@.&+!*\\(),]+"
URL_EXTENDED = [r"http[s]?://[^" + SPACE + r"]+", r"www\.[^" + SPACE + r"]+"]
URL_EMBED = r"(?:http|www|https)[^" + SPACE + r"]+"
# An e-mail match always starts where a run of non-blanks starts (if a
# suffix of the run matches, the whole run does, and the trailing greedy
# part runs to the end of the run), so the look-behind changes no result;
# it stops the engine from retrying at every character of long runs
# (quadratic backtracking).
_RUN_START = r"(?<![^" + SPACE + r"])"
EMAIL_STANDARD = _RUN_START + r"[^" + SPACE + r"]+@[^" + SPACE + r"]+\.[^" + SPACE + r"]+"
EMAIL_EMBED = _RUN_START + r"[^" + SPACE + r"]+@[^" + SPACE + r"]+"
KEPT_PUNCT = r""".,!?:;'"()\-\[\]"""
TAG = r"<[^>]+>"
# Most characters of a text are visible ASCII or a blank: the first half of an
# intersection rejects these by one comparison, before the class proper, a
# chain of Unicode tests, is asked.  Runs that a replacement by one blank
# would leave as they are do not match.
_ODD_SPACE = r"[\x00-\x1f\x7f-\x{10ffff}&&[" + SPACE + r"]]"
_ANY_SPACE = r"[\x00-\x20\x7f-\x{10ffff}&&[" + SPACE + r"]]"
SPACE_RUN = " " + _ANY_SPACE + "+|" + _ODD_SPACE + _ANY_SPACE + "*"
SPECIAL = r"[\x00-\x1f\x23-\x26\x2a\x2b\x2f\x3c-\x40\x5c\x5e\x60\x7b-\x{10ffff}&&[^" + WORD + SPACE + KEPT_PUNCT + "]]"
# What strip_specials and collapse_whitespace replace by blanks, as one class.
_ANY_BREAK = r"[\x00-\x20\x23-\x26\x2a\x2b\x2f\x3c-\x40\x5c\x5e\x60\x7b-\x{10ffff}&&[^" + WORD + KEPT_PUNCT + "]]"
_ODD_BREAK = _ANY_BREAK.replace(r"\x00-\x20", r"\x00-\x1f", 1)
BREAK_RUN = " " + _ANY_BREAK + "+|" + _ODD_BREAK + _ANY_BREAK + "*"
# A word of 3+ ASCII capitals; the capitals are looked for first.  Java looks
# behind by code points only if the pattern has one above U+FFFF: U+10000, a letter.
CAPS_START = r"(?=[A-Z]{3,}(?![" + WORD + r"]))(?<![" + WORD + "\U00010000])"
CAPS_HEAD = r"^[A-Z]{3,}(?![" + WORD + r"])"
# (?d): only "\n" ends a line for ".", as in Python
REPEAT_RUN = r"(?d)(.)\1{3,}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _replace_if_in(c, literals: list[str], pattern: str, replacement: str) -> Column:
    """``regexp_replace`` of texts with one of ``literals``, without which
    ``pattern`` matches nowhere: a search for bytes spares the others the
    engine.  The input is bound to a lambda variable and so read once."""
    def change(x):
        found = x.contains(literals[0])
        for literal in literals[1:]:
            found = found | x.contains(literal)
        return F.when(found, F.regexp_replace(x, pattern, replacement)).otherwise(x)
    return F.element_at(F.transform(F.array(_c(c)), change), 1)


# -- single steps (each one regexp_replace family) ---------------------------

def collapse_whitespace(c) -> Column:
    """Any run of (Python-)whitespace -> one space; then strip both ends."""
    return F.trim(normalize_spaces(c))


def normalize_spaces(c) -> Column:
    """Any run of whitespace -> one space (no stripping)."""
    return F.regexp_replace(_c(c), SPACE_RUN, " ")


def strip_html(c) -> Column:
    """Remove ``<...>`` tags (adjacent words fuse, as in the reference)."""
    return _replace_if_in(c, ["<"], TAG, "")


def mask_urls(c, policy: str = "standard") -> Column:
    c = _c(c)
    if policy == "standard":
        return _replace_if_in(c, ["http"], URL_STANDARD, "[URL]")
    if policy == "extended":
        for literal, p in zip(["http", "www."], URL_EXTENDED):
            c = _replace_if_in(c, [literal], p, "[URL]")
        return c
    if policy == "embed":
        return _replace_if_in(c, ["http", "www"], URL_EMBED, "[URL]")
    raise ValueError(f"unknown url policy {policy!r}")


def mask_emails(c, policy: str = "standard") -> Column:
    pat = EMAIL_EMBED if policy == "embed" else EMAIL_STANDARD
    return _replace_if_in(c, ["@"], pat, "[EMAIL]")


def squash_punctuation(c) -> Column:
    """``..+`` -> ``...``, ``!!+`` -> ``!!``, ``??+`` -> ``??``."""
    c = _replace_if_in(c, [".."], r"[.]{2,}", "...")
    c = _replace_if_in(c, ["!!!"], r"[!]{3,}", "!!")
    return _replace_if_in(c, ["???"], r"[?]{3,}", "??")


def strip_specials(c) -> Column:
    """Every character outside word/space/kept punctuation -> a space."""
    return F.regexp_replace(_c(c), SPECIAL, " ")


def blank_breaks(c) -> Column:
    """``collapse_whitespace`` of ``strip_specials``, in one pass."""
    return F.trim(F.regexp_replace(_c(c), BREAK_RUN, " "))


def lower_caps_words(c) -> Column:
    """Lower-case whole words made of 3+ ASCII capitals.

    Spark has no replace-with-callback.  The text is cut before each such
    word, so that a piece has at most one, at its head; that is lowered and the
    pieces are joined again.  The input is read once, so the expression stays
    linear when Catalyst inlines it.
    """
    def lowered(piece):
        head = F.length(F.regexp_extract(piece, CAPS_HEAD, 0))
        return F.concat(F.lower(F.substring(piece, F.lit(1), head)), F.substring(piece, head + 1, F.length(piece)))
    pieces = F.split(_c(c), CAPS_START, -1)
    return F.array_join(F.transform(pieces, lambda w: F.when(w.rlike(CAPS_HEAD), lowered(w)).otherwise(w)), "")


def squeeze_repeats(c) -> Column:
    """A run of 4+ equal characters -> two of them."""
    return F.regexp_replace(_c(c), REPEAT_RUN, "$1$1")


def _is_null_marker(c: Column) -> Column:
    return F.lower(c).isin(*NULL_MARKERS)


# -- full cleaners -------------------------------------------------------------

def clean_text(c, policy: str = "standard") -> Column:
    """Clean a text column with one of the three reference policies, as one
    expression (every step reads its input once, so the expression is
    linear in the number of steps).  On tables :func:`with_clean_text`
    stages the steps.  Null input is treated as ''."""
    raw = F.coalesce(_c(c).cast("string"), F.lit(""))
    t = raw
    for step in _steps(policy):
        t = step(t)
    if policy == "embed":
        return t
    marker = (_is_null_marker(raw) if policy == "standard"
              else _is_null_marker(F.regexp_replace(raw, "^[" + SPACE + "]+|[" + SPACE + "]+$", "")))
    return F.when(marker, F.lit("")).otherwise(t)


def _steps(policy: str):
    """The cleaning steps of a policy as Column -> Column functions.

    Blanks are made one where specials are replaced: no step before asks which
    or how many blanks there are, none after makes runs of them or looks at
    the ends of a text."""
    if policy == "embed":
        return [F.lower, strip_html, lambda c: mask_urls(c, "embed"), lambda c: mask_emails(c, "embed"),
                squash_punctuation, blank_breaks]
    if policy not in ("standard", "extended"):
        raise ValueError(f"unknown cleaning policy {policy!r}")
    return [strip_html, lambda c: mask_urls(c, policy), mask_emails, squash_punctuation, blank_breaks,
            lower_caps_words, squeeze_repeats]


def with_clean_text(df, in_col: str = "text", policy: str = "standard",
                    out_col: str = "text"):
    """DataFrame form of :func:`clean_text`, the one to use on tables.

    Each step is its own projection and reads its input once, so whatever
    Catalyst inlines (projection collapsing, predicate push-down) stays
    linear in the number of steps.
    """
    raw, t = "__clean_raw", "__clean_t"
    df = df.withColumn(raw, F.coalesce(F.col(in_col).cast("string"), F.lit("")))
    df = df.withColumn(t, F.col(raw))
    for step in _steps(policy):
        df = df.withColumn(t, step(F.col(t)))
    r = F.col(raw)
    if policy == "standard":
        marker = _is_null_marker(r)
    elif policy == "extended":
        marker = _is_null_marker(F.regexp_replace(r, "^[" + SPACE + "]+|[" + SPACE + "]+$", ""))
    else:
        marker = F.lit(False)
    return df.withColumn(out_col, F.when(marker, F.lit("")).otherwise(F.col(t))).drop(raw, t)


def word_count(c) -> Column:
    """Number of whitespace-separated tokens (Python ``len(str.split())``)."""
    toks = F.split(collapse_whitespace(c), " ", -1)
    return F.size(F.filter(toks, lambda x: F.length(x) > 0))


def preview(c, width: int = 100) -> Column:
    """First ``width`` characters plus ``...`` when the text is longer."""
    c = _c(c)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)
