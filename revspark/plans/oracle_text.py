"""DuckDB SQL for the text cleaners, used by the correctness oracles.

DuckDB's regex engine (RE2) has no look-around and no back-reference, so
ALL-CAPS lowering is written as a token transform (maximal runs of word /
non-word characters) and run squeezing as a filter over the characters.
Steps are chained as CTEs so no step's SQL is repeated.
"""
from __future__ import annotations

SPACE = r"\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"
KEPT = r""".,!?:;'"()\-\[\]"""
NULLS = "('null', 'none', 'nan', 'n/a', '', ' ')"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(t: str, pat: str, rep: str) -> str:
    return f"regexp_replace({t}, {q(pat)}, {q(rep)}, 'g')"


STEPS = {
    "ws": lambda t: rr(t, f"[{SPACE}]+", " "),
    "html": lambda t: rr(t, "<[^>]+>", ""),
    "url_standard": lambda t: rr(t, r"http[s]?://[a-zA-Z0-9$-_@.&+!*\\(),]+", "[URL]"),
    "url_extended": lambda t: rr(rr(t, rf"http[s]?://[^{SPACE}]+", "[URL]"), rf"www\.[^{SPACE}]+", "[URL]"),
    "url_embed": lambda t: rr(t, rf"(?:http|www|https)[^{SPACE}]+", "[URL]"),
    "email_standard": lambda t: rr(t, rf"[^{SPACE}]+@[^{SPACE}]+\.[^{SPACE}]+", "[EMAIL]"),
    "email_embed": lambda t: rr(t, rf"[^{SPACE}]+@[^{SPACE}]+", "[EMAIL]"),
    "punct": lambda t: rr(rr(rr(t, r"[.]{2,}", "..."), r"[!]{2,}", "!!"), r"[?]{2,}", "??"),
    "specials": lambda t: rr(t, f"[^{WORD}{SPACE}{KEPT}]", " "),
    "caps": lambda t: (f"array_to_string(list_transform(regexp_extract_all({t}, {q(f'[{WORD}]+|[^{WORD}]+')}), "
                       f"lambda x: CASE WHEN regexp_full_match(x, '[A-Z]{{3,}}') THEN lower(x) ELSE x END), '')"),
    "collapse": lambda t: f"trim({rr(t, f'[{SPACE}]+', ' ')})",
    "lower": lambda t: f"lower({t})",
}

# run squeezing needs the character list as its own column
REPEAT_FILTER = ("array_to_string(list_filter(cs, lambda ch, i: NOT coalesce(ch <> chr(10) AND cs[i-1] = ch "
                 "AND cs[i-2] = ch AND (coalesce(cs[i-3] = ch, false) OR coalesce(cs[i+1] = ch, false)), false)), '')")

POLICY_STEPS = {
    "standard": ["ws", "html", "url_standard", "email_standard", "punct", "specials", "caps", "REPEAT", "collapse"],
    "extended": ["ws", "html", "url_extended", "email_standard", "punct", "specials", "caps", "REPEAT", "collapse"],
    "embed": ["lower", "html", "url_embed", "email_embed", "punct", "specials", "collapse"],
}


def chain(source_sql: str, steps: list[str], keep: str = "id", name: str = "c") -> tuple[str, str]:
    """CTE chain applying ``steps`` to column ``t`` of ``source_sql``.

    ``source_sql`` must select ``{keep}``, ``raw`` and ``t``.  Returns the
    CTE text (without WITH) and the name of the last CTE.
    """
    ctes = [f"{name}0 AS ({source_sql})"]
    prev = f"{name}0"
    for i, st in enumerate(steps, 1):
        cur = f"{name}{i}"
        if st == "REPEAT":
            ctes.append(f"{cur}x AS (SELECT {keep}, raw, regexp_extract_all(t, '(?s).') AS cs FROM {prev})")
            ctes.append(f"{cur} AS (SELECT {keep}, raw, {REPEAT_FILTER} AS t FROM {cur}x)")
        else:
            ctes.append(f"{cur} AS (SELECT {keep}, raw, {STEPS[st]( 't')} AS t FROM {prev})")
        prev = cur
    return ",\n".join(ctes), prev


def cleaned_cte(source_sql: str, policy: str, keep: str = "id", name: str = "c") -> tuple[str, str]:
    """CTEs ending in ``{name}`` with columns ``{keep}, raw, t`` cleaned by ``policy``.

    ``source_sql`` selects ``{keep}`` and ``raw`` (null already made '').
    """
    src = f"SELECT {keep}, raw, raw AS t FROM ({source_sql})"
    body, last = chain(src, POLICY_STEPS[policy], keep, name + "_s")
    if policy == "standard":
        marker = f"lower(raw) IN {NULLS}"
    elif policy == "extended":
        marker = f"lower({rr('raw', f'^[{SPACE}]+|[{SPACE}]+$', '')}) IN {NULLS}"
    else:
        marker = "false"
    body += f",\n{name} AS (SELECT {keep}, raw, CASE WHEN {marker} THEN '' ELSE t END AS t FROM {last})"
    return body, name


def single_step_sql(source_sql: str, step: str, keep: str = "id") -> str:
    body, last = chain(f"SELECT {keep}, raw, raw AS t FROM ({source_sql})", [step], keep)
    return f"WITH {body}\nSELECT {keep}, t AS text FROM {last}"
