"""Plain single-process versions of the operators, for small fixtures."""
from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def substring_dedup(docs, length=20):
    """{doc_id: (n_words, n_removed, sha)}; docs: unique (doc_id, text)."""
    first, out = {}, {}
    ordered = sorted(docs, key=lambda d: d[0])
    words = {i: WORD.findall(t or "") for i, t in ordered}
    for i, _ in ordered:
        for s in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][s: s + length]), (i, s))
    for i, w in words.items():
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if first[tuple(w[s: s + length])] != (i, s):
                gone[s: s + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), sha(" ".join(kept).encode()))
    return out


def byte_dedup(docs, length=50):
    """{doc_id: (n_bytes, n_removed, n_spans, sha)}."""
    first, out = {}, {}
    raw = {i: (t or "").encode() for i, t in sorted(docs, key=lambda d: d[0])}
    for i, b in raw.items():
        for s in range(len(b) - length + 1):
            first.setdefault(b[s: s + length], i)
    for i, b in raw.items():
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if first[b[s: s + length]] < i:
                gone[s: s + length] = [True] * length
        runs = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out[i] = (len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def shingles(text, size):
    low = re.sub(r"[A-Z]", lambda m: m.group().lower(), text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < size else frozenset(tuple(w[i: i + size]) for i in range(len(w) - size + 1))


def near_dedup(docs, size=2, similarity=80):
    """{doc_id: (n_shingles, component)}."""
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= similarity * max(len(sets[a]), len(sets[b])):
                common = len(sets[a] & sets[b])
                if 100 * common >= similarity * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def exact_dedup(docs):
    """{doc_id: (keep_id, group_size, sha)}."""
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in docs}
    groups = {}
    for i, t in docs:
        groups.setdefault(norm[i], []).append((-len(t or ""), i))
    return {i: (min(groups[norm[i]])[1], len(groups[norm[i]]), sha(norm[i].encode())) for i, _ in docs}


def align(passage, item, match=2, miss=1, gap=1):
    """Smith-Waterman score of two sequences, cell by cell."""
    above, best = [0] * (len(passage) + 1), 0
    for x in item:
        row = [0]
        for j, y in enumerate(passage):
            row.append(max(0, above[j] + (match if x == y else -miss), above[j + 1] - gap, row[j] - gap))
        best, above = max(best, *row), row
    return best
