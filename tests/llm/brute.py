"""Brute-force versions of the operators, over lists of rows."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import xxhash


def spans_removed(data: bytes, gone: np.ndarray):
    edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
    kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if len(data) else b""
    return int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()


def suffix_dedup(rows, length=400):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each (doc_id, text)."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((d, len(b), *spans_removed(b, gone)))
    return out


def substring_dedup(rows, window=50):
    """(doc_id, n_words, n_removed, kept_sha256) of each (doc_id, text)."""
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    first: dict[tuple, int] = {}
    for d, w in texts:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(marks, bits=3):
    """For each fingerprint, the position of the first row it hangs together with."""
    parent = list(range(len(marks)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(marks))]


def near_duplicates(rows, shingle=3, bits=3):
    """(doc_id, fingerprint, component_id) of each (doc_id, text)."""
    marks = [fingerprint(t, shingle) for _, t in rows]
    groups = roots(marks, bits)
    least: dict[int, int] = {}
    for (d, _), g in zip(rows, groups):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return [(d, f"{m:016x}", least.get(g)) for (d, _), m, g in zip(rows, marks, groups)]


def quality(text):
    """The base counts and the base verdict of a text."""
    words = (text or "").encode().split()
    grams = list(zip(words, words[1:], words[2:]))
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    n = len(words)
    return (
        n, sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


def top_k(rows, k=10, scale=1024):
    """(query_id, rank, vec_id, score) for (vec_id, vector) rows; queries are ids divisible by 100."""
    good = [
        (i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, (query, v) in enumerate(good):
        if query % 100 == 0:
            scored = sorted(
                (-sum(x * y for x, y in zip(v, w)), i)
                for b, (i, w) in enumerate(good) if b != a and len(w) == len(v)
            )
            out += [(query, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out
