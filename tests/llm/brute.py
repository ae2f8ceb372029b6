"""Plain single-process versions of the operators that SQL cannot express."""

from __future__ import annotations

from collections import defaultdict


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) >= 5:
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()


def near_groups(docs, percent=75):
    """[(doc_id, text)] -> {index: (n_shingles, component)}; shared shingles give the pairs to compare."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    both = defaultdict(int)
    for group in by.values():
        for k, i in enumerate(group):
            for j in group[k + 1:]:
                both[i, j] += 1
    for (i, j), n in both.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        least[r] = min(least.get(r, d), d)
    return {i: (len(sets[i]), least[root(i)]) for i in range(len(docs))}


def remove_repeats(docs, width=50):
    """[(doc_id, bytes)] -> {index: mask of removed bytes}."""
    first = {}
    for d, b in docs:
        for i in range(len(b) - width + 1):
            s = b[i:i + width]
            first[s] = min(first.get(s, d), d)
    out = {}
    for k, (d, b) in enumerate(docs):
        mask = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i:i + width]] < d:
                mask[i:i + width] = b"\x01" * width
        out[k] = bytes(mask)
    return out
