"""Plain single-process versions of the operators, for small fixtures."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def groups(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, k):
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def near_duplicates(rows, k):
    """rows: (doc_id, text), ids distinct. {doc_id: (n_shingles, component_id, kept)}"""
    sets = {i: shingles(t, k) for i, t in rows}
    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    shared = Counter()
    for ids in index.values():
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                shared[ids[a], ids[b]] += 1
    links = [p for p, n in shared.items() if 100 * n >= 80 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    of = groups(sets, links)
    return {i: (len(sets[i]), of[i], of[i] == i) for i in sets}


def removed_words(rows, length):
    """rows: (doc_id, text). [(doc_id, words, removed positions)]"""
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - length + 1):
            if seen[tuple(w[s : s + length])] > 1:
                gone.update(range(s, s + length))
        out.append((i, w, gone))
    return out
