"""Plain loops that the operators are held against."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def covered(sequences, window):
    """Per sequence, which units a window that also starts anywhere else covers."""
    seen = Counter(tuple(s[i:i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append(gone)
    return out


def runs(flags):
    return sum(1 for i, f in enumerate(flags) if f and (not i or not flags[i - 1]))


_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, n):
    w = WORD.findall((text or "").encode().translate(_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(rows, n, percent):
    """[(id, text)] -> sorted [(id, set size, smallest id of the component)]."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)].append(key)
    return [(key, len(sets[i]), min(least[root(i)], default=None)) for i, (key, _) in enumerate(rows)]


def facts(text):
    text = text or ""
    w = words(text)
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line.encode()):
            repeats += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = [False] * len(w)
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            inside[i:i + 8] = [True] * 8
    return (len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), repeats, sum(inside))
