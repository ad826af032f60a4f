"""Plain versions of the n-gram Jaccard join, for small tables."""

import re
from collections import defaultdict
from fractions import Fraction

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(rows, size, threshold):
    """(id, set size, smallest id reachable) of each of the rows (id, text); every pair that shares a shingle is compared."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        near = {j for t in s for j in holders[t]}
        for j in near:
            both = len(s & sets[j])
            if Fraction(both, len(s) + len(sets[j]) - both) >= threshold:
                parent[top(i)] = top(j)
        for t in s:
            holders[t].append(i)
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[top(i)] = min(least.get(top(i), id_), id_)
    return [(id_, len(sets[i]), least.get(top(i))) for i, (id_, _) in enumerate(rows)]
