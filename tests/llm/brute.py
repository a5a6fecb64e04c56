"""Plain versions of the operators on Python lists, to hold results against."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text, k):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_duplicates(docs, k, percent):
    """{row number: (set size, smallest doc_id reachable)} for (doc_id, text) rows."""
    sets = [shingle_set(t, k) for _, t in docs]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {i: (len(sets[i]), least.get(find(i))) for i in range(len(docs))}
