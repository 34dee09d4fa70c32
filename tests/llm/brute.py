"""Plain counterparts of the operators, for comparison on small tables."""

import collections
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def components(rows, k, num, den):
    """(doc_id, n_shingles, component_id) per row, by an index of all shingles."""
    sets = [shingle_set(text, k) for _, text in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = collections.defaultdict(list)
    for n, s in enumerate(distinct):
        common = collections.Counter(m for f in s for m in index[f])
        for m, c in common.items():
            if den * c >= num * (len(s) + len(distinct[m]) - c):
                parent[find(n)] = find(m)
        for f in s:
            index[f].append(n)
    place = {s: n for n, s in enumerate(distinct)}
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            root = find(place[s])
            least[root] = min(least.get(root, i), i)
    return [(i, len(s), least.get(find(place[s])) if s else i) for (i, _), s in zip(rows, sets)]
