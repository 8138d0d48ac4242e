"""Plain-Python references."""

import re


def shingles(text, words=5):
    """Set of word tuples of a text."""
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k:k + words]) for k in range(max(1, len(found) - words + 1)))


def components(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def near_duplicates(rows, percent):
    """{doc_id: (n_shingles, component)} over all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    holders, links = {}, []
    for i in sorted(sets):
        common = {}
        for s in sets[i]:
            for j in holders.get(s, ()):
                common[j] = common.get(j, 0) + 1
            holders.setdefault(s, []).append(i)
        links += [(i, j) for j, n in common.items() if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)]
    comp = components(sets, links)
    return {i: (len(sets[i]), comp[i]) for i in sets}
