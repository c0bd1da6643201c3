"""Near duplicates by comparing whole sets, for small tables."""

import re


def shingle_set(text, words):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset()


def components(texts, words, percent):
    """texts: id -> text; gives id -> smallest id reachable."""
    sets = {i: shingle_set(t, words) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            small, large = sorted((len(x), len(y)))
            if not small or 100 * small < percent * large:
                continue
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in texts}
