"""Plain Python versions to compare with."""

import re


def sets_of(texts, words=5):
    out = []
    for text in texts:
        tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(tokens[i : i + words]) for i in range(len(tokens) - words + 1)} if len(tokens) >= words else set()
        out.append(grams or ({tuple(tokens)} if tokens else set()))
    return out


def classes(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def jaccard(rows, percent=75):
    """{id: (n_shingles, component)} of (id, text) rows with distinct ids."""
    rows = sorted(rows)
    sets = sets_of([t for _, t in rows])
    at, links = {}, []
    for i, s in enumerate(sets):
        seen = set()
        for gram in s:
            seen.update(at.setdefault(gram, []))
            at[gram].append(i)
        for j in seen:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                links.append((i, j))
    return {rows[i][0]: (len(sets[i]), rows[c][0]) for i, c in enumerate(classes(len(rows), links))}
