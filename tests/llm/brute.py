"""Plain versions of what the duplicate operators compute."""

import re


def ngrams(text, n=5):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def components(rows, n=5, percent=80):
    """{place: smallest id reachable} of rows (id, text); None where no id is reachable."""
    sets = [ngrams(text, n) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            best[find(i)] = min(best.get(find(i), key), key)
    return [best.get(find(i)) for i in range(len(rows))], [len(s) for s in sets]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
