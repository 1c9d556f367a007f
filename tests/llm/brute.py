"""Plain versions of the operators, over a whole small table at once."""

import re
import zlib
from collections import Counter, defaultdict
from math import log10

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    text = text or ""
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)


def remainder(doc_id, k):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % k


def shingles(text):
    w = words(text, True)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """rows: (doc_id, text); the smallest id of each row's component, row by row."""
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(rows))], [len(s) for s in sets]


def without_passages(rows, k=50):
    """(n_words, kept words) of each row."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - k + 1) if doc_id is not None else ():
            window = tuple(w[i : i + k])
            first[window] = min(doc_id, first.get(window, doc_id))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - k + 1) if doc_id is not None else ():
            if first[tuple(w[i : i + k])] < doc_id:
                gone[i : i + k] = [True] * k
        out.append((len(w), [x for x, g in zip(w, gone, strict=True) if not g]))
    return out


def base_scores(rows):
    tokens = [words(t, True) + [None] for _, t in rows]
    count = Counter(x for (i, _), t in zip(rows, tokens, strict=True) if remainder(i, 7) != 2 for x in t)
    n, v = sum(count.values()), len(count)
    return n, [(len(t), sum(x in count for x in t), sum(log10((count[x] + 1) / (n + v + 1)) for x in t)) for t in tokens]


def targets(sizes, weights=(5, 2, 1), most=3):
    """Raise the water level until nothing is above its cap."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    capped = set()
    while True:
        left = sum(sizes) - sum(most * sizes[i] for i in capped)
        unit = sum(w[i] for i in range(len(sizes)) if i not in capped)
        share = [most * sizes[i] if i in capped else left * w[i] / unit for i in range(len(sizes))]
        new = {i for i in range(len(sizes)) if i not in capped and share[i] > most * sizes[i] + 1e-9}
        if not new:
            return share
        capped |= new
