"""Plain versions of what the operators find, for small tables."""

import hashlib
from collections import Counter

import numpy as np


def tokens(text):
    return (text or "").encode().lower().split()


def shingles(text, width):
    w = tokens(text)
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def components(rows, width, percent):
    """{id: (set size, smallest id reachable over links)}."""
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeats(rows, least):
    """(id, bytes, bytes removed, stretches, hash of the rest) of each row."""
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[k : k + least] for k in range(len(b) - least + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - least + 1):
            if count[b[k : k + least]] > 1:
                gone[k : k + least] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out
