"""Plain versions of the operators, for small tables."""

import hashlib
import re

import numpy as np

from lakeops.llm.components import forest


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text):
    """Lower-case A-Z, five words each; fewer words make one."""
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4)))


def near(a, b):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 75 * (len(a) + len(b) - both)


def near_duplicates(docs):
    """(number of shingles, least id) of each (id, text), every pair compared; ids are not null."""
    sets = [shingle_set(t) for _, t in docs]
    by_shingle = {}
    for i, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    pairs = {(i, j) for held in by_shingle.values() for i in held for j in held if i < j}
    links = [(i, j) for i, j in pairs if near(sets[i], sets[j])]
    roots = forest(links)
    least = {}
    for i, (key, _) in enumerate(docs):
        r = roots.get(i, i)
        least[r] = min(least.get(r, key), key)
    return [(len(sets[i]), least[roots.get(i, i)]) for i in range(len(docs))]


def removed(docs, length=50):
    """For each (id, text): bytes, removed spans, kept bytes; a null id is the greatest."""
    first = {}
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    data = [(t or "").encode() for _, t in docs]
    for i in order:
        for k in range(len(data[i]) - length + 1):
            first.setdefault(data[i][k:k + length], docs[i][0])
    out = []
    for (key, _), b in zip(docs, data):
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            least = first[b[k:k + length]]
            if least is not None and (key is None or least < key):
                gone[k] += 1
                gone[k + length] -= 1
        mask = np.cumsum(gone[:-1]) > 0 if len(b) else np.zeros(0, bool)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(int), [0]))))
        kept = bytes(np.frombuffer(b, np.uint8)[~mask])
        out.append((len(b), [tuple(e) for e in edges.reshape(-1, 2).tolist()], kept))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


def vector_links(rows, threshold=0.98):
    """(links, least id) of each (id, vector, label), every pair compared; ids are not null."""
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        x /= np.abs(x).max()
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None
             and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
             and units[i] @ units[j] >= threshold]
    roots = forest(links)
    least = {}
    for i, (key, *_) in enumerate(rows):
        r = roots.get(i, i)
        least[r] = min(least.get(r, key), key)
    counts = np.bincount([i for p in links for i in p], minlength=len(rows)) if links else np.zeros(len(rows), int)
    return [(int(counts[i]), least[roots.get(i, i)]) for i in range(len(rows))]


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by resharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=str) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {s: 0.0 for s in names}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out
