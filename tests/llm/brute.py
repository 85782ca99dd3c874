"""Plain Python forms of the operators, for small tables."""

import hashlib
from collections import Counter

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def raw(text):
    return (text or "").encode()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def substring_dedup(docs, window):
    first = {}
    for i, t in docs:
        words = raw(t).split()
        for j in range(len(words) - window + 1):
            if i is not None:
                key = tuple(words[j : j + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in docs:
        words = raw(t).split()
        gone = [False] * len(words)
        for j in range(len(words) - window + 1):
            if i is not None and first[tuple(words[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        out.append((i, len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def exact_dedup(docs):
    texts = [raw(t).translate(FOLD) for _, t in docs]
    out = []
    for (i, _), t in zip(docs, texts):
        ids = [j for (j, _), u in zip(docs, texts) if u == t]
        known = [j for j in ids if j is not None]
        keep = max(known) if known else None
        out.append((i, keep, len(ids), i == keep, sha(t)))
    return out


def shingles(text, words):
    w = raw(text).translate(FOLD).split()
    if len(w) < words:
        return {tuple(w)} if w else set()
    return {tuple(w[j : j + words]) for j in range(len(w) - words + 1)}


def near_dedup(docs, words, percent):
    sets = [shingles(t, words) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    out = []
    for a, (i, _) in enumerate(docs):
        ids = [docs[b][0] for b in range(len(docs)) if find(b) == find(a) and docs[b][0] is not None]
        component = min(ids) if ids else None
        out.append((i, len(sets[a]), component, i == component))
    return out


def repeated_bytes(docs, length):
    """For each text, True for the bytes covered by a string of ``length`` bytes that starts twice."""
    count = Counter()
    for _, t in docs:
        b = raw(t)
        count.update(b[j : j + length] for j in range(len(b) - length + 1))
    masks = []
    for _, t in docs:
        b = raw(t)
        gone = [False] * len(b)
        for j in range(len(b) - length + 1):
            if count[b[j : j + length]] > 1:
                gone[j : j + length] = [True] * length
        masks.append(gone)
    return masks


def suffix_dedup(docs, length):
    out = []
    for (i, t), gone in zip(docs, repeated_bytes(docs, length)):
        b = raw(t)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out
