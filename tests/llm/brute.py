"""Plain Python versions of what the operators compute."""

import collections
import re

import numpy as np


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def shingle_set(text):
    found = words(text)
    width = min(5, len(found))
    return frozenset(tuple(found[k : k + width]) for k in range(len(found) - width + 1)) if found else frozenset()


def reach(links, keys):
    """For each key the smallest key that links lead to."""
    out = {}
    for key in keys:
        seen, stack = {key}, [key]
        while stack:
            for other in links[stack.pop()]:
                if other not in seen:
                    seen.add(other)
                    stack.append(other)
        out[key] = min(seen)
    return out


def jaccard_links(sets, threshold=0.8):
    holders = collections.defaultdict(list)
    for key, shingles in sets.items():
        for s in shingles:
            holders[s].append(key)
    links = collections.defaultdict(set)
    for key, shingles in sets.items():
        shared = collections.Counter(other for s in shingles for other in holders[s] if other != key)
        for other, n in shared.items():
            if n >= threshold * (len(shingles) + len(sets[other]) - n) - 1e-9:
                links[key].add(other)
    return links


def classes(rows):
    """``{position: (n_links, smallest id)}`` for rows of (id, text)."""
    sets = {(i, k): shingle_set(t) for k, (i, t) in enumerate(rows) if i is not None}
    links = jaccard_links(sets)
    first = reach(links, sets)
    return sorted((i, len(links[i, k]), first[i, k][0]) if i is not None else (None, 0, None) for k, (i, _) in enumerate(rows))


def cut(rows, length=50):
    """``{id: (n_bytes, n_removed, spans, kept)}``."""
    first, out = {}, {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if first.setdefault(data[k : k + length], key) < key:
                gone[k : k + length] = True
        edge = np.diff(gone.astype(np.int8), prepend=0)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[key] = (len(data), int(gone.sum()), int((edge == 1).sum()), kept)
    return out
