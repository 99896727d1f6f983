"""Word shingles and their min-hashes, computed over many texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

WIDTH = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: Sequence[str]) -> list[np.ndarray]:
    """A 64-bit hash for each word of each text. Words are runs of letters a-z, digits and characters beyond ASCII,
    in lower case; all else separates them."""
    hashes, counts = flat_words(texts)
    return np.split(hashes, np.cumsum(counts)[:-1]) if len(counts) else []


def flat_words(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of all texts behind one another, and how many words each has."""
    encoded = [text.lower().encode() for text in texts]
    data = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
    inside = _WORD[data]
    step = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    power, inverse = powers_to(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])])
    hashes = mixed((total[stops] - total[starts]) * inverse[starts] + (stops - starts).astype(np.uint64))
    ends = np.cumsum([len(e) + 1 for e in encoded])
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words, sorted; all words are one run if there are fewer."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total = total * _BASE + words[k : len(words) - width + 1 + k]
    return np.unique(mixed(total + np.uint64(width)))


def flat_runs(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of words of each text, and the text of each run."""
    per = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), per)
    at = np.arange(len(owner)) + np.repeat(np.cumsum(counts) - counts - (np.cumsum(per) - per), per)
    wide = np.minimum(counts, width)[owner]
    total = np.zeros(len(owner), np.uint64)
    for k in range(width):
        inside = wide > k
        total[inside] = total[inside] * _BASE + hashes[at[inside] + k]
    return mixed(total + wide.astype(np.uint64)), owner


def _first_of_equals(found: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by owner and run, and which are there for the first time in it."""
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return order, first


def flat_shingles(hashes: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of many texts whose words lie behind one another, and how many each text has."""
    found, owner = flat_runs(hashes, counts, width)
    order, first = _first_of_equals(found, owner)
    kept = order[first]
    return found[kept], np.bincount(owner[kept], minlength=len(counts))


def flat_distinct(hashes: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """``flat_shingles`` with the shingles of a text in the order of their first words. Few repeat inside a text, so
    that only those that may are put in order."""
    found, owner = flat_runs(hashes, counts, width)
    both = mixed(found + owner.astype(np.uint64) * _BASE)
    held = np.sort(both)
    again = held[1:][held[1:] == held[:-1]]
    if len(again):
        place = np.searchsorted(again, both)
        place[place == len(again)] = 0
        at = np.flatnonzero(again[place] == both)
        order, first = _first_of_equals(found[at], owner[at])
        kept = np.ones(len(found), bool)
        kept[at[order[~first]]] = False
        found, owner = found[kept], owner[kept]
    return found, np.bincount(owner, minlength=len(counts))


def flat_set_hashes(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``set_hash`` of sets that lie behind one another."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(flat), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return mixed(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64) * _BASE).view(np.int64)


def set_hash(shingle_set: np.ndarray) -> int:
    """One signed 64-bit number for a set of shingles."""
    total = int(mixed(shingle_set).sum(dtype=np.uint64)) + len(shingle_set) * int(_BASE)
    return int(mixed(np.array([total % (1 << 64)], np.uint64))[0].view(np.int64))


def min_hashes(sets: Sequence[np.ndarray], n: int, seed: int = 1) -> np.ndarray:
    """``n`` 32-bit min-hashes of each set, as rows; sets must not be empty."""
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    return flat_min_hashes(flat, np.array([len(s) for s in sets], np.int64), n, seed)


def flat_min_hashes(flat: np.ndarray, sizes: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """``min_hashes`` of sets that lie behind one another."""
    draw = np.random.default_rng(seed)
    factor = draw.integers(0, 1 << 32, n, np.uint32) | np.uint32(1)
    offset = draw.integers(0, 1 << 32, n, np.uint32)
    out = np.full((len(sizes), n), 0xFFFFFFFF, np.uint32)
    keys = (flat >> np.uint64(32)).astype(np.uint32) ^ flat.astype(np.uint32)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for k in range(0, len(keys), 512):
        values = keys[k : k + 512, None] * factor + offset
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        values ^= values >> np.uint32(13)
        own = owner[k : k + 512]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        found = np.minimum.reduceat(values, starts, axis=0)
        out[own[starts]] = np.minimum(out[own[starts]], found)
    return out
