"""Splitting text into the pieces that byte-level tokenizers merge within, and a bounded cache of encoded pieces."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import regex

# The split patterns that the public vocabularies are used with.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The same splits for texts of PLAIN characters only, where the classes of the standard library's
# faster engine agree with the Unicode properties above.
_BYTE_LEVEL_PLAIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_WORD_PLAIN = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
# U+0130 changes its length in lower case; it and all else outside the ranges take the general way.
_NOT_PLAIN = re.compile(
    "[^\t\n\r\x20-\x7e\xa1\xab\xbb\xbf\xc0-\xd6\xd8-\xf6\xf8-įı-ɏ‐-‧]"
)
_BYTE_LEVEL = regex.compile(BYTE_LEVEL)


def plain(text: str) -> bool:
    return _NOT_PLAIN.search(text) is None


def split_byte_level(text: str) -> list[str]:
    """All pieces of ``text`` in order; joined they give the text back."""
    return (_BYTE_LEVEL_PLAIN if plain(text) else _BYTE_LEVEL).findall(text)


def _kind(char: str) -> int:
    return next(k for k, m in enumerate((r"[^\W\d_]", r"\d", r"\s", "")) if re.match(m, char))


_LETTER, _NUMBER, _SPACE, _SIGN, _BREAK = range(5)
#: Kinds of all characters up to the last plain one; U+0000, which is not plain, stands between texts.
_KINDS = np.array([_BREAK, *(_kind(chr(c)) for c in range(1, 0x2028))], np.uint8)


def byte_level_starts(points: np.ndarray) -> np.ndarray:
    """Where the pieces of plain texts start, as ``split_byte_level`` cuts them: ``points`` are the code points of the
    texts, each with a U+0000 after it, which is a piece of its own."""
    kind = _KINDS[points]
    start = np.ones(len(points), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _BREAK)
    # White space before a word: its last character stands alone, or goes with the word if it is a blank.
    after = np.flatnonzero(start[1:] & (kind[:-1] == _SPACE) & (kind[1:] != _BREAK)) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 0x20]] = False
    # A contraction: an apostrophe that starts a piece, and one or two letters.
    ends = np.concatenate([points, np.zeros(3, points.dtype)])
    quote = np.flatnonzero((points == 0x27) & start)
    first, second = ends[quote + 1], ends[quote + 2]
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (first == ord(a)) & (second == ord(b))
    for found, letters in ((quote[one], 1), (quote[two], 2)):
        start[found + 1] = False
        rest = found + 1 + letters
        start[rest[_KINDS[ends[rest]] == _LETTER]] = True
    return np.flatnonzero(start)


def split_plain_words(text: str) -> list[str]:
    """Pieces of a plain text in lower case, white space dropped."""
    return _WORD_PLAIN.findall(text.lower())


class PieceCache(dict):
    """Encoded pieces by piece. Misses are encoded alone or many at once; at ``limit`` entries it starts anew."""

    def __init__(self, encode: Callable[[list[str]], Iterable], limit: int, seed: dict | None = None):
        super().__init__()
        self.encode, self.limit, self.seed = encode, limit, seed or {}
        self.update(self.seed)

    def __missing__(self, piece: str):
        self.learn([piece])
        return self[piece]

    def learn(self, pieces: list[str]) -> None:
        """Encode ``pieces`` together."""
        if len(self) + len(pieces) > self.limit + len(self.seed):
            self.clear()
            self.update(self.seed)
        self.update(zip(pieces, self.encode(pieces), strict=True))


class AgingCache(PieceCache):
    """A cache that keeps its last ``limit`` entries apart when it starts anew: pieces met again come back from there,
    so that only rare ones are encoded twice. It holds twice ``limit`` entries at most."""

    def __init__(self, encode: Callable[[list[str]], Iterable], limit: int):
        super().__init__(encode, limit)
        self.older: dict = {}

    def __missing__(self, piece: str):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            (found,) = self.encode([piece])
        self[piece] = found
        return found
