"""Byte-level BPE by replaying the merges over all distinct words of a batch at once."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ebbline.llm.common import ship
from ebbline.llm.pieces import PieceCache, split_byte_level

#: Characters of text whose new words are replayed together, words a worker keeps.
BATCH_CHARS = 500_000
CACHE_SIZE = 400_000

_codecs: dict = {}


class MergeReplay:
    """Applies the merges of a rank table to a corpus of words in rank order.

    The words lie one behind the other in one byte string. ``waiting`` is the inverted index: the start of every
    adjacent pair by the rank of the token the pair would form. Taking the lowest rank, each of its pairs that
    still stands is joined and only the pairs with its left and right neighbour are looked up again. A pair that
    turns up with a lower rank than the one in hand is taken first, so every word sees its merges in the same
    order as if it were encoded alone.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.pair_rank = np.full(65536, -1, dtype=np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.pair_rank[token[0] << 8 | token[1]] = rank

    def index(self, data: bytes, first: np.ndarray) -> dict[int, list[int]]:
        """Starts of adjacent byte pairs by rank; ``first`` marks the first byte of each word."""
        codes = np.frombuffer(data, np.uint8).astype(np.int64)
        ranks = self.pair_rank[codes[:-1] << 8 | codes[1:]]
        ranks[first[1 : len(codes)] == 1] = -1
        places = np.flatnonzero(ranks >= 0)
        places = places[np.argsort(ranks[places], kind="stable")]
        kinds, starts = np.unique(ranks[places], return_index=True)
        return {int(k): p.tolist() for k, p in zip(kinds, np.split(places, starts[1:]), strict=True)} if len(kinds) else {}

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word; words must not be empty. Words that are tokens themselves need no merge."""
        whole = list(map(self.ranks.get, words))
        if any(w is not None for w in whole):
            rest = iter(self.encode([word for word, w in zip(words, whole, strict=True) if w is None]))
            return [next(rest) if w is None else [w] for w in whole]
        data = b"".join(words)
        n = len(data)
        if not n:
            return [[] for _ in words]
        first = np.zeros(n + 1, np.uint8)
        bounds = np.cumsum([0, *map(len, words)])
        first[bounds] = 1
        waiting = self.index(data, first)
        first = first.tobytes()
        end = list(range(1, n + 1))  # of the token that starts here; 0: inside a token
        before = list(range(-1, n))  # start of the token to the left
        ranks, size, rank_of = list(waiting), self.size, self.ranks.get
        heapq.heapify(ranks)

        while ranks:
            rank = heapq.heappop(ranks)
            places, length = waiting.pop(rank), size[rank]
            places.sort()
            for k, at in enumerate(places):
                middle = end[at]
                stop = at + length
                if not middle or first[middle] or end[middle] != stop:
                    continue
                end[at], end[middle] = stop, 0
                lower = False
                if not first[stop]:
                    before[stop] = at
                    found = rank_of(data[at : end[stop]])
                    if found is not None:
                        if found in waiting:
                            waiting[found].append(at)
                        else:
                            waiting[found] = [at]
                            heapq.heappush(ranks, found)
                        lower = found < rank
                if not first[at]:
                    left = before[at]
                    found = rank_of(data[left:stop])
                    if found is not None:
                        if found in waiting:
                            waiting[found].append(left)
                        else:
                            waiting[found] = [left]
                            heapq.heappush(ranks, found)
                        lower = lower or found < rank
                if lower and k + 1 < len(places):
                    waiting[rank] = places[k + 1 :]
                    heapq.heappush(ranks, rank)
                    break
        out = []
        for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            ids, at = [], start
            while at < stop:
                after = end[at]
                ids.append(rank_of(data[at:after]))
                at = after
            out.append(ids)
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class Codec:
    def __init__(self, path: str):
        ranks = read_ranks(path)
        replay = MergeReplay(ranks)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.ids = PieceCache(
            lambda pieces: [np.array(i, "<u4").tobytes() for i in replay.encode([p.encode() for p in pieces])], CACHE_SIZE
        )

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; new words are replayed together."""
        split = [split_byte_level(text) for text in texts]
        new = set().union(*split).difference(self.ids)
        if new:
            self.ids.learn(sorted(new))
        return [b"".join(map(self.ids.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec(path: str) -> Codec:
    from ebbline.llm import merge_replay as module

    if path not in module._codecs:
        module._codecs[path] = module.Codec(path)
    return module._codecs[path]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts, null ones as empty, of about ``BATCH_CHARS`` characters at once; a longer text comes alone."""
    start, chars = 0, 0
    texts = [text or "" for text in batch.column(1).to_pylist()]
    for stop, text in enumerate(texts, 1):
        chars += len(text)
        if chars >= BATCH_CHARS or stop == len(texts):
            yield batch.column(0).slice(start, stop - start), texts[start:stop]
            start, chars = stop, 0


def encode(documents: DataFrame, rank_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of every text: ``(id, n_tokens, ids)``, one row per input row, without special tokens.

    ``ids`` holds little-endian unsigned 32-bit integers. Texts are split by the byte-level pattern; each batch's
    words that the worker does not know yet are encoded together by ``MergeReplay``. Words do not leave their task,
    so nothing is shuffled. Null and empty texts have no ids; null ids stay null; repeated rows give repeated
    results; other columns are not read.
    """
    ship(documents.sparkSession)
    names = [id_column, "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(rank_path)
        for batch in batches:
            for keys, texts in _parts(batch):
                ids = codec.encode_all(texts)
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, counts, pa.array(ids, pa.binary())], names)

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(documents[id_column], documents[text_column])
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, rank_path: str, id_column: str = "doc_id") -> DataFrame:
    """``(id, n_tokens, ids, decoded)``: the bytes that the ids stand for. Null ids decode to no bytes."""
    ship(encoded.sparkSession)
    names = [id_column, "n_tokens", "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(rank_path)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                decoded = [codec.decode(ids or b"") for ids in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], names)

    kind = encoded.schema[id_column].dataType.simpleString()
    rows = encoded.select(encoded[id_column], encoded["n_tokens"], encoded["ids"])
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids binary, decoded binary")


def digests(documents: DataFrame, rank_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` of encoding every text and decoding its ids.

    Both are done by one worker with one codec, so a core holds one vocabulary and one cache, and only digests leave
    it. Null and empty texts have no ids and the digests of nothing; null ids stay null; repeated rows give repeated
    results; an empty table gives an empty result; other columns are not read.
    """
    ship(documents.sparkSession)
    names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(rank_path)
        for batch in batches:
            for keys, texts in _parts(batch):
                ids = codec.encode_all(texts)
                sums = [[hashlib.sha256(i).hexdigest() for i in ids], [hashlib.sha256(codec.decode(i)).hexdigest() for i in ids]]
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, counts, *(pa.array(s, pa.string()) for s in sums)], names)

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(documents[id_column], documents[text_column])
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
