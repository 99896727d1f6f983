"""Token ids in files, compressed by pair grammars that allow reading one document alone."""

from __future__ import annotations

import os
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import ship, small
from ebbline.llm.pieces import AgingCache, byte_level_starts, plain, split_byte_level

#: Ids compressed under one grammar, rounds of replacement, least count of a replaced pair, rules per round.
BLOCK_IDS = 2_000_000
ROUNDS = 6
LEAST_COUNT = 4
RULES_PER_ROUND = 2_048
CACHE_SIZE = 400_000
#: Characters of plain texts that are cut at once.
PLAIN_CHARS = 2_000_000
_BUCKETS = 20  # bits of the first, coarse count of pairs

FILE_SCHEMA = (
    "shard int, block int, first_id {0}, last_id {0}, n_ids long, ids array<{0}>, lengths array<int>, "
    "offsets array<int>, base int, rules binary, rule_lengths binary, symbols binary, wide boolean"
)
_encoders: dict = {}


def byte_marks() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 characters stand for
    themselves, all others for the characters from 256 on in ascending order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class IdEncoder:
    """Texts to little-endian unsigned 32-bit ids by the tokenizers library, each distinct piece once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.base = self.tokenizer.get_vocab_size(with_added_tokens=True)
        model, marks = self.tokenizer.model, byte_marks()

        def piece_ids(piece: str) -> bytes:
            found = model.tokenize((piece if piece.isascii() else piece.encode().decode("latin-1")).translate(marks))
            return pack(f"<{len(found)}I", *[token.id for token in found])

        self.pieces = AgingCache(lambda pieces: map(piece_ids, pieces), CACHE_SIZE)

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.library(text)
        return b"".join(map(self.pieces.__getitem__, split_byte_level(text)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Plain texts are cut and looked up together, each distinct piece once."""
        out: list[bytes] = [b""] * len(texts)
        held, size = [], 0
        for k, text in enumerate(texts):
            if not plain(text) or any(s in text for s in self.special):
                out[k] = self.encode(text)
                continue
            held.append(k)
            size += len(text)
            if size >= PLAIN_CHARS:
                self._encode_plain(texts, held, out)
                held, size = [], 0
        if held:
            self._encode_plain(texts, held, out)
        return out

    def _encode_plain(self, texts: list[str], held: list[int], out: list[bytes]) -> None:
        joined = "\0".join([*(texts[k] for k in held), ""])
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts = byte_level_starts(points)
        if not joined.isascii():
            extra = (points >= 0x80).astype(np.int8)  # bytes beyond one
            extra[points >= 0x800] += 1
            starts = starts + np.cumsum(extra, dtype=np.int64)[starts] - extra[starts]
        data = joined.encode()
        offsets = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        values = [b"" if p == "\0" else self.pieces[p] for p in pieces.dictionary.to_numpy(zero_copy_only=False)]
        number = pieces.indices.to_numpy()
        many = np.array([len(v) // 4 for v in values], np.int64)
        sizes = many[number]
        ends = np.cumsum(sizes)
        place = np.repeat((np.cumsum(many) - many)[number] - (ends - sizes), sizes)
        place += np.arange(len(place))
        ids = np.frombuffer(b"".join(values), "<u4")[place].tobytes()
        low = 0
        for k, high in zip(held, (4 * ends[number == number[-1]]).tolist(), strict=True):
            out[k], low = ids[low:high], high


class Grammar:
    """Rules that stand for id pairs: symbol ``base + k`` expands to ``rules[k]``, ``lengths[k]`` ids in all."""

    def __init__(self, base: int, rules: np.ndarray, lengths: np.ndarray):
        self.base, self.rules, self.lengths = base, rules, lengths
        self.starts = np.cumsum(lengths, dtype=np.int64) - lengths
        self.flat = np.zeros(int(lengths.sum()), np.uint32)
        for (left, right), at in zip(rules.tolist(), self.starts.tolist(), strict=True):
            for symbol in (left, right):
                part = [symbol] if symbol < base else self.flat[self.starts[k := symbol - base] :][: self.lengths[k]]
                self.flat[at : at + len(part)] = part
                at += len(part)

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each symbol stands for."""
        return np.concatenate([np.ones(self.base, np.int64), self.lengths])[symbols]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        # Ids and rules alike are stretches of one table: an id of itself, a rule of its expansion.
        table = np.concatenate([np.arange(self.base, dtype="<u4"), self.flat.astype("<u4")])
        first = np.concatenate([np.arange(self.base), self.starts + self.base])[symbols]
        sizes = self.sizes(symbols)
        ends = np.cumsum(sizes)
        place = np.repeat(first - (ends - sizes), sizes)
        place += np.arange(len(place))
        return table[place]

    def part(self, symbols: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of what ``symbols`` stand for, expanding only the symbols that cover them."""
        ends = np.cumsum(self.sizes(symbols))
        low, high = np.searchsorted(ends, [start, stop - 1], side="right") if stop > start else (0, -1)
        before = int(ends[low - 1]) if low else 0
        return self.expand(symbols[low : high + 1])[start - before : max(stop, start) - before]


def _distinct(keys: np.ndarray, slots: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the number of each key among them, and how often each is there.

    Keys of a slot are nearly always one and the same, so that only the others are sorted."""
    number = np.zeros((1 << _BUCKETS) + 1, np.int32)
    number[used] = np.arange(len(used))
    at = number[slots]
    held = np.zeros(len(used), keys.dtype)
    held[at] = keys
    other = np.flatnonzero(held[at] != keys)
    rest, inverse, often = np.unique(keys[other], return_inverse=True, return_counts=True)
    at[other] = len(used) + inverse
    counts = np.bincount(at, minlength=len(used) + len(rest))
    return np.concatenate([held, rest]), at, counts


def compress(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """A grammar for ``ids``, the remaining symbols, and which of them end a document.

    Each round counts all adjacent pairs, first by hash, then exactly those whose hash is frequent, gives the most
    frequent ones a symbol each and replaces them from left to right. No pair crosses a document's end.
    """
    # Pairs of symbols below 65,536 fit into 32 bits.
    kind, wide, bits, factor = (np.uint16, np.uint32, 16, 0x9E3779B1) if base < 65_536 else (np.uint32, np.uint64, 32, 0x9E3779B97F4A7C15)
    symbols, last = ids.astype(kind), last.copy()
    rules, lengths = [], []
    most = max(0, 65_536 - base) if base < 65_536 else 1 << 24
    for _ in range(ROUNDS):
        if len(symbols) < 2 or len(rules) >= most:
            break
        keys = symbols[:-1].astype(wide)
        keys <<= wide(bits)
        keys |= symbols[1:]
        slots = ((keys * wide(factor)) >> wide(2 * bits - _BUCKETS)).astype(np.intp)
        slots[np.flatnonzero(last[:-1])] = 1 << _BUCKETS
        counts = np.bincount(slots, minlength=(1 << _BUCKETS) + 1)
        counts[-1] = 0
        high = counts[np.flatnonzero(counts >= LEAST_COUNT)]
        least = int(np.partition(high, -RULES_PER_ROUND)[-RULES_PER_ROUND]) if len(high) > RULES_PER_ROUND else LEAST_COUNT
        frequent = counts >= least
        places = np.flatnonzero(frequent[slots])
        found, inverse, often = _distinct(keys[places], slots[places], np.flatnonzero(frequent))
        room = min(RULES_PER_ROUND, most - len(rules))
        chosen = np.lexsort((found, -often))
        chosen = chosen[often[chosen] >= least][:room]
        if not len(chosen):
            break
        number = np.full(len(found), -1, np.int32)
        number[chosen] = np.arange(len(chosen)) + base + len(rules)
        new = number[inverse]
        own = np.flatnonzero(new >= 0)
        places, new = places[own], new[own]
        run = np.flatnonzero(np.diff(places, prepend=-2) != 1)  # neighbours overlap: every second one of a run
        offset = np.arange(len(places)) - np.repeat(run, np.diff(run, append=len(places)))
        own = np.flatnonzero(offset & 1 == 0)
        places, new = places[own], new[own]
        for key in found[chosen].tolist():
            left, right = key >> bits, key & ((1 << bits) - 1)
            rules.append((left, right))
            lengths.append(sum(1 if s < base else lengths[s - base] for s in (left, right)))
        kept = np.ones(len(symbols), bool)
        kept[places + 1] = False
        symbols[places] = new
        last[places] = last[places + 1]
        kept = np.flatnonzero(kept)
        before, symbols, last = len(symbols), symbols[kept], last[kept]
        if before - len(symbols) < 0.01 * before:
            break
    table = np.array(rules, np.uint32).reshape(-1, 2)
    return Grammar(base, table, np.array(lengths, np.int64)), symbols.astype(np.int64), last


def write_tokens(
    documents: DataFrame,
    tokenizer_path: str,
    path: str,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text, append ``end_id`` and write the ids to Parquet files at ``path`` in ascending id order.

    Documents are ranged by id into shards; a shard is cut into blocks of about ``block_ids`` ids, a document never
    into two. A row holds one block: its documents, their lengths in ids and where their symbols start, the
    grammar's rules with expansion lengths, and the symbols. Null and empty texts hold only the end id. Null ids
    come first; rows that repeat an id lie side by side in the order of a hash of their text.
    """
    ship(documents.sparkSession)
    kind = documents.schema[id_column].dataType.simpleString()

    def packed(shard: int, block: int, ids: list, encoded: list[bytes], base: int, schema: pa.Schema) -> pa.RecordBatch:
        end = np.array([end_id], "<u4").tobytes()
        lengths = np.array([len(e) // 4 + 1 for e in encoded], np.int64)
        flat = np.frombuffer(b"".join(x for e in encoded for x in (e, end)), "<u4")
        last = np.zeros(len(flat), bool)
        last[np.cumsum(lengths) - 1] = True
        grammar, symbols, last = compress(flat, last, max(base, end_id + 1))
        wide = grammar.base + len(grammar.rules) > 65_536
        offsets = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
        row = {
            "shard": shard, "block": block, "first_id": ids[0], "last_id": ids[-1], "n_ids": len(flat), "ids": ids,
            "lengths": lengths.tolist(), "offsets": offsets.tolist(), "base": grammar.base,
            "rules": grammar.rules.astype("<u4").tobytes(), "rule_lengths": grammar.lengths.astype("<u4").tobytes(),
            "symbols": symbols.astype("<u4" if wide else "<u2").tobytes(), "wide": wide,
        }
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ebbline.llm import token_files as module

        if tokenizer_path not in module._encoders:
            module._encoders[tokenizer_path] = module.IdEncoder(tokenizer_path)
        encoder = module._encoders[tokenizer_path]
        shard, block, size, ids, encoded, schema = TaskContext.get().partitionId(), 0, 0, [], [], None
        for batch in batches:
            id_type = batch.schema.field(0).type
            schema = pa.schema(
                [("shard", pa.int32()), ("block", pa.int32()), ("first_id", id_type), ("last_id", id_type)]
                + [("n_ids", pa.int64()), ("ids", pa.list_(id_type)), ("lengths", pa.list_(pa.int32()))]
                + [("offsets", pa.list_(pa.int32())), ("base", pa.int32()), ("rules", pa.binary())]
                + [("rule_lengths", pa.binary()), ("symbols", pa.binary()), ("wide", pa.bool_())]
            )
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for key, found in zip(batch.column(0).to_pylist(), encoder.encode_all(texts), strict=True):
                ids.append(key)
                encoded.append(found)
                size += len(encoded[-1]) // 4 + 1
                if size >= block_ids:
                    yield packed(shard, block, ids, encoded, encoder.base, schema)
                    block, size, ids, encoded = block + 1, 0, [], []
        if ids:
            yield packed(shard, block, ids, encoded, encoder.base, schema)

    rows = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    order = ["id", F.xxhash64("text")]
    shards = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shards.mapInArrow(run, FILE_SCHEMA.format(kind)).write.parquet(path)


def read_tokens(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids)`` from the written files: ids as little-endian unsigned 32-bit integers, and how
    many ids lie before them in all files. An empty table gives an empty result."""
    ship(files.sparkSession)
    blocks = files.select("shard", "block", "n_ids")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("in_shard"))
    ahead = F.sum("in_shard").over(Window.orderBy("shard")) - F.col("in_shard")  # one row per shard
    shards = shards.select(F.col("shard").alias("of_shard"), ahead.alias("ahead"))
    inside = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    starts = blocks.select(F.col("shard"), F.col("block"), inside.alias("inside"))
    starts = starts.join(shards, F.col("shard") == F.col("of_shard")).select(
        F.col("shard").alias("s"), F.col("block").alias("b"), (F.col("ahead") + F.col("inside")).alias("start")
    )
    kind = files.schema["first_id"].dataType.simpleString()
    names = [id_column, "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                row = {n: c[0].as_py() for n, c in zip(part.schema.names, part.columns, strict=True) if n != "ids"}
                grammar = Grammar(
                    row["base"],
                    np.frombuffer(row["rules"], "<u4").reshape(-1, 2),
                    np.frombuffer(row["rule_lengths"], "<u4").astype(np.int64),
                )
                symbols = np.frombuffer(row["symbols"], "<u4" if row["wide"] else "<u2")
                flat = grammar.expand(symbols)
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                keys = part.column("ids").flatten()
                for low in range(0, len(lengths), 1_000):
                    at = slice(low, low + 1_000)
                    part_ends = np.append(0, np.cumsum(lengths[at]))
                    held = flat[ends[low] - lengths[low] : ends[low] - lengths[low] + part_ends[-1]]
                    offsets = (4 * part_ends).astype(np.int64)
                    found = pa.LargeBinaryArray.from_buffers(
                        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(held)]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys[low : low + 1_000],
                            pa.array(row["start"] + (ends - lengths)[at]),
                            pa.array(lengths[at]),
                            found.cast(pa.binary()),
                        ],
                        names,
                    )

    wide = files.join(small(starts), (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b")))
    wide = wide.select("start", "ids", "lengths", "base", "rules", "rule_lengths", "symbols", "wide")
    return wide.mapInArrow(run, f"`{id_column}` {kind}, start long, n_tokens long, ids binary")


def read_document(files: DataFrame, key, start: int = 0, stop: int | None = None) -> list[list[int]]:
    """Ids ``start`` to ``stop`` of the document ``key``, one list per row that had this id.

    Only blocks whose id range holds the key are read, and only the symbols that cover the wanted ids expanded.
    """
    found = []
    low = F.col("first_id").isNull() | (F.col("first_id") <= F.lit(key))  # null ids come first
    rows = files.where(low & (F.col("last_id") >= F.lit(key)))
    for row in rows.orderBy("shard", "block").toLocalIterator():
        symbols = np.frombuffer(row.symbols, "<u4" if row.wide else "<u2")
        rules = np.frombuffer(row.rules, "<u4").reshape(-1, 2)
        grammar = Grammar(row.base, rules, np.frombuffer(row.rule_lengths, "<u4").astype(np.int64))
        bounds = [*row.offsets, len(symbols)]
        for k, other in enumerate(row.ids):
            if other == key:
                until = row.lengths[k] if stop is None else min(stop, row.lengths[k])
                found.append(grammar.part(symbols[bounds[k] : bounds[k + 1]], start, until).tolist())
    return found


def digests(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of what the files hold."""
    return read_tokens(files, id_column).select(id_column, "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
