"""Alignment of two tokenizers over one corpus: where their tokens end together, and which ids overlap how often.

Inside a task everything is Arrow: lists of ids are flattened with their parent indices, running sums of token bytes
give the ends, a hash join on the ends aligns both sides, and group-bys count. Spark merges the counts of blocks.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import ship, written
from ebbline.llm.pieces import BYTE_LEVEL, plain
from ebbline.llm.token_files import byte_marks

#: Bytes of text aligned at once, and bytes of text whose links share one list of id pairs. A longer text stands alone.
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
#: Writers and readers of Parquet hold a row group at a time, and count its bytes after every hundred rows only.
ONE_BLOCK_A_GROUP = {"parquet.block.row.count.limit": "1"}
MARK = "▁"
_tokenizers: dict = {}


class ByteLevel:
    """Ids of a byte-level vocabulary file of the tokenizers library.

    Where ids are merge ranks, plain texts go through the same merges in tiktoken, which is several times faster.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, special = content["model"]["vocab"], {t["content"] for t in content["added_tokens"]}
        values = {mark: byte for byte, mark in byte_marks().items()}
        self.bytes = {
            i: token.encode() if token in special else bytes(values[c] for c in token) for token, i in vocabulary.items()
        }
        merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        ranked = {token: i for token, i in vocabulary.items() if token not in special}
        in_order = [ranked.get("".join(pair)) for pair in merges] == list(range(256, 256 + len(merges)))
        splits = content.get("pre_tokenizer") or {}
        usual = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
        self.fast = None
        if in_order and usual and not content.get("normalizer") and len(ranked) == 256 + len(merges):
            ranks = {self.bytes[i]: i for i in ranked.values()}
            self.fast = tiktoken.Encoding("aligned", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None and plain(text):
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids of a sentencepiece model, and the bytes that its pieces stand for."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = {}
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            byte = self.library.is_byte(i)
            self.bytes[i] = bytes([int(piece[1:-1], 16)]) if byte else piece.replace(MARK, " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text)


def _tables(side: ByteLevel | Pieces) -> tuple[pa.Array, pa.Array]:
    """Bytes in each token and its number as text, by id."""
    size = max(side.bytes) + 1
    return (
        pa.array([len(side.bytes.get(i, b"")) for i in range(size)], pa.int64()),
        pa.array([str(i) for i in range(size)], pa.string()),
    )


class Aligner:
    def __init__(self, byte_level_path: str, pieces_path: str):
        self.a, self.b = ByteLevel(byte_level_path), Pieces(pieces_path)
        self.a_bytes, self.a_names = _tables(self.a)
        self.b_bytes, self.b_names = _tables(self.b)

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Both sides' ids, or none where a side does not give back the text."""
        if not text:
            return [], []
        spaced = " " + text
        a, b = self.a.encode(spaced), self.b.encode(text)
        data = spaced.encode()
        if b"".join(map(self.a.bytes.__getitem__, a)) != data or b"".join(map(self.b.bytes.__getitem__, b)) != data:
            return [], []
        return a, b

    def align(self, texts: list[str | None]) -> tuple[pa.Table, pa.Table]:
        """Per text ``(doc, n_a, n_b, n_groups, n_links, digest)``, and ``(doc, pair, times)`` of the linked ids."""
        encoded = [self.encode(text) for text in texts]
        a_lists, b_lists = _lists([a for a, _ in encoded]), _lists([b for _, b in encoded])
        a_side = _side(a_lists, self.a_bytes, "a", "a_at")
        b_side = _side(b_lists, self.b_bytes, "b", "b_at")
        # Ends are counted through all texts of the slice, so an end belongs to one text.
        joined = a_side.join(b_side, "end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
        a_at, b_at = joined["a_at"], joined["b_at"]
        both = pc.and_(pc.is_valid(a_at), pc.is_valid(b_at))
        # An end of one side lies inside the token of the other side that ends next.
        a_token = pc.fill_null_backward(joined["a"])
        doc = pc.fill_null_backward(joined["doc"])
        pair = pc.add(pc.multiply(a_token.cast(pa.int64()), 1 << 32), pc.fill_null_backward(joined["b"]).cast(pa.int64()))
        links = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        links = links.rename_columns(["doc", "pair", "times"]).sort_by([("doc", "ascending"), ("pair", "ascending")])
        number = len(texts)
        n_links = _per_doc(doc, number)
        n_groups = _per_doc(pc.filter(doc, both), number)
        a_text = _grouped(a_lists, self.a_names, pc.filter(a_at, both))
        b_text = _grouped(b_lists, self.b_names, pc.filter(b_at, both))
        groups = pc.binary_join_element_wise(a_text, b_text, "|")
        offsets = np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32)
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), groups), ";")
        digests = [hashlib.sha256(g.as_buffer()).hexdigest() if n else "" for g, n in zip(whole, n_groups.tolist(), strict=True)]
        found = pa.table(
            {
                "n_a": pc.list_value_length(a_lists).cast(pa.int64()),
                "n_b": pc.list_value_length(b_lists).cast(pa.int64()),
                "n_groups": pa.array(n_groups),
                "n_links": pa.array(n_links),
                "groups_sha256": pa.array(digests, pa.string()),
            }
        )
        return found, links


def _lists(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = np.concatenate([np.array(i, np.int32) for i in ids]) if ids else np.array([], np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _side(lists: pa.ListArray, sizes: pa.Array, name: str, at: str) -> pa.Table:
    """One row per token: its end, its id, its place, and on the first side the text it is in."""
    flat = pc.list_flatten(lists)
    columns = {
        "end": pc.cumulative_sum(pc.take(sizes, flat)),
        name: flat,
        at: pa.array(np.arange(len(flat), dtype=np.int32)),
    }
    if name == "a":
        columns["doc"] = pc.list_parent_indices(lists).cast(pa.int32())
    return pa.table(columns)


def _per_doc(doc: pa.ChunkedArray, number: int) -> np.ndarray:
    return np.bincount(doc.to_numpy(), minlength=number).astype(np.int64)


def _grouped(lists: pa.ListArray, names: pa.Array, last: pa.ChunkedArray) -> pa.Array:
    """The ids of each group as text; ``last`` is the place of each group's last token."""
    offsets = pa.array(np.concatenate([[0], last.to_numpy() + 1]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.take(names, pc.list_flatten(lists))), ",")


def _cuts(texts: list[str | None], limit: int) -> Iterator[slice]:
    start = held = 0
    for k, text in enumerate(texts):
        size = 4 * len(text) if text and not text.isascii() else len(text or "")
        if held and held + size > limit:
            yield slice(start, k)
            start, held = k, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


class Block:
    """What a task has aligned since it last gave out a row."""

    def __init__(self):
        self.ids, self.found, self.links, self.rows, self.held = [], [], [], 0, 0

    def add(self, ids: pa.Array, texts: list[str | None], aligner: Aligner) -> None:
        found, links = aligner.align(texts)
        self.ids.append(ids)
        self.found.append(found)
        self.links.append(links.set_column(0, "doc", pc.add(links["doc"].cast(pa.int64()), self.rows)))
        self.rows += len(ids)
        self.held += sum(len(t or "") for t in texts)

    def row(self, number: int, names: list[str]) -> pa.RecordBatch:
        found, links = pa.concat_tables(self.found), pa.concat_tables(self.links)
        # A pair comes once per text here, so its rows are the texts that hold it.
        totals = links.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "holders"])
        totals = totals.sort_by("pair").combine_chunks()
        at = np.searchsorted(totals["pair"].to_numpy(), links["pair"].to_numpy()).astype(np.int32)
        columns = [
            pa.chunked_array(self.ids),
            *found.columns,
            pa.array(np.bincount(links["doc"].to_numpy(), minlength=self.rows).astype(np.int32)),
            totals["pair"],
            totals["holders"],
            pa.array(at),
            links["times"].cast(pa.int32()),
        ]
        flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in flat]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], names)


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def blocks(
    documents: DataFrame, byte_level_path: str, pieces_path: str, id_column: str, text_column: str
) -> DataFrame:
    """One row per block of texts: their figures, the linked id pairs with the texts that hold them, and per text
    which of the pairs it has how often."""
    kind = documents.schema[id_column].dataType.simpleString()
    names = ["block", "ids", *COLUMNS, "sizes", "pairs", "holders", "at", "times"]
    schema = (
        f"block long, ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
        "groups_sha256 array<string>, sizes array<int>, pairs array<long>, holders array<long>, at array<int>, times array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ebbline.llm import alignment as module

        key = (byte_level_path, pieces_path)
        if key not in module._tokenizers:
            module._tokenizers[key] = module.Aligner(*key)
        aligner, block = module._tokenizers[key], module.Block()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for cut in module._cuts(texts, SLICE_BYTES):
                block.add(batch.column(0)[cut.start : cut.stop], texts[cut], aligner)
                if block.held >= BLOCK_BYTES:
                    yield block.row(number, names)
                    number, block = number + 1, module.Block()
        if block.rows:
            yield block.row(number, names)

    return documents.select(documents[id_column], documents[text_column]).mapInArrow(run, schema)


def pair_counts(table: DataFrame) -> DataFrame:
    """``(pair, held_by, best)``: texts that hold each linked id pair, and whether no pair of its first id has more."""
    parts = table.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).select("p.pairs", "p.holders")
    counts = parts.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("held_by"))
    counts = written(counts.withColumn("first", F.shiftright("pair", 32).cast("int")), "pair-counts")
    # One row per id of the first vocabulary.
    highest = counts.groupBy("first").agg(F.max("held_by").alias("highest"))
    joined = counts.join(F.broadcast(highest), "first")
    return joined.select("pair", "held_by", (F.col("held_by") == F.col("highest")).alias("best"))


def align(
    documents: DataFrame,
    byte_level_path: str,
    pieces_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row.

    ``byte_level_path`` (A) is a byte-level file of the tokenizers library, ``pieces_path`` (B) a sentencepiece model
    that puts a space before a text; A encodes the text with that space. Strings of special tokens are plain text.
    Offsets where tokens of both sides end cut them into groups. A link is a token of A and one of B whose bytes
    overlap; the count of an id pair is the number of rows of the whole table that hold it linked. ``n_best`` counts
    the links whose pair has the highest count of its A id, ties included; ``count_sum`` adds the counts of all links.

    A task keeps one list of the id pairs of each block of about ``BLOCK_BYTES``, so a pair moves once per block and
    not once per text; a longer text is a block of its own. Null and empty texts, and texts that a side does not give
    back byte for byte (those with U+2581), have zeros and an empty digest, and count for no pair. Null ids stay null,
    repeated rows are texts of their own, an empty table gives an empty result, and other columns are not read.
    """
    ship(documents.sparkSession)
    table = written(blocks(documents, byte_level_path, pieces_path, id_column, text_column), "aligned", ONE_BLOCK_A_GROUP)
    spread = table.select("block", F.posexplode("pairs").alias("place", "pair"))
    # Rows, not a list per block: Spark sorts them by block on disk where it must, and a list would lie on the heap.
    marked = (F.shiftleft("held_by", 1) + F.col("best").cast("long")).alias("marked")
    counted = spread.join(pair_counts(table), "pair").select(F.col("block").alias("of_block"), "place", marked)
    kind = documents.schema[id_column].dataType.simpleString()
    names = [id_column, *COLUMNS[:4], "n_best", "count_sum", "groups_sha256"]

    def run(counts: pa.Table, rows: pa.Table) -> pa.Table:
        row = {name: rows[name].combine_chunks().flatten() for name in rows.column_names if name != "block"}
        # A block without a link has no counts.
        values = np.zeros(len(counts), np.int64)
        values[counts["place"].to_numpy()] = counts["marked"].to_numpy()
        row |= {"held_by": pa.array(values >> 1), "best": pa.array(values & 1)}
        return pa.table([row["ids"], *(row[c] for c in COLUMNS[:4]), *_sums(row), row["groups_sha256"]], names)

    schema = f"`{id_column}` {kind}, " + ", ".join(f"{n} long" for n in names[1:7]) + ", groups_sha256 string"
    return counted.groupBy("of_block").cogroup(table.drop("pairs", "holders").groupBy("block")).applyInArrow(run, schema)


def _sums(row: dict) -> list[pa.Array]:
    """Per text of a block: links whose pair is a best one, and the counts of all links."""
    ends = np.concatenate([[0], np.cumsum(row["sizes"].to_numpy())])
    if not ends[-1]:
        return [pa.array(np.zeros(len(ends) - 1, np.int64))] * 2
    times = row["times"].cast(pa.int64())
    sums = []
    for values in (row["best"], row["held_by"]):
        running = pc.cumulative_sum(pc.multiply(times, pc.take(values, row["at"]))).to_numpy()
        running = np.concatenate([[0], running])
        sums.append(pa.array(running[ends[1:]] - running[ends[:-1]]))
    return sums
