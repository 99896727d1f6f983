"""Token counts per document without moving a single pre-token."""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import pick, ship
from ebbline.llm.pieces import PieceCache, plain, split_plain_words

#: Rows read to fill the first tier, entries kept there, entries a worker's own cache may hold.
SAMPLE_ROWS = 1_000
TABLE_SIZE = 32_768
CACHE_SIZE = 200_000

_counters: dict = {}


class TokenCounter:
    """Lengths of frequent pre-tokens first, then a worker's cache, then the tokenizer."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lengths = PieceCache(lambda pieces: [self.library(p) for p in pieces], CACHE_SIZE, frequent)

    def library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        if not plain(text) or any(s in text for s in self.special):
            return self.library(text)
        return sum(map(self.lengths.__getitem__, split_plain_words(text)))


def frequent_pieces(
    documents: DataFrame, path: str, text_column: str, sample_rows: int, table_size: int
) -> dict[str, int]:
    """Token counts of the ``table_size`` most frequent pre-tokens in ``sample_rows`` rows.

    The sample only decides which lengths are looked up first; no count depends on it.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if plain(text):
                    seen.update(split_plain_words(text))
        top = seen.most_common(table_size)
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array([p for p, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    pieces = pick(documents, [text_column]).where(F.col(text_column).isNotNull()).limit(sample_rows)
    rows = (
        pieces.mapInArrow(counts, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(table_size)
        .collect()
    )
    counter = TokenCounter(path, {})
    return {row.piece: counter.library(row.piece) for row in rows}


def token_counts(
    documents: DataFrame,
    tokenizer_path: str,
    limit: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    table_size: int = TABLE_SIZE,
) -> DataFrame:
    """Bytes and tokens of every text: ``(id, n_bytes, n_tokens, over_limit)``, one row per input row.

    ``tokenizer_path`` is a file of the tokenizers library whose pre-tokens are words, single digits and runs of
    other marks in lower case. Tier one, the lengths of at most ``table_size`` frequent pre-tokens, is broadcast;
    misses are encoded once per worker and kept in a cache of bounded size. Texts outside the plain character
    ranges, or with a special token's string, go to the library whole. No pre-token leaves its task.

    Null and empty texts count 0 bytes and 0 tokens; null ids stay null; repeated rows give repeated results; an
    empty table gives an empty result; other columns are not read.
    """
    spark = documents.sparkSession
    ship(spark)
    frequent = spark.sparkContext.broadcast(
        frequent_pieces(documents, tokenizer_path, text_column, sample_rows, table_size)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ebbline.llm import token_counts as module

        if tokenizer_path not in module._counters:
            module._counters[tokenizer_path] = module.TokenCounter(tokenizer_path, frequent.value)
        counter = module._counters[tokenizer_path]
        for batch in batches:
            counts = [counter.count(text) if text else 0 for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names)

    names = [id_column, "n_bytes", "n_tokens"]
    kind = documents.schema[id_column].dataType.simpleString()
    n_bytes = F.coalesce(F.octet_length(documents[text_column]), F.lit(0)).cast("long")
    rows = documents.select(documents[id_column], documents[text_column], n_bytes.alias("n_bytes"))
    counted = rows.mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
