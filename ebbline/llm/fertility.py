"""Quality rules: plain counts of words, symbols and repeats, then how public tokenizers take the words apart.

Text that a vocabulary was not made for, such as keys, encoded data, broken encodings or another language than the one
stated, is cut into more and other tokens than its language usually is. What is usual is read from the corpus itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import ship, written

LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8  # a power of two
#: A band reaches this many quartile distances beyond the quartiles.
REACH = 3
#: Documents from which a band is read; where a language has fewer of a length, the band of all its lengths holds.
LEAST_DOCUMENTS = 100
#: Grids on which measures are counted, so that quartiles are exact: steps a unit.
GRID = {"chars_per_token": 100, "fallback_share": 1000, "token_entropy": 50}
#: The least quartile distance, so that very uniform corpora do not lose ordinary texts: 0.05 characters, 1 %, 0.25 bits.
LEAST_SPREAD = {"chars_per_token": 5, "fallback_share": 10, "token_entropy": 12}
#: Characters that are measured at once, and characters of words that a worker remembers.
SLICE_CHARS = 2_000_000
CACHE_CHARS = 4_000_000

_SPACE = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_SCRIPTS = {
    name: regex.compile(rf"\p{{Script={name}}}")
    for name in ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Thai", "Hangul", "Hiragana", "Katakana", "Han")
}
_lexicons: dict = {}


def script_of(text: str) -> str:
    """The script with most characters (ties: first of the list), or ``none``."""
    counts = {name: sum(1 for _ in pattern.finditer(text)) for name, pattern in _SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "none"


class Lexicon(dict):
    """Numbers of words; for each number the tokens of both vocabularies. Forgets all when it holds too much."""

    def __init__(self, ranks_path: str, pieces_path: str):
        super().__init__()
        import public_tokenizers
        import sentencepiece
        import tiktoken

        from ebbline.llm.merge_replay import read_ranks

        self.byte_level = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks_path), special_tokens={}
        )
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.chars = 0
        self.tokens = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int32)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def learn(self) -> None:
        """Tokens of the words met since the last call."""
        if not self.new:
            return
        self.chars += sum(map(len, self.new))
        tokens = [len(self.byte_level.encode_ordinary(" " + word)) for word in self.new]
        pieces = self.pieces.encode(self.new, num_threads=1)
        sizes = np.cumsum([len(p) for p in pieces])
        self.tokens = np.concatenate([self.tokens, tokens])
        self.starts = np.concatenate([self.starts, self.starts[-1] + sizes])
        self.flat = np.concatenate([self.flat, *(np.array(p, np.int32) for p in pieces)])
        self.new = []


def repeated_words(words: np.ndarray, doc: np.ndarray, number: int) -> np.ndarray:
    """Per document the words inside windows that come twice or more in it. Windows of 2, 4, 8 words get numbers by
    joining two of half their length, so equal numbers are equal words."""
    out = np.zeros(number, np.int64)
    if len(words) < WINDOW:
        return out
    codes = pd.factorize(words)[0].astype(np.int64)
    width = 1
    while width < WINDOW:
        codes = pd.factorize(codes[:-width] * len(words) + codes[width:])[0].astype(np.int64)
        width *= 2
    inside = np.flatnonzero(doc[: len(codes)] == doc[WINDOW - 1 :])
    keys = pd.factorize(doc[inside] * np.int64(len(words)) + codes[inside])[0]
    again = inside[np.bincount(keys)[keys] > 1] if len(keys) else inside
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    return np.bincount(doc, weights=np.cumsum(edges[:-1]) > 0, minlength=number).astype(np.int64)


def entropies(tokens: np.ndarray, doc: np.ndarray, number: int, size: int) -> np.ndarray:
    """Bits per token of each document's own token frequencies; 0 without tokens."""
    if not len(tokens):
        return np.zeros(number)
    codes, keys = pd.factorize(doc * np.int64(size) + tokens)
    counts = np.bincount(codes).astype(float)
    total = np.bincount(doc, minlength=number)
    inner = np.bincount(keys // size, weights=counts * np.log2(counts), minlength=number)
    return np.where(total > 0, np.log2(np.maximum(total, 1)) - inner / np.maximum(total, 1), 0.0)


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


def measure(texts: list[str], lexicon: Lexicon) -> dict[str, np.ndarray]:
    """Counts and measures of each text."""
    if lexicon.chars > CACHE_CHARS:
        lexicon.forget()
    found = [_WORD.findall(text) for text in texts]
    number = len(texts)
    n_words = np.array([len(f) for f in found], np.int64)
    words = np.fromiter((lexicon[w] for f in found for w in f), np.int64, int(n_words.sum()))
    lexicon.learn()
    doc = np.repeat(np.arange(number), n_words)
    sizes = np.diff(lexicon.starts)[words]
    at = np.repeat(lexicon.starts[words] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    pieces, piece_doc = lexicon.flat[at], np.repeat(doc, sizes)
    n_pieces = np.bincount(piece_doc, minlength=number)
    n_bytes = np.bincount(piece_doc, weights=lexicon.is_byte[pieces], minlength=number).astype(np.int64)
    n_tokens = np.bincount(doc, weights=lexicon.tokens[words], minlength=number).astype(np.int64)
    word_chars = np.array([len(t) - sum(map(t.count, _SPACE)) for t in texts], np.int64)
    entropy = entropies(pieces, piece_doc, number, len(lexicon.is_byte))
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": np.array([sum(map(t.count, _SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeated_words(words, doc, number),
        "chars_per_token": GRID["chars_per_token"] * word_chars // np.maximum(n_tokens, 1),
        "fallback_share": GRID["fallback_share"] * n_bytes // np.maximum(n_pieces, 1),
        "token_entropy": np.floor(GRID["token_entropy"] * entropy + 1e-6).astype(np.int64),
    }


def _cuts(texts: list[str]) -> Iterator[slice]:
    start = held = 0
    for k, text in enumerate(texts):
        if held and held + len(text) > SLICE_CHARS:
            yield slice(start, k)
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(
    documents: DataFrame, ranks_path: str, pieces_path: str, id_column: str, text_column: str, language: Column
) -> DataFrame:
    """``(id, kind, length_class, counts.., base_failed, measures..)`` per row; measures are steps on their grids."""
    id_type = documents.schema[id_column].dataType.simpleString()
    names = ["id", "kind", *COUNTS, *GRID]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ebbline.llm import fertility as module

        key = (ranks_path, pieces_path)
        if key not in module._lexicons:
            module._lexicons[key] = module.Lexicon(*key)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            kinds = batch.column(2).to_pylist()
            for cut in module._cuts(texts):
                found = module.measure(texts[cut], module._lexicons[key])
                stated = [k or module.script_of(t) for k, t in zip(kinds[cut], texts[cut], strict=True)]
                columns = [pa.array(stated, pa.string()), *(pa.array(found[n].astype(np.int64)) for n in names[2:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[cut.start : cut.stop], *columns], names)

    text = F.coalesce(documents[text_column], F.lit(""))
    rows = documents.select(documents[id_column], text.alias("text"), language.alias("kind"))
    schema = f"id {id_type}, kind string, " + ", ".join(f"{n} long" for n in names[2:])
    measured = rows.mapInArrow(run, schema)
    n = F.col("n_words")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * n)
    return measured.withColumn("base_failed", failed).withColumn(
        "length_class", F.when(n > 0, F.floor(F.log2(n.cast("double")))).otherwise(0).cast("int")
    )


def _edge(measure: str, reach: Column) -> Column:
    ends = F.struct((F.col("first") - reach).alias("low"), (F.col("third") + reach).alias("high"))
    return F.max(F.when(F.col("measure") == measure, ends)).alias(measure)


def bands(measured: DataFrame) -> DataFrame:
    """``(kind, length_class, low.., high..)``: where the measures of documents that pass the base rules lie.

    Measures are counted on their grids over all documents, so quartiles are exact and at most a few thousand rows
    per language and length leave the count. Where a language has fewer than ``LEAST_DOCUMENTS`` of a length, the
    band of all its lengths holds; where it has fewer in all, the band of all documents.
    """
    stacked = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in GRID))).alias("m")
    single = measured.where(~F.col("base_failed")).select("kind", "length_class", stacked)
    counts = single.groupBy("kind", "length_class", "m.measure", "m.value").agg(F.count("*").alias("n"))
    counts = written(counts.withColumn("every", F.lit(0)), "measure-counts")
    out = counts.select("kind", "length_class", "every").distinct()
    for level, keys in enumerate((["kind", "length_class"], ["kind"], ["every"])):
        pooled = counts.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
        whole = Window.partitionBy(*keys, "measure")
        running = F.sum("n").over(whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
        ranked = pooled.select("*", running.alias("end"), F.sum("n").over(whole).alias("total"))

        def quartile(share: float) -> Column:
            return F.min(F.when(F.col("end") >= share * F.col("total"), F.col("value")))

        found = ranked.groupBy(*keys, "measure").agg(
            quartile(0.25).alias("first"), quartile(0.75).alias("third"), F.max("total").alias("total")
        )
        distance = F.col("third") - F.col("first")
        edges = found.groupBy(*keys).agg(
            F.max("total").alias("total"), *(_edge(m, REACH * F.greatest(distance, F.lit(least))) for m, least in LEAST_SPREAD.items())
        )
        enough = F.col("total") >= (0 if keys == ["every"] else LEAST_DOCUMENTS)
        level_rows = edges.where(enough).select(*keys, F.struct(*GRID).alias(f"band_{level}"))
        out = out.join(level_rows, keys, "left")
    return out.select("kind", "length_class", F.coalesce("band_0", "band_1", "band_2").alias("band"))


def quality(
    documents: DataFrame,
    ranks_path: str,
    pieces_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str | None = "lang",
) -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, reason,
    chars_per_token, fallback_share, token_entropy)``, one row per input row.

    Words are runs without ASCII white space. A document fails the base rules with fewer than 20 words, or with more
    than 30 % of its words in 8-word windows that it holds twice or more. The others are held against the band of
    their language (without one: their script) and length: characters per token of ``ranks_path`` (a tiktoken rank
    file), share of byte-fallback tokens and bits of entropy per token of ``pieces_path`` (a sentencepiece model), each
    word encoded alone. A document outside a band of three quartile distances around the quartiles is not kept, and
    ``reason`` names the first measure; characters per token and entropy may lie too low or too high, the byte share
    only too high.

    Null and empty texts have no words and fail the base rules, with measures of 0; null ids stay null; repeated rows
    are documents of their own, in the bands too; an empty table gives an empty result; other columns are not read.
    Whole texts of any length are measured, a long one alone.
    """
    ship(documents.sparkSession)
    language = F.nullif(F.trim(documents[language_column].cast("string")), F.lit("")) if language_column else F.lit(None).cast("string")
    table = written(measures(documents, ranks_path, pieces_path, id_column, text_column, language), "measures")
    limits = written(bands(table), "bands")
    joined = table.join(limits, ["kind", "length_class"], "left")
    reason = F.when(F.col("base_failed"), "base")
    for m in GRID:
        low, high = F.col(f"band.{m}.low"), F.col(f"band.{m}.high")
        outside = (F.col(m) > high) if m == "fallback_share" else (F.col(m) < low) | (F.col(m) > high)
        reason = reason.when(outside, m)
    values = [(F.col(m) / steps).alias(m) for m, steps in GRID.items()]
    out = joined.select("id", *COUNTS, "base_failed", reason.alias("reason"), *values)
    return out.select(
        F.col("id").alias(id_column), *COUNTS, "base_failed", F.col("reason").isNull().alias("kept"), "reason", *GRID
    )
