"""Counts, files and merges against the libraries, on odd texts and on random ones."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ebbline.llm import merge_replay, token_counts, token_files
from ebbline.llm.pieces import BYTE_LEVEL, AgingCache, byte_level_starts, plain, split_byte_level

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merge_replay.read_ranks(RANKS), special_tokens={}
    )


def test_pattern_is_the_public_one():
    assert BYTE_LEVEL == public_tokenizers.PATTERN


def test_counts_match_the_library(documents):
    library = Tokenizer.from_file(WORDS)
    got = token_counts.token_counts(documents, WORDS, limit=3)
    expected = sorted(
        (str(r.doc_id), len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 3)
        for r in documents.collect()
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == expected


def test_counts_do_not_depend_on_the_first_tier(documents):
    token_counts._counters.clear()
    small = token_counts.token_counts(documents, WORDS, sample_rows=1, table_size=1)
    large = token_counts.token_counts(documents, WORDS)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_no_shuffle_of_pre_tokens(documents):
    plan = token_counts.token_counts(documents, WORDS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("build", ["counts", "encode"])
def test_empty_table(no_documents, build):
    if build == "counts":
        assert token_counts.token_counts(no_documents, WORDS).collect() == []
    else:
        assert merge_replay.digests(no_documents, RANKS).collect() == []


def test_merges_match_the_library(documents, reference):
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in merge_replay.digests(documents, RANKS).collect())
    expected = []
    for row in documents.collect():
        ids = reference.encode_ordinary(row.text or "")
        raw = np.array(ids, "<u4").tobytes()
        text = (row.text or "").encode()
        expected.append((str(row.doc_id), len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest()))
    assert got == sorted(expected)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_replay_of_any_words(texts):
    ranks = merge_replay.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = sorted({piece for text in texts for piece in split_byte_level(text.encode("utf-8", "ignore").decode())})
    got = test_replay_of_any_words.replay.encode([w.encode() for w in words])
    assert got == [library.encode_ordinary(w) for w in words]


test_replay_of_any_words.replay = merge_replay.MergeReplay(merge_replay.read_ranks(RANKS))


def test_replay_takes_a_lower_rank_that_turns_up_late():
    """Tables where a longer token has a lower rank than its parts, against one word at a time."""
    draw = random.Random(3)
    for _ in range(200):
        tokens = [bytes([b]) for b in b"abc"]
        extra = {bytes(draw.choice(b"abc") for _ in range(draw.randint(2, 4))) for _ in range(12)}
        order = list(extra)
        draw.shuffle(order)
        ranks = {bytes([b]): 1_000 + b for b in range(256)} | {t: k for k, t in enumerate(order)}
        words = [bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 12))) for _ in range(6)]
        assert merge_replay.MergeReplay(ranks).encode(words) == [one_by_one(w, ranks) for w in words], (ranks, tokens)


def one_by_one(word, ranks):
    if word in ranks:
        return [ranks[word]]
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda k: (ranks.get(parts[k] + parts[k + 1], 1 << 30), k))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


def test_files_round_trip(spark, documents, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(documents, BYTES, path, block_ids=2_000)
    files = spark.read.parquet(path)
    library = Tokenizer.from_file(BYTES)
    rows = sorted(documents.collect(), key=lambda r: (-1 if r.doc_id is None else r.doc_id))
    start, expected = 0, []
    for row in rows:
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 0]
        expected.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(token_files.digests(files).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == expected
    whole = [*library.encode(rows[7].text or "", add_special_tokens=False).ids, 0]
    assert token_files.read_document(files, rows[7].doc_id) == [whole]
    assert token_files.read_document(files, rows[7].doc_id, 3, 9) == [whole[3:9]]
    assert token_files.read_document(files, 99_999) == []
    assert files.agg({"n_ids": "sum"}).first()[0] == start


def test_files_of_an_empty_table(spark, no_documents, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(no_documents, BYTES, path)
    assert token_files.digests(spark.read.parquet(path)).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=300), st.integers(1, 7))
def test_grammar_expands_to_its_ids(ids, every):
    flat = np.array(ids, "<u4")
    last = np.zeros(len(flat), bool)
    last[every - 1 :: every] = True
    last[-1] = True
    grammar, symbols, ends = token_files.compress(flat, last, 6)
    assert grammar.expand(symbols).tolist() == ids
    assert ends.sum() == last.sum()
    assert grammar.part(symbols, len(ids) // 3, len(ids) // 2).tolist() == ids[len(ids) // 3 : len(ids) // 2]


def test_rank_file_is_base64(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"ab") + b" 7\n")
    assert merge_replay.read_ranks(str(path)) == {b"ab": 7}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab sStmdrevl'\n\t\r 19_.,!-éÉß“”—¿")), min_size=1, max_size=4))
def test_plain_texts_are_cut_together_as_they_are_alone(texts):
    assert all(map(plain, texts))
    joined = "".join(text + "\0" for text in texts)
    starts = byte_level_starts(np.array([ord(c) for c in joined], np.uint32)).tolist()
    cut = [joined[a:b] for a, b in zip(starts, [*starts[1:], len(joined)], strict=True)]
    assert cut == [piece for text in texts for piece in [*split_byte_level(text), "\0"]]


def test_texts_encoded_together_have_the_ids_of_the_library(monkeypatch):
    monkeypatch.setattr(token_files, "PLAIN_CHARS", 40)
    library, encoder = Tokenizer.from_file(BYTES), token_files.IdEncoder(BYTES)
    texts = ["don't\n\n we'll  see", "", "naïve — “x”", "漢字 ok", "<|endoftext|> a", "\0 b", "a  \n", "'re 're", "x" * 50, " ", "it's"]
    for _ in range(2):
        got = [np.frombuffer(e, "<u4").tolist() for e in encoder.encode_all(texts)]
        assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert encoder.encode_all([]) == []


def test_an_aging_cache_forgets_only_what_is_not_met_again():
    asked = []
    cache = AgingCache(lambda pieces: [asked.append(p) or p.upper() for p in pieces], 3)
    for piece in ["a", "b", "c", "d", "a", "e", "f", "a", "g", "h", "a"]:
        assert cache[piece] == piece.upper()
    assert asked.count("a") == 1 and len(cache) <= 3 and len(cache.older) <= 3
