"""Fertility rules, alignment of two tokenizers and centroid clustering against plain Python."""

import collections
import hashlib
import json
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ebbline.llm import alignment, centroids, fertility
from ebbline.llm.queries import ORACLES, QUERIES
from ebbline.llm.token_files import byte_marks

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF_DIR = "/root/testdata/sf0.001"


# Fertility rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    repeated = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    doubles = sum(line in lines[:k] for k, line in enumerate(lines)) if len(lines) < 2_000 else len(lines) - len(set(lines))
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), doubles, len(repeated), failed


def rules(rows):
    return [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows
    ]


def key(row):
    return tuple(str(v) for v in row)


def test_rules_match_plain_counts(documents):
    got = fertility.quality(documents, RANKS, PIECES).collect()
    expected = [(r.doc_id, *plain_counts(r.text)) for r in documents.collect()]
    assert sorted(rules(got), key=key) == sorted(expected, key=key)
    assert all((r.reason is None) == r.kept and not (r.base_failed and r.kept) for r in got)


def test_rules_of_random_texts_and_many_repeats(spark):
    draw = random.Random(5)
    texts = [" ".join(draw.choice("a b c d".split()) for _ in range(draw.randrange(60))) for _ in range(40)]
    texts += ["x\n \n\nx\ny|x\n" * 3, "one two three four five six seven eight " * 2, " ".join(map(str, range(8))) + "\v" + " ".join(map(str, range(8)))]
    texts += ["same line of text\n" * 50_000, "y" * 300_000, " " * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = fertility.quality(df, RANKS, PIECES, language_column=None).collect()
    assert sorted(rules(got)) == sorted((k, *plain_counts(t)) for k, t in enumerate(texts))


def test_measures_match_the_libraries():
    lexicon = fertility.Lexicon(RANKS, PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["Plain words here, and again plain words.", "", "漢字 ﷽ �", "x" * 50, "  "]
    got = fertility.measure(texts, lexicon)
    for k, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        pieces = [p for w in words for p in library.encode(w)]
        tokens = sum(len(lexicon.byte_level.encode_ordinary(" " + w)) for w in words)
        shares = [n / len(pieces) for n in collections.Counter(pieces).values()]
        assert got["chars_per_token"][k] == 100 * sum(map(len, words)) // max(tokens, 1)
        assert got["fallback_share"][k] == 1000 * sum(map(library.is_byte, pieces)) // max(len(pieces), 1)
        assert got["token_entropy"][k] == math.floor(50 * -sum(s * math.log2(s) for s in shares) + 1e-6)


def test_forgetting_words_changes_nothing(monkeypatch):
    texts = [f"word{k} of text {k % 7} with some words more" for k in range(50)]
    whole = fertility.measure(texts, fertility.Lexicon(RANKS, PIECES))
    lexicon = fertility.Lexicon(RANKS, PIECES)
    monkeypatch.setattr(fertility, "CACHE_CHARS", 10)
    parts = [fertility.measure([t], lexicon) for t in texts]
    for name, values in whole.items():
        assert values.tolist() == [p[name][0] for p in parts]


def plain_quartile(values, share):
    values = sorted(values)
    return values[math.ceil(share * len(values)) - 1]


def test_bands_and_odd_documents(spark):
    draw = random.Random(3)
    common = "the of and to in is that for it with as was on be at by this had not are but from or have an they which one you were".split()
    plain = [" ".join(draw.choice(common) for _ in range(draw.randrange(40, 60))) for _ in range(300)]
    odd = ["".join(draw.choice("0123456789abcdef") for _ in range(40)) for _ in range(30)]
    texts = [(k, t, "en") for k, t in enumerate(plain)] + [(900, " ".join(odd), "en"), (901, " ".join("漢字仮名交じり文" * 2 for _ in range(40)), "en")]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in fertility.quality(df, RANKS, PIECES).collect()}
    assert sum(got[k].kept for k in range(300)) >= 298
    assert not got[900].kept and got[900].reason == "chars_per_token" and not got[900].base_failed
    assert not got[901].kept
    measured = fertility.measures(df, RANKS, PIECES, "doc_id", "text", df.lang).cache()
    rows = [r for r in measured.collect() if not r.base_failed]
    band = {(r.kind, r.length_class): r.band for r in fertility.bands(measured).collect()}["en", 5]
    for name in fertility.GRID:
        values = [r[name] for r in rows if r.length_class == 5]
        first, third = plain_quartile(values, 0.25), plain_quartile(values, 0.75)
        reach = 3 * max(third - first, fertility.LEAST_SPREAD[name])
        assert (band[name].low, band[name].high) == (first - reach, third + reach)
    measured.unpersist()


def test_rare_languages_use_wider_bands(spark):
    texts = [(k, f"number {k} of the words and more words in it " + " ".join(map(str, range(k, k + 20))), "en") for k in range(120)]
    texts += [(500, texts[0][1], "xx"), (501, texts[1][1], None)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    measured = fertility.measures(df, RANKS, PIECES, "doc_id", "text", df.lang).cache()
    found = {r.kind: r.band for r in fertility.bands(measured).collect()}
    assert set(found) == {"en", "xx", "Latin"} and found["xx"] == found["Latin"]
    measured.unpersist()


def test_scripts():
    assert [fertility.script_of(t) for t in ("abc где", "абв a", "漢字", "123 !", "")] == ["Latin", "Cyrillic", "Han", "none", "none"]


def test_rules_of_an_empty_table(no_documents):
    result = fertility.quality(no_documents, RANKS, PIECES)
    assert result.collect() == [] and result.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


# Alignment


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    values = {mark: byte for byte, mark in byte_marks().items()}
    vocabulary = json.load(open(BYTES))["model"]["vocab"]
    a_bytes = {i: bytes(values.get(c, 0) for c in t) for t, i in vocabulary.items()}
    return a, b, a_bytes


def plain_links(sides, text):
    """Groups, and for each overlapping pair of tokens its ids."""
    a, b, a_bytes = sides
    if not text:
        return [], [], [], []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    pieces = [b.id_to_piece(i) for i in b_ids]
    b_parts = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
    a_parts = [a_bytes[i] for i in a_ids]
    if b"".join(a_parts) != (" " + text).encode() or b"".join(b_parts) != (" " + text).encode():
        return [], [], [], []
    a_ends, b_ends = np.cumsum([len(p) for p in a_parts]), np.cumsum([len(p) for p in b_parts])
    links = []
    first = 0
    for i, end in enumerate(a_ends):
        for j in range(first, len(b_ends)):
            start = b_ends[j] - len(b_parts[j])
            if start >= end:
                break
            if b_ends[j] > end - len(a_parts[i]):
                links.append((a_ids[i], b_ids[j]))
            else:
                first = j + 1
    groups, x, y = [], 0, 0
    for end in sorted({*a_ends.tolist()} & {*b_ends.tolist()}):
        left, right = int((a_ends <= end).sum()), int((b_ends <= end).sum())
        groups.append(",".join(map(str, a_ids[x:left])) + "|" + ",".join(map(str, b_ids[y:right])))
        x, y = left, right
    return a_ids, b_ids, groups, links


def plain_alignment(sides, rows):
    found = [(i, *plain_links(sides, t)) for i, t in rows]
    holders = collections.Counter(pair for row in found for pair in set(row[4]))
    highest = collections.Counter()
    for (a, _), n in holders.items():
        highest[a] = max(highest[a], n)
    return sorted(
        (
            str(i),
            len(a),
            len(b),
            len(groups),
            len(links),
            sum(holders[p] == highest[p[0]] for p in links),
            sum(holders[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        )
        for i, a, b, groups, links in found
    )


def aligned(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r.doc_id), *(r[n] for n in names)) for r in alignment.align(df, BYTES, PIECES).collect())


def test_alignment_matches_plain_python(spark, documents, sides):
    odd = [(50, "a▁b"), (51, "  two  spaces\n\n and <s> </s> <unk> <0x41> <|endoftext|>"), (52, "🙂\x00 ﬁ ＦＵ ẞ"), (None, "\t"), (53, " ")]
    df = documents.select("doc_id", "text", "key", "n").unionByName(
        spark.createDataFrame([(i, t, 1, 2) for i, t in odd], "doc_id long, text string, key long, n long")
    )
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert aligned(df) == plain_alignment(sides, rows)


def test_alignment_over_many_blocks(spark, sides, monkeypatch):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 7_000)
    assert aligned(df) == plain_alignment(sides, rows)


def test_blocks_are_held_one_at_a_time(spark, monkeypatch):
    """A row group is one block, and the counts of blocks reach their task as rows that Spark can spill."""
    df = spark.createDataFrame([(i, f"text {i} of some words " * 40) for i in range(60)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 5_000)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 2_000)
    tables = {}
    real = alignment.written
    monkeypatch.setattr(alignment, "written", lambda d, label, *o: tables.setdefault(label, real(d, label, *o)))
    found = alignment.align(df, BYTES, PIECES)
    assert found.count() == 60
    groups = [
        footer.row_group(k).num_rows
        for file in tables["aligned"].inputFiles()
        for footer in [pq.read_metadata(file.removeprefix("file://"))]
        for k in range(footer.num_row_groups)
    ]
    assert len(groups) > 5 and set(groups) == {1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "CoGroup" in plan


def test_aligner_in_slices(sides):
    aligner = alignment.Aligner(BYTES, PIECES)
    texts = ["one text", "", None, "an other ▁ one", "漢字 and   spaces ", "x" * 5_000, " " * 5_000]
    for part in (texts, texts[:1], texts[1:3], []):
        found, links = aligner.align(part)
        for k, text in enumerate(part):
            a, b, groups, pairs = plain_links(sides, text)
            assert [found[n][k].as_py() for n in ("n_a", "n_b", "n_groups", "n_links")] == [len(a), len(b), len(groups), len(pairs)]
            rows = [(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF, r["times"]) for r in links.to_pylist() if r["doc"] == k]
            assert sorted(rows) == sorted((*p, n) for p, n in collections.Counter(pairs).items())


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_both_sides_give_the_library_ids(text):
    global _aligner
    if "_aligner" not in globals():
        _aligner = alignment.Aligner(BYTES, PIECES)
    assert _aligner.a.encode(" " + text) == _aligner.a.library.encode(" " + text, add_special_tokens=False).ids


def test_very_long_texts_align(spark):
    texts = ["word " * 200_000, "a" * 300_000, " " * 100_000 + "x", "line\n" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in alignment.align(df, BYTES, PIECES).collect()}
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups and r.n_groups > 0 for r in rows.values())


def test_alignment_of_an_empty_table(no_documents, documents):
    assert aligned(no_documents) == []
    assert {r[1:] for r in aligned(documents.where("text is null or text = ''"))} == {(0, 0, 0, 0, 0, 0, "")}


# Centroids


def plain_clusters(rows, number=40, rounds=5):
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), list(centroids.transform(np.array([r[1]]))[0])))
    centres = np.array([v for _, v in start[:number]], object)
    vectors = np.array([v for _, v in kept], object)

    def assign():
        distances = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
        return [min(range(len(centres)), key=lambda k: (d[k], k)) for d in distances], distances

    for _ in range(rounds):
        found, _ = assign()
        for k in set(found):
            own = vectors[[f == k for f in found]]
            centres[k] = own.sum(axis=0) // len(own)
    found, distances = assign()
    own = [distances[i][k] for i, k in enumerate(found)]
    inertia = collections.Counter()
    for k, d in zip(found, own, strict=True):
        inertia[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    return sorted((str(i), k, d, inertia[k], sum(own), digest[k]) for (i, _), k, d in zip(kept, found, own, strict=True))


def clustered(df, **options):
    return sorted((str(r[0]), *r[1:]) for r in centroids.cluster(df, **options).collect())


def test_centroids_match_sql(spark):
    connection = connect(SF_DIR)
    assert differences(QUERIES["op13_centroids"](spark, SF_DIR), connection, ORACLES["op13_centroids"]) == []


def test_centroids_of_odd_vectors(spark):
    draw = random.Random(1)
    rows = [(k, [draw.uniform(-1, 1) for _ in range(64)], k, k) for k in range(90)]
    rows += [(200 + k, [float(draw.randrange(-1, 2))] * 64, 1, 1) for k in range(30)]  # ties and exact copies
    rows += [(7, rows[7][1], 1, 1), (7, rows[8][1], 1, 1), (None, rows[3][1], 1, 1)]
    rows += [(300, None, 1, 1), (301, [], 1, 1), (302, [1.0] * 63, 1, 1), (303, [1.0] * 63 + [None], 1, 1)]
    rows += [(304, [1.0] * 63 + [math.nan], 1, 1), (305, [math.inf] * 64, 1, 1), (306, [1.0] * 65, 1, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster long, distance long").repartition(3)
    expected = plain_clusters([r[:2] for r in rows])
    assert len(expected) == 123 and clustered(df) == expected


def test_large_values_and_few_vectors(spark):
    draw = random.Random(2)
    rows = [(k, [draw.uniform(-8191, 8191) for _ in range(64)]) for k in range(25)] + [(99, [9000.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clustered(df) == plain_clusters(rows[:-1])
    assert clustered(df.limit(0)) == []


def test_search_equals_all_distances_and_drops_centroids():
    draw = np.random.default_rng(4)
    vectors, centres = draw.integers(-300, 300, (500, 64)), draw.integers(-300, 300, (40, 64))
    centres[5] = centres[30]
    vectors[:20] = centres[30]
    found, distance = centroids.nearest(centroids.transform(vectors), centroids.transform(centres))
    whole = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (found == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
    assert (centroids.inverse(centroids.transform(vectors)) == vectors).all()


def test_rows_of_the_transform_go_from_coarse_to_fine():
    matrix = centroids.hadamard(64)
    assert (matrix @ matrix.T == 64 * np.eye(64)).all()
    assert [(row[1:] != row[:-1]).sum() for row in matrix] == list(range(64))
