"""Deduplication operators against plain Python, on odd rows and on texts with planted copies."""

import random
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from brute import classes, cut, jaccard_links, reach, shingle_set, words

from ebbline.llm import forest_join, paragraphs, projection_dedup, suffix_dedup
from ebbline.llm.components import components
from ebbline.llm.verify import block_links
from ebbline.sources.scratch import scratch_root

NONE = float("nan")


def planted(seed=1, n=120):
    """Texts of which many are copies or edits of others."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["ñandú", "the", "of", "日本"]
    rows = []
    for k in range(n):
        if k > 10 and draw.random() < 0.6:
            found = rows[draw.randrange(len(rows))][1].split(" ")
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                found[draw.randrange(len(found))] = draw.choice(vocabulary)
        else:
            found = [draw.choice(vocabulary) for _ in range(draw.choice([3, 8, 40, 90]))]
            if len(found) > 30:
                found[15] += "\n" + found[16]
        rows.append((k * 3 - 20, " ".join(found)))
    return rows


@pytest.fixture(scope="module")
def copies(spark):
    rows = planted()
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 140)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (None, 3), (40, 0)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_classes_match_all_pairs(copies):
    rows, documents = copies
    got = sorted(tuple(r) for r in forest_join.similarity_classes(documents).select("doc_id", "n_links", "class_id").collect())
    assert got == classes(rows)
    assert sum(r[1] for r in got) > 50


def test_classes_of_odd_rows(documents):
    got = forest_join.similarity_classes(documents).select("doc_id", "n_links", "class_id").collect()
    expected = classes([(r.doc_id, r.text) for r in documents.where("doc_id is not null").collect()])
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == expected
    assert [tuple(r) for r in got if r.doc_id is None] == [(None, 0, None)]


def test_kept_documents(documents, no_documents):
    kept = forest_join.keep_first(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 2, 3, 4, 5, 6, 7, 12, 12, 13, 14]
    assert forest_join.keep_first(no_documents).collect() == []


def test_recall_of_the_matched_depth():
    depth = forest_join.matched_depth(0.8, 0.999)
    assert 1 - (1 - 0.8**depth) ** forest_join.TREES >= 0.999 > 1 - (1 - 0.8 ** (depth + 1)) ** forest_join.TREES
    with pytest.raises(ValueError):
        forest_join.matched_depth(0.1, 0.999, trees=2)


def test_blocks_give_counts_and_connect(copies):
    import pandas as pd

    from ebbline.llm.shingles import shingles, word_hashes

    texts = {t: i for i, t in copies[0]}
    sets = {i: shingles(w) for (t, i), w in zip(texts.items(), word_hashes(list(texts)), strict=True)}
    plain = jaccard_links({i: frozenset(s.tolist()) for i, s in sets.items()})
    keys = sorted(sets)
    frame = pd.DataFrame({"node": keys, "weight": 1, "side": 0, "shingles": [sets[k].tobytes() for k in keys]})

    def links(rows):
        found = block_links(*(rows[c].to_numpy() for c in ("side", "node", "weight")), rows.shingles.to_list(), 0.8)
        return pd.DataFrame(dict(zip(("node", "n", "other", "link"), found, strict=True)))

    whole = links(frame)
    assert {r.node: r.n for r in whole[~whole.link].itertuples()} == {k: len(v) for k, v in plain.items() if v}
    found = {k: set() for k in keys}
    for r in whole[whole.link].itertuples():
        found[r.node].add(r.other)
        found[r.other].add(r.node)
        assert r.node != r.other
    assert reach(found, keys) == reach(plain, keys)
    half = len(keys) // 2
    parts = [frame[:half], frame[half:].assign(side=0), pd.concat([frame[:half], frame[half:].assign(side=1)])]
    split = pd.concat([links(p) for p in parts])
    assert split[~split.link].groupby("node").n.sum().to_dict() == {k: len(v) for k, v in plain.items() if v}


def test_paragraphs_match_all_pairs(copies, documents):
    more = [(r.doc_id + 1_000, r.text) for r in documents.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    rows = copies[0] + more
    table = documents.sparkSession.createDataFrame(rows, "doc_id long, text string")
    sets = {}
    for key, text in rows:
        for at, line in enumerate((text or "").split("\n")):
            if len(words(line)) >= paragraphs.LEAST_WORDS:
                sets[key, at] = shingle_set(line)
    first = reach(jaccard_links(sets), sets)
    expected = sorted((*k, *f) for k, f in first.items() if k != f)
    got = paragraphs.repeated_paragraphs(table)
    assert sorted(tuple(r) for r in got.select("line_id", "at", "class_id", "class_at").collect()) == expected
    assert len(expected) > 10


def test_paragraph_texts(documents, no_documents):
    kept = paragraphs.drop_repeated(documents)
    assert kept.columns == documents.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[8] == "own words of eight" and texts[7].count("\n") == 1 and texts[2] is None and texts[9] == ""
    assert texts[None].startswith("token0")
    assert paragraphs.removals(no_documents).collect() == []


def test_bytes_match_brute_force(copies, documents):
    more = [(r.doc_id + 1_000, r.text) for r in documents.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    rows = copies[0] + more + [(5_000 + k, "ab" * (30 + k) + "c" + "ab" * 40) for k in range(4)]
    table = documents.sparkSession.createDataFrame(rows, "doc_id long, text string")
    expected = cut(rows)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.dedup(table).collect()}
    assert got == expected
    assert all(len(r.spans) == r.n_spans for r in suffix_dedup.dedup(table).collect())


def test_bytes_of_odd_rows(documents, no_documents):
    rows = {r.doc_id: r for r in suffix_dedup.dedup(documents).collect()}
    assert len(suffix_dedup.dedup(documents).collect()) == documents.count()
    assert rows[None].n_removed == 0 and rows[2].n_bytes == 0 and rows[9].n_removed == rows[9].n_bytes
    assert rows[8].n_removed > 300 and rows[7].n_removed == 0
    assert suffix_dedup.dedup(no_documents).collect() == []


def test_texts_alike_in_part_write_no_more_than_they_are(spark):
    draw = np.random.default_rng(3)
    base = draw.integers(97, 123, 6_000)
    rows = []
    for k in range(40):
        text = base.copy()
        text[np.cumsum(draw.integers(35, 90, 60))] = 65 + k % 26
        rows.append((k, bytes(text.astype(np.uint8)).decode()))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    root = Path(scratch_root(spark).removeprefix("file:"))
    before = {p for p in root.rglob("*.parquet")}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.dedup(table).collect()}
    assert got == cut(rows)
    groups = {}
    for p in set(root.rglob("*.parquet")) - before:
        groups[p.parent.name] = groups.get(p.parent.name, 0) + pq.read_table(p).nbytes
    assert groups and sum(groups.values()) < sum(len(t) for _, t in rows), groups


def test_classes_hold_equal_rows_only(monkeypatch):
    draw = np.random.default_rng(4)
    rows = draw.integers(0, 2, (300, 9)).astype(np.uint8)
    expected = [x.tobytes() for x in rows]
    for _ in range(2):
        number = suffix_dedup._classes(rows)
        assert len(set(zip(number.tolist(), expected, strict=True))) == len(set(expected)) == len(set(number.tolist()))
        monkeypatch.setattr(suffix_dedup, "mixed", lambda x: x & np.uint64(1))  # all but two hashes are alike


def test_every_repeated_string_has_an_anchor():
    draw = np.random.default_rng(5)
    data = draw.integers(97, 100, 4_000).astype(np.uint8)
    place, _, first, last = suffix_dedup.anchors(suffix_dedup.prefix_hashes(data))
    covered = np.zeros(len(data) - suffix_dedup.LENGTH + 1, bool)
    for p, a, b in zip(place, first, last, strict=True):
        assert a <= p <= b + suffix_dedup.LENGTH - suffix_dedup.GRAM
        covered[a : b + 1] = True
    assert covered.all() and len(place) < len(data) / 8


def vectors():
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((6, 16))
    rows = [(k, (centres[k % 6] + 0.12 * (k % 5) * draw.standard_normal(16)).tolist(), k % 3) for k in range(150)]
    rows += [(k + 200, rows[k][1], rows[k][2]) for k in range(30)]
    odd = [
        (400, None, 1), (401, [0.0] * 16, 1), (402, [1.0] * 15 + [NONE], 1), (403, [1.0] * 15 + [float("inf")], 1),
        (404, [1.0] * 15 + [None], 1), (405, rows[0][1], None), (406, [1.0, 2.0], 1), (407, [1.0, 2.0], 1), (408, [], 1),
        (409, [1e300 * x for x in rows[1][1]], 1), (410, [1e-300 * x for x in rows[1][1]], 1),
    ]
    return rows + odd


def test_vectors_match_all_pairs(spark):
    rows = vectors()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, node int, size string")
    unit = {}
    for key, vector, label in rows:
        if vector and label is not None and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            scaled = np.array(vector) / np.abs(vector).max()
            unit[key] = (label, scaled / np.sqrt((scaled * scaled).sum()))
    links = {k: set() for k, _, _ in rows}
    for a, (la, va) in unit.items():
        for b, (lb, vb) in unit.items():
            if a != b and la == lb and len(va) == len(vb) and va @ vb >= 0.93:
                links[a].add(b)
    first = reach(links, links)
    expected = sorted((k, len(links[k]), first[k], first[k] == k) for k in links)
    got = projection_dedup.near_vectors(table)
    assert sorted(tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()) == expected
    assert sum(r[1] for r in expected) > 500


def test_vectors_with_null_ids_and_none(spark):
    kind = "vec_id long, embedding array<float>, label int"
    one = spark.createDataFrame([(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)], kind)
    assert sorted((r.vec_id is None, r.n_links, r.component_id, r.kept) for r in projection_dedup.near_vectors(one).collect()) == [
        (False, 0, 3, True),
        (True, 0, None, True),
    ]
    assert projection_dedup.near_vectors(one.limit(0)).collect() == []


def test_collision_count_is_calibrated():
    least = projection_dedup.least_collisions(projection_dedup.PROJECTIONS, 1e-3)
    draw = np.random.default_rng(8)
    a = draw.standard_normal((4_000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = draw.standard_normal((4_000, 64))
    b -= (b * a).sum(axis=1)[:, None] * a
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1)[:, None]
    lines = projection_dedup.directions(64, projection_dedup.PROJECTIONS)
    width = np.sqrt(2 - 2 * 0.93)
    hits = (np.abs(a @ lines - b @ lines) <= width).sum(axis=1)
    assert (hits >= least).mean() > 0.996
    found = projection_dedup.collisions((a @ lines)[:50], (b @ lines)[:70], width)
    assert (found == (np.abs((a @ lines)[:50, None] - (b @ lines)[None, :70]) <= width).sum(axis=2)).all()
