"""Short lines and passages inside longer lines."""

import random
import re

import numpy as np
from brute import jaccard_links, reach, shingle_set, words

from ebbline.llm import paragraphs, shingles

PASSAGE = [
    "The committee met on the first Monday of the month to hear what the surveyors had found along the river bank.",
    "It was agreed by all who were present that the old bridge should stay open until the new one had been paid for.",
]
OTHER = [
    "Nobody in the valley could remember a spring in which so many of the orchards had flowered before the end of March.",
    "Letters from the capital took eleven days to arrive and were by then of interest only to the clerk who filed them.",
    "What the miller told his sons about the price of flour was repeated at every table between here and the coast.",
]


def kept_of(spark, rows):
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in paragraphs.drop_repeated(table).collect()}
    told = {r.doc_id: r for r in paragraphs.removals(table).collect()}
    assert {k: r.kept for k, r in told.items()} == kept
    return kept, told


def test_short_copies_and_passages_inside_lines(spark):
    whole = f"{OTHER[0]} {PASSAGE[0]} {PASSAGE[1]} {OTHER[1]}"
    near = PASSAGE[0].replace("river bank", "river's bed")
    rows = [
        (1, "Sign up for our weekly letter\n---\nown words of one"),
        (2, "Sign up for our weekly letter!\n---\nown words of two"),
        (3, whole),
        (4, f"Good. 日本。 {PASSAGE[0]} {PASSAGE[1]} {OTHER[2]}"),
        (5, f"first\n{near}\nlast"),
        (6, f"{PASSAGE[1]} {OTHER[1]}"),
    ]
    kept, told = kept_of(spark, rows)
    assert kept[1] == rows[0][1] and kept[2] == "---\nown words of two"
    assert kept[3] == whole
    assert kept[4] == f"Good. 日本。 {OTHER[2]}"
    assert kept[5] == "first\nlast"
    assert kept[6] == "" and (told[6].n_removed, told[6].n_cut) == (1, 0)
    assert told[4].n_cut == 2 and told[4].n_removed == 0


def test_the_first_of_a_piece_is_never_in_a_line_that_goes(spark):
    changed = PASSAGE[1].replace("old bridge should stay open", "stone ford must be closed")
    lines = [*OTHER, PASSAGE[0], *(f"{x[:-1]} and so on for the rest of that year." for x in OTHER)]
    rows = [(1, " ".join([*lines, PASSAGE[1]])), (2, " ".join([*lines, changed])), (3, f"{changed} Nothing else was said about it by any of those who had travelled there together.")]
    kept, told = kept_of(spark, rows)
    assert told[2].n_removed == 1 and kept[2] == ""
    assert changed in kept[3]


def test_rows_that_share_an_id_keep_their_own_lines(spark):
    rows = [
        (1, "a line that several of the texts here hold in just the same words"),
        (2, "a line that several of the texts here hold in just the same words\nown line of the one row"),
        (2, "entirely different words that only stand here\nand a second line of the other row"),
        (3, "a text that is there twice\nwith two lines"),
        (3, "a text that is there twice\nwith two lines"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = table.selectExpr("*", "7 AS cuts", "8 AS line_id", "9 AS line_positions", "10 AS text_key")
    found = paragraphs.drop_repeated(clashing)
    assert found.columns == clashing.columns
    kept = sorted((r.doc_id, r.text) for r in found.collect())
    assert kept == sorted([rows[0], (2, "own line of the one row"), *rows[2:]])


def test_very_many_lines_and_cuts_are_edited_in_one_pass():
    lines = [f"line {k}" for k in range(200_000)]
    cuts = [x for k in range(1, 200_000, 2) for x in (k, 0, 5)]
    assert paragraphs.edited("\n".join(lines), range(0, 200_000, 2), cuts) == "\n".join(str(k) for k in range(1, 200_000, 2))
    cuts = [x for k in range(0, 200_000, 2) for x in (0, k, 1)]
    assert paragraphs.edited("ab" * 100_000, [], cuts) == "b" * 100_000
    assert paragraphs.edited("abcdef\nx", [1], [0, 0, 1, 0, 3, 2]) == "bcf"


def test_pieces_match_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.where("doc_id is not null and text is not null").dropDuplicates(["doc_id"]).collect()]
    long = [(k, text) for k, text in rows if any(len(paragraphs.pieces_of(x)) > 1 for x in text.split("\n"))]
    rows += [(1_000 + k, f"Foreword of copy {k} that has some words of its own and is long enough.\n{text} {OTHER[k % 3]}") for k, text in long]
    rows += [(2_000 + k, f"{OTHER[k]} {PASSAGE[0]} {OTHER[(k + 1) % 3]}") for k in range(3)]
    table = spark_table(documents, rows)
    later = paragraphs.repeated_paragraphs(table).collect()
    whole = {(r.line_id, r.at) for r in later if r.start is None}
    units = {}
    for key, text in rows:
        for at, line in enumerate(text.split("\n")):
            starts = paragraphs.pieces_of(line)
            for x, y in zip(starts, [*starts[1:], len(line)]):
                if (key, at) not in whole and words(line[x:y]):
                    units[key, at, x] = shingle_set(line[x:y])
    first = reach(jaccard_links(units), units)
    expected = sorted((k, f) for k, f in first.items() if k != f and len(paragraphs.pieces_of(dict(rows)[k[0]].split("\n")[k[1]])) > 1)
    got = sorted(((r.line_id, r.at, r.start), (r.class_id, r.class_at)) for r in later if r.start is not None)
    assert got == [(k, f[:2]) for k, f in expected] and len(got) >= 5


def spark_table(like, rows):
    return like.sparkSession.createDataFrame(rows, "doc_id long, text string")


def test_flat_shingles_are_those_of_each_text():
    texts = ["", "one", "one two three four", "a b c d e", "a b a b a b a b a b", " ".join(map(str, range(300)))]
    flat, sizes = shingles.flat_shingles(*shingles.flat_words(texts))
    sets = [shingles.shingles(w) for w in shingles.word_hashes(texts)]
    assert sizes.tolist() == [len(s) for s in sets] and flat.tolist() == [x for s in sets for x in s.tolist()]
    assert shingles.flat_set_hashes(flat, sizes).tolist() == [shingles.set_hash(s) for s in sets]


def test_a_band_that_very_many_nodes_share_joins_them_all(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(f"{text} tail{k}", [{"at": 0, "start": 0, "length": 400, "node": k * 31 % 997, "extra": None}]) for k in range(997)]
    table = spark.createDataFrame(rows, "text string, places array<struct<at int, start int, length int, node long, extra long>>")
    links = paragraphs.band_links(table.repartition(16), 14, 4).collect()
    graph = {k: set() for k in range(997)}
    for a, b in links:
        graph[a].add(b)
        graph[b].add(a)
    assert set(reach(graph, graph).values()) == {0} and len(links) < 14 * 997


def test_distinct_shingles_are_the_sets():
    texts = ["", "one", "a b a b a b a b a b a b", " ".join(str(k % 17) for k in range(300)), " ".join(map(str, range(50)))]
    flat, sizes = shingles.flat_shingles(*shingles.flat_words(texts))
    found, many = shingles.flat_distinct(*shingles.flat_words(texts))
    assert many.tolist() == sizes.tolist() and found.tolist() != flat.tolist()
    for part, other in zip(np.split(found, np.cumsum(many)[:-1]), np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
        assert sorted(part.tolist()) == other.tolist()


def test_texts_are_signed_once_and_compared_from_their_words(documents, monkeypatch):
    signed, held = [], []
    links, written = paragraphs.band_links, paragraphs.written
    monkeypatch.setattr(paragraphs, "band_links", lambda *a: signed.append(a) or links(*a))
    monkeypatch.setattr(paragraphs, "written", lambda df, label: held.append((label, df.columns)) or written(df, label))
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(k, f"{text} tail{k}\n{text}. {text.upper()} tail{k}.") for k in range(5)]
    rows.append(rows[3])  # repeats id and text
    later = paragraphs.repeated_paragraphs(spark_table(documents, rows)).collect()
    assert len({(r.line_id, r.at) for r in later if r.class_id == 0}) == 9
    assert len(signed) == 1 and not any("shingles" in columns for _, columns in held)


def test_units_of_a_text_are_signed_as_each_alone():
    ends = ["", "One sentence of enough words to stand alone, it says. ", "日本語の文章がここにあります。続きの文章もここにありますよ。", "no sign at all "]
    lines = [" ".join([*OTHER, *PASSAGE]), PASSAGE[0], "ΟΔΟΣ ΟΔΟΣ. " * 12, "a b c d e f g", f"{'x' * 70}. {'y' * 70}. {OTHER[0]} {OTHER[1]}"]
    lines += ["".join(ends) * 3, f"{OTHER[0]} {OTHER[1]}　{OTHER[2]}", "。".join([*OTHER, "ende"]), "…” ".join(OTHER)]
    texts = ["\n".join(lines), "", "\n\n", *lines]
    units = paragraphs.Units(texts)
    cut = [texts[k].split("\n")[at][x : x + n] for k, (at, x, n, _, _) in zip(units.owners, units.places, strict=True)]
    flat, sizes = shingles.flat_distinct(*shingles.flat_words(cut))
    assert units.counts.tolist() == shingles.flat_words(cut)[1].tolist() and units.counts.max() > 60
    assert [x.tolist() for x in units.sets()] == [shingles.flat_set_hashes(flat, sizes).tolist(), sizes.tolist()]
    long = units.counts >= shingles.WIDTH
    assert (units.min_hashes(56)[long] == shingles.flat_min_hashes(flat, sizes, 56)[long]).all()
    assert {0, 1, 2} == set(units.places[long, 3].tolist())


def test_paragraph_ends_are_found_as_by_the_plain_pattern():
    plain = re.compile(r"""[.!?…]+["'”’»)\]]*\s+|[。！？]+["”’」』）]*\s*""")
    draw = random.Random(7)
    for _ in range(3_000):
        text = "".join(draw.choices(".!?…。！？\"'”)」 　ab", k=30))
        assert [m.span() for m in paragraphs._END.finditer(text)] == [m.span() for m in plain.finditer(text)]


def test_texts_are_signed_where_they_lie(documents, monkeypatch):
    held, shuffled = {}, paragraphs.written
    monkeypatch.setattr(paragraphs, "written", lambda df, label: held.update({label: df._jdf.queryExecution().toString()}) or shuffled(df, label))
    rows = [(k, f"{OTHER[k % 3]} tail{k}\n{OTHER[0]} {PASSAGE[0]} {k}") for k in range(9)]
    assert paragraphs.repeated_paragraphs(spark_table(documents, rows)).count() > 5
    assert "Join" not in held["band-links"] and "SortAggregate" not in held["paragraph-nodes"] + held["members"]
