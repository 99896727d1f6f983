"""Line, benchmark and toxicity filters, and the pipeline, against plain Python and planted rows."""

import random
import re
import time
import zlib
from pathlib import Path

import corpus_pipeline
import pytest
from brute import classes
from compare import connect, differences
from pyspark.sql import functions as F

from ebbline.llm import decontaminate, site_lines, toxicity
from ebbline.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    connection = connect(SF_DIR)
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == []


def boilerplate(rows, ratio, least):
    pages, lines = {}, {}
    for _, host, text in rows:
        if host is None:
            continue
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip() for x in (text or "").split("\n")} - {""}:
            lines[host, line] = lines.get((host, line), 0) + 1
    bad = {k for k, n in lines.items() if n >= least and n > ratio * pages[k[0]]}
    return {
        i: t if t is None or not any((h, x.strip()) in bad for x in t.split("\n")) else "\n".join(x for x in t.split("\n") if (h, x.strip()) not in bad)
        for i, h, t in rows
    }


def test_lines_match_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for k in range(300):
        host = draw.choice(["hot", "hot", "a", "b", None, ""])
        common = ["Home | About ", "  Home | About", "Cookies", "", "rare line", f"own {k}", f"own {k % 40}"]
        rows.append((k, host, draw.choice([None, ""] + ["\n".join(draw.sample(common, 4)) for _ in range(8)])))
    table = spark.createDataFrame([(*r, 9, "y") for r in rows], "doc_id long, source string, text string, n long, host string")
    got = site_lines.drop_boilerplate(table, "source", ratio=0.2, least_pages=4)
    assert got.columns == table.columns
    assert {r.doc_id: r.text for r in got.collect()} == boilerplate(rows, 0.2, 4)
    assert site_lines.drop_boilerplate(table.limit(0), "source").collect() == []


def test_rows_that_share_an_id_keep_their_own_lines(spark):
    rows = [(1, "s", "menu\nown 1"), (1, "s", "precious\nmenu"), (1, "s", "precious\nmenu"), (1, "t", "precious\nmenu")]
    rows += [(k, "s", f"menu\nown {k}") for k in range(2, 9)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = site_lines.drop_boilerplate(table, "source", ratio=0.5, least_pages=5).collect()
    expected = [(1, "s", "own 1"), (1, "s", "precious"), (1, "s", "precious"), (1, "t", "precious\nmenu")]
    assert sorted((r.doc_id, r.source, r.text) for r in got) == expected + [(k, "s", f"own {k}") for k in range(2, 9)]
    pages = table.select(
        table.doc_id.alias("page_id"), F.concat(F.lit("http://h"), "source", F.lit("/x")).alias("url"), F.col("text").alias("html"), F.lit(1).alias("line_key")
    )
    kept = site_lines.page_boilerplate(pages, ratio=0.5, least_pages=5).collect()
    assert sorted(r.text for r in kept if r.page_id == 1) == ["own 1", "precious", "precious", "precious\nmenu"]
    assert site_lines.page_boilerplate(pages.limit(0)).collect() == []


def test_very_long_texts_lose_lines_in_one_pass(spark):
    lines = [f"menu {k}" if k % 2 else f"own {k}" for k in range(200_000)]
    rows = [(1, "s", "\n".join(lines))] + [(k, "s", "\n".join(f"menu {j}" for j in range(1, 200_000, 2))) for k in range(2, 6)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    start = time.time()
    got = {r.doc_id: r.text for r in site_lines.drop_boilerplate(table, "source", ratio=0.5, least_pages=5).collect()}
    assert time.time() - start < 60
    assert got == {1: "\n".join(line for line in lines if line.startswith("own"))} | {k: "" for k in range(2, 6)}


def test_lines_of_null_ids_and_small_hosts(spark):
    rows = [(None, "s", "x"), (1, "s", "x"), (2, "s", "x"), (3, "t", "x")]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = site_lines.drop_boilerplate(table, "source", ratio=0.1, least_pages=3).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "x"), (1, ""), (2, ""), (3, "x")]


def test_page_text(spark):
    html = "<html><style>p{}</style><!-- c --><p>One <b>bold</b> word</p><script>x<y</script><div> Two<br>Three </div>"
    row = spark.createDataFrame([(1, "HTTP://Host.Example:80/a", html), (2, "no url", None)], "page_id long, url string, html string")
    got = {r.page_id: r for r in site_lines.page_boilerplate(row).collect()}
    assert (got[1].host, got[1].text, got[1].n_lines, got[1].n_dropped) == ("host.example", "One bold word\nTwo\nThree", 3, 0)
    assert (got[2].host, got[2].text, got[2].n_lines) == (None, "", 0)


def similarity(window, item, holders):
    def bag(words):
        width = min(5, len(words))
        out = {}
        for k in range(len(words) - width + 1):
            out[tuple(words[k : k + width])] = out.get(tuple(words[k : k + width]), 0) + 1
        return out

    a, b = bag(window), bag(item)
    weight = {s: 1 / holders[s] for s in b}
    both = sum(weight[s] * min(a.get(s, 0), b[s]) for s in b)
    return both / (sum(weight[s] * b[s] for s in b) + sum(weight.get(s, 1) * n for s, n in a.items()) - both)


def test_leaks_match_all_windows(spark, documents):
    draw = random.Random(9)
    vocabulary = [f"v{k}" for k in range(300)]
    items = [(k, [draw.choice(vocabulary) for _ in range(draw.choice([8, 13, 22, 37, 58, 130]))]) for k in range(12)]
    items.append((12, items[0][1][:6]))
    items.append((13, list(items[3][1])))
    docs = []
    for k in range(150):
        body = [draw.choice(vocabulary) for _ in range(draw.randrange(0, 200))]
        if k % 2:
            passage = list(draw.choice(items)[1])
            if k % 3 == 0 and len(passage) > 50:
                passage[draw.randrange(len(passage))] = "edited"
            at = draw.randrange(len(body) + 1)
            body[at:at] = passage
        docs.append((k, " ".join(w.upper() if draw.random() < 0.1 else w for w in body).replace(" v1 ", ", v1\n")))
    item_rows = [(k, ". ".join(w)) for k, w in items] + [(14, None), (None, "x y z"), (15, "")]
    table = spark.createDataFrame([(*d, 1, "q", 3) for d in docs] + [(None, docs[1][1], 1, "q", 3), (900, None, 1, "q", 3)], "doc_id long, text string, item long, words string, size int")
    benchmark = spark.createDataFrame(item_rows, "item_id long, text string")
    holders = {}
    for _, words in items:
        for s in {tuple(words[k : k + 5]) for k in range(len(words) - 4)}:
            holders[s] = holders.get(s, 0) + 1
    expected = {}
    for key, text in docs:
        words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
        for item, own in items:
            if len(own) >= decontaminate.LEAST_WORDS:
                found = max((similarity(words[max(0, k) : k + len(own)], own, holders) for k in range(-3, len(words)) if words[max(0, k) : k + len(own)]), default=0)
                if found >= 0.8:
                    expected[key, item] = round(found, 6)
    got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in decontaminate.leaks(table, benchmark).collect()}
    exact = {k for k, v in expected.items() if v == 1}
    assert exact and exact <= set(got) <= set(expected)
    assert len(got) >= 0.9 * len(expected)
    assert all(got[k] <= expected[k] + 1e-6 for k in got)
    kept = decontaminate.drop_leaking(table, benchmark)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in docs} - {k for k, _ in got} | {None, 900}
    assert decontaminate.leaks(table.limit(0), benchmark).collect() == []
    assert decontaminate.leaks(table, benchmark.limit(0)).collect() == []
    assert decontaminate.leaks(documents, benchmark).columns == ["doc_id", "item_id", "similarity"]


def test_all_fingerprints_within_the_radius_meet(spark):
    """Any two fingerprints at most RADIUS bits apart share a key of the multi-index."""
    from pyspark.sql import functions as F

    draw = random.Random(6)
    rows = []
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randrange(decontaminate.RADIUS + 1)):
            b ^= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    table = spark.createDataFrame(rows, "a long, b long").select(
        decontaminate.block_keys(F.lit(8), F.col("a"), False).alias("a"), decontaminate.block_keys(F.lit(8), F.col("b"), True).alias("b")
    )
    assert table.where(F.arrays_overlap("a", "b")).count() == 300


def test_no_python_in_decontamination(spark):
    source = Path(decontaminate.__file__).read_text()
    assert not re.search(r"udf|pandas|InArrow|\.rdd", source)


@pytest.fixture(scope="module")
def toxic_rows():
    draw = random.Random(12)
    vocabulary = ["the", "of", "and", "letzte", "être", "word", "plain", "text", "lorem", "ipsum", "naïve", "日本"]
    rows = []
    for k in range(900):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(5, 60))]
        toxic = k % 6 == 0
        if toxic:
            for word in ("idiotic", "scumbag"):
                words[draw.randrange(len(words))] = word
        rows.append((k, " ".join(words), "en", int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark, toxic_rows):
    documents = spark.createDataFrame([r[:3] for r in toxic_rows] + [(None, "x", "en"), (5_000, None, "en"), (5_001, "", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1, r[3]) for r in toxic_rows] + [(None, 1, 1), (3, 1, None), (77_777, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents, labels, ~toxicity.held_out())
    scored = documents.select("doc_id", toxicity.held_out().alias("held_out"), toxicity.score(documents, model).alias("score")).collect()
    truth = {r[0]: r[3] for r in toxic_rows}
    held = [r for r in scored if r.doc_id in truth and r.held_out]
    assert len(held) > 100 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored if r.doc_id is not None)
    right = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in held]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r.score <= 1 for r in scored)
    assert {r.doc_id: r.score < 0.5 for r in scored if r.doc_id in (5_000, 5_001)} == {5_000: True, 5_001: True}
    kept = toxicity.drop_toxic(documents, labels)
    assert kept.columns == documents.columns and 700 < kept.count() < 790


def test_toxicity_does_not_read_held_out_labels(spark, toxic_rows):
    documents = spark.createDataFrame([r[:3] for r in toxic_rows], "doc_id long, text string, lang string")
    kind = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(r[0], 1, r[3]) for r in toxic_rows], kind)
    flipped = spark.createDataFrame([(r[0], 1, 1 - r[3] if zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[3]) for r in toxic_rows], kind)
    one, two = (toxicity.fit(documents, x, ~toxicity.held_out()) for x in (labels, flipped))
    assert abs(one.weights - two.weights).max() < 1e-9 and abs(one.intercept - two.intercept) < 1e-9


def test_no_task_of_the_toxicity_fit_chains_python_steps(spark, toxic_rows, monkeypatch):
    plans, written = {}, toxicity.written
    monkeypatch.setattr(toxicity, "written", lambda df, label: plans.update({label: df._jdf.queryExecution().toString()}) or written(df, label))
    documents = spark.createDataFrame([r[:3] for r in toxic_rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1, r[3]) for r in toxic_rows], "doc_id long, quality int, toxic int")
    toxicity.fit(documents, labels, ~toxicity.held_out())
    plan = plans["toxicity-vectors"].split("== Physical Plan ==")[1]
    assert len(re.findall(r"BatchEvalPython|ArrowEvalPython|MapInArrow", plan)) == 1


def test_toxicity_without_labels(spark, documents, no_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(documents, labels).count() == documents.count()
    assert toxicity.drop_toxic(no_documents, labels).collect() == []
    only = spark.createDataFrame([(k, 1, 1) for k in range(20)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(documents, only, ~toxicity.held_out()).score("any") == pytest.approx(1)


def test_pipeline_stages(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), name)
        assert docs.columns == documents.columns
        seen[name] = (before, docs)
    before, after = seen["line_dedup"]
    expected = boilerplate([(r.doc_id, r.source, r.text) for r in before.collect()], site_lines.RATIO, site_lines.LEAST_PAGES)
    assert {r.doc_id: r.text for r in after.collect()} == expected
    before, after = seen["ngram_join"]
    heads = {c for _, _, c in classes([(r.doc_id, r.text) for r in before.collect()])}
    assert {r.doc_id for r in after.collect()} == heads
    before, after = seen["decontamination"]
    norm = lambda t: " " + " ".join(w for w in re.split(r"[\W_]+", t.lower()) if w) + " "
    items = [norm(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaking = {r.doc_id for r in before.collect() if any(i in norm(r.text) for i in items)}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == leaking
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.count() == docs.count() and last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5
