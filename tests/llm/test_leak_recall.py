"""Benchmark items whose start, middle or end was changed."""

import random

import pytest
from test_filters import similarity

from ebbline.llm import decontaminate


def edited(words, kind, draw):
    """``words`` with as many of them replaced as leave about 0.8, or both ends cut off, or a word put in."""
    n = max(1, (len(words) - 4) // 9)
    new = [f"new{draw.randrange(10**9)}" for _ in range(n)]
    if kind == "start":
        return new + words[n:]
    if kind == "end":
        return words[:-n] + new
    if kind == "ends":
        return words[n : len(words) - n + 1]
    at = len(words) // 2 + draw.randrange(-4, 5)
    return words[:at] + new[:1] + words[at + (kind == "middle") :]


@pytest.mark.parametrize("kind", ["start", "middle", "end", "ends", "inserted"])
def test_recall_of_edits(spark, kind):
    draw = random.Random(3)
    items = {k: [f"w{draw.randrange(3_000)}" for _ in range(draw.randrange(43, 99))] for k in range(120)}
    rows, expected = [], set()
    for k, own in items.items():
        around = [[] if kind == "ends" else [f"d{draw.randrange(3_000)}" for _ in range(draw.randrange(40))] for _ in range(2)]
        words = around[0] + edited(own, kind, draw) + around[1]
        holders = dict.fromkeys((tuple(own[i : i + 5]) for i in range(len(own) - 4)), 1)
        if max(similarity(words[max(0, i) : i + len(own)], own, holders) for i in range(-len(own) // 4, len(words))) >= 0.8:
            expected.add((k, k))
        rows.append((k, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(table, benchmark).collect()}
    print(kind, len(got & expected), "of", len(expected))
    assert len(expected) > 50
    assert got == expected
