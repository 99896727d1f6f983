"""Similarity join of documents by banded min-hashes and exact Jaccard verification.

Bands have one fixed length, the longest that meets the recall: sets that share a longer run share these too, so a
sorted trie whose prefixes are shortened down to it would name the same candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import ship, small, written
from ebbline.llm.components import components
from ebbline.llm.shingles import min_hashes, set_hash, shingles, word_hashes
from ebbline.llm.verify import batches_of, candidate_components, verified_links

THRESHOLD = 0.8
RECALL = 0.999
#: Bands, and the most min-hashes that one may have.
TREES = 32
DEPTH = 10


def matched_depth(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix of which a pair of similarity ``threshold`` shares one of ``trees`` with ``recall``."""
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    raise ValueError("more trees are needed for this recall")


def shingle_sets(documents: DataFrame, id_column: str, text_column: str, trees: int, length: int) -> DataFrame:
    """``(id, n_shingles, node, prefixes)``: the set's size and hash, and its bands, for every text."""
    ship(documents.sparkSession)
    names = [id_column, "n_shingles", "node", "prefixes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for part in batches_of(texts):
                sets = [shingles(words) for words in word_hashes(texts[part])]
                signed = iter(min_hashes([s for s in sets if len(s)], trees * length))
                prefixes = [next(signed).astype("<u4").tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.start, part.stop - part.start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_hash(s) for s in sets], pa.int64()),
                        pa.array(prefixes, pa.binary()),
                    ],
                    names,
                )

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(documents[id_column], documents[text_column])
    return rows.mapInArrow(run, f"`{id_column}` {kind}, n_shingles long, node long, prefixes binary")


def sets_of(texts: DataFrame) -> DataFrame:
    """``(node, component, weight, n_shingles, shingles)`` from rows that have a ``text`` in place of the set.

    Rows whose text has another set than the node's are left out: their id is repeated."""
    ship(texts.sparkSession)
    names = ["node", "component", "weight", "n_shingles", "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_texts = [text or "" for text in batch.column(3).to_pylist()]
            for part in batches_of(all_texts):
                sets = [shingles(words) for words in word_hashes(all_texts[part])]
                columns = [c.slice(part.start, part.stop - part.start) for c in batch.columns[:3]]
                sizes = pa.array([len(s) for s in sets], pa.int64())
                columns += [sizes, pa.array([s.tobytes() for s in sets], pa.binary())]
                same = pa.array([set_hash(s) == n for s, n in zip(sets, columns[0].to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays(columns, names).filter(same)

    rows = texts.select("node", "component", "weight", "text")
    return rows.mapInArrow(run, "node long, component long, weight long, n_shingles long, shingles binary")


def similarity_classes(
    documents: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    trees: int = TREES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(id, n_links, class_id)`` for every row: how many other rows reach ``threshold`` in Jaccard similarity of
    distinct five-word shingles, and the smallest id that links lead to, its own included.

    Rows with one shingle set are copies and go on as one node. Every node has ``trees`` bands of the
    greatest length at which a pair at the threshold shares one with ``recall`` (``matched_depth``). Nodes that share a band, directly or through others, form a candidate component; inside it all pairs of
    compatible size are verified exactly, block by block. Texts of fewer than five words are one shingle; texts
    without words link with nothing, nor do rows with a null id, which come back with 0 links and a null class.
    Rows that repeat an id count as copies of it.
    """
    length = matched_depth(threshold, recall, trees)
    rows = written(shingle_sets(documents, id_column, text_column, trees, length), "signatures")
    keyed = rows.where(F.col(id_column).isNotNull() & (F.col("n_shingles") > 0))
    nodes = keyed.groupBy("node").agg(
        F.min(id_column).alias("first"), F.count("*").alias("weight"), F.max("prefixes").alias("prefixes")
    )
    nodes = written(nodes, "nodes")
    cut = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(t, F.substring("prefixes", t * 4 * length + 1, F.lit(4 * length))))
    candidates = written(candidate_components(nodes.select("node", F.explode(cut).alias("key"))), "components")
    members = nodes.join(small(candidates.withColumnRenamed("node", "n")), F.col("node") == F.col("n"))
    members = written(members.select("node", "component", "weight", F.col("first").alias("of_id")), "members")
    texts = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    texts = texts.join(small(members), F.col("id") == F.col("of_id"))
    counts, links = verified_links(sets_of(texts).dropDuplicates(["node"]), threshold)
    classes = components(links)
    named = nodes.select("node", "first", "weight").join(
        counts.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left"
    ).join(classes.withColumnRenamed("node", "m"), F.col("node") == F.col("m"), "left")
    named = written(named.select(F.col("node").alias("k"), "first", "weight", "n_links", "component"), "classes")
    heads = named.where("component is not null").groupBy(F.col("component").alias("head")).agg(F.min("first").alias("least"))
    named = named.join(heads, F.col("component") == F.col("head"), "left").select(
        "k", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "first").alias("class_id")
    )
    joined = rows.join(named, (F.col("node") == F.col("k")) & (F.col("n_shingles") > 0) & F.col(id_column).isNotNull(), "left")
    return joined.select(
        id_column, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("class_id", id_column).alias("class_id")
    )


def keep_first(documents: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` with the row of the smallest id of each class only. Columns stay as they are; rows with a null
    id stay; rows that repeat a kept id stay."""
    classes = similarity_classes(documents, threshold, id_column=id_column, text_column=text_column)
    gone = classes.where(F.col(id_column) != F.col("class_id")).select(F.col(id_column).alias("gone_id")).distinct()
    gone = small(written(gone, "copies"))
    return documents.join(gone, documents[id_column] == F.col("gone_id"), "left_anti")
