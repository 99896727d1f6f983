"""Paragraphs that repeat across or inside documents, exactly or nearly."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import lines_of, pick, release, ship, small, written
from ebbline.llm.components import components
from ebbline.llm.planes import planes, unplanes
from ebbline.llm.shingles import WIDTH, flat_distinct, flat_min_hashes, flat_runs, flat_set_hashes, flat_shingles, flat_words, mixed
from ebbline.llm.verify import batches_of, verified_links

THRESHOLD = 0.8
#: Lines with fewer words are left alone: blank ones and those of signs only.
LEAST_WORDS = 1
RECALL = 0.999
ROWS = 4
#: Inside a line a paragraph begins at each sentence of at least so many UTF-8 bytes; shorter ones stay with the one
#: before. Where it begins depends on its own words only, so a passage is cut alike wherever it stands.
SENTENCE_BYTES = 60
# A set of first characters in front: the search skips to them.
_END = re.compile(r"""[.!?…。！？](?:(?<=[.!?…])[.!?…]*["'”’»)\]]*\s+|(?<=[。！？])[。！？]*["”’」』）]*\s*)""")
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: The bits of a node that candidates are found by.
NODE = np.uint64((1 << 40) - 1)
#: Band keys that a task packs at once, and that a bucket holds, about.
KEYS_AT_ONCE = 1_000_000
#: What a row of ``paragraph_places`` is: a line of several paragraphs, a line that is one, or one inside a line.
LONG, LINE, PIECE = range(3)


def bands_for(threshold: float, recall: float, rows: int = ROWS) -> int:
    """Bands of ``rows`` min-hashes needed for a pair at ``threshold`` to collide in one with ``recall``."""
    bands = 1
    while 1 - (1 - threshold**rows) ** bands < recall:
        bands += 1
    return bands


def pieces_of(line: str) -> list[int]:
    """Where the sentence-bounded paragraphs of a line begin; they follow one another without a gap."""
    ends = [m.end() for m in _END.finditer(line)]
    starts, ascii_only = [0], line.isascii()
    for start, stop in zip(ends, [*ends, len(line)][1:], strict=True):
        if start < stop and (stop - start if ascii_only else len(line[start:stop].encode())) >= SENTENCE_BYTES:
            starts.append(start)
    return starts


class Units:
    """Lines and the paragraphs inside them of some texts: ``owners`` and ``places`` (line, start, length, kind, line
    length) of each, its words' hashes and their number.

    Words are hashed once: those of a line are those of its paragraphs, unless one begins inside a word."""

    def __init__(self, texts: Sequence[str]):
        parts, owners, places, spans = [], [], [], []
        for k, text in enumerate(texts):
            for at, line in enumerate(text.split("\n")):
                starts, size, first = pieces_of(line), len(line), len(parts)
                owners += [k] * (len(starts) + (len(starts) > 1))
                if len(starts) == 1:
                    parts.append(line)
                    places.append((at, 0, size, LINE, size))
                    spans.append((first, first + 1))
                    continue
                apart = not all(line[x - 1] in " \t\r\f\v" for x in starts[1:])
                if apart:
                    parts.append(line)
                places.append((at, 0, size, LONG, size))
                spans.append((first, first + (1 if apart else len(starts))))
                for x, y in zip(starts, [*starts[1:], size], strict=True):
                    places.append((at, x, y - x, PIECE, size))
                    spans.append((len(parts), len(parts) + 1))
                    parts.append(line[x:y])
        self.owners, self.places = np.array(owners, np.int64), np.array(places, np.int32).reshape(-1, 5)
        self.low, self.high = np.array(spans, np.int64).reshape(-1, 2).T
        self.part_hashes, self.part_counts = flat_words(parts)
        self.ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.part_counts)])
        self.counts = self.ends[self.high] - self.ends[self.low]
        self.hashes = self.part_hashes[self._words(np.arange(len(self.counts)))]

    def _words(self, units: np.ndarray) -> np.ndarray:
        """Where the words of ``units`` lie, one behind the other."""
        counts = self.counts[units]
        return np.arange(counts.sum()) + np.repeat(self.ends[self.low[units]] - (np.cumsum(counts) - counts), counts)

    def sets(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and size of each unit's set of shingles."""
        flat, sizes = flat_distinct(self.hashes, self.counts)
        return flat_set_hashes(flat, sizes), sizes

    def min_hashes(self, n: int) -> np.ndarray:
        """``n`` min-hashes of each unit of five words or more. Those of a line are the least of its paragraphs' and
        those of the runs of words that begin in one and end in another."""
        enough = self.part_counts >= WIDTH
        signed = np.full((len(enough) + 1, n), 0xFFFFFFFF, np.uint32)
        held = np.repeat(enough, self.part_counts)
        found, owner = flat_runs(self.part_hashes[held], self.part_counts[enough], WIDTH)
        signed[:-1][enough] = flat_min_hashes(found, np.bincount(owner, minlength=int(enough.sum())), n)
        out = signed[self.low]
        long = np.flatnonzero((self.high - self.low > 1) & (self.counts >= WIDTH))
        if len(long):
            pairs = np.stack([self.low[long], self.high[long]], axis=1).reshape(-1)
            words = self._words(long)
            found, owner = flat_runs(self.part_hashes[words], self.counts[long], WIDTH)
            part = np.repeat(np.arange(len(enough)), self.part_counts)[words]
            first = np.arange(len(found)) + owner * (WIDTH - 1)
            across = part[first] != part[first + WIDTH - 1]
            between = flat_min_hashes(found[across], np.bincount(owner[across], minlength=len(long)), n)
            out[long] = np.minimum(np.minimum.reduceat(signed, pairs, axis=0)[::2], between)
        return out


def least_set(threshold: float) -> float:
    """The size from which a set can reach ``threshold`` with another one."""
    return math.ceil(threshold / (1 - threshold) - 1e-9) if threshold < 1 else math.inf


def paragraph_places(documents: DataFrame, id_column: str, text_column: str, least_words: int, threshold: float) -> DataFrame:
    """``(doc, text_key, at, start, length, kind, line_length, node, signed)``: for each long enough line, and each
    paragraph inside one, its place, the hash of its shingle set, and whether the set is large enough to reach the
    threshold with any other."""
    ship(documents.sparkSession)
    names = ["doc", "text_key", "at", "start", "length", "kind", "line_length", "node", "signed"]
    least = least_set(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(2).to_pylist()]
            for part in batches_of(texts):
                units = Units(texts[part])
                hashes, sizes = units.sets()
                kept = np.flatnonzero(units.counts >= least_words)
                own = pa.array(units.owners[kept] + part.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(own),
                        batch.column(1).take(own),
                        *(pa.array(np.ascontiguousarray(column)) for column in units.places[kept].T),
                        pa.array(hashes[kept]),
                        pa.array(sizes[kept] >= least),
                    ],
                    names,
                )

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(documents[id_column], text_key(documents[text_column]), documents[text_column])
    return rows.where(documents[id_column].isNotNull()).mapInArrow(
        run, f"doc {kind}, text_key long, at int, start int, length int, kind int, line_length int, node long, signed boolean"
    )


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def units_in(texts: Sequence[str], places: Sequence[Sequence[dict]]) -> Iterator[tuple[list[str], list[dict]]]:
    """The wanted units of many texts, some texts at a time."""
    for part in batches_of(texts):
        units, found = [], []
        for text, wanted in zip(texts[part], places[part], strict=True):
            lines = text.split("\n")
            units += [lines[p["at"]][p["start"] : p["start"] + p["length"]] for p in wanted]
            found += wanted
        yield units, found


def with_places(documents: DataFrame, nodes: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(text, places)``: each text that holds the first unit of one of ``nodes(first, ...)``, with these units'
    places and what else ``nodes`` has. The list of a row is bounded by its text."""
    place = [F.col(f"first.{name}").alias(name) for name in ("at", "start", "length")]
    others = [name for name in nodes.columns if name != "first"]
    wanted = nodes.groupBy(F.col("first.doc").alias("of_doc"), F.col("first.text_key").alias("of_key"))
    wanted = wanted.agg(F.collect_list(F.struct(*place, *others)).alias("places"))
    texts = documents.select(documents[id_column].alias("id"), text_key(documents[text_column]).alias("key"), documents[text_column].alias("text"))
    return texts.join(wanted, (F.col("id") == F.col("of_doc")) & (F.col("key") == F.col("of_key"))).select("text", "places")


def _sorted_planes(values: np.ndarray) -> bytes:
    """The steps, modulo 2^40, between ascending values of 40 bits, byte by byte: the high bytes hardly change."""
    return planes(np.diff(values, prepend=np.uint64(0)), 5)


def band_links(texts: DataFrame, bands: int, rows: int, buckets: int = 64, least_words: int = LEAST_WORDS, least: float = 0) -> DataFrame:
    """``(a, b)``: links that join all nodes of ``texts(text, places)`` that share a band of ``rows`` min-hashes, by the
    low 40 bits of a node (``NODE``) and of a key inside its bucket: what falls together by chance is one more candidate.
    Without ``places`` all lines and pieces of ``least_words`` words and ``least`` shingles are signed where the texts lie.

    A task hangs the nodes that share a band among the texts it holds under the least of them and sends only that
    one on, so a band that very many nodes share sends few rows to the bucket that holds it. What is shuffled are
    packed lists, about nine bytes for a key and its node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[tuple]) -> pa.RecordBatch:
            key, node = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(key)
            key, node = key[order], node[order]
            start = np.ones(len(key), bool)
            start[1:] = key[1:] != key[:-1]
            at = np.flatnonzero(start)
            least = np.minimum.reduceat(node, at)
            hung = node != (root := np.repeat(least, np.diff(at, append=len(key))))
            links = np.unique(np.stack([root[hung], node[hung]], axis=1), axis=0)
            key, node = key[at], least
            bucket = ((key >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
            low = (key >> np.uint64(max(0, 25 - buckets.bit_length()))) & NODE  # ascends inside a bucket, from 0 again once at most
            packed = []
            if len(links):
                packed.append((int(bucket[0]), True, len(links), links.T.tobytes()))
            for part in np.split(np.arange(len(key)), np.flatnonzero(np.diff(bucket)) + 1):
                packed.append((int(bucket[part[0]]), False, len(part), _sorted_planes(low[part]) + planes(node[part], 5)))
            columns = list(zip(*packed, strict=True))
            columns[3] = [pa.compress(x, "zstd", asbytes=True) for x in columns[3]]
            kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        def signed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            all_texts = [text or "" for text in batch.column(0).to_pylist()]
            if batch.num_columns == 1:
                for part in batches_of(all_texts):
                    units = Units(all_texts[part])
                    node, sizes = units.sets()
                    kept = np.flatnonzero((units.counts >= max(least_words, WIDTH)) & (sizes >= least))
                    kept = kept[np.unique(node[kept], return_index=True)[1]]
                    yield node[kept], units.min_hashes(bands * rows)[kept]
                return
            for units, places in units_in(all_texts, batch.column(1).to_pylist()):
                flat, sizes = flat_distinct(*flat_words(units))
                yield np.array([p["node"] for p in places], np.int64), flat_min_hashes(flat, sizes, bands * rows)

        held, size = [], 0
        for batch in batches:
            for node, hashes in signed(batch):
                hashes = hashes.astype(np.uint64).reshape(-1, bands, rows)
                keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(hashes), 1))
                for k in range(rows):
                    keys = mixed(keys * _STEP + hashes[:, :, k])
                held.append((keys.reshape(-1), np.repeat(node.view(np.uint64) & NODE, bands)))
                size += len(node) * bands
                if size >= KEYS_AT_ONCE:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    def stars(bucket: pd.DataFrame) -> pd.DataFrame:
        links, keys, nodes = [np.zeros((2, 0), np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for known, n, data in zip(bucket.known, bucket.n, bucket.packed, strict=True):
            data = pa.decompress(data, (16 if known else 10) * n, "zstd", asbytes=True)
            if known:
                links.append(np.frombuffer(data, np.uint64).reshape(2, n))
            else:
                keys.append(np.cumsum(unplanes(data[: 5 * n], 5), dtype=np.uint64) & NODE)
                nodes.append(unplanes(data[5 * n :], 5))
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.argsort(key)
        key, node = key[order], node[order]
        at = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
        many = np.diff(at, append=len(key))
        root = np.repeat(np.minimum.reduceat(node, at), many) if len(key) else node
        hung = node != root
        links.append(np.stack([root[hung], node[hung]]))
        found = np.unique(np.concatenate(links, axis=1), axis=1).astype(np.int64)
        return pd.DataFrame({"a": found[0], "b": found[1]})

    names = ["bucket", "known", "n", "packed"]
    sent = texts.mapInArrow(run, "bucket int, known boolean, n int, packed binary")
    return sent.groupBy("bucket").applyInPandas(stars, "a long, b long")


def unit_sets(texts: DataFrame) -> DataFrame:
    """``(node, component, weight, n_shingles, unit)`` of the nodes of ``texts(text, places)``: how large a node's set
    is, and the text that ``sets_of`` takes it from, which is less than half as large."""
    names = ["node", "component", "weight", "n_shingles", "unit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_texts = [text or "" for text in batch.column(0).to_pylist()]
            for units, places in units_in(all_texts, batch.column(1).to_pylist()):
                _, sizes = flat_distinct(*flat_words(units))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p["node"] for p in places], pa.int64()),
                        pa.array([p["component"] for p in places], pa.int64()),
                        pa.array(np.ones(len(places), np.int64)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(units, pa.string()),
                    ],
                    names,
                )

    return texts.mapInArrow(run, "node long, component long, weight long, n_shingles long, unit string")


def sets_of(units: list[str]) -> list[bytes]:
    """The sorted shingle set of each unit."""
    flat, sizes = flat_shingles(*flat_words(units))
    ends = np.cumsum(sizes)
    return [flat[y - n : y].tobytes() for y, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def candidate_sets(
    found: DataFrame, documents: DataFrame, bands: int, id_column: str, text_column: str, least_words: int, threshold: float
) -> DataFrame:
    """``unit_sets`` of all nodes of ``found``, a written table, that collide in a band with another one. Lines and
    pieces are signed together, where their texts lie."""
    spark = documents.sparkSession
    ship(spark)
    keys = found.where("signed").count() * bands
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 64, keys // KEYS_AT_ONCE)
    texts = documents.where(documents[id_column].isNotNull()).select(documents[text_column])
    links = written(band_links(texts, bands, ROWS, buckets, least_words, least_set(threshold)), "band-links")
    release(spark)
    candidates = written(components(links), "components")
    release(spark)
    low = F.col("node").bitwiseAND(int(NODE))
    members = found.where("signed").join(small(candidates.withColumnRenamed("node", "n")), low == F.col("n"))
    # Any place of a node will do. One per node, column by column: a least struct would have to be sorted for.
    members = members.select("node", "component", "doc", "text_key", "at", "start", "length").dropDuplicates(["node"])
    members = written(members.select(F.struct("doc", "text_key", "at", "start", "length").alias("first"), "node", "component"), "members")
    release(spark)
    sets = written(unit_sets(with_places(documents, members, id_column, text_column)), "unit-sets")
    release(spark)
    if sets.count() > members.count():  # of rows that repeat id and text
        sets = written(sets.dropDuplicates(["node"]), "unit-sets")
    return sets


def later_copies(found: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Rows of ``found``, part of a written table, for every paragraph of a cluster but the first, with ``least``: the
    document, text, line and start of the first. ``sets``: the candidates, of which those in ``found`` are compared."""
    nodes = written(found.groupBy("node").agg(F.count("*").alias("copies")), "paragraph-nodes")
    own = sets.join(nodes.select(F.col("node").alias("k")), F.col("node") == F.col("k"), "left_semi")
    _, links = verified_links(own, threshold, "unit", sets_of)
    release(found.sparkSession)
    classes = components(links)
    named = nodes.join(classes.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    named = named.where("copies > 1 or component is not null")
    named = written(named.select(F.col("node").alias("k"), F.coalesce("component", "node").alias("class")), "classes")
    # Only paragraphs of a cluster are put in order.
    held = written(found.join(small(named), F.col("node") == F.col("k")).drop("k"), "clustered")
    release(found.sparkSession)
    place = F.struct("doc", "text_key", "at", "start")
    heads = written(held.groupBy(F.col("class").alias("head")).agg(F.min(place).alias("least")), "heads")
    later = held.join(small(heads), F.col("class") == F.col("head"))
    return later.where(place > F.col("least")).drop("head")


def repeated_paragraphs(
    documents: DataFrame,
    threshold: float = THRESHOLD,
    least_words: int = LEAST_WORDS,
    recall: float = RECALL,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``(line_id, text_key, at, class_id, class_at, start, length, line_length)`` for every paragraph of a cluster
    but the first: its document and 0-based line, and those of the first, by document id, line and place in it.
    ``start`` is null for a whole line, else it and ``length`` tell the characters of the line that repeat.

    Paragraphs are lines of at least ``least_words`` words, then sentence-bounded pieces of those lines that stay
    (``pieces_of``), so that what keeps a cluster's first piece is never a line that goes. Those with one set of
    five-word shingles are copies and go on as one node; nodes that collide in a band of min-hashes are candidates, lines
    and pieces together, all pairs of a candidate component are verified by exact Jaccard similarity in blocks, and verified links are
    joined to clusters. Documents with a null id, null and empty texts have no paragraphs here. Rows that share an
    id but not their text are documents of their own, in the order of ``text_key``, a hash of the text; rows that
    repeat both are one document.
    """
    bands = bands_for(threshold, recall)
    found = written(paragraph_places(documents, id_column, text_column, least_words, threshold), "paragraphs")
    sets = candidate_sets(found, documents, bands, id_column, text_column, least_words, threshold)
    lines = written(later_copies(found.where(F.col("kind") != PIECE), sets, threshold), "later-lines")
    gone = lines.select(*(F.col(n).alias(f"gone_{n}") for n in ("doc", "text_key", "at"))).distinct()
    stay = [F.col(n) == F.col(f"gone_{n}") for n in ("doc", "text_key", "at")]
    pieces = written(found.where(F.col("kind") != LONG).join(gone, stay, "left_anti"), "pieces")
    pieces = written(later_copies(pieces, sets, threshold), "later-pieces")
    release(documents.sparkSession)
    inside = F.when(F.col("kind") == PIECE, F.col("start"))
    return lines.unionByName(pieces).select(
        F.col("doc").alias("line_id"),
        "text_key",
        "at",
        F.col("least.doc").alias("class_id"),
        F.col("least.at").alias("class_at"),
        inside.alias("start"),
        "length",
        "line_length",
    )


def removed_places(later: DataFrame) -> DataFrame:
    """``(line_id, line_key, line_positions, cuts, firsts)`` per text: lines that go, line, start and length of each
    run that goes inside others, one behind the other, and the documents of the firsts. A line all of whose pieces go
    is a line that goes."""
    per = later.groupBy("line_id", "text_key", "at").agg(
        F.max(F.col("start").isNull()).alias("whole"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.struct("at", "start", "length"))).alias("cuts"),
        F.max("line_length").alias("line_length"),
        F.collect_set("class_id").alias("firsts"),
    )
    cut = F.aggregate("cuts", F.lit(0), lambda n, c: n + c["length"])
    per = per.withColumn("whole", F.col("whole") | (cut == F.col("line_length")))
    cuts = F.sort_array(F.flatten(F.collect_list(F.when(~F.col("whole"), F.col("cuts")))))
    return per.groupBy("line_id", F.col("text_key").alias("line_key")).agg(
        F.array_sort(F.collect_set(F.when(F.col("whole"), F.col("at")))).alias("line_positions"),
        F.flatten(F.transform(cuts, lambda c: F.array(c["at"], c["start"], c["length"]))).alias("cuts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("firsts")))).alias("firsts"),
    )


def edited(text: str, positions: Sequence[int], cuts: Sequence[int]) -> str:
    """``text`` without the lines at ``positions`` and the runs ``cuts``: line, start and length of each, ascending."""
    lines, gone = text.split("\n"), set(positions)
    parts, before = {}, {}
    for at, start, length in zip(cuts[::3], cuts[1::3], cuts[2::3], strict=True):
        parts.setdefault(at, []).append(lines[at][before.get(at, 0) : start])
        before[at] = start + length
    for at, stop in before.items():
        lines[at] = "".join([*parts[at], lines[at][stop:]])
    return "\n".join(line for at, line in enumerate(lines) if at not in gone)


def kept_text(text: Column, removed: DataFrame) -> Column:
    """What ``line_positions`` and ``cuts`` of ``removed`` leave of a text; null where nothing goes."""

    @F.pandas_udf("string")
    def kept(texts: pd.Series, positions: pd.Series, cuts: pd.Series) -> pd.Series:
        found = zip(texts, positions, cuts, strict=True)
        return pd.Series([None if t is None else edited(t, p.tolist(), c.tolist()) for t, p, c in found], dtype=object)

    return kept(F.when(removed["line_positions"].isNotNull(), text), removed["line_positions"], removed["cuts"])


def _with_removed(documents: DataFrame, removed: DataFrame, id_column: str, text_column: str) -> DataFrame:
    same = (documents[id_column] == removed["line_id"]) & (text_key(documents[text_column]) == removed["line_key"])
    return documents.join(removed, same, "left")


def drop_repeated(documents: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` without all paragraphs of a cluster but its first. No row goes; other columns stay."""
    later = repeated_paragraphs(documents, threshold, id_column=id_column, text_column=text_column)
    gone = removed_places(later)
    wide = _with_removed(documents, gone, id_column, text_column)
    text = F.coalesce(kept_text(documents[text_column], gone), documents[text_column])
    return wide.select(*(text.alias(n) if n == text_column else documents[n] for n in documents.columns))


def removals(documents: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_lines, n_removed, removed, first_docs, n_cut, kept)`` per row: how many lines, how many of them go,
    which, the documents that keep the first of each cluster, how many pieces go out of other lines, and the text
    that is left."""
    documents = pick(documents, [id_column, text_column])
    later = repeated_paragraphs(documents, threshold, id_column=id_column, text_column=text_column)
    gone = removed_places(later)
    wide = _with_removed(documents, gone, id_column, text_column)
    text = documents[text_column]
    removed = F.coalesce("line_positions", F.array().cast("array<int>"))
    return wide.select(
        documents[id_column],
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        removed.alias("removed"),
        F.coalesce("firsts", F.array()).alias("first_docs"),
        F.coalesce(F.size("cuts") / 3, F.lit(0)).cast("long").alias("n_cut"),
        F.coalesce(kept_text(text, gone), text, F.lit("")).alias("kept"),
    )
