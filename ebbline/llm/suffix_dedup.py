"""Byte strings that also start in an earlier document, by a depth-limited radix sort of suffixes.

Suffixes are ordered through ``length`` bytes only, by passes that each look at one more digit of the suffixes
that the passes before have left together; those equal through the last digit are the repeated strings.

The first digit is a run of ``GRAM`` bytes inside the string, chosen by its content: the one of least hash. Equal
strings have it at the same offset, so the first pass takes one entry for all neighbouring strings that share it,
about one in fifteen bytes, and moves five bytes of its hash. Entries alone with their digit are done. For the others
the stretch of bytes under all strings that share the run moves once, and the further digits are read from it in the
run's bucket: the whole stretch, since equal ones are repeated as a whole; its halves; at last string by string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import release, ship, written
from ebbline.llm.planes import planes, unplanes
from ebbline.llm.shingles import mixed, powers_to

LENGTH = 50
GRAM = 20
BATCH_BYTES = 4_000_000
#: Bytes of text whose runs share a bucket, about.
BUCKET_BYTES = 8_000_000
#: Largest size of a table of copied texts that is broadcast.
BROADCAST_BYTES = 32_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_HIGHEST = np.iinfo(np.int64).max


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, from which ``span_hashes`` takes any stretch's."""
    power, _ = powers_to(len(data) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])])


def span_hashes(prefix: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    _, inverse = powers_to(len(prefix))
    return mixed(mixed((prefix[stops] - prefix[starts]) * inverse[starts]) + (stops - starts).astype(np.uint64))


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over each run of ``width`` values, by doubling."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = best(values[:-step], values[step:])
        size += step
    return values


def anchors(prefix: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(place, hash, first, last)`` of every run of ``GRAM`` bytes that is the least in some string of ``length``
    bytes, and the first and last start of the strings that it is the least of. Ties are all taken."""
    n = len(prefix) - 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none, none
    at = np.arange(n - GRAM + 1)
    grams = span_hashes(prefix, at, at + GRAM)
    width = length - GRAM + 1
    least = _slide(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    place = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), width, np.maximum) == grams)
    change = np.flatnonzero(np.diff(least, prepend=least[:1] + np.uint64(1)) != 0)
    until = np.append(change[1:], len(least)) - 1
    low, high = np.searchsorted(place, change), np.searchsorted(place, until + width)
    many = high - low
    segment = np.repeat(np.arange(len(change)), many)
    which = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    own = grams[place[which]] == least[change[segment]]
    segment, which = segment[own], which[own]
    place = place[which]
    return place, grams[place], np.maximum(change[segment], place - width + 1), np.minimum(until[segment], place)


def first_pass(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """``(doc, places)``: in each document the runs that another document has too, by the low 40 bits of their hash
    inside a bucket of its high bits."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            docs, places, grams = (np.concatenate(x) for x in zip(*held, strict=True))
            bucket = (grams >> np.uint64(40)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=bucket[order][:1] + np.uint64(1)) != 0)
            rows = []
            for part in np.split(order, cuts[1:]) if len(order) else []:
                own = docs[part]
                steps = np.diff(own, prepend=np.int64(0)).view(np.uint64)
                rows.append((int(bucket[part[0]]), planes(steps, 8), planes(places[part].view(np.uint64), 5), planes(grams[part], 5)))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "docs", "places", "grams"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                place, grams, _, _ = anchors(prefix_hashes(data), length)
                held.append((np.full(len(place), doc, np.int64), place, grams))
                size += len(data)
                if size >= BATCH_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def shared(bucket: pd.DataFrame) -> pd.DataFrame:
        docs = np.concatenate([np.cumsum(unplanes(x, 8).view(np.int64)) for x in bucket.docs])
        places = np.concatenate([unplanes(x, 5) for x in bucket.places]).view(np.int64)
        grams = np.concatenate([unplanes(x, 5) for x in bucket.grams])
        order = np.argsort(grams, kind="stable")
        docs, places, grams = docs[order], places[order], grams[order]
        starts = np.flatnonzero(np.diff(grams, prepend=grams[:1] + np.uint64(1)) != 0)
        if not len(starts):
            return pd.DataFrame({"doc": [], "places": []})
        several = np.minimum.reduceat(docs, starts) < np.maximum.reduceat(docs, starts)
        kept = np.repeat(several, np.diff(starts, append=len(grams)))
        docs, places = docs[kept], places[kept]
        order = np.argsort(docs, kind="stable")
        docs, places = docs[order], places[order]
        cuts = np.flatnonzero(np.diff(docs)) + 1
        if not len(docs):
            return pd.DataFrame({"doc": [], "places": []})
        return pd.DataFrame({"doc": docs[np.append(0, cuts)], "places": [p.astype("<i8").tobytes() for p in np.split(places, cuts)]})

    sent = texts.select("doc", "text").mapInArrow(entries, "bucket int, docs binary, places binary, grams binary")
    return sent.groupBy("bucket").applyInPandas(shared, "doc long, places binary")


def _classes(rows: np.ndarray) -> np.ndarray:
    """A number for each row of bytes, equal for equal rows only: rows are grouped by hash and then compared."""
    n = len(rows)
    wide = np.zeros((n, -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    words = wide.view(np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(words.shape[1]):
        total = mixed(total * _STEP + words[:, k])
    order = np.argsort(total, kind="stable")
    first = np.ones(n, bool)
    first[1:] = total[order][1:] != total[order][:-1]
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(first) - 1
    if (words != words[order[first][number]]).any():  # two strings of one hash
        return np.unique(wide.view(f"V{wide.shape[1]}").ravel(), return_inverse=True)[1]
    return number


def _ends(number: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest document of each row's class."""
    ends = []
    for best, none in ((np.minimum, _HIGHEST), (np.maximum, -_HIGHEST - 1)):
        found = np.full(int(number.max()) + 1 if len(number) else 0, none, np.int64)
        best.at(found, number, docs)
        ends.append(found[number])
    return ends[0], ends[1]


def merged(docs: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of each document, those that overlap or touch as one."""
    if not len(docs):
        return docs, low, high
    order = np.lexsort((low, docs))
    docs, low, high = docs[order], low[order], high[order]
    number = np.cumsum(np.diff(docs, prepend=docs[:1]) != 0)
    step = int(high.max()) + 1
    reach = np.maximum.accumulate(number * step + high) - number * step  # of the document so far
    start = np.ones(len(docs), bool)
    start[1:] = (number[1:] != number[:-1]) | (low[1:] > reach[:-1])
    at = np.flatnonzero(start)
    return docs[at], low[at], reach[np.append(at[1:], len(docs)) - 1]


def repeats(docs: np.ndarray, places: np.ndarray, before: np.ndarray, after: np.ndarray, bytes_: np.ndarray, length: int):
    """``(doc, low, high)`` of what strings of earlier documents cover, for all stretches that share their runs.

    Whole stretches come first: of equal ones all but the first document's are done. The others go on if a half
    stretch, one of which every string covers, is in two documents, and then string by string, by their place to the
    run. Strings of a stretch overlap, so that what goes of it is in one piece."""
    shift = length - GRAM
    half = shift // 2
    reach = np.stack([before, after], axis=1).astype("<i4").view(np.uint8)
    least, _ = _ends(_classes(np.concatenate([bytes_, reach], axis=1)), docs)
    whole = docs > least
    out = [(docs[whole], (places - before)[whole], (places + after)[whole])]
    docs, places, before, after, bytes_ = (x[~whole] for x in (docs, places, before, after, bytes_))
    sides = []
    for start, stop, inside in ((shift - half, shift + GRAM, before >= half), (shift, length + half, after >= GRAM + half)):
        at = np.flatnonzero(inside)
        low, high = _ends(_classes(bytes_[at, start:stop]), docs[at])
        sides.append(np.zeros(len(docs), bool))
        sides[-1][at[low < high]] = True
    low, high = np.full(len(docs), _HIGHEST), np.full(len(docs), -1, np.int64)
    for k in range(shift + 1):  # strings that start k bytes before the run
        at = np.flatnonzero(sides[0 if k >= half else 1] & (before >= k) & (after >= length - k))
        earlier = at[docs[at] > _ends(_classes(bytes_[at, shift - k : shift - k + length]), docs[at])[0]]
        low[earlier] = places[earlier] - k
        high[earlier] = np.maximum(high[earlier], places[earlier] - k + length)
    some = high >= 0
    out.append((docs[some], low[some], high[some]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def second_pass(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """``(doc, low, high)`` of the stretches that earlier documents repeat, for ``texts(doc, text, named)``.

    The bytes under all strings that share a run named in ``named`` go to the run's bucket once, where every further
    digit is read from them. Of equal stretches a task sends those of its first document only; the others are known to
    be repeated."""
    width, shift = 2 * length - GRAM, length - GRAM

    def packed(bucket: int, cuts: bool, n: int, columns: list[bytes]) -> tuple:
        return bucket, cuts, n, pa.compress(b"".join(columns), "zstd", asbytes=True)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(doc: int, text: str, named: list[bytes]) -> tuple:
            data = np.frombuffer(text.encode(), np.uint8)
            place, grams, first, last = anchors(prefix_hashes(data), length)
            own = np.isin(place, np.concatenate([np.frombuffer(x, "<i8") for x in named]))
            place, grams, before = place[own], grams[own], (place - first)[own]
            after = (last + length)[own] - place
            around = np.concatenate([np.zeros(shift, np.uint8), data, np.zeros(length, np.uint8)])
            bytes_ = np.lib.stride_tricks.sliding_window_view(around, width)[place]
            column = np.arange(width)
            bytes_ = np.where((column >= (shift - before)[:, None]) & (column < (shift + after)[:, None]), bytes_, np.uint8(0))
            return np.full(len(place), doc, np.int64), place, before, after, bytes_, grams

        def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            docs, places, before, after, bytes_, grams = (np.concatenate(x) for x in zip(*held, strict=True))
            if not len(docs):
                return
            reach = np.stack([before, after], axis=1).astype("<i4").view(np.uint8)
            least, _ = _ends(_classes(np.concatenate([bytes_, reach], axis=1)), docs)
            later = docs > least
            cuts = merged(docs[later], (places - before)[later], (places + after)[later])
            rows = [packed(int(docs[0]) % buckets, True, len(cuts[0]), [c.astype("<i8").tobytes() for c in cuts])]
            bucket = ((grams >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            order = np.flatnonzero(~later)
            order = order[np.argsort(bucket[order], kind="stable")]
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                columns = [planes(np.diff(docs[part], prepend=np.int64(0)).view(np.uint64), 8)]
                columns += [planes(x[part].view(np.uint64), 4) for x in (places, before, after)]
                rows.append(packed(int(bucket[part[0]]), False, len(part), [*columns, bytes_[part].tobytes()]))
            kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "cuts", "n", "packed"])

        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(found(*row))
                size += len(row[1])
                if size >= BATCH_BYTES:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    def resolved(bucket: pd.DataFrame) -> pd.DataFrame:
        cuts, held = [], []
        for known, n, data in zip(bucket.cuts, bucket.n, bucket.packed, strict=True):
            data = pa.decompress(data, 24 * n if known else (20 + width) * n, "zstd", asbytes=True)
            if known:
                cuts.append(tuple(np.frombuffer(data, "<i8").reshape(3, n)))
                continue
            docs = np.cumsum(unplanes(data[: 8 * n], 8).view(np.int64))
            numbers = [unplanes(data[k * n : (k + 4) * n], 4).view(np.int64) for k in (8, 12, 16)]
            held.append((docs, *numbers, np.frombuffer(data, np.uint8, offset=20 * n).reshape(n, width)))
        if held:
            cuts.append(merged(*repeats(*(np.concatenate(x) for x in zip(*held, strict=True)), length)))
        doc, low, high = (np.concatenate(c) for c in zip(*cuts, strict=True))
        return pd.DataFrame({"doc": doc, "low": low, "high": high})

    sent = texts.select("doc", "text", "named").mapInArrow(entries, "bucket int, cuts boolean, n int, packed binary")
    return sent.groupBy("bucket").applyInPandas(resolved, "doc long, low int, high int")


def repeated_bytes(documents: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc, low, high)``: stretches of bytes [low, high) under strings that also start in a document with a smaller
    id. They may overlap or touch. Documents that copy an earlier one whole are not listed: see ``dedup``."""
    spark = documents.sparkSession
    ship(spark)
    texts = documents.select(documents[id_column].cast("long").alias("doc"), documents[text_column].alias("text"))
    texts = texts.where(F.col("doc").isNotNull() & (F.octet_length("text") >= length))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 64, size // BUCKET_BYTES)
    named = written(first_pass(texts, length, buckets), "suffix-first")
    release(spark)
    places = named.groupBy(F.col("doc").alias("d")).agg(F.collect_list("places").alias("named"))
    return second_pass(texts.join(places, F.col("doc") == F.col("d")), length, buckets)


def dedup(documents: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, spans, kept)`` per row: the bytes covered by strings of ``length`` bytes
    that also start in a document with a smaller id are cut. ``spans`` holds start and end of every maximal cut,
    ``kept`` the remaining bytes, which may end inside a character.

    All judging is done on the input. Null and empty texts and texts shorter than ``length`` lose nothing, nor do
    rows with a null id, which also cut nothing elsewhere. Rows that repeat an id never cut each other. Ids must be
    integers; other columns are not read. Texts that copy an earlier document whole are cut whole without further
    comparison; all others go through the passes of ``repeated_bytes``.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(documents[id_column].alias("id"), F.coalesce(documents[text_column], F.lit("")).alias("text"))
    key = F.sha2("text", 256)
    long_enough = F.col("id").isNotNull() & (F.octet_length("text") >= length)
    copies = rows.where(long_enough).groupBy(key.alias("key")).agg(F.min("id").alias("a"), F.max("id").alias("z"))
    copies = spread(written(copies.where("a < z").select("key", "a"), "copies"), 56)
    marked = rows.withColumn("text_key", key).join(copies, F.col("text_key") == F.col("key"), "left")
    copy = F.coalesce(long_enough & (F.col("id") > F.col("a")), F.lit(False))
    fresh = marked.where(~copy).select("id", "text")
    cuts = repeated_bytes(fresh, length, "id", "text").groupBy(F.col("doc").alias("d"))
    # Joined alike at every size: a table that grows with the texts is no table to broadcast.
    cuts = written(cuts.agg(F.collect_list(F.struct("low", "high")).alias("cuts")), "suffix-cuts").hint("merge")
    release(spark)
    wide = marked.select("id", "text", copy.alias("copy")).join(cuts, (F.col("id") == F.col("d")) & ~F.col("copy"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1_000):
                yield cut(batch.slice(k, 1_000))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        bounds = batch.column("cuts").fill_null([])
        lows, highs = (c.to_numpy(zero_copy_only=False) for c in bounds.flatten().flatten())
        many = bounds.value_lengths().to_numpy()
        ends = np.cumsum(many)
        starts = ends - many
        for k, (text, copy) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            data = text.encode()
            if copy:
                out.append((len(data), len(data), [[0, len(data)]], b""))
                continue
            low, high = lows[starts[k] : ends[k]], highs[starts[k] : ends[k]]
            inside = high <= len(data)
            change = np.bincount(low[inside], minlength=len(data) + 1) - np.bincount(high[inside], minlength=len(data) + 1)
            gone = np.cumsum(change[:-1]) > 0
            edge = np.diff(gone.view(np.int8), prepend=np.int8(0), append=np.int8(0))
            spans = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if len(spans) else data
            out.append((len(data), int(gone.sum()), spans.tolist(), kept))
        size, removed, spans, kept = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(size, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                pa.array(kept, pa.binary()),
            ],
            [id_column, "n_bytes", "n_removed", "n_spans", "spans", "kept"],
        )

    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary"
    return wide.select("id", "text", "copy", "cuts").mapInArrow(run, schema)


def spread(table: DataFrame, row_bytes: int) -> DataFrame:
    """``table`` for broadcast if its rows, of ``row_bytes`` each, are small together."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table
