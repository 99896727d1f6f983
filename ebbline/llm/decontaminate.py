"""Benchmark passages in documents: SimHash windows, a multi-index on fingerprint blocks, exact verification.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.llm.common import small, written

THRESHOLD = 0.8
WIDTH = 5
#: Words from one window's start to the next.
STRIDE = 4
#: Window sizes in strides. An item is looked for by windows of the largest size that fits it at any alignment.
SIZES = (1, 2, 3, 4, 6, 8, 12)
#: Fingerprints within this Hamming distance are found with certainty: of four 16-bit blocks one differs in at most
#: RADIUS // 4 = 1 bit, and each item is indexed under every block value within one bit of its own.
RADIUS = 7
BLOCKS = 4
#: Items with fewer words than fill a window at each alignment are not looked for.
LEAST_WORDS = 2 * STRIDE - 1
_ONES = 0x0101010101010101


def words_of(text: str | Column) -> Column:
    """Words in lower case: runs of letters and digits. A null text has none."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def lane_sums(words: list[Column]) -> list[Column]:
    """Eight packed counters of eight byte lanes: how many of ``words`` have each of 64 hash bits set."""
    hashes = [F.when(w.isNotNull(), F.xxhash64(w)).otherwise(F.lit(0).cast("long")) for w in words]
    mask = F.lit(_ONES)
    return [reduce(Column.__add__, [F.shiftrightunsigned(h, k).bitwiseAND(mask) for h in hashes]) for k in range(8)]


def fingerprint(sums: list[Column], words: int) -> Column:
    """The 64-bit SimHash of a window of ``words`` words: a bit is set where more than half of them have it."""
    raised = F.lit(_ONES * (63 - words // 2))
    bits = [F.shiftrightunsigned((s + raised).bitwiseAND(F.lit(_ONES << 6)), 6) for s in sums]
    return reduce(Column.bitwiseOR, [F.shiftleft(bit, k) for k, bit in enumerate(bits)])


def document_windows(documents: DataFrame, sizes: list[int]) -> DataFrame:
    """``(doc, b, size, fp)``: fingerprints of all windows of each size, at stride ``b`` as their last."""
    texts = documents.where(F.col("doc").isNotNull()).repartition("doc")
    rows = texts.select("doc", words_of("text").alias("words"))
    last = F.floor((F.size("words") - 1) / STRIDE).cast("int")
    rows = rows.where(F.size("words") > 0).select("doc", "words", F.explode(F.sequence(F.lit(0), last)).alias("b"))
    sums = lane_sums([F.get("words", F.col("b") * STRIDE + k) for k in range(STRIDE)])
    rows = rows.select("doc", "b", *(s.alias(f"l{k}") for k, s in enumerate(sums)))
    each = []
    for size in sizes:
        frame = Window.partitionBy("doc").orderBy("b").rowsBetween(1 - size, 0)
        each.append(fingerprint([F.sum(f"l{k}").over(frame) for k in range(8)], size * STRIDE).alias(f"f{size}"))
    rows = rows.select("doc", "b", *each)
    windows = F.array(*(F.struct(F.lit(size).alias("size"), F.col(f"f{size}").alias("fp")) for size in sizes))
    return rows.select("doc", "b", F.explode(windows).alias("w")).where("b + 1 >= w.size").select("doc", "b", "w.size", "w.fp")


def unbroken(n: Column) -> Column:
    """Words in a row that any window of similarity 0.8 shares with an item of ``n`` words whose shingles no other item
    holds. A changed place inside the item costs at least four of its shingles and adds five, so there are at most a
    fortieth as many as shingles; what 0.8 leaves besides may be cut off the ends."""
    m = n - (WIDTH - 1)
    k = F.floor(m / 40)
    ends = F.floor((m - 40 * k) / 5)
    return F.ceil((m - 4 * k - ends) / (k + 1)) + (WIDTH - 1)


def largest(words: Column) -> Column:
    """The largest window size that fits into ``words`` words at any alignment."""
    return F.array_max(F.filter(F.array(*map(F.lit, SIZES)), lambda s: s * STRIDE + STRIDE - 1 <= words))


def item_windows(items: DataFrame) -> DataFrame:
    """``(item, offset, size, near, same, fp)``: fingerprints of each item's windows.

    ``near``: windows of the largest size that fits, from each alignment of a stride, at each multiple of that size
    and at the item's end, so that every word is in one. ``same``: windows short enough to lie in what any match
    leaves ``unbroken``, from every word, for documents that hold them word by word."""
    rows = items.withColumn("n", F.size("words")).where(F.col("n") >= LEAST_WORDS)
    rows = rows.withColumns({"fit": largest(F.col("n")), "piece": largest(unbroken(F.col("n")))})
    rows = rows.select("item", "n", "fit", "piece", F.posexplode("words").alias("offset", "word"))
    sums = [lane.alias(f"l{k}") for k, lane in enumerate(lane_sums([F.col("word")]))]
    rows = rows.select("item", "n", "fit", "piece", "offset", *sums)
    each = []
    for size in SIZES:
        frame = Window.partitionBy("item").orderBy("offset").rowsBetween(0, size * STRIDE - 1)
        each.append(fingerprint([F.sum(f"l{k}").over(frame) for k in range(8)], size * STRIDE).alias(f"f{size}"))
    rows = rows.select("item", "n", "fit", "piece", "offset", *each)
    windows = F.array(*(F.struct(F.lit(size).alias("size"), F.col(f"f{size}").alias("fp")) for size in SIZES))
    rows = rows.select("item", "n", "fit", "piece", "offset", F.explode(windows).alias("w"))
    rows = rows.select("item", "n", "fit", "piece", "offset", "w.*")
    last = F.col("n") - F.col("fit") * STRIDE - (STRIDE - 1)
    beside = F.pmod(F.col("offset"), F.col("fit") * STRIDE)
    placed = (F.col("offset") >= last) | (beside < STRIDE)
    rows = rows.withColumn("near", (F.col("size") == F.col("fit")) & placed).withColumn("same", F.col("size") == F.col("piece"))
    rows = rows.where((F.col("near") | F.col("same")) & (F.col("offset") + F.col("size") * STRIDE <= F.col("n")))
    return rows.select("item", "offset", "size", "near", "same", "fp")


def block_keys(size: Column, fp: Column, flips: bool) -> Column:
    """Keys of the four 16-bit blocks of a fingerprint; with ``flips`` also those one bit away."""
    changes = [0, *(1 << k for k in range(16))] if flips else [0]
    keys = []
    for j in range(BLOCKS):
        block = F.shiftrightunsigned(fp, 16 * j).bitwiseAND(F.lit(0xFFFF).cast("long"))
        place = size.cast("long") * (BLOCKS << 16) + (j << 16)
        keys += [place + block.bitwiseXOR(F.lit(c).cast("long")) for c in changes]
    return F.array(*keys)


def whole_key(size: Column, fp: Column) -> Column:
    """The key of a fingerprint that is to be met bit by bit."""
    return F.array(F.xxhash64(size, fp))


def candidates(documents: DataFrame, items: DataFrame) -> DataFrame | None:
    """``(doc, item, start)``: where an item would start so that its window's fingerprint is within the radius, or is
    the same for windows that are looked for word by word. None if no item is long enough."""
    index = written(item_windows(items), "item-windows")
    used = index.groupBy("size").agg(F.max("near").alias("near"), F.max("same").alias("same")).collect()
    sizes = sorted(row["size"] for row in used)
    if not sizes:
        return None
    none = F.array().cast("array<long>")

    def keys(near: Column, same: Column, size: Column, fp: Column, flips: bool) -> Column:
        return F.concat(F.when(near, block_keys(size, fp, flips)).otherwise(none), F.when(same, whole_key(size, fp)).otherwise(none))

    index = index.withColumnRenamed("fp", "item_fp").withColumnRenamed("size", "item_size")
    wanted = keys(F.col("near"), F.col("same"), F.col("item_size"), F.col("item_fp"), True)
    index = index.select("item", "offset", "item_fp", F.explode(wanted).alias("item_key"))
    index = small(written(index, "item-index"))
    windows = document_windows(documents, sizes)
    of = F.col("size")
    near, same = (of.isin([row["size"] for row in used if row[kind]]) for kind in ("near", "same"))
    probes = windows.withColumn("key", F.explode(keys(near, same, of, F.col("fp"), False)))
    near = (F.col("key") == F.col("item_key")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    start = (F.col("b") + 1 - F.col("size")) * STRIDE - F.col("offset")
    return probes.join(index, near).select("doc", "item", start.alias("start")).distinct()


def shingles(words: Column) -> Column:
    """Hashes of all runs of ``WIDTH`` words; none where there are fewer."""
    last = F.size(words) - WIDTH
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, WIDTH)))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<long>"))


def once(value: Column) -> Column:
    """``value`` as a generated column: it is computed once per row however often it is used."""
    return F.explode(F.array(value))


def leaks(
    documents: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``(id, item, similarity)`` for each document and item whose best window reaches ``threshold``.

    Windows of item size slide over every document in strides; a stride's alignment costs nothing, since an item is
    indexed at each of them. A window within ``RADIUS`` bits of an item's fingerprint is compared at its place and
    one word to either side by weighted Jaccard similarity of five-word shingles: multiplicities, times one over
    the number of items that hold the shingle.

    Null ids, null and empty texts, and items of fewer than ``LEAST_WORDS`` words match nothing; rows that repeat a
    document's id are compared each and give one result; of items that repeat an id the greatest text counts.
    The item index is broadcast only if it is counted to be small.
    """
    documents = documents.select(documents[id_column].alias("doc"), documents[text_column].alias("text"))
    items = items.select(items[item_column].alias("item"), items[item_text_column].alias("text"))
    items = items.where("item is not null and text is not null").groupBy("item").agg(F.max("text").alias("text"))
    items = written(items.select("item", words_of("text").alias("words")), "items")
    found = candidates(documents, items)
    names = [F.col("doc").alias(id_column), F.col("item").alias(item_column), "similarity"]
    if found is None:
        none = documents.limit(0).withColumn("similarity", F.lit(0.0))
        kind = items.schema["item"].dataType
        return none.withColumn("item", F.lit(None).cast(kind)).select(*names)
    around = F.explode(F.sequence(F.col("start") - 1, F.col("start") + 1)).alias("at")
    found = written(found.select(F.col("doc").alias("of_doc"), "item", around).distinct(), "leak-candidates")

    counted = items.select("item", F.size("words").alias("n"), F.explode(shingles(F.col("words"))).alias("shingle"))
    counted = counted.groupBy("item", "n", "shingle").agg(F.count("*").alias("c"))
    weight = counted.groupBy(F.col("shingle").alias("s")).agg((1 / F.count("*")).alias("weight"))
    counted = counted.join(weight, F.col("shingle") == F.col("s")).select("item", "n", "shingle", "c", "weight")
    counted = written(counted, "item-shingles")
    mass = F.col("weight") * F.col("c")
    whole = counted.groupBy(F.col("item").alias("of_item")).agg(
        F.max("n").alias("n"), F.sum(mass).alias("whole"), F.map_from_entries(F.collect_list(F.struct("shingle", mass))).alias("masses")
    )
    whole = small(written(whole, "item-weights"))

    places = found.groupBy("of_doc").agg(F.collect_list(F.struct("item", "at")).alias("places"))
    places = small(written(places, "places"))
    rows = documents.join(places, F.col("doc") == F.col("of_doc"))
    rows = rows.select("doc", F.xxhash64("text").alias("row"), "places", once(words_of("text")).alias("words"))
    rows = rows.select("doc", "row", "places", F.size("words").alias("size"), once(shingles(F.col("words"))).alias("all"))
    rows = rows.select("doc", "row", "size", "all", F.explode("places").alias("place"))
    rows = rows.join(whole, F.col("place.item") == F.col("of_item"))
    low, high = F.greatest("place.at", F.lit(0)), F.least(F.col("place.at") + F.col("n"), F.col("size"))
    window = F.slice("all", low + 1, F.greatest(high - low - (WIDTH - 1), F.lit(0)))
    rows = rows.select("doc", "row", F.col("of_item").alias("item"), "place.at", "whole", "masses", once(window).alias("window"))
    # What the window can share at most: the item's whole mass of every shingle that it has at all.
    most = F.aggregate(F.array_intersect("window", F.map_keys("masses")), F.lit(0.0), lambda t, s: t + F.element_at("masses", s))
    rows = rows.where(most >= (threshold - 1e-9) * F.col("whole"))
    rows = rows.select("doc", "item", "at", "row", "whole", F.explode("window").alias("shingle"))
    rows = rows.groupBy("doc", "item", "at", "row", "whole", "shingle").agg(F.count("*").alias("m"))
    own = small(counted.select(F.col("item").alias("of_item"), F.col("shingle").alias("s"), "c", "weight"))
    rows = rows.join(own, (F.col("item") == F.col("of_item")) & (F.col("shingle") == F.col("s")), "left")
    rows = rows.groupBy("doc", "item", "at", "row", "whole").agg(
        F.sum(F.coalesce(F.col("weight") * F.least("c", "m"), F.lit(0.0))).alias("both"),
        F.sum(F.coalesce("weight", F.lit(1.0)) * F.col("m")).alias("window"),
    )
    similarity = F.col("both") / (F.col("whole") + F.col("window") - F.col("both"))
    best = rows.groupBy("doc", "item").agg(F.max(similarity).alias("similarity"))
    return best.where(F.col("similarity") >= threshold - 1e-9).select(*names)


def drop_leaking(
    documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``documents`` without those that hold a benchmark item. Columns stay; rows with a null id stay."""
    found = leaks(documents, items, threshold, id_column, text_column)
    gone = small(written(found.select(F.col(id_column).alias("gone_id")).distinct(), "leaking"))
    return documents.join(gone, documents[id_column] == F.col("gone_id"), "left_anti")
