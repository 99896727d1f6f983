"""Exact order statistics by radix, without a global sort and without sampled bounds.

A number becomes a 64-bit integer of the same order, and rows are counted by its leading bits, 16 more at each level.
Ranks are selected by refining only the prefixes that hold them. Running totals refine only the prefixes with too many
rows, so that a window never orders more than ``group_rows`` rows, however the values are spread.

``by`` groups are meant to be table columns or labels, so few by construction; the count of a level has at most
65,536 rows per group and refined prefix.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, IntegralType, TimestampType

from ebbline.functions.columns import double_order
from ebbline.sources.scratch import materialize

#: Bits below the prefix at each level.
SHIFTS = (48, 32, 16, 0)
GROUP_ROWS = 1 << 16


def order_image(df: DataFrame, value: str) -> Column:
    """A long of the same order as the column."""
    kind, column = df.schema[value].dataType, F.col(f"`{value}`")
    if isinstance(kind, IntegralType):
        return column.cast("long")
    if isinstance(kind, (FloatType, DoubleType)):
        return double_order(column)
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("long")
    raise TypeError(f"{value!r} is {kind.simpleString()}; ranks need a number, a date or a timestamp")


def _prefix(shift: int) -> Column:
    return F.shiftright("_key", shift)


def _running(by: Sequence[str], order: str):
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def select_ranks(
    values: DataFrame, ranks: DataFrame, by: Sequence[str] = (), group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``(by.., rank, value)``: the value at each wanted zero-based rank.

    ``values`` holds (by.., value) rows with their count ``n``, ``ranks`` the wanted (by.., rank) rows, few of them.
    Ranks beyond the rows have no row in the result. Reads ``values`` at most once per level, so pass a written table.
    """
    keyed = values.withColumn("_key", order_image(values, "value"))
    wanted = ranks.distinct().select(*by, "rank", F.col("rank").alias("_left"), F.lit(0).cast("long").alias("_parent"))
    wanted = materialize(wanted, "ranks")
    scope, shift = keyed.withColumn("_parent", F.lit(0).cast("long")), SHIFTS[0]
    while True:
        counts = scope.groupBy(*by, "_parent", _prefix(shift).alias("_digit")).agg(
            F.sum("n").alias("_n"),
            F.count("*").alias("_rows"),
            F.min("value").alias("value"),
            (F.min("_key") < F.max("_key")).alias("_several"),
        )
        counts = counts.withColumn("_end", F.sum("_n").over(_running([*by, "_parent"], "_digit")))
        start = F.col("_end") - F.col("_n")
        found = wanted.join(counts, [*by, "_parent"]).filter((F.col("_left") >= start) & (F.col("_left") < F.col("_end")))
        wanted = materialize(
            found.select(*by, "rank", (F.col("_left") - start).alias("_left"), F.col("_digit").alias("_parent"), "value", "_rows", "_several"),
            "ranks",
        )
        most = wanted.filter("_several").agg(F.max("_rows")).first()[0]
        if most is None:
            return wanted.select(*by, "rank", "value")
        # At most one row per wanted rank.
        prefixes = F.broadcast(wanted.select(*by, "_parent").distinct())
        scope = keyed.withColumn("_parent", _prefix(shift)).join(prefixes, [*by, "_parent"], "left_semi")
        wanted = wanted.select(*by, "rank", "_left", "_parent")
        # Few rows are ordered at once, many by their next bits.
        shift = 0 if most <= group_rows else SHIFTS[SHIFTS.index(shift) + 1]


def _groups(
    keyed: DataFrame, totals: Sequence[str], by: Sequence[str], group_rows: int
) -> tuple[DataFrame, list[int]]:
    """``(by.., _shift, _group, _before_<total>..)``: prefixes of at most ``group_rows`` rows that cover all rows, with
    the sums over all earlier rows; and the shifts that occur."""
    scope = keyed.withColumn("_parent", F.lit(0).cast("long"))
    carried = [F.lit(0).cast("long").alias(f"_base_{t}") for t in totals]
    scope = scope.select("*", *carried)
    found, used = None, []
    for shift in SHIFTS:
        sums = scope.groupBy(*by, "_parent", _prefix(shift).alias("_group")).agg(
            F.count("*").alias("_rows"),
            *(F.sum(t).alias(f"_in_{t}") for t in totals),
            *(F.max(f"_base_{t}").alias(f"_base_{t}") for t in totals),
        )
        inside = _running([*by, "_parent"], "_group")
        before = [
            (F.sum(f"_in_{t}").over(inside) - F.col(f"_in_{t}") + F.col(f"_base_{t}")).alias(f"_before_{t}") for t in totals
        ]
        level = materialize(sums.select(*by, F.lit(shift).alias("_shift"), "_group", "_rows", *before), "groups")
        heavy = level.filter(F.col("_rows") > (group_rows if shift else F.lit(1 << 62)))
        light = level.filter(F.col("_rows") <= (group_rows if shift else F.lit(1 << 62))).drop("_rows")
        found, used = light if found is None else found.unionByName(light), [*used, shift]
        if heavy.isEmpty():
            break
        parents = heavy.select(
            *by, F.col("_group").alias("_parent"), *(F.col(f"_before_{t}").alias(f"_base_{t}") for t in totals)
        )
        scope = keyed.withColumn("_parent", _prefix(shift)).join(parents, [*by, "_parent"])
    return found, used


def grouped(
    df: DataFrame, value: str, totals: Sequence[str] = (), by: Sequence[str] = (), group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``df`` with ``(_shift, _group)``, groups of neighbouring values of at most ``group_rows`` rows each, and with
    ``_before_<total>``, the sums over all earlier groups."""
    keyed = df.withColumn("_key", order_image(df, value))
    groups, used = _groups(keyed, totals, by, group_rows)
    at = F.array(*(F.struct(F.lit(s).alias("s"), _prefix(s).alias("g")) for s in used))
    # A row has one prefix per level, one of which is a group.
    rows = keyed.withColumn("_at", F.explode(at)).withColumns({"_shift": F.col("_at.s"), "_group": F.col("_at.g")})
    return rows.drop("_at", "_key").join(groups, [*by, "_shift", "_group"])


def running_totals(
    df: DataFrame, value: str, totals: Mapping[str, str], by: Sequence[str] = (), group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Inclusive running sums in ascending ``value``; ``totals`` maps whole-numbered input to output columns.

    ``value`` must be unique within ``by``: aggregate ties away first, which also flattens values that are very
    frequent. Reads ``df`` more than once, so pass a written table if it is costly.
    """
    rows = grouped(df, value, list(totals), by, group_rows)
    inside = _running([*by, "_shift", "_group"], f"`{value}`")
    return rows.select(
        *(F.col(f"`{c}`") for c in df.columns),
        *((F.sum(source).over(inside) + F.col(f"_before_{source}")).alias(name) for source, name in totals.items()),
    )


def exact_quantiles(
    values: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = (), group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` weighted by ``n``, one row per ``by`` group.

    ``values`` holds distinct (by.., value) rows with their count ``n``; pass a written table.
    """
    last = F.sum("n") - 1
    exact = [F.struct(F.lit(name).alias("name"), (last * p).alias("exact")) for name, p in probabilities.items()]
    targets = values.groupBy(*by).agg(F.array(*exact).alias("t")).select(*by, F.inline("t"))
    targets = targets.withColumn("ends", F.array(F.floor("exact"), F.ceil("exact")))
    targets = materialize(targets, "quantile-ranks")
    picked = select_ranks(values, targets.select(*by, F.explode("ends").alias("rank")), by, group_rows)
    ends = targets.withColumn("rank", F.explode("ends")).join(picked, [*by, "rank"])
    low, high = (F.max(F.when(F.col("rank") == F.col("ends")[i], F.col("value"))) for i in (0, 1))
    part = F.max(F.col("exact") - F.col("ends")[0])
    found = ends.groupBy(*by, "name").agg((low + (high - low) * part).alias("quantile"))
    return found.groupBy(*by).agg(
        *(F.max(F.when(F.col("name") == name, F.col("quantile"))).alias(name) for name in probabilities)
    )
