"""Column profiles from sketches kept per part of a table, so that a new part is added without rereading the others.

A part is whatever the caller names, a day or a file. For each part and column there is one row with its rows, its
nulls and a distinct-count sketch of fixed size; rows of parts merge into the profile of any set of parts.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's buckets: 4,096 buckets of about a byte, estimates within ``ERROR`` twice out of three times.
LOG_BUCKETS = 12
ERROR = 0.83 / 2 ** (LOG_BUCKETS / 2)


def part_sketches(df: DataFrame, part: Column) -> DataFrame:
    """``(part, column, n_rows, n_null, sketch)`` for every column, in one aggregation with fixed-width buffers.

    Values are counted by their text; null is no value.
    """

    def cell(name: str) -> Column:
        value = F.col(f"`{name}`")
        return F.struct(
            F.lit(name).alias("column"),
            F.count("*").alias("n_rows"),
            F.count_if(value.isNull()).alias("n_null"),
            F.hll_sketch_agg(value.cast("string"), F.lit(LOG_BUCKETS)).alias("sketch"),
        )

    cells = F.array(*(cell(c) for c in df.columns)).alias("cells")
    return df.groupBy(part.cast("string").alias("part")).agg(cells).select("part", F.inline("cells"))


def known_parts(df: DataFrame, path: str) -> list[str | None]:
    """Parts that the store at ``path`` has; none if there is no store yet."""
    try:
        return [r.part for r in df.sparkSession.read.parquet(path).select("part").distinct().collect()]  # one row per part
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def add_parts(df: DataFrame, part: Column, path: str) -> DataFrame:
    """Append the sketches of the parts of ``df`` that the store at ``path`` has not, and return the whole store.

    The filter on ``part`` reaches a scan that is partitioned by it, so known parts are not read. A part is final: rows
    that are added to it later are not seen. Null is a part of its own.
    """
    name, known = part.cast("string"), known_parts(df, path)
    named = [p for p in known if p is not None]
    new = ~name.isin(named) if named else F.lit(True)
    fresh = df.filter(F.coalesce(new, F.lit(None not in known)))
    part_sketches(fresh, part).write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def merged_profile(store: DataFrame) -> DataFrame:
    """``(column, n_rows, null_count, unique_count)`` over all parts of ``store``; ``unique_count`` is an estimate."""
    distinct = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return store.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("null_count"), distinct.alias("unique_count")
    )
