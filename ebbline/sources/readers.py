"""Scans: event log as JSON or CSV, feature files by suffix, relational tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ebbline.schema import EVENT_LOG_SCHEMA


def read_json(
    spark: SparkSession, path: str, schema: StructType | None = EVENT_LOG_SCHEMA
) -> DataFrame:
    """JSON lines. The fixed schema spares the inference pass; ``schema=None`` infers instead."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column stays a string."""
    return spark.read.option("header", True).csv(path)


def load_features(
    spark: SparkSession,
    path: str,
    feature_cols: Sequence[str] | None = None,
    label: str = "label",
) -> DataFrame:
    """Feature file by suffix, reduced to ``feature_cols + [label]``, every column a double.

    CSV is read as strings and cast, so no inference pass is needed; values that are not numbers
    become null.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        df = read_csv(spark, path)
    elif suffix == "json":
        df = read_json(spark, path, schema=None)
    elif suffix == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported feature file {path!r}: use .csv, .json or .parquet")
    names = [*feature_cols, label] if feature_cols else df.columns
    return df.select(*(_double(df, name).alias(name) for name in names))


def _double(df: DataFrame, name: str):
    column = F.col(f"`{name}`")
    return column.try_cast("double") if df.schema[name].dataType.simpleString() == "string" else column.cast("double")


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan; a partition column splits it into parallel range reads."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if partition_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partition column needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, *, limit: int | None = None, **scan) -> DataFrame:
    """Relational table; ``limit`` and later filters are pushed to the database."""
    df = spark.read.format("jdbc").options(**jdbc_options(**scan)).load()
    return df if limit is None else df.limit(limit)
