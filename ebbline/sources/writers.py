"""Sinks: JSON, CSV and Parquet export, appended CSV, temp views."""

from pyspark.sql import DataFrame


def export(df: DataFrame, path: str, file_type: str, single_file: bool = False) -> None:
    """Overwrite ``path``. ``single_file`` funnels the output through one task: small results only."""
    if file_type not in ("csv", "json", "parquet"):
        raise ValueError(f"unsupported file type {file_type!r}: use csv, json or parquet")
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    if file_type == "csv":
        writer = writer.option("header", True)
    writer.format(file_type).save(path)


def append_csv(df: DataFrame, path: str, drop: tuple[str, ...] = ("userId",)) -> None:
    """Append distinct rows as CSV without header, identifying columns left out.

    Duplicates are removed before the columns are dropped: two users with equal features stay two
    rows.
    """
    df.dropDuplicates().drop(*drop).write.mode("append").csv(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
