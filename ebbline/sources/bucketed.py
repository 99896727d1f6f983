"""A log stored in buckets of its users, so that work per user needs no exchange."""

from pyspark.sql import DataFrame, SparkSession

from ebbline.schema import USER
from ebbline.sources.scratch import scratch_path


def write_bucketed(log: DataFrame, table: str, buckets: int, key: str = USER, path: str | None = None) -> DataFrame:
    """``log`` as the catalog table ``table``, in ``buckets`` files by ``key``; what it reads is partitioned by ``key``.

    Choose ``buckets`` by the size of the log: a bucket is one task of every later job. The files lie under ``path``
    or in the scratch folder. A table of that name is replaced. Rows are moved once, here.
    """
    spark: SparkSession = log.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = log.repartition(buckets, key)
    target = path or scratch_path(spark, f"bucketed-{table.rpartition('.')[2]}")
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", target).saveAsTable(table)
    return spark.table(table)
