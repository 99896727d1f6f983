"""Scratch tables in the shared folder the cluster names in ``spark.checkpoint.dir``."""

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for scratch tables (a temporary one only in local mode without the setting)."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        _local_root = root = _local_root or tempfile.mkdtemp(prefix="ebbline-")
    return f"{root.rstrip('/')}/ebbline-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables of this application; results that still read them fail afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "table", options: Mapping[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet, with the writer's ``options``, and read it back.

    For results that later steps read several times: the written table cuts the lineage, survives
    lost executors and still prunes columns, which a cache or a row checkpoint does not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
