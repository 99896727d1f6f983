"""Readers, writers and scratch tables."""

import pytest
from pyspark.sql import functions as F

from ebbline.schema import EVENT_LOG_SCHEMA
from ebbline.sources import scratch
from ebbline.sources import (
    append_csv,
    export,
    jdbc_options,
    load_features,
    materialize,
    read_csv,
    read_json,
    scratch_path,
)


@pytest.fixture
def features(spark):
    rows = [("1", 0, 2.5, "7"), ("2", 1, None, "x")]
    return spark.createDataFrame(rows, "userId string, label int, plays double, note string")


def test_json_with_fixed_and_inferred_schema(spark, tmp_path):
    path = str(tmp_path / "log")
    row = {"userId": "1", "ts": 5, "page": "Home", "song": "extra"}
    spark.createDataFrame([row]).write.json(path)
    assert read_json(spark, path).schema == EVENT_LOG_SCHEMA
    assert "song" in read_json(spark, path, schema=None).columns


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_load_features_casts_to_double(spark, tmp_path, features, kind):
    path = str(tmp_path / f"features.{kind}")
    export(features, path, kind, single_file=True)
    loaded = load_features(spark, path, ["plays", "note"])
    assert loaded.dtypes == [("plays", "double"), ("note", "double"), ("label", "double")]
    assert sorted(map(tuple, loaded.collect()), key=str) == [(2.5, 7.0, 0.0), (None, None, 1.0)]
    assert load_features(spark, path).columns == load_features(spark, path, None).columns


def test_unknown_formats(spark, tmp_path, features):
    with pytest.raises(ValueError):
        load_features(spark, str(tmp_path / "features.xml"))
    with pytest.raises(ValueError):
        export(features, str(tmp_path / "x"), "xml")


def test_export_overwrites(spark, tmp_path, features):
    path = str(tmp_path / "out")
    export(features, path, "csv")
    export(features.limit(1), path, "csv")
    assert read_csv(spark, path).count() == 1
    assert {kind for _, kind in read_csv(spark, path).dtypes} == {"string"}


def test_append_csv_keeps_equal_rows_of_different_users(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("1", 5, 'a "b"'), ("2", 5, 'a "b"'), ("2", 5, 'a "b"')], "userId string, n int, s string")
    append_csv(df, path)
    append_csv(df, path)
    back = spark.read.csv(path, escape="\\")
    assert back.count() == 4 and len(back.columns) == 2
    assert back.filter(F.col("_c1") == 'a "b"').count() == 4


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "user_logs") == {"url": "jdbc:x", "dbtable": "user_logs"}
    split = jdbc_options("jdbc:x", "t", "id", 0, 100, 8, {"user": "u"})
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8" and split["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")


def test_scratch_tables(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    df = materialize(spark.range(10).withColumn("x", F.rand()))
    assert df.collect() == df.collect()
    assert "FileScan" in df._jdf.queryExecution().executedPlan().toString()


def test_drop_scratch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(tmp_path / "own"))
    assert scratch.materialize(spark.range(3), "t").count() == 3 and any(tmp_path.iterdir())
    scratch.drop_scratch(spark)
    assert not any(tmp_path.iterdir())
