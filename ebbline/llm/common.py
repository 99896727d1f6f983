"""What the operators share: tables, code for Python workers, cut lineage, bounded broadcasts, edited texts."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.sources import materialize

BROADCAST_ROWS = 200_000
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, whatever folder the driver was started from, and hand them at
    most ``BATCH_ROWS`` rows at once: a row is a whole text, and workers stay alive with what they have allocated."""
    context = spark.sparkContext
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="ebbline-code-")) / "ebbline_code.zip"
    with zipfile.ZipFile(target, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else ``df``; give it fixed-width rows
    of a written table, since they are counted here."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lines_of(text: str | Column) -> Column:
    """Lines of a text; a null text has one empty line."""
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n", -1)


def line_key(key: Column, group: Column, text: Column) -> Column:
    """A key of a row's lines: its id with a digest of what decides about them, so that rows that share an id but not
    their text stay apart. Null where the id is."""
    parts = F.concat_ws("\n", F.coalesce(group.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.concat(key.cast("string"), F.lit(":"), F.md5(parts))


def without_positions(lines: Column, positions: Column) -> Column:
    """``lines`` without those at the ascending 0-based ``positions``, in one pass: the stretches between them."""
    held = F.struct(lines.alias("lines"), F.concat(F.array(F.lit(-1)), positions, F.array(F.size(lines))).alias("at"))

    def cut(h: Column) -> Column:
        def stretch(k: Column) -> Column:
            return F.slice(h["lines"], h["at"][k - 1] + 2, h["at"][k] - h["at"][k - 1] - 1)

        return F.flatten(F.transform(F.sequence(F.lit(1), F.size(h["at"]) - 1), stretch))

    # Bound by an outer lambda, so that the lines are split once and not once per stretch.
    return F.transform(F.array(held), cut)[0]


def without_lines(documents: DataFrame, dropped: DataFrame, key: Column, text_column: str) -> DataFrame:
    """``documents`` with the text's lines at the ascending 0-based positions ``dropped(line_id, line_positions)``
    removed, ``line_id`` being the row's ``key``.

    Texts without a dropped line, null texts among them, stay byte for byte. All columns keep their names and order.
    """
    names = documents.columns
    wide = documents.join(dropped, key == dropped["line_id"], "left")
    kept = F.array_join(without_positions(lines_of(documents[text_column]), F.col("line_positions")), "\n")
    text = F.when(F.col("line_positions").isNull(), documents[text_column]).otherwise(kept)
    return wide.select(*(text.alias(n) if n == text_column else documents[n] for n in names))


def written(df: DataFrame, label: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe when executors are lost."""
    return materialize(df, f"llm-{label}", options)


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns, so that other columns cannot clash with those an operator adds."""
    return df.select(*(df[n] for n in names))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished passes: they go once the driver's references are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
