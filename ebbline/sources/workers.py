"""This package's code for Python workers, whatever folder the driver was started from."""

import tempfile
import zipfile
from pathlib import Path
from threading import Lock

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_lock = Lock()  # models are fitted in threads


def ship_code(spark: SparkSession) -> None:
    """Send the package to the executors once per application; Spark serves it to executors that come later too."""
    context = spark.sparkContext
    with _lock:
        if context.applicationId in _shipped:
            return
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="ebbline-core-")) / "ebbline_core.zip"
        with zipfile.ZipFile(target, "w") as bundle:
            for source in sorted(root.rglob("*.py")):
                bundle.write(source, source.relative_to(root.parent))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)
