"""Session helpers."""

from __future__ import annotations

import pathlib
import tempfile
import weakref
import zipfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

_shipped: weakref.WeakSet[SparkContext] = weakref.WeakSet()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's Python files to the executors, once per application."""
    context = spark.sparkContext
    if context not in _shipped:
        package = pathlib.Path(__file__).resolve().parent
        bundle = pathlib.Path(tempfile.mkdtemp(prefix="spark-")) / "labflow_package.zip"
        with zipfile.ZipFile(bundle, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(str(bundle))
        _shipped.add(context)
    return spark
