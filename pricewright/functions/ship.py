"""Making this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    to = os.path.join(tempfile.mkdtemp(), "pricewright_core.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(top):
            for n in (x for x in names if x.endswith(".py")):
                path = os.path.join(folder, n)
                z.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(to)
    _shipped.add(app)
