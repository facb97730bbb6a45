"""Python workers need this package; a session that did not install it gets it from the driver."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors once a session, through Spark's own file service."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="kinfold-"), "kinfold_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(os.path.join(top, "kinfold")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, top))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
