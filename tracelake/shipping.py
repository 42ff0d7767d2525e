"""Give the Python workers this package: a zip of its sources, added to the session once."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the workers' path; a second call for the same application does nothing."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tracelake-zip-"), "tracelake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.join("tracelake", os.path.relpath(file, root)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
