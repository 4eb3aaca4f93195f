"""Sends this package to the executors, for sessions that started without it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = "keycadence"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the session's Python files, once; as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{PACKAGE}.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(os.path.join(ROOT, PACKAGE)):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        archive.write(file, os.path.relpath(file, ROOT))
        context.addPyFile(path)
        _sent.add(context.applicationId)
    return spark
