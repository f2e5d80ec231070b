"""Making the package importable in Python workers, wherever the driver was started."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import marginalia

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(marginalia.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="marginalia-"), "marginalia.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                z.write(file, os.path.join("marginalia", os.path.relpath(file, root)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
