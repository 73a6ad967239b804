"""Make this package importable in the Python workers of a session.

On a cluster the package may be installed on every machine; if not, the driver
sends a zip of its sources (some 100 KB) through Spark's own file distribution.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package once per application."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="quire-zip-"), "quire_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("quire", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(path)
    _SENT.add(app)
