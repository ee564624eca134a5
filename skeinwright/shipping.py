"""Makes this package importable for Python workers that don't see the driver's source folder."""

from __future__ import annotations

import os
import shutil
import sys
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers, once for each application, unless they inherit its path."""
    package = Path(__file__).resolve().parent
    root, app = str(package.parent), spark.sparkContext.applicationId
    inherited = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if app in _shipped or root in inherited or os.getcwd() == root:
        return
    _shipped.add(app)
    folder = tempfile.mkdtemp(prefix="skeinwright-src-")
    archive = shutil.make_archive(f"{folder}/skeinwright", "zip", root, package.name)
    spark.sparkContext.addPyFile(archive)
    sys.path[:] = [p for p in sys.path if p != archive]
