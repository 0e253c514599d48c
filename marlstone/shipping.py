"""The package's own code for the executors' Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once an application; an installed package or --py-files does the same."""
    app = spark.sparkContext.applicationId
    if app in _DONE:
        return
    root = Path(__file__).resolve().parent
    held = tempfile.mkdtemp(prefix="marlstone-code-")  # on the driver only: Spark serves the file to the executors
    tree = Path(held) / "tree" / root.name
    shutil.copytree(root, tree, ignore=shutil.ignore_patterns("__pycache__", "*.pyc"))
    spark.sparkContext.addPyFile(shutil.make_archive(f"{held}/{root.name}-code", "zip", tree.parent, root.name))
    _DONE.add(app)
