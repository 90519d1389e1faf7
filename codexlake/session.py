"""What a session needs before Python code of this package runs on executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def passing_folder() -> str:
    """A folder of the driver's own for what Spark's file service sends out; it goes when the driver ends."""
    path = tempfile.mkdtemp(prefix="codexlake-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once a Spark application.

    Workers unpickle functions by module name; where the package is not installed
    on every machine this is what makes it importable there.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(passing_folder(), "codexlake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.join("codexlake", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
