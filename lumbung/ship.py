"""This package on the path of Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_PACKAGE = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def shipped(spark: SparkSession | None = None) -> None:
    """Sends the package to the session's executors, once an application, by the way that Spark has for it (addPyFile). Workers that find it on PYTHONPATH, as on a cluster that has it there, need no copy.

    Whatever runs Python in tasks calls this; there is no need to call it oneself.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    context = spark.sparkContext
    paths = (context.environment.get("PYTHONPATH", "") + os.pathsep + os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if context.applicationId in _SHIPPED or _ROOT in [os.path.abspath(p) for p in paths if p]:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="lumbung-"), f"{_PACKAGE}.zip")  # the driver serves it from here
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(os.path.join(_ROOT, _PACKAGE)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, _ROOT))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
