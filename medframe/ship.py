"""Ship this package to the executors' Python workers (``addPyFile``).

Arrow batch functions and pandas UDFs are pickled by reference to their
module, so workers must be able to import ``medframe``. On a cluster that
usually means the package is installed in the image; otherwise this zips the
package once per SparkContext and registers it with ``addPyFile``, which
Spark distributes with the job.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: dict = {}  # application -> the archive's path on the driver, None if not shipped


def ensure(spark: SparkSession) -> None:
    """Ship once per application; set ``spark.medframe.ship=false`` when the
    package is installed on the executors' image."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _shipped:
        return
    if str(spark.conf.get("spark.medframe.ship", "true")).lower() == "false":
        _shipped[key] = None
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="medframe-py-")
    path = os.path.join(out_dir, "medframe.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _shipped[key] = path


def archive(spark: SparkSession) -> str | None:
    """Where the driver keeps the shipped archive."""
    ensure(spark)
    return _shipped[spark.sparkContext.applicationId]
