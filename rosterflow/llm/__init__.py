"""Operators of a training-data pipeline, thirteen of them, with their queries.

Nothing else in the library imports this package.  Operators read only the columns
they name: further columns of the input, whatever they are called, are left aside,
and what an operator returns is listed in its docstring.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import rosterflow
from pyspark.sql import SparkSession


BATCH_ROWS = 1000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark context, and keep their batches small.

    Texts are long, so batches of Spark's default 10,000 rows would hold tens of megabytes on both
    sides of each task; a smaller setting of the session is left as it is.  The archive is made in
    the driver's temporary folder and served by the driver, as ``--py-files`` does; no executor
    reads that folder.
    """
    context = spark.sparkContext
    if not 0 < int(spark.conf.get(_BATCHES)) <= BATCH_ROWS:
        spark.conf.set(_BATCHES, BATCH_ROWS)
    if getattr(context, "_rosterflow_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(rosterflow.__file__))
    path = os.path.join(tempfile.mkdtemp(), "rosterflow_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("rosterflow", os.path.relpath(full, top)))
    context.addPyFile(path)
    context._rosterflow_shipped = True
