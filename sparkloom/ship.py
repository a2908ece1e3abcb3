"""Makes this package importable in Python workers wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors once per application, and keep Arrow batches of whole texts small."""
    if spark.conf.get(BATCH) == "10000":  # the default suits narrow rows; ours hold whole texts
        spark.conf.set(BATCH, "512")
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        home = Path(__file__).resolve().parent
        file = os.path.join(tempfile.mkdtemp(prefix="sparkloom-ship-"), "sparkloom.zip")
        with zipfile.ZipFile(file, "w") as out:
            for source in sorted(home.rglob("*.py")):
                out.write(source, source.relative_to(home.parent))
        context.addPyFile(file)
        _SHIPPED.add(context.applicationId)
    return spark
