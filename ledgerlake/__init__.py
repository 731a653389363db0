"""Public-money analytics and corpus jobs as Spark DataFrame code."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: Bytes of an Arrow batch that goes to a Python worker, about: long texts come few at a time.
ARROW_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes; send this package to the executors (as ``--py-files`` would), once for each application."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b") == "67108864b":  # Spark's default
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-"), "ledgerlake.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
