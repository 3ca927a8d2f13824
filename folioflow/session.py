"""Making the package known to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application, unless their PYTHONPATH has it already."""
    app = spark.sparkContext.applicationId
    if app in _shipped or str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = Path(tempfile.mkdtemp(prefix="folioflow-")) / "folioflow.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted((ROOT / "folioflow").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
