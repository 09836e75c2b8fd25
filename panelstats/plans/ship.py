"""Makes the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[2]
_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers once per application, unless PYTHONPATH already holds it."""
    app = spark.sparkContext.applicationId
    if app in _done or str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    to = Path(tempfile.mkdtemp(prefix="spark-package-")) / "panelstats.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted((_ROOT / "panelstats").rglob("*.py")):
            z.write(p, p.relative_to(_ROOT))
    spark.sparkContext.addPyFile(str(to))
    _done.add(app)
