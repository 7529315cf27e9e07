"""Make this library importable in Python workers, wherever the driver imported it from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_sent: dict[str, object] = {}


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's source files to the executors once a session.

    Spark's own file server hands them out; the archive stays open on the driver until it ends.
    """
    context = spark.sparkContext
    if context.applicationId not in _sent:
        folder = tempfile.TemporaryDirectory(prefix="repopulse-code-")
        archive = f"{folder.name}/repopulse_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(_PACKAGE.rglob("*.py")):
                out.write(path, f"{_PACKAGE.name}/{path.relative_to(_PACKAGE)}")
        context.addPyFile(archive)
        _sent[context.applicationId] = folder
    return spark
