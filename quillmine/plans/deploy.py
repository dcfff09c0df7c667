"""Getting the package to Python workers that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> SparkSession:
    """Hands the package's sources to Spark once per context, which serves them to every worker, whatever its path and folder."""
    context = spark.sparkContext
    if not getattr(context, "_quillmine_shipped", False):
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="quillmine-"), "quillmine.zip")  # on the driver; Spark copies it from there
        with zipfile.ZipFile(target, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(target))
        context._quillmine_shipped = True
    return spark
