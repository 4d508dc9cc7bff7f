"""How the package reaches executors that do not have it installed."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> str:
    """Zip the package and hand it to all executors of the session; returns the archive's path.

    Needed where Python workers start outside this folder and vigil is not installed there; ``spark-submit --py-files`` with the
    same archive does as well.
    """
    root = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='vigil-')}/vigil", "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(archive)
    return archive
