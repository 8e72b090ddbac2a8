"""Making the package known to the Python workers of a session."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Put the folder of this package on the path of the session's Python workers.

    That serves where executors see the same folders as the driver. Elsewhere the package is given to them as usual, with
    ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    path = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in path:
        env["PYTHONPATH"] = os.pathsep.join([root, *path])
