"""What partition code needs from the session."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package wherever it was imported from."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, path) if x)
