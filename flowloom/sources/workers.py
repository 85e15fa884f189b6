"""Where Python workers find this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it. A cluster needs it installed or sent with --py-files."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
