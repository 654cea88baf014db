"""Python workers find this package where the driver has it; on a cluster it is installed or sent with --py-files."""

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def reach(spark: SparkSession) -> SparkSession:
    """Put the folder of the package on the path of the workers that start from now on."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark
