"""Lets Python workers import this package."""

from __future__ import annotations

import os
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ready(spark: SparkSession) -> None:
    """Puts the folder that holds the package on the workers' path, which is enough where executors share it.

    Elsewhere, submit the package with --py-files."""
    held = spark.sparkContext.environment
    paths = [p for p in held.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        held["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def shipped(function):
    """The function of a session and more, called once its workers are ready."""

    @wraps(function)
    def run(spark, *args, **kwargs):
        ready(spark)
        return function(spark, *args, **kwargs)

    return run
