"""Registered queries of this subpackage, and the package for Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import daybook

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Rows in one Arrow batch, so that a batch of long texts fits a Python worker.
BATCH_ROWS = 2_000

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, wherever they run."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    top = os.path.dirname(os.path.abspath(daybook.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-package-"), "daybook.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("daybook", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def prepared(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    ship_package(spark)


def query(name: str, expected: str | None = None):
    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepared(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if expected is not None:
            ORACLES[name] = expected
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
