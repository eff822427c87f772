"""Registration of queries with the SQL that gives the expected result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so both engines print them alike."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            else f.name
            for f in df.schema
        ]
    )


def query(name: str, expected: str | None = None, dates: str = ""):
    """Register a query; ``dates`` names the date and timestamp columns of ``expected``."""

    def register(build):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(build(spark, sf_dir))

        QUERIES[name] = run
        if expected is not None:
            casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split())
            ORACLES[name] = f"SELECT * REPLACE ({casts}) FROM (\n{expected}\n)" if casts else expected
        return run

    return register
