"""Logical names for models: staging as views, marts as stored tables that follow their sources."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.plans.models import MART_DATES, MARTS, STAGING
from daybook.plans.monitoring import DAILY_AGGREGATES
from daybook.sources import snapshots
from daybook.sources.snapshots import Snapshot
from daybook.sources.warehouse import read_table, table_snapshot

STAGING_SCHEMA, MART_SCHEMA, AGGREGATE_SCHEMA = "staging", "marts", "aggregates"


def source(
    spark: SparkSession, warehouse: str, name: str, run_dates: list[date | str] | None = None
) -> DataFrame:
    """A declared warehouse table, or some of its dates."""
    return read_table(spark, warehouse, name, run_dates)


def view_name(name: str) -> str:
    if name in STAGING:
        return f"{STAGING_SCHEMA}_{name}"
    if name in MARTS:
        return f"{MART_SCHEMA}_{name}"
    raise ValueError(f"Unknown model: {name}")


def ref(spark: SparkSession, name: str) -> DataFrame:
    """A registered model by its bare name."""
    return spark.table(view_name(name))


def mart_path(warehouse: str, name: str) -> str:
    return f"{warehouse}/{MART_SCHEMA}/{name}"


def staged(
    spark: SparkSession, warehouse: str, name: str, run_dates: list[date | str] | None = None
) -> DataFrame:
    build, table = STAGING[name]
    return build(source(spark, warehouse, table, run_dates))


def register_staging(spark: SparkSession, warehouse: str) -> None:
    for name in STAGING:
        staged(spark, warehouse, name).createOrReplaceTempView(view_name(name))


def outdated(table: Snapshot, mart: Snapshot) -> list[date]:
    """Dates on which a mart was not built from what its table holds now."""
    now = {day: held.version for day, held in table.dates.items() if held.rows}
    then = {day: held.built_from for day, held in mart.dates.items()}
    return sorted(day for day in {*now, *then} if now.get(day) != then.get(day))


def build_marts(spark: SparkSession, warehouse: str, rebuild: bool = False) -> dict[str, list[date]]:
    """Bring every mart up to date and register it; returns the dates rebuilt of each.

    A mart has one folder for each date and remembers the version of its table it was
    built from. Only dates whose version is another now are read and written, as one commit of
    the mart. ``rebuild`` takes all dates, after a change of the model itself.
    """
    done = {}
    for name, (build, model) in MARTS.items():
        table = table_snapshot(spark, warehouse, STAGING[model][1])
        done[name] = follow(
            spark, mart_path(warehouse, name), MART_DATES[name], table,
            lambda days: build(staged(spark, warehouse, model, days)), rebuild,
        )
        read_mart(spark, warehouse, name).createOrReplaceTempView(view_name(name))
    return done


def follow(
    spark: SparkSession,
    path: str,
    date_column: str,
    table: Snapshot,
    rows_of: Callable[[list[date]], DataFrame],
    rebuild: bool = False,
) -> list[date]:
    """Bring a stored table up to date with the one it is built from; returns the dates rebuilt."""
    stored = snapshots.snapshot(spark, path)
    days = sorted({*table.dates, *stored.dates}) if rebuild else outdated(table, stored)
    if days:
        versions = {day: table.dates[day].version for day in days if table.rows(day)}
        rows = rows_of(days).hint("rebalance", date_column)
        snapshots.replace_dates(rows, path, date_column, days, versions)
    return days


def aggregate_path(warehouse: str, name: str) -> str:
    return f"{warehouse}/{AGGREGATE_SCHEMA}/{name}"


def refresh_aggregates(spark: SparkSession, warehouse: str, rebuild: bool = False) -> dict[str, list[date]]:
    """Bring the aggregates kept by day up to date; returns the dates recomputed of each.

    Distinct counts are exact: a day is counted anew as a whole, and no
    count spans days. Dates whose table version is the same are not read.
    """
    return {
        name: follow(
            spark, aggregate_path(warehouse, name), "metric_date", table_snapshot(spark, warehouse, table),
            lambda days: build(source(spark, warehouse, table, days)), rebuild,
        )
        for name, (build, table) in DAILY_AGGREGATES.items()
    }


def read_aggregate(
    spark: SparkSession, warehouse: str, name: str, run_dates: list[date | str] | None = None
) -> DataFrame:
    build, table = DAILY_AGGREGATES[name]
    schema = build(spark.createDataFrame([], S.table_schema(S.TABLES[table]))).schema
    return snapshots.read_dates(spark, aggregate_path(warehouse, name), schema, "metric_date", run_dates)


def read_mart(
    spark: SparkSession, warehouse: str, name: str, run_dates: list[date | str] | None = None
) -> DataFrame:
    build, model = MARTS[name]
    nothing = spark.createDataFrame([], S.table_schema(S.TABLES[STAGING[model][1]]))
    schema = build(STAGING[model][0](nothing)).schema
    return snapshots.read_dates(spark, mart_path(warehouse, name), schema, MART_DATES[name], run_dates)


def list_models(spark: SparkSession, warehouse: str) -> DataFrame:
    """(table_schema, table_name, row_count) of registered models, in order; counts come from the commits."""
    rows = []
    for name in [*STAGING, *MARTS]:
        if not spark.catalog.tableExists(view_name(name)):
            continue
        if name in STAGING:
            rows.append((STAGING_SCHEMA, name, table_snapshot(spark, warehouse, STAGING[name][1]).total_rows()))
        else:
            rows.append((MART_SCHEMA, name, snapshots.snapshot(spark, mart_path(warehouse, name)).total_rows()))
    models = spark.createDataFrame(rows, "table_schema string, table_name string, row_count bigint")
    return models.orderBy(F.col("table_schema"), F.col("table_name"))
