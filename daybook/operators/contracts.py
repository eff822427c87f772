"""Data contracts: checks of stored tables, and a gate for rows on their way into one.

Each check gives rows of (table, column, check, failures, status). All checks of a
table that look at one row at a time share one aggregation, which needs no shuffle;
a key is counted in a second one that reads the key's columns only.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.dates import seconds_between
from daybook.operators.rejects import union_all_by_name
from daybook.schemas import TableContract

# Columns tested on the models.
NOT_NULL_COLUMNS = {
    "stg_processed_trades": [
        "order_id", "portfolio_id", "trade_date", "side", "quantity", "pnl_unresolvable",
    ],
    "stg_portfolio_pnl": ["portfolio_id", "pnl_date"],
    "stg_rejected_records": ["rejection_id", "source_name", "rejection_rule"],
    "fct_daily_trading_pnl": ["trade_date", "portfolio_id", "symbol", "trade_count"],
    "fct_portfolio_risk": ["portfolio_id", "pnl_date"],
    "fct_daily_data_quality": ["run_date", "source_name", "rejection_rule"],
}
UNIQUE_COLUMNS = {"stg_rejected_records": ["rejection_id"]}
ACCEPTED_VALUES = {
    "stg_processed_trades": {"side": ["BUY", "SELL"]},
    "fct_portfolio_risk": {"risk_status": ["BREACH", "WITHIN_LIMIT"]},
}


def _report(df: DataFrame, table: str, column: Column, check: str) -> DataFrame:
    """Shape a frame with a ``failures`` column as check results."""
    return df.select(
        F.lit(table).alias("table"),
        column.alias("column"),
        F.lit(check).alias("check"),
        F.col("failures").cast("bigint").alias("failures"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )


@dataclass(frozen=True)
class Count:
    """One result row: an aggregate over a table that gives its number of failures."""

    column: str
    check: str
    failures: Column


def _report_counts(df: DataFrame, table: str, counts: list[Count]) -> DataFrame:
    """All counts in one pass over ``df``, one result row each."""
    totals = df.agg(*[c.failures.cast("bigint").alias(f"n{i}") for i, c in enumerate(counts)])
    rows = [
        F.struct(F.lit(c.column).alias("column"), F.lit(c.check).alias("check"), F.col(f"n{i}").alias("failures"))
        for i, c in enumerate(counts)
    ]
    return totals.select(F.inline(F.array(*rows))).select(
        F.lit(table).alias("table"),
        "column",
        "check",
        "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
    )


def _not_null(columns: list[str]) -> list[Count]:
    return [Count(c, "not_null", F.count_if(F.col(c).isNull())) for c in columns]


def _accepted_values(column: str, values: list[str]) -> Count:
    strange = F.when(~F.col(column).isin(values), F.col(column))
    return Count(column, "accepted_values", F.count_distinct(strange))


def check_not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return _report_counts(df, table, _not_null(columns))


def check_unique(
    df: DataFrame, table: str, columns: list[str], check: str = "unique"
) -> DataFrame:
    """Failures are keys that occur more than once; keys with a NULL do not count."""
    repeated = (
        df.dropna(subset=columns)
        .groupBy(*columns)
        .agg(F.count("*").alias("copies"))
        .agg(F.count_if(F.col("copies") > 1).alias("failures"))
    )
    return _report(repeated, table, F.lit(", ".join(columns)), check)


def check_accepted_values(
    df: DataFrame, table: str, column: str, values: list[str]
) -> DataFrame:
    """Failures are distinct values outside the list; NULL is not judged."""
    return _report_counts(df, table, [_accepted_values(column, values)])


def check_freshness(
    df: DataFrame,
    table: str,
    loaded_at: str = "loaded_at",
    as_of: datetime | None = None,
    warn_hours: float = 24,
    error_hours: float = 48,
) -> DataFrame:
    """Age of the newest row: pass, warn or error. A table without rows is an error."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    age = df.agg(F.max(loaded_at).alias("newest")).select(
        (seconds_between(F.col("newest"), now) / 3600).alias("hours")
    )
    hours = F.col("hours")
    status = (
        F.when(hours.isNull() | (hours > error_hours), "error")
        .when(hours > warn_hours, "warn")
        .otherwise("pass")
    )
    return age.select(
        F.lit(table).alias("table"),
        F.lit(loaded_at).alias("column"),
        F.lit("freshness").alias("check"),
        F.when(status == "pass", 0).otherwise(1).cast("bigint").alias("failures"),
        status.alias("status"),
    )


def check_primary_key(df: DataFrame, contract: TableContract) -> DataFrame:
    return check_unique(df, contract.name, contract.primary_key, check="primary_key")


@dataclass(frozen=True)
class Constraint:
    """A condition of one column: a row for which ``broken`` is true violates it."""

    column: str
    check: str
    broken: Column


def required_constraints(contract: TableContract, columns: list[str]) -> list[Constraint]:
    """NULL where the contract wants a value, for those of its columns that are there."""
    serial = [contract.serial_column] if contract.serial_column else []
    wanted = [*serial, *contract.required, "loaded_at"]
    return [Constraint(c, "not_null", F.col(c).isNull()) for c in wanted if c in columns]


def bound_constraints(contract: TableContract) -> list[Constraint]:
    """Text longer than declared, or decimals that do not fit the declared type."""
    lengths = [
        Constraint(c, "bounds", F.length(F.col(c)) > n) for c, n in contract.max_lengths.items()
    ]
    decimals = [c for c, type_ in contract.types.items() if isinstance(type_, T.DecimalType)]
    return lengths + [Constraint(c, "bounds", _unfit(contract, c)) for c in decimals]


def _unfit(contract: TableContract, column: str) -> Column:
    """A value that the declared type of its column cannot hold."""
    return F.col(column).isNotNull() & F.col(column).try_cast(contract.types[column]).isNull()


def _counts(constraints: list[Constraint]) -> list[Count]:
    return [Count(c.column, c.check, F.count_if(c.broken)) for c in constraints]


def check_required(df: DataFrame, contract: TableContract) -> DataFrame:
    return _report_counts(df, contract.name, _counts(required_constraints(contract, df.columns)))


def check_lengths(df: DataFrame, contract: TableContract) -> DataFrame:
    return _report_counts(df, contract.name, _counts(bound_constraints(contract)))


def check_table(df: DataFrame, contract: TableContract) -> DataFrame:
    """All declared constraints of one warehouse table: a pass for the rows, one for the key."""
    constraints = required_constraints(contract, df.columns) + bound_constraints(contract)
    return union_all_by_name(
        [_report_counts(df, contract.name, _counts(constraints)), check_primary_key(df, contract)]
    )


def check_models(models: dict[str, DataFrame]) -> DataFrame:
    """All column tests of the staging models and marts given by name."""
    checks = []
    for name, df in models.items():
        counts = _not_null(NOT_NULL_COLUMNS.get(name, [])) + [
            _accepted_values(column, values) for column, values in ACCEPTED_VALUES.get(name, {}).items()
        ]
        if counts:
            checks.append(_report_counts(df, name, counts))
        checks += [check_unique(df, name, [column]) for column in UNIQUE_COLUMNS.get(name, [])]
    return union_all_by_name(checks)


# --- rows on their way into a table -------------------------------------------------------


def incoming_constraints(contract: TableContract) -> list[Constraint]:
    """What a row must meet before its cells are cast: values present, of the type, short enough.

    Rows may come with other types than the declared ones, such as text or wider decimals.
    """
    required = [c for c in contract.required if c in contract.columns]
    return (
        [Constraint(c, "not_null", F.col(c).isNull()) for c in required]
        + [Constraint(c, "type", _unfit(contract, c)) for c in contract.columns]
        + [
            Constraint(c, "length", F.length(F.col(c).cast("string")) > n)
            for c, n in contract.max_lengths.items()
        ]
    )


def violations(contract: TableContract) -> Column:
    """array<struct<column, check>> of the constraints an incoming row breaks, empty for a good row."""
    return F.array_compact(
        F.array(
            *[
                F.when(c.broken, F.struct(F.lit(c.column).alias("column"), F.lit(c.check).alias("check")))
                for c in incoming_constraints(contract)
            ]
        )
    )


def _typed(contract: TableContract) -> list[Column]:
    return [F.col(c).try_cast(contract.types[c]).alias(c) for c in contract.columns]


def enforce_contract(df: DataFrame, contract: TableContract) -> DataFrame:
    """The contract's columns in their declared types; a row that breaks a constraint fails the job.

    The check is part of the projection, so that rows are judged while they are
    written and not in a pass of their own. The error names table, column and
    constraint, not the value.
    """
    checked: dict[str, Column] = {}
    for c in incoming_constraints(contract):
        message = f"{contract.name}.{c.column} breaks its contract: {c.check}"
        broken = checked.get(c.column, F.when(F.lit(False), F.lit(None).cast(contract.types[c.column])))
        error = F.raise_error(F.lit(message)).cast(contract.types[c.column])
        checked[c.column] = broken.when(c.broken, error)
    return df.select(
        *[
            checked[c].otherwise(F.col(c).try_cast(contract.types[c])).alias(c) if c in checked else cell
            for c, cell in zip(contract.columns, _typed(contract), strict=True)
        ]
    )


def split_by_contract(
    df: DataFrame, contract: TableContract, carried: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the contract, in its types; the others as they came).

    The others keep every incoming column in ``record``, as JSON, next to the
    ``violations`` and the ``carried`` columns. No row is lost: each is in
    exactly one of the two.
    """
    names = set(df.columns)
    helper = "broken"
    while helper in names:
        helper += "_"
    # NULL cells stay in the JSON, so a missing value can be told from a missing column.
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    judged = df.withColumn(helper, violations(contract))
    good = judged.where(F.size(helper) == 0).select(*_typed(contract))
    bad = judged.where(F.size(helper) > 0).select(
        *(carried or []), record.alias("record"), F.col(helper).alias("violations")
    )
    return good, bad
