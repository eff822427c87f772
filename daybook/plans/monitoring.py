"""Monitoring views and operational reports over the warehouse tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.dates import RunDate, run_date_column, seconds_between
from daybook.functions.money import ratio_or_zero
from daybook.operators.gate import MAX_REJECT_RATE, MAX_UNRESOLVABLE, gate_passes
from daybook.operators.rejects import rejection_counts, union_all_by_name


def v_pipeline_load_summary(load_log: DataFrame) -> DataFrame:
    """Loads per pipeline run: rows moved, outcomes and total duration."""
    runs = load_log.groupBy("dag_id", "airflow_run_id", "run_date").agg(
        F.count("*").alias("load_task_count"),
        F.sum("rows_deleted").alias("total_rows_deleted"),
        F.sum("rows_inserted").alias("total_rows_inserted"),
        F.count_if(F.col("load_status") == "SUCCESS").alias("successful_load_count"),
        F.count_if(F.col("load_status") == "FAILED").alias("failed_load_count"),
        F.min("started_at").alias("load_started_at"),
        F.max("completed_at").alias("load_completed_at"),
    )
    duration = seconds_between(F.col("load_started_at"), F.col("load_completed_at"))
    return runs.withColumn("load_duration_seconds", duration)


def v_table_load_metrics(load_log: DataFrame) -> DataFrame:
    """Every load with its duration."""
    duration = seconds_between(F.col("started_at"), F.col("completed_at"))
    return load_log.select(
        "load_id",
        "dag_id",
        "airflow_run_id",
        "run_date",
        "target_table",
        "rows_deleted",
        "rows_inserted",
        "load_status",
        "started_at",
        "completed_at",
        duration.alias("duration_seconds"),
        "error_message",
    )


def v_daily_trade_metrics(trades: DataFrame) -> DataFrame:
    """Trades per day with exact distinct portfolios and symbols.

    Trades are first reduced to one row per day, portfolio and symbol, so the
    distinct counts run over those rows and a busy day is spread over tasks.
    """
    grain = trades.groupBy("trade_date", "portfolio_id", "symbol").agg(
        F.count("*").alias("n"),
        F.count_if("pnl_unresolvable").alias("unresolvable"),
        F.count_if(F.col("side") == "BUY").alias("buys"),
        F.count_if(F.col("side") == "SELL").alias("sells"),
        F.sum("realized_pnl_usd").alias("pnl_usd"),
    )
    return grain.groupBy(F.col("trade_date").alias("metric_date")).agg(
        F.sum("n").alias("processed_trade_count"),
        F.sum("unresolvable").alias("unresolvable_trade_count"),
        F.sum("buys").alias("buy_trade_count"),
        F.sum("sells").alias("sell_trade_count"),
        F.coalesce(F.sum("pnl_usd"), F.lit(0)).alias("total_realized_pnl_usd"),
        F.count_distinct("portfolio_id").alias("portfolio_count"),
        F.count_distinct("symbol").alias("symbol_count"),
    )


def v_rejections_by_rule(rejected: DataFrame) -> DataFrame:
    return rejection_counts(rejected, by=["run_date"]).withColumnRenamed("run_date", "metric_date")


def v_daily_rejection_metrics(rejected: DataFrame) -> DataFrame:
    """Rejects per day and source, from the few counts per day, source and rule."""
    return rejection_days(v_rejections_by_rule(rejected))


def rejection_days(by_rule: DataFrame) -> DataFrame:
    """Rejects per day, from counts per day, source and rule."""
    count, source = F.col("rejected_record_count"), F.col("source_name")

    def from_source(name: str) -> Column:
        return F.sum(F.when(source == name, count).otherwise(0))

    return by_rule.groupBy("metric_date").agg(
        F.sum(count).alias("rejected_record_count"),
        from_source(S.TRADES).alias("rejected_trade_count"),
        from_source(S.MARKET_DATA).alias("rejected_market_count"),
        from_source(S.PORTFOLIO).alias("rejected_portfolio_count"),
        F.count_distinct("rejection_rule").alias("rejection_rule_count"),
    )


def v_daily_quality_metrics(
    trades: DataFrame,
    rejected: DataFrame,
    max_reject_rate: float = MAX_REJECT_RATE,
    max_unresolvable: int = MAX_UNRESOLVABLE,
) -> DataFrame:
    """Reject rate and gate per day from the tables.

    Unlike the gate on run metrics, a day without any trade does not pass.
    """
    accepted = trades.groupBy(F.col("trade_date").alias("metric_date")).agg(
        F.count("*").alias("accepted_trade_count"),
        F.count_if("pnl_unresolvable").alias("unresolvable_count"),
    )
    refused = rejected.groupBy(F.col("run_date").alias("metric_date")).agg(
        F.count_if(F.col("source_name") == S.TRADES).alias("rejected_trade_count"),
        F.count("*").alias("total_rejected_count"),
    )
    return quality_days(accepted, refused, max_reject_rate, max_unresolvable)


def quality_days(
    accepted: DataFrame,
    refused: DataFrame,
    max_reject_rate: float = MAX_REJECT_RATE,
    max_unresolvable: int = MAX_UNRESOLVABLE,
) -> DataFrame:
    """Reject rate and gate per day, from a row per day of accepted and of refused counts."""
    counts = [
        "accepted_trade_count",
        "rejected_trade_count",
        "total_rejected_count",
        "unresolvable_count",
    ]
    daily = accepted.join(refused, "metric_date", "full_outer").fillna(0, subset=counts)

    inbound = F.col("accepted_trade_count") + F.col("rejected_trade_count")
    rate = ratio_or_zero(F.col("rejected_trade_count"), inbound)
    passed = (inbound > 0) & gate_passes(
        rate, F.col("unresolvable_count"), max_reject_rate, max_unresolvable
    )
    return daily.select(
        "metric_date",
        *counts,
        rate.alias("trade_reject_rate"),
        passed.alias("quality_gate_passed"),
    )


def v_portfolio_risk_summary(portfolio_pnl: DataFrame) -> DataFrame:
    value_breach = F.col("market_value_limit_breached")
    loss_breach = F.col("daily_loss_limit_breached")
    return portfolio_pnl.groupBy(F.col("pnl_date").alias("metric_date")).agg(
        F.count("*").alias("portfolio_count"),
        F.count_if(value_breach).alias("market_value_breach_count"),
        F.count_if(loss_breach).alias("daily_loss_breach_count"),
        F.count_if(value_breach | loss_breach).alias("total_breached_portfolios"),
        F.coalesce(F.sum("total_market_value_usd"), F.lit(0)).alias("total_market_value_usd"),
        F.coalesce(F.sum("total_unrealized_pnl_usd"), F.lit(0)).alias("total_unrealized_pnl_usd"),
    )


def monitoring_views(tables: dict[str, DataFrame], load_log: DataFrame) -> dict[str, DataFrame]:
    """All monitoring views by name, lazily."""
    trades, rejected = tables["processed_trades"], tables["rejected_records"]
    return {
        "v_pipeline_load_summary": v_pipeline_load_summary(load_log),
        "v_table_load_metrics": v_table_load_metrics(load_log),
        "v_daily_trade_metrics": v_daily_trade_metrics(trades),
        "v_daily_rejection_metrics": v_daily_rejection_metrics(rejected),
        "v_daily_quality_metrics": v_daily_quality_metrics(trades, rejected),
        "v_portfolio_risk_summary": v_portfolio_risk_summary(tables["portfolio_pnl"]),
        "v_rejections_by_rule": v_rejections_by_rule(rejected),
    }


# Aggregate kept by day -> (builder, the table it reads). A day's rows come from rows of that day.
DAILY_AGGREGATES = {
    "daily_trades": (v_daily_trade_metrics, "processed_trades"),
    "daily_rejections": (v_rejections_by_rule, "rejected_records"),
    "daily_risk": (v_portfolio_risk_summary, "portfolio_pnl"),
}


def views_of_aggregates(kept: dict[str, DataFrame], load_log: DataFrame) -> dict[str, DataFrame]:
    """The monitoring views from aggregates kept by day; no trade or reject is read again."""
    by_day = rejection_days(kept["daily_rejections"])
    accepted = kept["daily_trades"].select(
        "metric_date",
        F.col("processed_trade_count").alias("accepted_trade_count"),
        F.col("unresolvable_trade_count").alias("unresolvable_count"),
    )
    refused = by_day.select(
        "metric_date", "rejected_trade_count", F.col("rejected_record_count").alias("total_rejected_count")
    )
    return {
        "v_pipeline_load_summary": v_pipeline_load_summary(load_log),
        "v_table_load_metrics": v_table_load_metrics(load_log),
        "v_daily_trade_metrics": kept["daily_trades"],
        "v_daily_rejection_metrics": by_day,
        "v_daily_quality_metrics": quality_days(accepted, refused),
        "v_portfolio_risk_summary": kept["daily_risk"],
        "v_rejections_by_rule": kept["daily_rejections"],
    }


def on_run_date(df: DataFrame, date_column: str, run_date: RunDate) -> DataFrame:
    return df.where(F.col(date_column) == run_date_column(run_date))


def table_row_counts(tables: dict[str, DataFrame], run_date: RunDate | None = None) -> DataFrame:
    """(table_name, row_count) of each warehouse table, on one date or overall."""
    counts = []
    for name, df in tables.items():
        if run_date is not None:
            df = on_run_date(df, S.TABLES[name].partition_column, run_date)
        counts.append(df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        ))
    return reduce(DataFrame.unionAll, counts)


def changed_row_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a rerun, with a flag where they differ."""
    return (
        before.withColumnRenamed("row_count", "rows_before")
        .join(after.withColumnRenamed("row_count", "rows_after"), "table_name", "full_outer")
        .withColumn("changed", ~F.col("rows_before").eqNullSafe(F.col("rows_after")))
    )


def latest_loads(load_log: DataFrame, count: int = 10) -> DataFrame:
    """The newest load attempts."""
    newest = load_log.orderBy(F.desc("load_id")).limit(count)
    return newest.select(
        "target_table", "rows_deleted", "rows_inserted", "load_status", "started_at", "completed_at"
    )


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare two (metric, value) frames: one row per metric with ``ok``."""
    return (
        expected.withColumnRenamed("value", "expected")
        .join(actual.withColumnRenamed("value", "actual"), "metric", "full_outer")
        .withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))
    )


def metric_values(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Turn count columns of one row into (metric, value) rows."""
    return df.select(*[F.col(m).cast("bigint").alias(m) for m in metrics]).unpivot(
        [], metrics, "metric", "value"
    )


def reconcile_metrics(metrics: DataFrame, tables: dict[str, DataFrame], run_date: RunDate) -> DataFrame:
    """Check one date's metrics document against the loaded tables."""
    # Metric -> the table whose row count it must equal.
    same_count = {
        "clean_trade_count": "processed_trades",
        "portfolio_pnl_count": "portfolio_pnl",
        "total_rejection_count": "rejected_records",
        "pnl_unresolvable_count": "unresolvable_pnl",
    }
    expected = metric_values(
        metrics.where(F.col("run_date").cast("date") == run_date_column(run_date)),
        list(same_count),
    )
    counted = [
        table_row_counts({table: tables[table]}, run_date).select(
            F.lit(metric).alias("metric"), F.col("row_count").alias("value")
        )
        for metric, table in same_count.items()
    ]
    return reconcile(expected, union_all_by_name(counted))


# Metric of a run -> the table and the condition on its rows whose count it must equal.
_TABLE_METRICS = {
    "clean_trade_count": ("processed_trades", None),
    "portfolio_pnl_count": ("portfolio_pnl", None),
    "total_rejection_count": ("rejected_records", None),
    "trade_rejection_count": ("rejected_records", S.TRADES),
    "pnl_unresolvable_count": ("unresolvable_pnl", None),
}
RECONCILED = ["total_trade_count", *_TABLE_METRICS]


def run_metric_values(metrics: DataFrame) -> DataFrame:
    """(run_date, metric, value) of metrics documents: the counts, and the entries of both maps as ``rule:`` and ``source:``."""
    day = F.col("run_date").cast("date").alias("run_date")
    counts = metrics.select(day, *[F.col(m).cast("bigint").alias(m) for m in RECONCILED]).unpivot(
        ["run_date"], RECONCILED, "metric", "value"
    )
    maps = [
        metrics.select(day, F.explode(column).alias("key", "value")).select(
            "run_date", F.concat(F.lit(prefix), "key").alias("metric"), "value"
        )
        for prefix, column in (("rule:", "rejection_count_by_rule"), ("source:", "rejection_count_by_source"))
    ]
    return union_all_by_name([counts, *maps]).where(F.col("value").isNotNull())


def table_metric_values(tables: dict[str, DataFrame]) -> DataFrame:
    """The same metrics as far as they are counts of warehouse rows, for every date that has rows; one pass over each table."""
    parts = []
    rejected = tables["rejected_records"].groupBy("run_date", "source_name", "rejection_rule").agg(F.count("*").alias("n"))
    for metric, (name, source) in _TABLE_METRICS.items():
        day = S.TABLES[name].partition_column
        if name == "rejected_records":
            counted = rejected.where(F.col("source_name") == source) if source else rejected
            sums = counted.groupBy("run_date").agg(F.sum("n").alias("value"))
        else:
            sums = tables[name].groupBy(F.col(day).alias("run_date")).agg(F.count("*").alias("value"))
        parts.append(sums.select("run_date", F.lit(metric).alias("metric"), "value"))
    for prefix, column in (("rule:", "rejection_rule"), ("source:", "source_name")):
        parts.append(rejected.groupBy("run_date", F.concat(F.lit(prefix), column).alias("metric")).agg(F.sum("n").alias("value")))
    total = parts[0].unionByName(parts[3]).groupBy("run_date").agg(F.sum("value").alias("value"))
    parts.append(total.select("run_date", F.lit("total_trade_count").alias("metric"), "value"))
    return union_all_by_name(parts)


def reconcile_sources(manifest: DataFrame | None, metrics: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Manifest, run metrics and tables side by side: one row for each date and metric that any of them has.

    Columns: run_date, metric, manifest_value, run_value, table_value, status. Status is
    ``ok`` where all that are asked agree, ``different`` where two values differ, or else
    ``missing in`` with the names of the sides without a value. A count of zero leaves no rows in a
    table, so a table without the metric agrees with zero. The manifest is only asked for metrics
    it names on some date; pass None where there is none.
    """
    sides = {"run": run_metric_values(metrics), "table": table_metric_values(tables)}
    if manifest is not None:
        sides = {"manifest": manifest.select("run_date", "metric", F.col("value").cast("bigint").alias("value"))} | sides
    long = union_all_by_name([df.withColumn("side", F.lit(name)) for name, df in sides.items()])
    wide = long.groupBy("run_date", "metric").pivot("side", list(sides)).agg(F.sum("value"))
    if manifest is None:
        asked = F.lit(False)
    else:
        named = manifest.select("metric").distinct().withColumn("asked", F.lit(True))
        wide = wide.join(F.broadcast(named) if _few(named) else named, "metric", "left")
        asked = F.coalesce("asked", F.lit(False))
    manifest_value = F.col("manifest") if manifest is not None else F.lit(None).cast("bigint")
    table_value = F.coalesce(F.col("table"), F.when(F.coalesce("run", manifest_value) == 0, F.lit(0).cast("bigint")))
    values = {"manifest": manifest_value, "run": F.col("run"), "table": table_value}
    known = F.array_compact(F.array(*values.values()))
    wanted = {"manifest": asked, "run": F.lit(True), "table": F.lit(True)}
    absent = F.concat_ws(", ", *[F.when(wanted[n] & v.isNull(), F.lit(n)) for n, v in values.items()])
    status = (
        F.when(F.array_min(known) != F.array_max(known), "different")
        .when(absent != "", F.concat(F.lit("missing in "), absent))
        .otherwise("ok")
    )
    return wide.select(
        "run_date", "metric", *[v.alias(f"{n}_value") for n, v in values.items()], status.alias("status")
    )


def _few(names: DataFrame, most: int = 10_000) -> bool:
    """Whether a list of names is small enough to be sent to every task."""
    return names.limit(most + 1).count() <= most
