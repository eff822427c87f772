"""Run metrics, one row per run date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.money import ratio_or_zero
from daybook.operators.gate import MAX_REJECT_RATE, MAX_UNRESOLVABLE, gate_passes
from daybook.operators.rejects import rejection_counts, union_all_by_name

PIPELINE_NAME = "daily_feed_pipeline"

COUNTS = [
    "valid_trade_count",
    "clean_trade_count",
    "pnl_unresolvable_count",
    "total_rejection_count",
    "trade_rejection_count",
    "portfolio_pnl_count",
]


def run_totals(
    valid: DataFrame,
    clean: DataFrame,
    rejected: DataFrame,
    portfolio: DataFrame,
    run_dates: DataFrame | None = None,
) -> DataFrame:
    """Counts and realized P&L per run date.

    Every table is reduced to one row per date before anything is combined.
    ``run_dates`` (one column ``run_date``) adds dates on which no table has rows.
    """
    clean = clean.withColumnRenamed("trade_date", "run_date")
    portfolio = portfolio.withColumnRenamed("pnl_date", "run_date")
    parts = [
        valid.groupBy("run_date").agg(F.count("*").alias("valid_trade_count")),
        clean.groupBy("run_date").agg(
            F.count("*").alias("clean_trade_count"),
            F.count_if("pnl_unresolvable").alias("pnl_unresolvable_count"),
            total_realized_pnl().alias("total_realized_pnl_usd"),
        ),
        rejected.groupBy("run_date").agg(
            F.count("*").alias("total_rejection_count"),
            F.count_if(F.col("source_name") == S.TRADES).alias("trade_rejection_count"),
        ),
        portfolio.groupBy("run_date").agg(F.count("*").alias("portfolio_pnl_count")),
    ]
    if run_dates is not None:
        parts.append(run_dates.select("run_date"))
    combined = union_all_by_name(parts).groupBy("run_date")
    return combined.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
        F.sum("total_realized_pnl_usd").alias("total_realized_pnl_usd"),
    ).withColumn(
        "total_trade_count", F.col("valid_trade_count") + F.col("trade_rejection_count")
    )


def total_realized_pnl() -> Column:
    """Dollar P&L over the trades that have one."""
    return F.sum(F.when(~F.col("pnl_unresolvable"), F.col("realized_pnl_usd")))


def rejection_maps(rejected: DataFrame) -> DataFrame:
    """Per run date a map rule -> count and a map source -> count."""
    counts = rejection_counts(rejected, by=["run_date"])
    day, source, rule = F.col("run_date"), F.col("source_name"), F.col("rejection_rule")
    sums = counts.groupingSets(
        [[day, rule], [day, source]], day, source, rule
    ).agg(F.sum("rejected_record_count").alias("n"))

    def as_map(key: Column) -> Column:
        entries = F.collect_list(F.when(key.isNotNull(), F.struct(key, F.col("n"))))
        return F.map_from_entries(F.array_sort(entries))

    return sums.groupBy("run_date").agg(
        as_map(rule).alias("rejection_count_by_rule"),
        as_map(source).alias("rejection_count_by_source"),
    )


def build_metrics(
    totals: DataFrame,
    rejected: DataFrame,
    max_reject_rate: float = MAX_REJECT_RATE,
    max_unresolvable: int = MAX_UNRESOLVABLE,
    pipeline_name: str = PIPELINE_NAME,
) -> DataFrame:
    """The metrics document of every run date in ``totals``, as typed columns.

    The gated rate counts rejected trades only; the overall rate puts the
    rejects of all feeds over the number of trades and may exceed 1.
    """
    trade_rate = ratio_or_zero(F.col("trade_rejection_count"), F.col("total_trade_count"))
    overall_rate = ratio_or_zero(F.col("total_rejection_count"), F.col("total_trade_count"))
    unresolvable = F.col("pnl_unresolvable_count")
    realized = F.col("total_realized_pnl_usd")
    no_counts = F.create_map().cast("map<string,bigint>")

    gate = F.struct(
        gate_passes(trade_rate, unresolvable, max_reject_rate, max_unresolvable).alias("passed"),
        unresolvable.alias("pnl_unresolvable_count"),
        F.lit(max_unresolvable).cast("bigint").alias("pnl_unresolvable_threshold"),
        F.round(trade_rate, 6).alias("trade_reject_rate"),
        F.lit(float(max_reject_rate)).alias("trade_reject_rate_threshold"),
    )
    columns = {
        "pipeline_name": F.lit(pipeline_name),
        "quality_gate": gate,
        "trade_reject_rate": F.round(trade_rate, 6),
        "overall_reject_rate": F.round(overall_rate, 6),
        "total_realized_pnl_usd": F.when(realized != 0, realized.cast("string")).otherwise("0"),
        "rejection_count_by_rule": F.coalesce("rejection_count_by_rule", no_counts),
        "rejection_count_by_source": F.coalesce("rejection_count_by_source", no_counts),
    }
    return (
        totals.join(rejection_maps(rejected), "run_date", "left")
        .withColumns(columns)
        .select(*S.METRICS_DOCUMENT.names)
    )


def metrics_json(metrics: DataFrame) -> DataFrame:
    """One JSON line per run date, keys in alphabetical order."""
    document = F.to_json(F.struct(*sorted(S.METRICS_DOCUMENT.names)))
    return metrics.select("run_date", document.alias("value"))
