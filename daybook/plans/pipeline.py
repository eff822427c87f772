"""The jobs: feeds to outputs, outputs to warehouse, warehouse to models."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.dates import parse_run_date, parse_run_dates
from daybook.functions.rules import valid_rows
from daybook.operators.contracts import check_freshness, check_models, check_table
from daybook.operators.gate import MAX_REJECT_RATE, MAX_UNRESOLVABLE, quality_gate, require_passed
from daybook.operators.market import market_rejects, tag_market, valid_prices
from daybook.operators.metrics import build_metrics, run_totals
from daybook.operators.portfolio import (
    judge_positions,
    portfolio_rejects,
    portfolio_rollup,
    price_positions,
    value_positions,
)
from daybook.operators.prices import fits_broadcast, price_lookup
from daybook.operators.rejects import union_all_by_name
from daybook.operators.trades import (
    TRADE_TAGS,
    price_trades,
    tag_trades,
    trade_rejects,
    unresolvable_trades,
)
from daybook.plans import monitoring
from daybook.plans.models import MARTS, STAGING
from daybook.sources import catalog, warehouse as wh
from daybook.sources.readers import (
    PORTFOLIO_FORMS,
    read_market_csv,
    read_metrics,
    read_partitions,
    read_tagged_text,
    require_source_dates,
)
from daybook.sources.session import COMPACT, FOLDERS_AT_ONCE, lean_writes, remove_folder, work_folder
from daybook.sources.snapshots import Reload
from daybook.sources.writers import write_metrics, write_partitions


def stage(df: DataFrame, folder: str) -> DataFrame:
    """Write a tagged feed once, valid and rejected rows apart, and read it back.

    Everything downstream then starts from files: the feed is parsed once, each
    half is read without the other, and a lost executor costs only its tasks.
    """
    marked = df.withColumn("is_rejected", F.col("rejection_rule").isNotNull())
    with lean_writes(df.sparkSession):
        marked.write.options(**COMPACT).partitionBy("is_rejected").parquet(folder)
    return df.sparkSession.read.schema(marked.schema).parquet(folder)


def half(staged: DataFrame, rejected: bool) -> DataFrame:
    return staged.where(F.col("is_rejected") == rejected).drop("is_rejected")


def gather_dates(df: DataFrame, date_column: str, dates: list[date]) -> DataFrame:
    """Bring each date's rows together, so that few files are written per date.

    Adaptive execution splits a date that is too large for one task. Of few dates every task
    writes a file each, so these rows need not be shuffled.
    """
    return df if len(dates) <= FOLDERS_AT_ONCE else df.hint("rebalance", date_column)


def run_pipeline(
    spark: SparkSession,
    in_root: str,
    out_root: str,
    run_dates: list[date | str],
    null_side_passes: bool = False,
    max_reject_rate: float = MAX_REJECT_RATE,
    max_unresolvable: int = MAX_UNRESOLVABLE,
    portfolio_form: str = "documents",
) -> DataFrame:
    """Process the feeds of one or many dates; returns their metrics.

    Reads ``trades``, ``market_data`` and ``portfolio`` under ``in_root``, each
    by ``dt=``; a feed without files for a date is an error, raised before anything
    is written. Replaces the dates' folders
    of the four outputs and the metrics under ``out_root``. ``portfolio_form`` says
    whether portfolio files hold a document each or a portfolio a line.
    """
    read_portfolio = PORTFOLIO_FORMS[portfolio_form]
    dates = [parse_run_date(d) for d in run_dates]
    require_source_dates(spark, in_root, dates)
    work = work_folder(spark, "run")
    try:
        metrics = _write_outputs(
            spark, in_root, out_root, dates, work, null_side_passes, read_portfolio
        )
        metrics = build_metrics(*metrics, max_reject_rate, max_unresolvable)
        write_metrics(metrics, f"{out_root}/metrics")
    finally:
        remove_folder(spark, work)
    return read_metrics(spark, f"{out_root}/metrics", dates)


def _write_outputs(
    spark: SparkSession,
    in_root: str,
    out_root: str,
    dates: list[date],
    work: str,
    null_side_passes: bool,
    read_portfolio: Callable[[SparkSession, str, list[date]], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """Write the four outputs; returns (totals per date, written rejects)."""
    day = F.col("dt")
    market = tag_market(read_market_csv(spark, f"{in_root}/market_data", dates), day)
    market = stage(market.drop("dt"), f"{work}/market_data")
    prices = valid_prices(half(market, rejected=False))
    small = fits_broadcast(price_lookup(prices))

    messages = read_tagged_text(spark, f"{in_root}/trades", dates)
    trades = tag_trades(messages, day, null_side_passes, TRADE_TAGS)
    # A valid message is fully parsed; only rejects need their text again.
    message = F.when(F.col("rejection_rule").isNotNull(), F.col("raw_record"))
    trades = stage(trades.drop("dt").withColumn("raw_record", message), f"{work}/trades")

    clean = price_trades(valid_rows(half(trades, rejected=False)), prices, small, in_files=True)
    if not small:
        clean = gather_dates(clean, "trade_date", dates)
    outputs = {name: f"{out_root}/{table.output_path}" for name, table in S.TABLES.items()}

    def write(name: str, df: DataFrame) -> DataFrame:
        dated = df.withColumn("dt", F.col(S.TABLES[name].partition_column))
        write_partitions(dated, outputs[name], dates)
        return read_partitions(spark, outputs[name], dates, schema=dated.schema).drop("dt")

    clean = write("processed_trades", clean)
    # Of the valid trades only their dates are still needed, for counting them.
    valid = stage(half(trades, rejected=False).select("run_date", "rejection_rule"), f"{work}/valid")
    remove_folder(spark, f"{work}/trades/is_rejected=false")
    unresolvable = unresolvable_trades(clean)
    write("unresolvable_pnl", unresolvable.select(*S.TABLES["unresolvable_pnl"].columns))

    documents = read_portfolio(spark, f"{in_root}/portfolio", dates)
    judged = judge_positions(documents, day).drop("dt")
    if not small:
        # The shuffled join reads its rows twice; spare the documents a second parse.
        judged = stage(judged, f"{work}/documents").drop("is_rejected")
    positions = stage(price_positions(judged, prices, small, in_files=not small), f"{work}/portfolio")
    remove_folder(spark, f"{work}/documents")
    rollup = portfolio_rollup(value_positions(half(positions, rejected=False)))
    portfolio = write("portfolio_pnl", gather_dates(rollup, "pnl_date", dates))
    remove_folder(spark, f"{work}/portfolio/is_rejected=false")
    rejects = union_all_by_name(
        [
            trade_rejects(half(trades, rejected=True)),
            market_rejects(half(market, rejected=True)),
            portfolio_rejects(half(positions, rejected=True)),
        ]
    )
    rejected = write("rejected_records", gather_dates(rejects, "run_date", dates))
    for feed in S.SOURCES:
        remove_folder(spark, f"{work}/{feed}/is_rejected=true")

    every_date = spark.createDataFrame([(d,) for d in dates], "run_date date")
    totals = run_totals(valid, clean, rejected, portfolio, every_date)
    return totals, rejected


def load_warehouse(
    spark: SparkSession,
    out_root: str,
    warehouse: str,
    run_dates: list[date | str] | date | str,
    run_id: str,
    max_reject_rate: float = MAX_REJECT_RATE,
    max_unresolvable: int = MAX_UNRESOLVABLE,
    quarantine: bool = False,
) -> dict[str, dict[date, Reload]]:
    """Judge the metrics of one or many dates; if all pass, reload the four tables, each by one commit.

    Rows that break a table's contract fail its load, or are set aside where ``quarantine`` is true.
    """
    days = parse_run_dates(run_dates)
    metrics = read_metrics(spark, f"{out_root}/metrics", days)
    require_passed(quality_gate(metrics, max_reject_rate, max_unresolvable, strict=True))
    wh.create_tables(spark, warehouse)
    loaded = {
        name: wh.load_table(spark, out_root, warehouse, name, days, run_id, quarantine=quarantine)
        for name in S.TABLES
    }
    absent = wh.missing_loads(wh.read_load_log(spark, warehouse), days, run_id).collect()
    if absent:
        names = ", ".join(sorted(f"{r['target_table']} {r['run_date']}" for r in absent))
        raise RuntimeError(f"Warehouse loads are missing: {names}")
    return loaded


def build_models(spark: SparkSession, warehouse: str, rebuild: bool = False) -> DataFrame:
    """Register staging views, bring the marts up to date, return the column tests' results."""
    catalog.register_staging(spark, warehouse)
    catalog.build_marts(spark, warehouse, rebuild)
    return check_models({name: catalog.ref(spark, name) for name in [*STAGING, *MARTS]})


def contract_report(spark: SparkSession, warehouse: str) -> DataFrame:
    """Declared constraints of all warehouse tables."""
    tables = wh.read_tables(spark, warehouse)
    return union_all_by_name([check_table(df, S.TABLES[name]) for name, df in tables.items()])


def freshness_report(
    spark: SparkSession, warehouse: str, as_of: datetime | None = None
) -> DataFrame:
    """Age of the newest row of every warehouse table."""
    tables = wh.read_tables(spark, warehouse)
    return union_all_by_name([check_freshness(df, name, as_of=as_of) for name, df in tables.items()])


def monitoring_views(
    spark: SparkSession, warehouse: str, maintained: bool = False
) -> dict[str, DataFrame]:
    """The monitoring views over a warehouse, also registered as temp views.

    With ``maintained`` they come from aggregates kept by day, which are first
    brought up to date for the dates that changed.
    """
    log = wh.read_load_log(spark, warehouse)
    if maintained:
        catalog.refresh_aggregates(spark, warehouse)
        kept = {name: catalog.read_aggregate(spark, warehouse, name) for name in monitoring.DAILY_AGGREGATES}
        views = monitoring.views_of_aggregates(kept, log)
    else:
        views = monitoring.monitoring_views(wh.read_tables(spark, warehouse), log)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views
