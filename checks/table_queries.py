"""Queries over the warehouse tables: models, monitoring views and contracts.

Tables carry a load stamp derived from the row, so that results can be compared.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks import feeds as X
from checks.feed_queries import PORTFOLIO_SQL, PRICED_SQL, all_rejects, prices, staged, totals, trades
from checks.oracles import expect, expect_daily
from checks.registry import query
from daybook import schemas as S
from daybook.operators import contracts as C
from daybook.operators.identity import with_content_ids
from daybook.operators.metrics import build_metrics
from daybook.operators.portfolio import process_portfolios
from daybook.operators.rejects import union_all_by_name
from daybook.operators.trades import trade_pnl, unresolvable_trades
from daybook.plans import models as M
from daybook.plans import monitoring as V
from daybook.sources.session import stored

AS_OF = datetime(2026, 8, 5, 12, 0, 0)


def processed_trades(spark, sf_dir, variant=X.DAILY, null_side_passes=False):
    valid = trades(spark, sf_dir, variant, null_side_passes)[0]
    clean = trade_pnl(valid, prices(spark, sf_dir, variant))[0]
    return clean.withColumn("loaded_at", F.col("transact_time") + F.expr("INTERVAL 1 HOUR"))


def portfolio_table(spark, sf_dir):
    held = stored(X.positions(spark, sf_dir, X.DAILY), "positions", lean=True)  # for prices and documents
    market = prices(spark, sf_dir, X.DAILY, portfolio_prices=True, held=held)
    pnl = process_portfolios(X.documents(spark, sf_dir, X.DAILY, held), F.col("dt"), market)[0]
    return pnl.withColumn("loaded_at", F.col("pnl_date").cast("timestamp"))


def rejected_records(spark, sf_dir, variant=X.DAILY):
    rows = stored(all_rejects(spark, sf_dir, variant, True), "rejects", lean=True)  # for counting and for numbering
    rejected = with_content_ids(rows, "rejection_id", ("rejected_at",))
    return rejected.withColumn("loaded_at", F.col("rejected_at") + F.expr("INTERVAL 1 HOUR"))


def tables(spark, sf_dir, parts=None):
    """The four tables of the fixed run date, from the given staged parts or from new ones."""
    _, clean, rejected, portfolio = parts or staged(spark, sf_dir)
    frames = {
        "processed_trades": clean,
        "portfolio_pnl": portfolio,
        "rejected_records": with_content_ids(rejected, "rejection_id", ("rejected_at",)),
        "unresolvable_pnl": unresolvable_trades(clean).select(*S.TABLES["unresolvable_pnl"].columns),
    }
    return {name: df.withColumn("loaded_at", F.lit(AS_OF)) for name, df in frames.items()}


def load_log(spark, sf_dir):
    return X.feed(spark, sf_dir, "feed_load_log")


# --- staging models and marts ---------------------------------------------------------


@query("stg_processed_trades", expect_daily(f"""
    SELECT {PRICED_SQL}, transact_time + INTERVAL 1 HOUR AS loaded_at FROM clean_trades"""),
    dates="transact_time trade_date loaded_at")
def stg_processed_trades(spark, sf_dir):
    return M.stg_processed_trades(processed_trades(spark, sf_dir))


@query("stg_portfolio_pnl", expect_daily(
    f"SELECT {PORTFOLIO_SQL}, CAST(pnl_date AS TIMESTAMP) AS loaded_at FROM portfolio_pnl",
    portfolio_prices=True), dates="pnl_date loaded_at")
def stg_portfolio_pnl(spark, sf_dir):
    return M.stg_portfolio_pnl(portfolio_table(spark, sf_dir))


@query("stg_rejected_records", expect_daily("""
    SELECT source_name, run_date, record_identifier, raw_record, rejection_rule, rejection_reason,
      CAST(run_date AS TIMESTAMP) AS rejected_at, run_date + INTERVAL 1 HOUR AS loaded_at
    FROM rejected_records"""), dates="run_date rejected_at loaded_at")
def stg_rejected_records(spark, sf_dir):
    return M.stg_rejected_records(rejected_records(spark, sf_dir)).drop("rejection_id")


@query("fct_daily_trading_pnl", expect_daily("""
    SELECT trade_date, portfolio_id, symbol, count(*) AS trade_count,
      CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE 0 END) AS DECIMAL(30,4)) AS buy_quantity,
      CAST(sum(CASE WHEN side = 'SELL' THEN quantity ELSE 0 END) AS DECIMAL(30,4)) AS sell_quantity,
      CAST(sum(realized_pnl_local) AS DECIMAL(34,4)) AS realized_pnl_local,
      CAST(sum(realized_pnl_usd) AS DECIMAL(34,4)) AS realized_pnl_usd,
      CAST(sum(CASE WHEN pnl_unresolvable THEN 1 ELSE 0 END) AS BIGINT) AS unresolvable_trade_count,
      max(transact_time + INTERVAL 1 HOUR) AS latest_loaded_at
    FROM clean_trades GROUP BY ALL"""), dates="trade_date latest_loaded_at")
def fct_daily_trading_pnl(spark, sf_dir):
    return M.fct_daily_trading_pnl(M.stg_processed_trades(processed_trades(spark, sf_dir)))


@query("fct_portfolio_risk", expect_daily(f"""
    SELECT {PORTFOLIO_SQL},
      CASE WHEN market_value_limit_breached OR daily_loss_limit_breached THEN 'BREACH'
        ELSE 'WITHIN_LIMIT' END AS risk_status,
      CASE WHEN max_market_value_usd <> 0 THEN
        CAST(CAST((2 * CAST(abs(total_market_value_usd) * 10000 AS HUGEINT) * 1000000
          + CAST(max_market_value_usd * 10000 AS HUGEINT))
          // (2 * CAST(max_market_value_usd * 10000 AS HUGEINT)) AS DECIMAL(18,0))
          * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(24,6)) END AS market_value_limit_utilization,
      CAST(pnl_date AS TIMESTAMP) AS latest_loaded_at
    FROM portfolio_pnl""", portfolio_prices=True), dates="pnl_date latest_loaded_at")
def fct_portfolio_risk(spark, sf_dir):
    risk = M.fct_portfolio_risk(M.stg_portfolio_pnl(portfolio_table(spark, sf_dir)))
    # The mart keeps 14 decimal places, the comparison looks at six.
    return risk.withColumn(
        "market_value_limit_utilization",
        F.col("market_value_limit_utilization").cast("decimal(24,6)"),
    )


@query("fct_daily_data_quality", expect_daily("""
    SELECT run_date, source_name, rejection_rule, count(*) AS rejected_record_count,
      CAST(run_date AS TIMESTAMP) AS latest_rejection_at, run_date + INTERVAL 1 HOUR AS latest_loaded_at
    FROM rejected_records GROUP BY run_date, source_name, rejection_rule"""),
    dates="run_date latest_rejection_at latest_loaded_at")
def fct_daily_data_quality(spark, sf_dir):
    return M.fct_daily_data_quality(M.stg_rejected_records(rejected_records(spark, sf_dir)))


# --- monitoring -------------------------------------------------------------------------


_SECONDS = "(epoch_us({end}) - epoch_us({start})) / 1000000.0::DOUBLE"


@query("v_pipeline_load_summary", X.oracle(f"""
    SELECT *, {_SECONDS.format(start='load_started_at', end='load_completed_at')} AS load_duration_seconds
    FROM (
      SELECT dag_id, airflow_run_id, run_date, count(*) AS load_task_count,
        CAST(sum(rows_deleted) AS BIGINT) AS total_rows_deleted,
        CAST(sum(rows_inserted) AS BIGINT) AS total_rows_inserted,
        count(*) FILTER (WHERE load_status = 'SUCCESS') AS successful_load_count,
        count(*) FILTER (WHERE load_status = 'FAILED') AS failed_load_count,
        min(started_at) AS load_started_at, max(completed_at) AS load_completed_at
      FROM feed_load_log GROUP BY ALL) t"""), dates="run_date load_started_at load_completed_at")
def v_pipeline_load_summary(spark, sf_dir):
    return V.v_pipeline_load_summary(load_log(spark, sf_dir))


@query("v_table_load_metrics", X.oracle(f"""
    SELECT load_id, dag_id, airflow_run_id, run_date, target_table, rows_deleted, rows_inserted,
      load_status, started_at, completed_at,
      {_SECONDS.format(start='started_at', end='completed_at')} AS duration_seconds, error_message
    FROM feed_load_log"""), dates="run_date started_at completed_at")
def v_table_load_metrics(spark, sf_dir):
    return V.v_table_load_metrics(load_log(spark, sf_dir))


@query("latest_loads", X.oracle("""
    SELECT target_table, rows_deleted, rows_inserted, load_status, started_at, completed_at
    FROM feed_load_log ORDER BY load_id DESC LIMIT 10"""), dates="started_at completed_at")
def latest_loads(spark, sf_dir):
    return V.latest_loads(load_log(spark, sf_dir))


@query("v_daily_trade_metrics", expect_daily("""
    SELECT trade_date AS metric_date, count(*) AS processed_trade_count,
      count(*) FILTER (WHERE pnl_unresolvable) AS unresolvable_trade_count,
      count(*) FILTER (WHERE side = 'BUY') AS buy_trade_count,
      count(*) FILTER (WHERE side = 'SELL') AS sell_trade_count,
      CAST(coalesce(sum(realized_pnl_usd), 0) AS DECIMAL(24,4)) AS total_realized_pnl_usd,
      count(DISTINCT portfolio_id) AS portfolio_count, count(DISTINCT symbol) AS symbol_count
    FROM clean_trades GROUP BY trade_date"""), dates="metric_date")
def v_daily_trade_metrics(spark, sf_dir):
    daily = V.v_daily_trade_metrics(processed_trades(spark, sf_dir))
    return daily.withColumn("total_realized_pnl_usd", F.col("total_realized_pnl_usd").cast(S.MONEY))


@query("v_daily_rejection_metrics", expect_daily("""
    SELECT run_date AS metric_date, count(*) AS rejected_record_count,
      count(*) FILTER (WHERE source_name = 'trades') AS rejected_trade_count,
      count(*) FILTER (WHERE source_name = 'market_data') AS rejected_market_count,
      count(*) FILTER (WHERE source_name = 'portfolio') AS rejected_portfolio_count,
      count(DISTINCT rejection_rule) AS rejection_rule_count
    FROM rejected_records GROUP BY run_date"""), dates="metric_date")
def v_daily_rejection_metrics(spark, sf_dir):
    return V.v_daily_rejection_metrics(rejected_records(spark, sf_dir))


@query("v_daily_quality_metrics", expect_daily("""
    SELECT metric_date, accepted_trade_count, rejected_trade_count, total_rejected_count, unresolvable_count,
      CASE WHEN accepted_trade_count + rejected_trade_count = 0 THEN 0.0::DOUBLE
        ELSE rejected_trade_count::DOUBLE / (accepted_trade_count + rejected_trade_count)::DOUBLE END AS trade_reject_rate,
      CASE WHEN accepted_trade_count + rejected_trade_count = 0 THEN FALSE
        ELSE rejected_trade_count * 50 < accepted_trade_count + rejected_trade_count
          AND unresolvable_count < 100 END AS quality_gate_passed
    FROM (
      SELECT coalesce(t.metric_date, r.metric_date) AS metric_date,
        coalesce(accepted_trade_count, 0) AS accepted_trade_count,
        coalesce(rejected_trade_count, 0) AS rejected_trade_count,
        coalesce(total_rejected_count, 0) AS total_rejected_count,
        coalesce(unresolvable_count, 0) AS unresolvable_count
      FROM (SELECT trade_date AS metric_date, count(*) AS accepted_trade_count,
              count(*) FILTER (WHERE pnl_unresolvable) AS unresolvable_count
            FROM clean_trades GROUP BY 1) t
      FULL JOIN (SELECT run_date AS metric_date,
              count(*) FILTER (WHERE source_name = 'trades') AS rejected_trade_count,
              count(*) AS total_rejected_count FROM rejected_records GROUP BY 1) r
        ON t.metric_date = r.metric_date) j"""), dates="metric_date")
def v_daily_quality_metrics(spark, sf_dir):
    _, clean, rejected, _ = staged(spark, sf_dir, X.DAILY)
    return V.v_daily_quality_metrics(clean, rejected)


@query("v_portfolio_risk_summary", expect_daily("""
    SELECT pnl_date AS metric_date, count(*) AS portfolio_count,
      count(*) FILTER (WHERE market_value_limit_breached) AS market_value_breach_count,
      count(*) FILTER (WHERE daily_loss_limit_breached) AS daily_loss_breach_count,
      count(*) FILTER (WHERE market_value_limit_breached OR daily_loss_limit_breached) AS total_breached_portfolios,
      CAST(coalesce(sum(total_market_value_usd), 0) AS DECIMAL(24,4)) AS total_market_value_usd,
      CAST(coalesce(sum(total_unrealized_pnl_usd), 0) AS DECIMAL(24,4)) AS total_unrealized_pnl_usd
    FROM portfolio_pnl GROUP BY pnl_date""", portfolio_prices=True), dates="metric_date")
def v_portfolio_risk_summary(spark, sf_dir):
    summary = V.v_portfolio_risk_summary(portfolio_table(spark, sf_dir))
    sums = ["total_market_value_usd", "total_unrealized_pnl_usd"]
    return summary.withColumns({c: F.col(c).cast(S.MONEY) for c in sums})


@query("v_rejections_by_rule", expect_daily("""
    SELECT run_date AS metric_date, source_name, rejection_rule, count(*) AS rejected_record_count
    FROM rejected_records GROUP BY ALL"""), dates="metric_date")
def v_rejections_by_rule(spark, sf_dir):
    return V.v_rejections_by_rule(rejected_records(spark, sf_dir))


_ROW_COUNTS = """
    SELECT 'processed_trades' AS table_name, count(*) AS row_count FROM clean_trades
    UNION ALL SELECT 'portfolio_pnl', count(*) FROM portfolio_pnl
    UNION ALL SELECT 'rejected_records', count(*) FROM rejected_records
    UNION ALL SELECT 'unresolvable_pnl', count(*) FROM clean_trades WHERE pnl_unresolvable"""


@query("table_row_counts", expect(_ROW_COUNTS))
def table_row_counts(spark, sf_dir):
    return V.table_row_counts(tables(spark, sf_dir), X.RUN_DATE)


@query("rows_on_date", expect_daily(f"""
    SELECT {PRICED_SQL} FROM clean_trades WHERE trade_date = (SELECT min(run_date) FROM typed_trades)"""),
    dates="transact_time trade_date")
def rows_on_date(spark, sf_dir):
    """One date of the trades: the filter reaches the messages' own date column."""
    first = X.messages(spark, sf_dir, X.DAILY).agg(F.min("dt")).first()[0]
    return V.on_run_date(processed_trades(spark, sf_dir), "trade_date", first).drop("loaded_at")


@query("metrics_reconciliation", expect("""
    SELECT metric, n AS expected, n AS actual, TRUE AS ok FROM (
      SELECT 'clean_trade_count' AS metric, count(*) AS n FROM clean_trades
      UNION ALL SELECT 'portfolio_pnl_count', count(*) FROM portfolio_pnl
      UNION ALL SELECT 'total_rejection_count', count(*) FROM rejected_records
      UNION ALL SELECT 'pnl_unresolvable_count', count(*) FROM clean_trades WHERE pnl_unresolvable) t"""))
def metrics_reconciliation(spark, sf_dir):
    parts = staged(spark, sf_dir)
    metrics = build_metrics(*totals(spark, sf_dir, parts=parts))
    return V.reconcile_metrics(metrics, tables(spark, sf_dir, parts), X.RUN_DATE)


@query("sources_reconciliation", expect("""
    SELECT (SELECT min(run_date) FROM typed_trades) AS run_date, metric,
      CASE metric WHEN 'total_trade_count' THEN n WHEN 'clean_trade_count' THEN n + 1 END AS manifest_value,
      n AS run_value, CASE metric WHEN 'portfolio_pnl_count' THEN NULL ELSE n END AS table_value,
      CASE metric WHEN 'clean_trade_count' THEN 'different' WHEN 'portfolio_pnl_count' THEN 'missing in table' ELSE 'ok' END AS status
    FROM t
    UNION ALL SELECT (SELECT min(run_date) FROM typed_trades), 'planted_gap', 7, NULL, NULL, 'missing in run, table' """,
    ("t", """
      SELECT 'clean_trade_count' AS metric, count(*) AS n FROM clean_trades
      UNION ALL SELECT 'portfolio_pnl_count', count(*) FROM portfolio_pnl
      UNION ALL SELECT 'total_rejection_count', count(*) FROM rejected_records
      UNION ALL SELECT 'trade_rejection_count', count(*) FROM rejected_records WHERE source_name = 'trades'
      UNION ALL SELECT 'pnl_unresolvable_count', count(*) FROM clean_trades WHERE pnl_unresolvable
      UNION ALL SELECT 'total_trade_count', count(*) FROM judged_trades
      UNION ALL SELECT 'rule:' || rejection_rule, count(*) FROM rejected_records GROUP BY 1
      UNION ALL SELECT 'source:' || source_name, count(*) FROM rejected_records GROUP BY 1""")), dates="run_date")
def sources_reconciliation(spark, sf_dir):
    """Manifest, metrics and tables of a date, with a wrong count, a metric nobody else has and a table without its rows."""
    parts = staged(spark, sf_dir)
    metrics = build_metrics(*totals(spark, sf_dir, parts=parts))
    held = tables(spark, sf_dir, parts)
    held["portfolio_pnl"] = held["portfolio_pnl"].where("false")
    counts = metrics.select("run_date", "total_trade_count", (F.col("clean_trade_count") + 1).alias("clean_trade_count"), F.lit(7).cast("bigint").alias("planted_gap"))
    manifest = counts.unpivot(["run_date"], ["total_trade_count", "clean_trade_count", "planted_gap"], "metric", "value")
    manifest = manifest.withColumn("run_date", F.col("run_date").cast("date"))
    return V.reconcile_sources(manifest, metrics, held)


# --- data contracts ---------------------------------------------------------------------


def staging(spark, sf_dir):
    """Staging models of the fixed date; trades without a side are let through."""
    return {
        "stg_processed_trades": M.stg_processed_trades(
            processed_trades(spark, sf_dir, X.FIXED, null_side_passes=True)
        ),
        "stg_rejected_records": M.stg_rejected_records(rejected_records(spark, sf_dir, X.FIXED)),
    }


@query("contract_not_null", expect("""
    SELECT 'stg_processed_trades' AS "table", c.name AS "column", 'not_null' AS "check",
      CASE c.name WHEN 'side' THEN (SELECT count(*) FROM clean_trades WHERE side IS NULL)
        ELSE 0::BIGINT END AS failures,
      CASE WHEN c.name = 'side' AND (SELECT count(*) FROM clean_trades WHERE side IS NULL) > 0
        THEN 'fail' ELSE 'pass' END AS status
    FROM (VALUES ('order_id'), ('portfolio_id'), ('trade_date'), ('side'), ('quantity'),
      ('pnl_unresolvable')) c(name)""", null_side_passes=True))
def contract_not_null(spark, sf_dir):
    name = "stg_processed_trades"
    return C.check_not_null(staging(spark, sf_dir)[name], name, C.NOT_NULL_COLUMNS[name])


@query("contract_unique", """
    SELECT 'lineitem' AS "table", 'l_orderkey, l_linenumber' AS "column", 'unique' AS "check",
      count(*) AS failures, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d""")
def contract_unique(spark, sf_dir):
    return C.check_unique(X.table(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


@query("contract_accepted_values", """
    SELECT 'events' AS "table", 'event_type' AS "column", 'accepted_values' AS "check",
      count(DISTINCT event_type) AS failures,
      CASE WHEN count(DISTINCT event_type) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM events WHERE event_type NOT IN ('click', 'view')""")
def contract_accepted_values(spark, sf_dir):
    return C.check_accepted_values(
        X.table(spark, sf_dir, "events"), "events", "event_type", ["click", "view"]
    )


@query("contract_primary_key", expect("""
    SELECT 'processed_trades' AS "table", 'order_id, trade_date' AS "column", 'primary_key' AS "check",
      count(*) AS failures, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT 1 FROM clean_trades GROUP BY order_id, trade_date HAVING count(*) > 1) d"""))
def contract_primary_key(spark, sf_dir):
    return C.check_primary_key(
        processed_trades(spark, sf_dir, X.FIXED), S.TABLES["processed_trades"]
    )


@query("contract_required", expect("""
    SELECT 'rejected_records' AS "table", c.name AS "column", 'not_null' AS "check",
      0::BIGINT AS failures, 'pass' AS status
    FROM (VALUES ('rejection_id'), ('source_name'), ('run_date'), ('rejection_rule'),
      ('rejection_reason'), ('rejected_at'), ('loaded_at')) c(name)"""))
def contract_required(spark, sf_dir):
    return C.check_required(
        rejected_records(spark, sf_dir, X.FIXED), S.TABLES["rejected_records"]
    )


@query("contract_lengths", """
    SELECT 'part' AS "table", c.name AS "column", 'bounds' AS "check", c.failures,
      CASE WHEN c.failures = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (
      SELECT 'symbol' AS name, count(*) FILTER (WHERE length(p_name) > 6) AS failures FROM part
      UNION ALL SELECT 'price', count(*) FILTER (WHERE p_retailprice >= 999.995) FROM part) c""")
def contract_lengths(spark, sf_dir):
    """Names longer than six characters, and prices that NUMERIC(5,2) cannot hold."""
    contract = S.TableContract(
        name="part", output_path=None, partition_column=None, columns=["symbol", "price"],
        types={"symbol": "string", "price": S.T.DecimalType(5, 2)}, required=[], primary_key=[],
        max_lengths={"symbol": 6},
    )
    part = X.table(spark, sf_dir, "part")
    return C.check_lengths(
        part.select(F.col("p_name").alias("symbol"), F.col("p_retailprice").alias("price")), contract
    )


@query("source_freshness", """
    SELECT event_type AS "table", 'ts' AS "column", 'freshness' AS "check",
      CASE WHEN hours > 24 THEN 1 ELSE 0 END::BIGINT AS failures,
      CASE WHEN hours > 48 THEN 'error' WHEN hours > 24 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT event_type, (epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max(ts))) / 3.6e9 AS hours
      FROM events GROUP BY 1) t""")
def source_freshness(spark, sf_dir):
    events = X.table(spark, sf_dir, "events")
    as_of = datetime(2024, 1, 31, 12)
    return union_all_by_name([
        C.check_freshness(events.where(F.col("event_type") == kind), kind, "ts", as_of)
        for kind in sorted(r["event_type"] for r in events.select("event_type").distinct().collect())
    ])


@query("contract_table", expect("""
    SELECT "check", count(*) AS columns_checked, CAST(sum(failures) AS BIGINT) AS failures FROM (
      SELECT 'not_null' AS "check", 0 AS failures FROM range(12)
      UNION ALL SELECT 'bounds', 0 FROM range(8)
      UNION ALL SELECT 'primary_key', (SELECT count(*) FROM (SELECT 1 FROM clean_trades
        WHERE pnl_unresolvable GROUP BY order_id, trade_date HAVING count(*) > 1) d)) t
    GROUP BY 1"""))
def contract_table(spark, sf_dir):
    """Every declared constraint of one table."""
    report = C.check_table(
        tables(spark, sf_dir)["unresolvable_pnl"], S.TABLES["unresolvable_pnl"]
    )
    return report.groupBy("check").agg(
        F.count("*").alias("columns_checked"), F.sum("failures").alias("failures")
    )


@query("contract_models", expect("""
    SELECT "check", count(*) AS columns_checked, CAST(sum(failures) AS BIGINT) AS failures FROM (
      SELECT 'not_null' AS "check", 0 AS failures FROM range(8)
      UNION ALL SELECT 'not_null', (SELECT count(*) FROM clean_trades WHERE side IS NULL)
      UNION ALL SELECT 'unique', 0
      UNION ALL SELECT 'accepted_values', 0) t
    GROUP BY 1""", null_side_passes=True))
def contract_models(spark, sf_dir):
    """The column tests of two staging models."""
    return C.check_models(staging(spark, sf_dir)).groupBy("check").agg(
        F.count("*").alias("columns_checked"), F.sum("failures").alias("failures")
    )
