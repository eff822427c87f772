"""Queries over the feeds: parsing, rules, joins, P&L, rejects, metrics and gate."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from checks import feeds as X
from checks.oracles import expect, expect_daily
from checks.registry import query
from daybook import schemas as S
from daybook.functions import money
from daybook.functions.rules import valid_rows
from daybook.operators import gate as G
from daybook.operators.market import market_rejects, process_market, tag_market, valid_prices
from daybook.operators.metrics import build_metrics, metrics_json, run_totals, total_realized_pnl
from daybook.operators.portfolio import (
    explode_positions,
    judge_positions,
    portfolio_rejects,
    portfolio_rollup,
    price_positions,
    process_portfolios,
    tag_positions,
    value_positions,
)
from daybook.operators.prices import fits_broadcast, price_lookup
from daybook.operators.rejects import (
    rejection_counts,
    rejection_rollup,
    union_all_by_name,
)
from daybook.operators.trades import (
    PRICED_COLUMNS,
    TRADE_TAGS,
    decode_side,
    parse_tagged,
    process_trades,
    tag_trades,
    trade_pnl,
    trade_rejects,
    type_trades,
)
from daybook.plans.pipeline import half, stage
from daybook.sources.session import stored, work_folder

DAY = X.RUN_DATE
REJECT = ["source_name", "run_date", "record_identifier", "raw_record", "rejection_rule", "rejection_reason"]
REJECT_SQL = ", ".join(REJECT)
TRADE_SQL = """order_id, portfolio_id, symbol, side, quantity, trade_price, average_cost, currency,
  transact_time, trade_date"""
TRADE = TRADE_SQL.replace("\n", "").replace(" ", "").split(",")
PRICED_SQL = ", ".join(PRICED_COLUMNS)


def prices(spark, sf_dir, variant=X.FIXED, portfolio_prices=False, held=None):
    """Valid prices of the fixed date or of every date."""
    feed = X.market(spark, sf_dir, variant, portfolio_prices, held)
    return process_market(feed, F.col("dt"))[0]


def trades(spark, sf_dir, variant=X.FIXED, null_side_passes=False):
    """(valid, rejected) trades without the message header."""
    messages = X.messages(spark, sf_dir, variant)
    return process_trades(messages, F.col("dt"), null_side_passes, tags=TRADE_TAGS)


def all_rejects(spark, sf_dir, variant=X.FIXED, apart=False):
    """Rejects of all three feeds, stamped with the midnight of their date.

    With ``apart`` feeds are derived and written one after the other: what is shuffled for
    one is gone before the next.
    """
    stamp = F.col("run_date").cast("timestamp")
    day = F.col("dt")
    write = partial(stored, lean=True) if apart else lambda rows, _: rows
    valid_market, market = process_market(X.market(spark, sf_dir, variant), day, stamp)
    trade = write(process_trades(X.messages(spark, sf_dir, variant), day, rejected_at=stamp)[1], "trade-rejects")
    market = write(market, "market-rejects")
    held = write(X.positions(spark, sf_dir, variant), "positions")
    documents = X.documents(spark, sf_dir, variant, held)
    portfolio = process_portfolios(documents, day, valid_market, rejected_at=stamp)[1]
    return union_all_by_name([trade, market, portfolio])


# --- projections, parsing and rules --------------------------------------------------


@query("tag_parse", expect("""
    SELECT begin_string, message_type, NULL::VARCHAR AS sender_comp_id, NULL::VARCHAR AS target_comp_id,
      NULL::VARCHAR AS message_sequence_number, order_id, portfolio_id, symbol, side_code, quantity,
      trade_price, average_cost, currency, transact_time FROM message_fields"""))
def tag_parse(spark, sf_dir):
    return parse_tagged(X.messages(spark, sf_dir)).select(*S.TAG_COLUMNS.values())


@query("side_decode", expect("""
    SELECT side_code, CASE side_code WHEN '1' THEN 'BUY' WHEN '2' THEN 'SELL' END AS side,
      count(*) AS messages FROM message_fields GROUP BY ALL"""))
def side_decode(spark, sf_dir):
    parsed = parse_tagged(X.messages(spark, sf_dir), {"54": "side_code"})
    return parsed.groupBy("side_code", decode_side().alias("side")).agg(F.count("*").alias("messages"))


@query("trade_typed", expect(f"SELECT {TRADE_SQL} FROM typed_trades"), dates="transact_time trade_date")
def trade_typed(spark, sf_dir):
    return type_trades(parse_tagged(X.messages(spark, sf_dir))).select(*TRADE)


@query("trade_valid", expect(f"SELECT {TRADE_SQL} FROM judged_trades WHERE rule IS NULL"),
       dates="transact_time trade_date")
def trade_valid(spark, sf_dir):
    return process_trades(X.messages(spark, sf_dir), DAY)[0].select(*TRADE)


@query("trade_valid_null_side", expect(
    f"SELECT {TRADE_SQL} FROM judged_trades WHERE rule IS NULL", null_side_passes=True),
    dates="transact_time trade_date")
def trade_valid_null_side(spark, sf_dir):
    """A message without a side passes, as a switch."""
    return process_trades(X.messages(spark, sf_dir), DAY, null_side_passes=True)[0].select(*TRADE)


@query("trade_rejections", expect(
    f"SELECT {REJECT_SQL} FROM rejected_records WHERE source_name = 'trades'"), dates="run_date")
def trade_rejections(spark, sf_dir):
    return process_trades(X.messages(spark, sf_dir), DAY)[1].select(*REJECT)


@query("trade_rule_counts", expect("""
    SELECT coalesce(rule, 'valid') AS verdict, count(*) AS messages FROM judged_trades GROUP BY ALL"""))
def trade_rule_counts(spark, sf_dir):
    verdict = F.coalesce("rejection_rule", F.lit("valid")).alias("verdict")
    tagged = tag_trades(X.messages(spark, sf_dir), DAY)
    return tagged.groupBy(verdict).agg(F.count("*").alias("messages"))


MARKET_SQL = """symbol, asset_class, close_price, currency, fx_rate_to_usd, price_date,
  normalized_symbol, effective_fx_rate_to_usd"""
MARKET = MARKET_SQL.replace("\n", "").replace(" ", "").split(",")


@query("market_valid", expect(f"SELECT {MARKET_SQL} FROM valid_prices"), dates="price_date")
def market_valid(spark, sf_dir):
    return process_market(X.market(spark, sf_dir), DAY)[0].select(*MARKET)


@query("market_rejections", expect(
    f"SELECT {REJECT_SQL} FROM rejected_records WHERE source_name = 'market_data'"), dates="run_date")
def market_rejections(spark, sf_dir):
    return process_market(X.market(spark, sf_dir), DAY)[1].select(*REJECT)


@query("effective_fx", expect("""
    SELECT upper(trim(currency)) AS currency, count(*) AS quotes,
      min(CASE WHEN upper(trim(currency)) = 'USD' THEN CAST(1 AS DECIMAL(20,10)) ELSE fx_rate_to_usd END) AS lowest_rate,
      max(CASE WHEN upper(trim(currency)) = 'USD' THEN CAST(1 AS DECIMAL(20,10)) ELSE fx_rate_to_usd END) AS highest_rate
    FROM feed_prices GROUP BY 1"""))
def effective_fx(spark, sf_dir):
    """The rate of every quote, valid or not."""
    rate = money.effective_fx(F.col("currency"), F.col("fx_rate_to_usd"))
    return tag_market(X.market(spark, sf_dir), DAY).groupBy("currency").agg(
        F.count("*").alias("quotes"),
        F.min(rate).alias("lowest_rate"),
        F.max(rate).alias("highest_rate"),
    )


@query("price_lookup", expect_daily("""
    SELECT normalized_symbol AS market_symbol, price_date, close_price, currency AS market_currency,
      effective_fx_rate_to_usd AS fx_rate_to_usd FROM valid_prices"""), dates="price_date")
def price_lookup_daily(spark, sf_dir):
    return price_lookup(prices(spark, sf_dir, X.DAILY))


POSITION_SQL = """source_run_date, portfolio_id, portfolio_name, symbol, position_quantity,
  position_currency, average_cost, max_market_value_usd, max_daily_loss_usd,
  max_position_concentration_pct, normalized_symbol"""
POSITION = POSITION_SQL.replace("\n", "").replace(" ", "").split(",")


@query("positions_exploded", expect(f"SELECT {POSITION_SQL} FROM judged_positions"),
       dates="source_run_date")
def positions_exploded(spark, sf_dir):
    return explode_positions(X.documents(spark, sf_dir)).select(*POSITION)


@query("portfolio_rejections", expect(
    f"SELECT {REJECT_SQL} FROM rejected_records WHERE source_name = 'portfolio'"), dates="run_date")
def portfolio_rejections(spark, sf_dir):
    market = prices(spark, sf_dir)
    return process_portfolios(X.documents(spark, sf_dir), DAY, market)[1].select(*REJECT)


# --- joins, valuation and P&L ---------------------------------------------------------


@query("position_values", expect("""
    SELECT portfolio_id, normalized_symbol, market_value_local, market_value_usd,
      unrealized_pnl_local, unrealized_pnl_usd FROM valued_positions"""))
def position_values(spark, sf_dir):
    tagged = tag_positions(X.documents(spark, sf_dir), DAY, prices(spark, sf_dir))
    return value_positions(tagged).select(
        "portfolio_id", "normalized_symbol", "market_value_local", "market_value_usd",
        "unrealized_pnl_local", "unrealized_pnl_usd",
    )


PORTFOLIO_SQL = ", ".join(S.TABLES["portfolio_pnl"].columns)


@query("portfolio_pnl", expect(f"SELECT {PORTFOLIO_SQL} FROM portfolio_pnl"), dates="pnl_date")
def portfolio_pnl(spark, sf_dir):
    return process_portfolios(X.documents(spark, sf_dir), DAY, prices(spark, sf_dir))[0]


@query("portfolio_pnl_daily", expect_daily(
    f"SELECT {PORTFOLIO_SQL} FROM portfolio_pnl", portfolio_prices=True), dates="pnl_date")
def portfolio_pnl_daily(spark, sf_dir):
    """Documents of many dates in one job, through the shuffled price join."""
    held = stored(X.positions(spark, sf_dir, X.DAILY), "positions", lean=True)  # for prices and documents
    market = prices(spark, sf_dir, X.DAILY, portfolio_prices=True, held=held)
    documents = X.documents(spark, sf_dir, X.DAILY, held)
    return process_portfolios(documents, F.col("dt"), market, small=False)[0]


@query("risk_breaches", expect("""
    SELECT portfolio_id, pnl_date, market_value_limit_breached, daily_loss_limit_breached
    FROM portfolio_pnl WHERE market_value_limit_breached OR daily_loss_limit_breached"""),
    dates="pnl_date")
def risk_breaches(spark, sf_dir):
    return portfolio_pnl.__wrapped__(spark, sf_dir).where(
        "market_value_limit_breached OR daily_loss_limit_breached"
    ).select("portfolio_id", "pnl_date", "market_value_limit_breached", "daily_loss_limit_breached")


@query("trade_pnl", expect(f"SELECT {PRICED_SQL} FROM clean_trades"), dates="transact_time trade_date")
def clean_trades(spark, sf_dir):
    valid = trades(spark, sf_dir)[0]
    return trade_pnl(valid, prices(spark, sf_dir))[0]


@query("trade_pnl_daily", expect_daily(f"SELECT {PRICED_SQL} FROM clean_trades"),
       dates="transact_time trade_date")
def clean_trades_daily(spark, sf_dir):
    """Many dates in one job, through the shuffled price join."""
    valid = trades(spark, sf_dir, X.DAILY)[0]
    return trade_pnl(valid, prices(spark, sf_dir, X.DAILY), small=False)[0]


@query("trade_pnl_null_side", expect(
    "SELECT side, pnl_unresolvable, count(*) AS trades, count(realized_pnl_usd) AS with_pnl FROM clean_trades GROUP BY ALL",
    null_side_passes=True))
def clean_trades_null_side(spark, sf_dir):
    """A trade that passed without a side has no P&L, yet is not unresolvable."""
    valid = trades(spark, sf_dir, null_side_passes=True)[0]
    clean = trade_pnl(valid, prices(spark, sf_dir))[0]
    return clean.groupBy("side", "pnl_unresolvable").agg(
        F.count("*").alias("trades"), F.count("realized_pnl_usd").alias("with_pnl")
    )


@query("unresolvable_pnl", expect(f"""
    SELECT {TRADE_SQL}, 'No valid same-date market price or FX rate was available.' AS unresolvable_reason
    FROM clean_trades WHERE pnl_unresolvable"""), dates="transact_time trade_date")
def unresolvable_pnl(spark, sf_dir):
    valid = trades(spark, sf_dir)[0]
    unresolvable = trade_pnl(valid, prices(spark, sf_dir))[1]
    return unresolvable.select(*S.TABLES["unresolvable_pnl"].columns)


# --- rejects, metrics and gate --------------------------------------------------------


@query("union_rejections", expect(f"SELECT {REJECT_SQL} FROM rejected_records"), dates="run_date")
def union_rejections(spark, sf_dir):
    return all_rejects(spark, sf_dir).select(*REJECT)


@query("rejection_counts", expect("""
    SELECT source_name, rejection_rule, count(*) AS rejected_record_count
    FROM rejected_records GROUP BY ALL"""))
def rejection_counts_(spark, sf_dir):
    return rejection_counts(all_rejects(spark, sf_dir))


@query("rejection_rollup", expect("""
    SELECT source_name, rejection_rule, count(*) AS rejected_record_count,
      CASE grouping(source_name, rejection_rule) WHEN 0 THEN 'source_rule' WHEN 1 THEN 'source'
        WHEN 2 THEN 'rule' ELSE 'total' END AS level
    FROM rejected_records
    GROUP BY GROUPING SETS ((source_name, rejection_rule), (source_name), (rejection_rule), ())"""))
def rejection_rollup_(spark, sf_dir):
    return rejection_rollup(all_rejects(spark, sf_dir))


def staged(spark, sf_dir, variant=X.FIXED):
    """Valid trades, clean trades, rejects and portfolios, each feed parsed once.

    The tagged feeds are written to a work folder first, as the pipeline does.
    """
    work = work_folder(spark, "staged")
    day, stamp = F.col("dt"), F.col("run_date").cast("timestamp")
    market = stage(tag_market(X.market(spark, sf_dir, variant), day), f"{work}/market")
    quotes = valid_prices(half(market, rejected=False))
    messages = X.messages(spark, sf_dir, variant)
    tagged = tag_trades(messages, day, tags=TRADE_TAGS)
    # A valid message is fully parsed; only rejects need their text again.
    message = F.when(F.col("rejection_rule").isNotNull(), F.col("raw_record"))
    trades = stage(tagged.withColumn("raw_record", message), f"{work}/trades")
    documents = X.documents(spark, sf_dir, variant)
    small = fits_broadcast(price_lookup(quotes))
    judged = judge_positions(documents, day)
    if not small:
        # The shuffled join reads its rows twice; spare the documents a second parse.
        judged = stage(judged, f"{work}/documents").drop("is_rejected")
    positions = stage(price_positions(judged, quotes, small, in_files=not small), f"{work}/positions")
    valid = valid_rows(half(trades, rejected=False))
    rejected = union_all_by_name(
        [
            trade_rejects(half(trades, rejected=True), stamp),
            market_rejects(half(market, rejected=True), stamp),
            portfolio_rejects(half(positions, rejected=True), stamp),
        ]
    )
    portfolio = portfolio_rollup(value_positions(half(positions, rejected=False)))
    return valid, trade_pnl(valid, quotes, small, in_files=True)[0], rejected, portfolio


def totals(spark, sf_dir, variant=X.FIXED, parts=None):
    """(totals per date, rejects) of the given staged parts or of new ones."""
    valid, clean, rejected, portfolio = parts or staged(spark, sf_dir, variant)
    return run_totals(valid, clean, rejected, portfolio), rejected


_RUN_COUNTS = ("run_counts", """
    SELECT run_date,
      CAST(sum(valid) AS BIGINT) AS valid_trade_count,
      CAST(sum(clean) AS BIGINT) AS clean_trade_count,
      CAST(sum(unresolvable) AS BIGINT) AS pnl_unresolvable_count,
      CAST(sum(rejected) AS BIGINT) AS total_rejection_count,
      CAST(sum(rejected_trades) AS BIGINT) AS trade_rejection_count,
      CAST(sum(portfolios) AS BIGINT) AS portfolio_pnl_count,
      CAST(sum(pnl) AS DECIMAL(24,4)) AS total_realized_pnl_usd,
      CAST(sum(valid) + sum(rejected_trades) AS BIGINT) AS total_trade_count
    FROM (
      SELECT run_date, 1 AS valid, 0 AS clean, 0 AS unresolvable, 0 AS rejected, 0 AS rejected_trades,
        0 AS portfolios, NULL::DECIMAL(24,4) AS pnl FROM judged_trades WHERE rule IS NULL
      UNION ALL SELECT trade_date, 0, 1, pnl_unresolvable::INT, 0, 0, 0, realized_pnl_usd FROM clean_trades
      UNION ALL SELECT run_date, 0, 0, 0, 1, (source_name = 'trades')::INT, 0, NULL FROM rejected_records
      UNION ALL SELECT pnl_date, 0, 0, 0, 0, 0, 1, NULL FROM portfolio_pnl
    ) u GROUP BY run_date""")


@query("run_counts", expect_daily("SELECT * FROM run_counts", _RUN_COUNTS), dates="run_date")
def run_counts(spark, sf_dir):
    counts = totals(spark, sf_dir, X.DAILY)[0]
    return counts.withColumn("total_realized_pnl_usd", F.col("total_realized_pnl_usd").cast(S.MONEY))


@query("total_realized_pnl", expect("""
    SELECT CAST(sum(realized_pnl_usd) AS DECIMAL(24,4)) AS total_realized_pnl_usd FROM clean_trades"""))
def total_realized(spark, sf_dir):
    clean = clean_trades.__wrapped__(spark, sf_dir)
    return clean.agg(total_realized_pnl().cast(S.MONEY).alias("total_realized_pnl_usd"))


_METRICS = ("metrics", """
    SELECT *, CASE WHEN total_trade_count > 0 THEN round(trade_rejection_count::DOUBLE / total_trade_count, 6) ELSE 0 END AS trade_reject_rate,
      CASE WHEN total_trade_count > 0 THEN round(total_rejection_count::DOUBLE / total_trade_count, 6) ELSE 0 END AS overall_reject_rate
    FROM run_counts""")


@query("run_metrics", expect("""
    SELECT run_date, 'daily_feed_pipeline' AS pipeline_name, total_trade_count, clean_trade_count,
      trade_rejection_count, total_rejection_count, pnl_unresolvable_count, portfolio_pnl_count,
      CAST(total_realized_pnl_usd AS VARCHAR) AS total_realized_pnl_usd,
      trade_reject_rate, overall_reject_rate,
      (SELECT string_agg(rejection_rule || '=' || n, ',' ORDER BY rejection_rule)
        FROM (SELECT rejection_rule, count(*) AS n FROM rejected_records GROUP BY 1) r) AS by_rule,
      (SELECT string_agg(source_name || '=' || n, ',' ORDER BY source_name)
        FROM (SELECT source_name, count(*) AS n FROM rejected_records GROUP BY 1) r) AS by_source,
      trade_reject_rate < 0.02 AND pnl_unresolvable_count < 100 AS passed
    FROM metrics""", _RUN_COUNTS, _METRICS), dates="run_date")
def run_metrics(spark, sf_dir):
    metrics = build_metrics(*totals(spark, sf_dir))
    return metrics.select(
        "run_date", "pipeline_name", "total_trade_count", "clean_trade_count",
        "trade_rejection_count", "total_rejection_count", "pnl_unresolvable_count",
        "portfolio_pnl_count", "total_realized_pnl_usd", "trade_reject_rate", "overall_reject_rate",
        *[
            F.array_join(F.array_sort(F.transform(F.map_entries(whole), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",").alias(name)
            for whole, name in (("rejection_count_by_rule", "by_rule"), ("rejection_count_by_source", "by_source"))
        ],
        F.col("quality_gate.passed").alias("passed"),
    )


@query("metrics_document")
def metrics_document(spark, sf_dir):
    """The metrics as one JSON line per date."""
    return metrics_json(build_metrics(*totals(spark, sf_dir)))


@query("quality_gate", expect_daily("""
    SELECT run_date, trade_reject_rate, pnl_unresolvable_count,
      trade_reject_rate < 0.05 AND pnl_unresolvable_count < 5 AS passed
    FROM metrics""", _RUN_COUNTS, _METRICS), dates="run_date")
def quality_gate(spark, sf_dir):
    """The gate per date with thresholds of its own."""
    metrics = build_metrics(*totals(spark, sf_dir, X.DAILY))
    judged = G.quality_gate(metrics, max_reject_rate=0.05, max_unresolvable=5)
    return judged.select("run_date", "trade_reject_rate", "pnl_unresolvable_count", "passed")


@query("gate_disagreement", expect_daily("""
    SELECT run_date, trade_reject_rate < 0.02 AND pnl_unresolvable_count < 100 AS recorded_passed,
      trade_reject_rate < 0.05 AND pnl_unresolvable_count < 5 AS passed,
      (trade_reject_rate < 0.02 AND pnl_unresolvable_count < 100)
        <> (trade_reject_rate < 0.05 AND pnl_unresolvable_count < 5) AS disagrees
    FROM metrics""", _RUN_COUNTS, _METRICS), dates="run_date")
def gate_disagreement(spark, sf_dir):
    """Dates on which other thresholds overturn the recorded verdict."""
    metrics = build_metrics(*totals(spark, sf_dir, X.DAILY))
    judged = G.quality_gate(metrics, max_reject_rate=0.05, max_unresolvable=5)
    return judged.select("run_date", "recorded_passed", "passed", "disagrees")


@query("gate_missing_metrics", expect_daily("""
    SELECT run_date, CASE WHEN trade_rejection_count > 0 THEN '' ELSE 'trade_reject_rate' END AS missing_metrics,
      CASE WHEN trade_rejection_count > 0 THEN trade_reject_rate < 0.02 AND pnl_unresolvable_count < 100 END AS passed
    FROM metrics""", _RUN_COUNTS, _METRICS), dates="run_date")
def gate_missing_metrics(spark, sf_dir):
    """Documents that lost their rate get a name for it and no verdict."""
    metrics = build_metrics(*totals(spark, sf_dir, X.DAILY))
    lost = F.col("trade_rejection_count") == 0
    rate = F.when(~lost, F.col("trade_reject_rate"))
    damaged = metrics.withColumn("trade_reject_rate", rate).withColumn(
        "quality_gate", F.col("quality_gate").withField("trade_reject_rate", rate)
    )
    return G.quality_gate(damaged).select("run_date", "missing_metrics", "passed")
