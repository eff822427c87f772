"""DuckDB text of the expected intermediate tables.

Everything here is computed from the feeds' columns, never from their raw
encodings, and shares no code with the library.
"""

from __future__ import annotations

from checks.feeds import DAILY, FIXED, oracle

# The reason each rule gives.
REASONS = {
    "TRADE_MISSING_ORDER_ID": "FIX tag 11 is missing.",
    "TRADE_MISSING_PORTFOLIO_ID": "FIX tag 1 is missing.",
    "TRADE_MISSING_SYMBOL": "FIX tag 55 is missing or empty.",
    "TRADE_INVALID_SIDE": "FIX tag 54 must be 1 for BUY or 2 for SELL.",
    "TRADE_INVALID_QUANTITY": "FIX tag 38 must contain a positive quantity.",
    "TRADE_INVALID_PRICE": "FIX tag 44 must contain a positive trade price.",
    "TRADE_INVALID_AVERAGE_COST": "FIX tag 6 must contain a non-negative average cost.",
    "TRADE_INVALID_CURRENCY": "FIX tag 15 must contain a three-character currency.",
    "TRADE_INVALID_TIMESTAMP": "FIX tag 60 must use the format YYYYMMDD-HH:MM:SS.",
    "TRADE_DATE_MISMATCH": "Trade date does not match the pipeline run date.",
    "MARKET_MISSING_SYMBOL": "Market-data symbol is missing.",
    "MARKET_INVALID_PRICE_DATE": "Market-data price date is invalid.",
    "MARKET_DATE_MISMATCH": "Market-data price date does not match the run date.",
    "MARKET_NULL_CLOSE_PRICE": "Close price is NULL; stale prices are not permitted.",
    "MARKET_NON_POSITIVE_CLOSE_PRICE": "Close price must be greater than zero.",
    "MARKET_INVALID_CURRENCY": "Market-data currency is invalid.",
    "MARKET_INVALID_FX_RATE": "A positive FX rate is required for non-USD prices.",
    "PORTFOLIO_DATE_MISMATCH": "Portfolio export date does not match the run date.",
    "PORTFOLIO_MISSING_ID": "Portfolio ID is missing.",
    "PORTFOLIO_MISSING_SYMBOL": "Portfolio position symbol is missing.",
    "PORTFOLIO_INVALID_QUANTITY": "Portfolio position quantity is invalid.",
    "PORTFOLIO_INVALID_CURRENCY": "Portfolio position currency is invalid.",
    "PORTFOLIO_MARKET_PRICE_UNAVAILABLE": "No valid same-date market price is available for the position.",
}

_REASONS = (
    "reasons",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{rule}', '{reason}')" for rule, reason in REASONS.items())
    + ") v(rule, reason)",
)

_MESSAGE_FIELDS = (
    "message_fields",
    """
    SELECT raw_record, dt AS run_date,
      CASE WHEN d<>13 THEN 'FIX.4.4' END AS begin_string,
      CASE WHEN d<>13 THEN 'D' END AS message_type,
      CASE WHEN d<>13 THEN nullif(trim(t11),'') END AS order_id,
      CASE WHEN d<>13 THEN nullif(trim(t1),'') END AS portfolio_id,
      CASE WHEN d<>13 THEN nullif(trim(t55),'') END AS symbol,
      CASE WHEN d<>13 THEN nullif(trim(t54),'') END AS side_code,
      CASE WHEN d<>13 THEN nullif(trim(t38),'') END AS quantity,
      CASE WHEN d<>13 THEN nullif(trim(t44),'') END AS trade_price,
      CASE WHEN d<>13 THEN nullif(trim(t6),'') END AS average_cost,
      CASE WHEN d<>13 THEN nullif(trim(t15),'') END AS currency,
      CASE WHEN d<>13 THEN nullif(trim(t60),'') END AS transact_time
    FROM feed_messages""",
)

_TYPED = (
    "typed_trades",
    r"""
    SELECT run_date, raw_record, order_id, portfolio_id, side_code,
      upper(regexp_replace(symbol, '\s+', '', 'g')) AS symbol,
      CASE side_code WHEN '1' THEN 'BUY' WHEN '2' THEN 'SELL' END AS side,
      TRY_CAST(quantity AS DECIMAL(20,4)) AS quantity,
      TRY_CAST(trade_price AS DECIMAL(20,8)) AS trade_price,
      TRY_CAST(average_cost AS DECIMAL(20,8)) AS average_cost,
      upper(trim(currency)) AS currency,
      try_strptime(transact_time, '%Y%m%d-%H:%M:%S') AS transact_time,
      CAST(try_strptime(transact_time, '%Y%m%d-%H:%M:%S') AS DATE) AS trade_date
    FROM message_fields""",
)


def _judged_trades(null_side_passes: bool) -> tuple[str, str]:
    side = "side_code NOT IN ('1','2')"
    if not null_side_passes:
        side = f"side_code IS NULL OR {side}"
    return (
        "judged_trades",
        f"""
        SELECT *, CASE
          WHEN order_id IS NULL THEN 'TRADE_MISSING_ORDER_ID'
          WHEN portfolio_id IS NULL THEN 'TRADE_MISSING_PORTFOLIO_ID'
          WHEN symbol IS NULL OR symbol = '' THEN 'TRADE_MISSING_SYMBOL'
          WHEN {side} THEN 'TRADE_INVALID_SIDE'
          WHEN quantity IS NULL OR quantity <= 0 THEN 'TRADE_INVALID_QUANTITY'
          WHEN trade_price IS NULL OR trade_price <= 0 THEN 'TRADE_INVALID_PRICE'
          WHEN average_cost IS NULL OR average_cost < 0 THEN 'TRADE_INVALID_AVERAGE_COST'
          WHEN currency IS NULL OR length(currency) <> 3 THEN 'TRADE_INVALID_CURRENCY'
          WHEN transact_time IS NULL THEN 'TRADE_INVALID_TIMESTAMP'
          WHEN trade_date <> run_date THEN 'TRADE_DATE_MISMATCH' END AS rule
        FROM typed_trades""",
    )


_JUDGED_MARKET = (
    "judged_market",
    r"""
    SELECT m.*, CASE
      WHEN normalized_symbol IS NULL OR normalized_symbol = '' THEN 'MARKET_MISSING_SYMBOL'
      WHEN price_date IS NULL THEN 'MARKET_INVALID_PRICE_DATE'
      WHEN price_date <> run_date THEN 'MARKET_DATE_MISMATCH'
      WHEN close_price IS NULL THEN 'MARKET_NULL_CLOSE_PRICE'
      WHEN close_price <= 0 THEN 'MARKET_NON_POSITIVE_CLOSE_PRICE'
      WHEN currency IS NULL OR length(currency) <> 3 THEN 'MARKET_INVALID_CURRENCY'
      WHEN currency <> 'USD' AND (fx_rate_to_usd IS NULL OR fx_rate_to_usd <= 0)
        THEN 'MARKET_INVALID_FX_RATE' END AS rule
    FROM (
      SELECT dt AS run_date, symbol, asset_class, close_price, upper(trim(currency)) AS currency,
        fx_rate_to_usd, price_date, upper(regexp_replace(symbol, '\s+', '', 'g')) AS normalized_symbol
      FROM feed_prices
    ) m""",
)

_PRICES = (
    "valid_prices",
    """
    SELECT run_date, symbol, asset_class, close_price, currency, fx_rate_to_usd, price_date,
      normalized_symbol,
      CASE WHEN currency = 'USD' THEN CAST(1 AS DECIMAL(20,10)) ELSE fx_rate_to_usd END
        AS effective_fx_rate_to_usd
    FROM judged_market WHERE rule IS NULL""",
)

_CLEAN = (
    "clean_trades",
    """
    SELECT order_id, portfolio_id, symbol, side, quantity, trade_price, average_cost, currency,
      transact_time, trade_date, close_price, market_currency, fx_rate_to_usd,
      CAST(CAST(CAST((close_price-average_cost)*quantity AS DECIMAL(38,8))*sign AS DECIMAL(38,6))
        AS DECIMAL(24,4)) AS realized_pnl_local,
      CAST(CAST(CAST(CAST((close_price-average_cost)*quantity AS DECIMAL(38,8))*sign
        AS DECIMAL(38,6))*fx_rate_to_usd AS DECIMAL(38,6)) AS DECIMAL(24,4)) AS realized_pnl_usd,
      close_price IS NULL AS pnl_unresolvable
    FROM (
      SELECT t.*, p.close_price, p.currency AS market_currency,
        p.effective_fx_rate_to_usd AS fx_rate_to_usd,
        CAST(CASE t.side WHEN 'BUY' THEN 1 WHEN 'SELL' THEN -1 END AS DECIMAL(2,0)) AS sign
      FROM judged_trades t LEFT JOIN valid_prices p
        ON t.symbol = p.normalized_symbol AND t.trade_date = p.price_date
      WHERE t.rule IS NULL
    ) j""",
)

_JUDGED_POSITIONS = (
    "judged_positions",
    r"""
    SELECT b.*, p.close_price, p.effective_fx_rate_to_usd AS fx_rate_to_usd,
      CASE WHEN b.base_rule IS NOT NULL THEN b.base_rule
        WHEN p.close_price IS NULL THEN 'PORTFOLIO_MARKET_PRICE_UNAVAILABLE' END AS rule,
      CASE WHEN b.base_rule IS NOT NULL THEN b.portfolio_id
        ELSE b.portfolio_id || ':' || b.normalized_symbol END AS record_identifier
    FROM (
      SELECT f.*, CASE
        WHEN source_run_date <> run_date THEN 'PORTFOLIO_DATE_MISMATCH'
        WHEN portfolio_id IS NULL THEN 'PORTFOLIO_MISSING_ID'
        WHEN normalized_symbol IS NULL OR normalized_symbol = '' THEN 'PORTFOLIO_MISSING_SYMBOL'
        WHEN position_quantity IS NULL THEN 'PORTFOLIO_INVALID_QUANTITY'
        WHEN position_currency IS NULL OR length(position_currency) <> 3
          THEN 'PORTFOLIO_INVALID_CURRENCY' END AS base_rule
      FROM (
        SELECT dt AS run_date, source_run_date, portfolio_id, portfolio_name, symbol,
          CAST(position_quantity AS DECIMAL(20,4)) AS position_quantity,
          upper(trim(currency)) AS position_currency, average_cost,
          max_market_value_usd, max_daily_loss_usd, max_position_concentration_pct,
          upper(regexp_replace(symbol, '\s+', '', 'g')) AS normalized_symbol
        FROM feed_positions
      ) f
    ) b LEFT JOIN valid_prices p
      ON b.base_rule IS NULL AND b.normalized_symbol = p.normalized_symbol
      AND b.source_run_date = p.price_date""",
)

_VALUED = (
    "valued_positions",
    """
    SELECT *,
      CAST(CAST(position_quantity*close_price AS DECIMAL(38,9)) AS DECIMAL(24,4)) AS market_value_local,
      CAST(CAST(CAST(position_quantity*close_price AS DECIMAL(38,9))*fx_rate_to_usd AS DECIMAL(38,6))
        AS DECIMAL(24,4)) AS market_value_usd,
      CAST(CAST((close_price-coalesce(average_cost,close_price))*position_quantity AS DECIMAL(38,8))
        AS DECIMAL(24,4)) AS unrealized_pnl_local,
      CAST(CAST(CAST((close_price-coalesce(average_cost,close_price))*position_quantity AS DECIMAL(38,8))
        *fx_rate_to_usd AS DECIMAL(38,6)) AS DECIMAL(24,4)) AS unrealized_pnl_usd
    FROM judged_positions WHERE rule IS NULL""",
)

_PORTFOLIO_PNL = (
    "portfolio_pnl",
    """
    SELECT *, abs(total_market_value_usd) > max_market_value_usd AS market_value_limit_breached,
      total_unrealized_pnl_usd < -max_daily_loss_usd AS daily_loss_limit_breached
    FROM (
      SELECT portfolio_id, portfolio_name, source_run_date AS pnl_date,
        CAST(count(*) AS BIGINT) AS position_count,
        CAST(sum(market_value_usd) AS DECIMAL(24,4)) AS total_market_value_usd,
        CAST(sum(unrealized_pnl_usd) AS DECIMAL(24,4)) AS total_unrealized_pnl_usd,
        max_market_value_usd, max_daily_loss_usd, max_position_concentration_pct
      FROM valued_positions GROUP BY ALL
    ) t""",
)

# A zero decimal of scale 10 is written to JSON in scientific notation.
_MARKET_PAYLOAD = """'{' || concat_ws(',', '"symbol":"' || symbol || '"',
  '"asset_class":"' || asset_class || '"', '"close_price":' || CAST(close_price AS VARCHAR),
  '"currency":"' || currency || '"',
  '"fx_rate_to_usd":' || CASE WHEN fx_rate_to_usd = 0 THEN '0E-10' ELSE CAST(fx_rate_to_usd AS VARCHAR) END,
  '"price_date":"' || CAST(price_date AS VARCHAR) || '"') || '}'"""

_POSITION_PAYLOAD = """'{' || concat_ws(',', '"portfolio_id":"' || portfolio_id || '"',
  '"symbol":"' || symbol || '"', '"position_quantity":' || CAST(position_quantity AS VARCHAR),
  '"position_currency":"' || position_currency || '"',
  '"average_cost":' || CAST(average_cost AS VARCHAR)) || '}'"""

_REJECTED = (
    "rejected_records",
    f"""
    SELECT u.source_name, u.run_date, u.record_identifier, u.raw_record,
      u.rule AS rejection_rule, r.reason AS rejection_reason
    FROM (
      SELECT 'trades' AS source_name, run_date, order_id AS record_identifier, raw_record, rule
      FROM judged_trades
      UNION ALL
      SELECT 'market_data', run_date, symbol, {_MARKET_PAYLOAD}, rule FROM judged_market
      UNION ALL
      SELECT 'portfolio', run_date, record_identifier, {_POSITION_PAYLOAD}, rule FROM judged_positions
    ) u JOIN reasons r ON u.rule = r.rule""",
)


def expect(
    select: str,
    *more: tuple[str, str],
    variant: str = FIXED,
    portfolio_prices: bool = False,
    null_side_passes: bool = False,
) -> str:
    """Expected result of ``select`` over the named tables above."""
    parts = [
        _REASONS, _MESSAGE_FIELDS, _TYPED, _judged_trades(null_side_passes), _JUDGED_MARKET,
        _PRICES, _CLEAN, _JUDGED_POSITIONS, _VALUED, _PORTFOLIO_PNL, _REJECTED,
    ]
    return oracle(select, *parts, *more, variant=variant, portfolio_prices=portfolio_prices)


def expect_daily(select: str, *more: tuple[str, str], portfolio_prices: bool = False) -> str:
    return expect(select, *more, variant=DAILY, portfolio_prices=portfolio_prices)
