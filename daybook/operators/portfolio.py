"""Portfolio documents: flatten, validate, value and roll up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions import money
from daybook.functions.dates import RunDate, run_date_column
from daybook.functions.rules import (
    Rule,
    apply_rules,
    first_match,
    materialize_columns,
    rejected_rows,
    valid_rows,
)
from daybook.functions.text import clean_code, is_blank, is_not_currency, normalize_symbol
from daybook.operators.prices import attach_prices
from daybook.operators.rejects import json_payload, rejected_record

LIMITS = ["max_market_value_usd", "max_daily_loss_usd", "max_position_concentration_pct"]
REJECT_FIELDS = ["portfolio_id", "symbol", "position_quantity", "position_currency", "average_cost"]


def explode_positions(documents: DataFrame) -> DataFrame:
    """One row per position; empty or NULL arrays leave one row of NULLs.

    Columns of ``documents`` other than the document's own two are carried.
    """
    carried = [c for c in documents.columns if c not in S.PORTFOLIO_DOCUMENT.names]
    portfolios = documents.select(
        *carried,
        F.col("run_date").alias("source_run_date"),
        F.explode_outer("portfolios").alias("portfolio"),
    )
    positions = portfolios.select(
        *carried,
        "source_run_date",
        "portfolio",
        F.explode_outer("portfolio.positions").alias("position"),
    )
    return positions.select(
        *carried,
        "source_run_date",
        "portfolio.portfolio_id",
        "portfolio.portfolio_name",
        "portfolio.base_currency",
        "position.symbol",
        "position.position_quantity",
        clean_code(F.col("position.currency")).alias("position_currency"),
        "position.average_cost",
        *[f"portfolio.metadata.risk_limits.{limit}" for limit in LIMITS],
        "portfolio.metadata.loaded_at",
        normalize_symbol(F.col("position.symbol")).alias("normalized_symbol"),
    )


def position_rules() -> list[Rule]:
    """Checks on the document alone. A NULL document date passes the first one."""
    # Rule names and reason texts.
    return [
        Rule("PORTFOLIO_DATE_MISMATCH", F.col("source_run_date") != F.col("run_date"),
             "Portfolio export date does not match the run date."),
        Rule("PORTFOLIO_MISSING_ID", F.col("portfolio_id").isNull(),
             "Portfolio ID is missing."),
        Rule("PORTFOLIO_MISSING_SYMBOL", is_blank(F.col("normalized_symbol")),
             "Portfolio position symbol is missing."),
        Rule("PORTFOLIO_INVALID_QUANTITY", F.col("position_quantity").isNull(),
             "Portfolio position quantity is invalid."),
        Rule("PORTFOLIO_INVALID_CURRENCY", is_not_currency(F.col("position_currency")),
             "Portfolio position currency is invalid."),
    ]


def price_rules() -> list[Rule]:
    """Checks that need the joined price."""
    fx = F.col("fx_rate_to_usd")
    # Rule names and reason texts.
    return [
        Rule("PORTFOLIO_MARKET_PRICE_UNAVAILABLE", F.col("close_price").isNull(),
             "No valid same-date market price is available for the position."),
        Rule("PORTFOLIO_FX_RATE_UNAVAILABLE", fx.isNull() | (fx <= 0),
             "No valid USD FX conversion rate is available for the position."),
    ]


def judge_positions(documents: DataFrame, run_date: RunDate) -> DataFrame:
    """Every position with the first document check it fails, if any.

    ``documents`` may carry the run date as a column ``dt``.
    """
    # The document has a run_date of its own, so the argument is resolved under another name.
    dated = documents.withColumn("expected_date", run_date_column(run_date))
    positions = explode_positions(dated).withColumnRenamed("expected_date", "run_date")
    return apply_rules(positions, position_rules())


def price_positions(
    judged: DataFrame, market: DataFrame, small: bool | None = None, in_files: bool = False
) -> DataFrame:
    """Judged positions with their price and, where it is missing, that verdict.

    Positions that failed a document check go through the join unpriced, so
    that one pass yields both the valued and the rejected rows.
    """
    priced = attach_prices(
        judged,
        market,
        symbol="normalized_symbol",
        day="source_run_date",
        eligible=F.col("rejection_rule").isNull(),
        small=small,
        in_files=in_files,
    )
    verdict = F.when(F.col("rejection_rule").isNull(), first_match(price_rules()))
    kept = [c for c in priced.columns if c not in ("rejection_rule", "rejection_reason")]
    return priced.withColumn("price_verdict", verdict).select(
        *kept,
        F.coalesce("rejection_rule", "price_verdict.rule").alias("rejection_rule"),
        F.coalesce("rejection_reason", "price_verdict.reason").alias("rejection_reason"),
        # A position that failed on its price is identified with its symbol.
        F.when(
            F.col("rejection_rule").isNull(),
            F.concat_ws(":", "portfolio_id", "normalized_symbol"),
        ).otherwise(F.col("portfolio_id")).alias("record_identifier"),
    )


def tag_positions(
    documents: DataFrame, run_date: RunDate, market: DataFrame, small: bool | None = None
) -> DataFrame:
    """Every position priced, with its first broken rule if any."""
    return price_positions(judge_positions(documents, run_date), market, small)


def value_positions(tagged: DataFrame) -> DataFrame:
    """Valid positions with market value and unrealized P&L."""
    close, quantity = F.col("close_price"), F.col("position_quantity")
    cost = money.cost_or_close(F.col("average_cost"), close)
    products = valid_rows(tagged).withColumns(
        {"value_product": quantity * close, "gain_product": (close - cost) * quantity}
    )
    value, gain, fx = F.col("value_product"), F.col("gain_product"), F.col("fx_rate_to_usd")
    return products.withColumns(
        {
            "market_value_local": money.as_money(value),
            "market_value_usd": money.as_money(value * fx),
            "unrealized_pnl_local": money.as_money(gain),
            "unrealized_pnl_usd": money.as_money(gain * fx),
        }
    ).drop("value_product", "gain_product")


def portfolio_rollup(positions: DataFrame) -> DataFrame:
    """Totals per portfolio and day, compared with the risk limits.

    Name and limits are part of the key: a portfolio exported with two sets of
    limits gives two rows. An absent limit gives a NULL flag.
    """
    totals = positions.groupBy(
        "portfolio_id",
        "portfolio_name",
        F.col("source_run_date").alias("pnl_date"),
        *LIMITS,
    ).agg(
        F.count("*").alias("position_count"),
        F.sum("market_value_usd").cast(S.MONEY).alias("total_market_value_usd"),
        F.sum("unrealized_pnl_usd").cast(S.MONEY).alias("total_unrealized_pnl_usd"),
    )
    flagged = totals.withColumns(
        {
            "market_value_limit_breached": F.abs("total_market_value_usd")
            > F.col("max_market_value_usd"),
            "daily_loss_limit_breached": F.col("total_unrealized_pnl_usd")
            < -F.col("max_daily_loss_usd"),
        }
    )
    return flagged.select(*S.TABLES["portfolio_pnl"].columns)


def portfolio_rejects(tagged: DataFrame, rejected_at=None) -> DataFrame:
    return rejected_record(
        rejected_rows(tagged),
        source=S.PORTFOLIO,
        run_date=F.col("run_date"),
        identifier=F.col("record_identifier"),
        payload=json_payload(*REJECT_FIELDS),
        rule=F.col("rejection_rule"),
        reason=F.col("rejection_reason"),
        rejected_at=rejected_at,
    )


def process_portfolios(
    documents: DataFrame,
    run_date: RunDate,
    market: DataFrame,
    small: bool | None = None,
    rejected_at=None,
) -> tuple[DataFrame, DataFrame]:
    """Documents and prices -> (portfolio P&L, reject records)."""
    tagged = materialize_columns(tag_positions(documents, run_date, market, small))
    return portfolio_rollup(value_positions(tagged)), portfolio_rejects(tagged, rejected_at)
