"""Market prices: validate, normalize, resolve the dollar rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions.dates import RunDate, run_date_column
from daybook.functions.money import effective_fx
from daybook.functions.rules import Rule, apply_rules, rejected_rows, valid_rows
from daybook.functions.text import clean_code, is_blank, is_not_currency, normalize_symbol
from daybook.operators.rejects import json_payload, rejected_record


def market_rules() -> list[Rule]:
    close, fx = F.col("close_price"), F.col("fx_rate_to_usd")
    # Rule names and reason texts.
    return [
        Rule("MARKET_MISSING_SYMBOL", is_blank(F.col("normalized_symbol")),
             "Market-data symbol is missing."),
        Rule("MARKET_INVALID_PRICE_DATE", F.col("price_date").isNull(),
             "Market-data price date is invalid."),
        Rule("MARKET_DATE_MISMATCH", F.col("price_date") != F.col("run_date"),
             "Market-data price date does not match the run date."),
        Rule("MARKET_NULL_CLOSE_PRICE", close.isNull(),
             "Close price is NULL; stale prices are not permitted."),
        Rule("MARKET_NON_POSITIVE_CLOSE_PRICE", close <= 0,
             "Close price must be greater than zero."),
        Rule("MARKET_INVALID_CURRENCY", is_not_currency(F.col("currency")),
             "Market-data currency is invalid."),
        Rule("MARKET_INVALID_FX_RATE", (F.col("currency") != "USD") & (fx.isNull() | (fx <= 0)),
             "A positive FX rate is required for non-USD prices."),
    ]


def tag_market(feed: DataFrame, run_date: RunDate) -> DataFrame:
    """Every price row normalized, with its first broken rule if any."""
    prepared = feed.withColumns(
        {
            "run_date": run_date_column(run_date),
            "normalized_symbol": normalize_symbol(F.col("symbol")),
            "currency": clean_code(F.col("currency")),
        }
    )
    return apply_rules(prepared, market_rules())


def valid_prices(tagged: DataFrame) -> DataFrame:
    return valid_rows(tagged).withColumn(
        "effective_fx_rate_to_usd", effective_fx(F.col("currency"), F.col("fx_rate_to_usd"))
    )


def market_rejects(tagged: DataFrame, rejected_at=None) -> DataFrame:
    return rejected_record(
        rejected_rows(tagged),
        source=S.MARKET_DATA,
        run_date=F.col("run_date"),
        identifier=F.col("symbol"),
        payload=json_payload(*S.MARKET_FEED.names),
        rule=F.col("rejection_rule"),
        reason=F.col("rejection_reason"),
        rejected_at=rejected_at,
    )


def process_market(
    feed: DataFrame, run_date: RunDate, rejected_at=None
) -> tuple[DataFrame, DataFrame]:
    """Price rows -> (valid prices, reject records)."""
    tagged = tag_market(feed, run_date)
    return valid_prices(tagged), market_rejects(tagged, rejected_at)
