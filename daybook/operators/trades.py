"""Tagged trade messages: parse, validate, price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.functions import money
from daybook.functions.dates import RunDate, run_date_column
from daybook.functions.rules import Rule, apply_rules, rejected_rows, valid_rows
from daybook.functions.text import (
    clean_code,
    delimited,
    empty_to_null,
    is_blank,
    is_not_currency,
    normalize_symbol,
    tag_position,
    tag_value,
)
from daybook.operators.prices import attach_prices
from daybook.operators.rejects import rejected_record

TRADE_COLUMNS = list(S.TABLES["unresolvable_pnl"].columns[:-1])
PRICED_COLUMNS = list(S.TABLES["processed_trades"].columns)

# The tags that rules and outputs read; the rest is message header.
TRADE_TAGS = {tag: name for tag, name in S.TAG_COLUMNS.items() if name in [*TRADE_COLUMNS, "side_code"]}

# Fixed value: the reason every unresolvable trade carries.
UNRESOLVABLE_REASON = "No valid same-date market price or FX rate was available."


def parse_tagged(raw: DataFrame, tags: dict[str, str] = S.TAG_COLUMNS) -> DataFrame:
    """One string column per tag next to the columns of ``raw``.

    ``extract_tag`` in steps: each step is used by the next more than once, so
    Spark keeps the projections apart, evaluates every search once per row and
    generates methods short enough for the JVM to compile.
    """
    fields = F.col("message_fields")
    delimited_rows = raw.withColumn("message_fields", delimited(F.col("raw_record")))
    found = delimited_rows.select(
        "*", *[tag_position(fields, tag).alias(f"position_{tag}") for tag in tags]
    )
    values = found.select(
        *raw.columns,
        *[tag_value(fields, F.col(f"position_{tag}"), tag).alias(name) for tag, name in tags.items()],
    )
    return values.select(
        *raw.columns, *[empty_to_null(F.col(name)).alias(name) for name in tags.values()]
    )


def type_trades(parsed: DataFrame) -> DataFrame:
    """Cast message fields; a field that does not convert becomes NULL."""
    typed = {
        "symbol": normalize_symbol(F.col("symbol")),
        "side": decode_side(),
        "quantity": F.col("quantity").try_cast(S.QUANTITY),
        "trade_price": F.col("trade_price").try_cast(S.PRICE),
        "average_cost": F.col("average_cost").try_cast(S.PRICE),
        "currency": clean_code(F.col("currency")),
        "transact_time": F.try_to_timestamp("transact_time", F.lit(S.MESSAGE_TIME_FORMAT)),
    }
    return parsed.withColumns(typed).withColumn("trade_date", F.to_date("transact_time"))


def decode_side():
    buy, sell = S.SIDES.items()
    code = F.col("side_code")
    return F.when(code == buy[0], buy[1]).when(code == sell[0], sell[1])


def trade_rules(null_side_passes: bool = False) -> list[Rule]:
    """Trade checks in order. A message without a side is rejected unless told otherwise."""
    unknown_side = ~F.col("side_code").isin(*S.SIDES)
    if not null_side_passes:
        unknown_side = F.col("side_code").isNull() | unknown_side
    quantity, price, cost = F.col("quantity"), F.col("trade_price"), F.col("average_cost")
    # Rule names and reason texts.
    return [
        Rule("TRADE_MISSING_ORDER_ID", F.col("order_id").isNull(),
             "FIX tag 11 is missing."),
        Rule("TRADE_MISSING_PORTFOLIO_ID", F.col("portfolio_id").isNull(),
             "FIX tag 1 is missing."),
        Rule("TRADE_MISSING_SYMBOL", is_blank(F.col("symbol")),
             "FIX tag 55 is missing or empty."),
        Rule("TRADE_INVALID_SIDE", unknown_side,
             "FIX tag 54 must be 1 for BUY or 2 for SELL."),
        Rule("TRADE_INVALID_QUANTITY", quantity.isNull() | (quantity <= 0),
             "FIX tag 38 must contain a positive quantity."),
        Rule("TRADE_INVALID_PRICE", price.isNull() | (price <= 0),
             "FIX tag 44 must contain a positive trade price."),
        Rule("TRADE_INVALID_AVERAGE_COST", cost.isNull() | (cost < 0),
             "FIX tag 6 must contain a non-negative average cost."),
        Rule("TRADE_INVALID_CURRENCY", is_not_currency(F.col("currency")),
             "FIX tag 15 must contain a three-character currency."),
        Rule("TRADE_INVALID_TIMESTAMP", F.col("transact_time").isNull(),
             "FIX tag 60 must use the format YYYYMMDD-HH:MM:SS."),
        Rule("TRADE_DATE_MISMATCH", F.col("trade_date") != F.col("run_date"),
             "Trade date does not match the pipeline run date."),
    ]


def tag_trades(
    raw: DataFrame,
    run_date: RunDate,
    null_side_passes: bool = False,
    tags: dict[str, str] = S.TAG_COLUMNS,
) -> DataFrame:
    """Every message parsed and typed, with its first broken rule if any.

    ``tags`` may be narrowed to ``TRADE_TAGS`` where no one reads the header.
    """
    dated = raw.withColumn("run_date", run_date_column(run_date))
    return apply_rules(type_trades(parse_tagged(dated, tags)), trade_rules(null_side_passes))


def trade_rejects(tagged: DataFrame, rejected_at=None) -> DataFrame:
    return rejected_record(
        rejected_rows(tagged),
        source=S.TRADES,
        run_date=F.col("run_date"),
        identifier=F.col("order_id"),
        payload=F.col("raw_record"),
        rule=F.col("rejection_rule"),
        reason=F.col("rejection_reason"),
        rejected_at=rejected_at,
    )


def process_trades(
    raw: DataFrame,
    run_date: RunDate,
    null_side_passes: bool = False,
    rejected_at=None,
    tags: dict[str, str] = S.TAG_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    """Messages -> (valid trades, reject records)."""
    tagged = tag_trades(raw, run_date, null_side_passes, tags)
    return valid_rows(tagged), trade_rejects(tagged, rejected_at)


def price_trades(
    trades: DataFrame, market: DataFrame, small: bool | None = None, in_files: bool = False
) -> DataFrame:
    """Valid trades with their close price and realized P&L.

    P&L compares the close price with the average cost; the trade price is
    carried but plays no part. Without a usable price the P&L is NULL. Columns
    that are not returned, such as the message, stay out of the join and its files.
    """
    priced = attach_prices(
        trades.select(*TRADE_COLUMNS), market, symbol="symbol", day="trade_date", small=small, in_files=in_files
    )
    signed_gain = (
        (F.col("close_price") - F.col("average_cost"))
        * F.col("quantity")
        * money.side_sign(F.col("side"))
    )
    judged = priced.withColumns(
        {
            "signed_gain": signed_gain,
            "pnl_unresolvable": money.price_is_unusable(
                F.col("close_price"), F.col("fx_rate_to_usd")
            ),
        }
    )
    resolvable, gain = ~F.col("pnl_unresolvable"), F.col("signed_gain")
    return judged.withColumns(
        {
            "realized_pnl_local": F.when(resolvable, money.as_money(gain)),
            "realized_pnl_usd": F.when(
                resolvable, money.as_money(gain * F.col("fx_rate_to_usd"))
            ),
        }
    ).select(*PRICED_COLUMNS)


def unresolvable_trades(clean: DataFrame) -> DataFrame:
    """Trades without P&L and why; they stay in the clean output as well."""
    return clean.where("pnl_unresolvable").withColumn(
        "unresolvable_reason", F.lit(UNRESOLVABLE_REASON)
    )


def trade_pnl(
    trades: DataFrame, market: DataFrame, small: bool | None = None, in_files: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Valid trades and prices -> (clean trades, unresolvable trades)."""
    clean = price_trades(trades, market, small, in_files)
    return clean, unresolvable_trades(clean)
