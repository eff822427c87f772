"""Profit, loss and market value with exact decimals.

Spark rounds each intermediate product to 38 digits, so factors are multiplied
in a fixed order (price difference, quantity, side, rate) and only the end is
cast to money. USD amounts multiply the unrounded local product by the rate,
not the local amount in money.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook import schemas as S


def as_money(amount: Column) -> Column:
    return amount.cast(S.MONEY)


def side_sign(side: Column) -> Column:
    """+1 for a buy, -1 for a sell, NULL otherwise."""
    sign = F.when(side == "BUY", F.lit(Decimal(1))).when(side == "SELL", F.lit(Decimal(-1)))
    return sign.cast(S.SIDE_SIGN)


def effective_fx(currency: Column, fx_rate: Column) -> Column:
    """Dollars need no rate."""
    return F.when(currency == "USD", F.lit(Decimal(1)).cast(S.FX_RATE)).otherwise(fx_rate)


def price_is_unusable(close_price: Column, fx_rate: Column) -> Column:
    return close_price.isNull() | fx_rate.isNull() | (fx_rate <= 0)


def cost_or_close(average_cost: Column, close_price: Column) -> Column:
    """A position of unknown cost is valued at no gain."""
    return F.coalesce(average_cost, close_price)


def share_of_limit(amount: Column, limit: Column) -> Column:
    """|amount| / limit; NULL without a limit or with a limit of zero."""
    return F.when(limit != 0, F.abs(amount) / limit)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 for an empty whole."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)
