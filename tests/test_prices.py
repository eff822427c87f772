from collections import Counter
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from daybook.operators.prices import attach_prices, fits_broadcast, price_lookup
from daybook.operators.trades import process_trades, trade_pnl
from tests.test_trades import message

DAY = date(2026, 8, 3)
MARKET = "normalized_symbol string, price_date date, close_price decimal(20,8), currency string, effective_fx_rate_to_usd decimal(20,10)"


def fixture(spark):
    """A key with a third of all rows, identical copies, NULL keys, a symbol priced twice."""
    rows = [(i, "HOT", DAY) for i in range(300)] + [(7, "HOT", DAY)] * 100
    rows += [(i, f"S{i % 50}", date(2026, 8, 1 + i % 5)) for i in range(500)]
    rows += [(i, None, DAY) for i in range(60)] + [(i, "HOT", None) for i in range(60)]
    prices = [("HOT", DAY, D(5), "USD", D(1)), ("S1", date(2026, 8, 2), D(6), "USD", D(1))]
    prices += [(f"S{i}", date(2026, 8, 3), D(i + 1), "EUR", D("1.1")) for i in range(0, 50, 2)]
    prices += [("S2", date(2026, 8, 3), D(99), "USD", D(1)), ("UNUSED", DAY, D(1), "USD", D(1))]
    left = spark.createDataFrame(rows, "id int, symbol string, day date")
    return rows, prices, left, spark.createDataFrame(prices, MARKET)


def brute_force(rows, prices, eligible=lambda row: True):
    out = Counter()
    for row in rows:
        found = [p[2] for p in prices if eligible(row) and row[1] and row[2] and (p[0], p[1]) == (row[1], row[2])]
        for close in found or [None]:
            out[(*row, close)] += 1
    return out


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("rows_per_salt", [7, 10**6])
def test_join_matches_brute_force(spark, small, rows_per_salt):
    rows, prices, left, market = fixture(spark)
    joined = attach_prices(left, market, "symbol", "day", small=small, rows_per_salt=rows_per_salt)
    assert joined.columns == ["id", "symbol", "day", "close_price", "market_currency", "fx_rate_to_usd"]
    got = Counter((r["id"], r["symbol"], r["day"], r["close_price"]) for r in joined.collect())
    assert got == brute_force(rows, prices)


@pytest.mark.parametrize("small", [True, False])
def test_ineligible_rows_stay_once_without_price(spark, small):
    rows, prices, left, market = fixture(spark)
    joined = attach_prices(
        left, market, "symbol", "day", eligible=F.col("id") % 2 == 0, small=small, rows_per_salt=7
    )
    got = Counter((r["id"], r["symbol"], r["day"], r["close_price"]) for r in joined.collect())
    assert got == brute_force(rows, prices, eligible=lambda row: row[0] % 2 == 0)


def test_hot_key_is_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).select("id", F.lit("HOT").alias("symbol"), F.lit(DAY).alias("day"))
        market = spark.createDataFrame([("HOT", DAY, D(5), "USD", D(1))], MARKET)
        joined = attach_prices(left, market, "symbol", "day", small=False, rows_per_salt=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_size_check(spark):
    lookup = price_lookup(fixture(spark)[3])
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_rows=28) and fits_broadcast(lookup, max_rows=29)
    assert not fits_broadcast(lookup, max_bytes=10)


def test_realized_pnl(spark):
    raw = spark.createDataFrame(
        [(message(t11="B", t6="90"),), (message(t11="S", t54="2", t6="90"),), (message(t11="N", t55="none"),),
         (message(t11="Q", t54=None),)],
        "raw_record string",
    )
    market = spark.createDataFrame([("ABC", DAY, D("100.00000001"), "EUR", D("1.1"))], MARKET)
    valid = process_trades(raw, DAY, null_side_passes=True)[0]
    clean, unresolvable = trade_pnl(valid, market)
    rows = {r["order_id"]: r for r in clean.collect()}
    assert rows["B"]["realized_pnl_local"] == D("105.0000")  # (100.00000001 - 90) * 10.5
    assert rows["B"]["realized_pnl_usd"] == D("115.5000")
    assert rows["S"]["realized_pnl_usd"] == D("-115.5000")
    assert rows["N"]["realized_pnl_usd"] is None and rows["N"]["pnl_unresolvable"]
    assert rows["Q"]["realized_pnl_usd"] is None and rows["Q"]["pnl_unresolvable"] is False
    (row,) = unresolvable.collect()
    assert row["order_id"] == "N"
    assert row["unresolvable_reason"] == "No valid same-date market price or FX rate was available."


def test_product_types_round_step_by_step(spark):
    from daybook.functions import money

    df = spark.createDataFrame(
        [(D("1.33333333"), D("3.3333"), D("1.1234567891"))],
        "gain decimal(21,8), quantity decimal(20,4), fx decimal(20,10)",
    )
    gain, quantity, fx = F.col("gain"), F.col("quantity"), F.col("fx")
    step = gain * quantity
    assert df.select(step).dtypes[0][1] == "decimal(38,8)"
    sign = money.side_sign(F.lit("BUY"))
    assert df.select(step * sign).dtypes[0][1] == "decimal(38,6)"
    assert df.select(step * sign * fx).dtypes[0][1] == "decimal(38,6)"
    assert df.select(money.as_money(step * sign * fx)).dtypes[0][1] == "decimal(24,4)"
    # 1.33333333 * 3.3333 = 4.44439998..., then * 1.1234567891, half up
    assert df.select(money.as_money(step * fx)).first()[0] == D("4.9931")
