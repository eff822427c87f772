import json
from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.operators.market import process_market, tag_market
from daybook.operators.portfolio import explode_positions, price_rules, process_portfolios, tag_positions
from daybook.functions.rules import first_match

DAY = date(2026, 8, 3)


def feed(spark, rows):
    """Market rows given as (symbol, close, currency, fx, price_date)."""
    full = [(s, "EQUITY", c, ccy, fx, d, None) for s, c, ccy, fx, d in rows]
    return spark.createDataFrame(full, S.MARKET_FEED)


def test_every_market_rule(spark):
    good = ("A", D(10), "USD", None, DAY)
    cases = [
        (good, None),
        (("  ", D(10), "USD", None, DAY), "MARKET_MISSING_SYMBOL"),
        ((None, D(10), "USD", None, DAY), "MARKET_MISSING_SYMBOL"),
        (("A", D(10), "USD", None, None), "MARKET_INVALID_PRICE_DATE"),
        (("A", D(10), "USD", None, date(2026, 8, 2)), "MARKET_DATE_MISMATCH"),
        (("A", None, "USD", None, DAY), "MARKET_NULL_CLOSE_PRICE"),
        (("A", D(0), "USD", None, DAY), "MARKET_NON_POSITIVE_CLOSE_PRICE"),
        (("A", D(-1), "USD", None, DAY), "MARKET_NON_POSITIVE_CLOSE_PRICE"),
        (("A", D(10), "US", None, DAY), "MARKET_INVALID_CURRENCY"),
        (("A", D(10), None, None, DAY), "MARKET_INVALID_CURRENCY"),
        (("A", D(10), "EUR", None, DAY), "MARKET_INVALID_FX_RATE"),
        (("A", D(10), "EUR", D(0), DAY), "MARKET_INVALID_FX_RATE"),
        (("A", D(10), " eur ", D("1.1"), DAY), None),
        (("A", D(10), "usd", D(-5), DAY), None),
    ]
    for row, rule in cases:
        assert tag_market(feed(spark, [row]), DAY).first()["rejection_rule"] == rule, row


def test_rates_and_payload(spark):
    rows = [("a", D(10), "usd", D(7), DAY), ("b", D(10), "eur", D("1.1"), DAY), (" c ", None, "eur", D("1.1"), DAY)]
    valid, rejected = process_market(feed(spark, rows), DAY)
    rates = {r["normalized_symbol"]: r["effective_fx_rate_to_usd"] for r in valid.collect()}
    assert rates == {"A": D(1), "B": D("1.1")}
    (reject,) = rejected.collect()
    assert reject["record_identifier"] == " c "
    assert json.loads(reject["raw_record"]) == {
        "symbol": " c ", "asset_class": "EQUITY", "currency": "EUR",
        "fx_rate_to_usd": 1.1, "price_date": "2026-08-03",
    }


def position(symbol, quantity="10", currency="usd", cost="5"):
    return {"symbol": symbol, "position_quantity": quantity, "currency": currency, "average_cost": cost}


def portfolio(name, positions, value_limit="1000", loss_limit="50"):
    limits = {"max_market_value_usd": value_limit, "max_daily_loss_usd": loss_limit,
              "max_position_concentration_pct": "20"}
    return {"portfolio_id": name, "portfolio_name": f"Portfolio {name}", "base_currency": "USD",
            "positions": positions, "metadata": {"risk_limits": limits}}


def documents(spark, *docs):
    lines = spark.createDataFrame([(json.dumps(d),) for d in docs], "line string")
    return lines.select(F.from_json("line", S.PORTFOLIO_DOCUMENT).alias("d")).select("d.*")


def market(spark, *more):
    rows = [("A", D(10), "USD", None, DAY), ("E", D(10), "EUR", D("1.1"), DAY), *more]
    return process_market(feed(spark, rows), DAY)[0]


def test_every_portfolio_rule(spark):
    cases = [
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position("a")])]}, None),
        ({"run_date": "2026-08-02", "portfolios": [portfolio("P", [position("a")])]}, "PORTFOLIO_DATE_MISMATCH"),
        ({"run_date": None, "portfolios": [portfolio("P", [position("a")])]}, "PORTFOLIO_MARKET_PRICE_UNAVAILABLE"),
        ({"run_date": "2026-08-03", "portfolios": [portfolio(None, [position("a")])]}, "PORTFOLIO_MISSING_ID"),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position(" ")])]}, "PORTFOLIO_MISSING_SYMBOL"),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [])]}, "PORTFOLIO_MISSING_SYMBOL"),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", None)]}, "PORTFOLIO_MISSING_SYMBOL"),
        ({"run_date": "2026-08-03", "portfolios": []}, "PORTFOLIO_MISSING_ID"),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position("a", quantity=None)])]}, "PORTFOLIO_INVALID_QUANTITY"),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position("a", quantity="x")])]}, "PORTFOLIO_INVALID_QUANTITY"),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position("a", quantity="0")])]}, None),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position("a", quantity="-3")])]}, None),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position("a", currency="us")])]}, "PORTFOLIO_INVALID_CURRENCY"),
        ({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position("zz")])]}, "PORTFOLIO_MARKET_PRICE_UNAVAILABLE"),
    ]
    prices = market(spark)
    for document, rule in cases:
        for small in (True, False):
            (row,) = tag_positions(documents(spark, document), DAY, prices, small).collect()
            assert row["rejection_rule"] == rule, document


def test_fx_rule_alone(spark):
    df = spark.createDataFrame([(D(1), None), (D(1), D(0)), (D(1), D(2))], "close_price decimal(20,8), fx_rate_to_usd decimal(20,10)")
    verdicts = [r[0] and r[0]["rule"] for r in df.select(first_match(price_rules())).collect()]
    assert verdicts == ["PORTFOLIO_FX_RATE_UNAVAILABLE", "PORTFOLIO_FX_RATE_UNAVAILABLE", None]


def test_rollup_limits_and_identifiers(spark):
    document = {"run_date": "2026-08-03", "portfolios": [
        portfolio("P1", [position("a", "10", cost="5"), position("e", "-2", cost=None), position("q")]),
        portfolio("P2", [position("a", "200", cost="10.5")]),
        portfolio("P3", [position("a", "200", cost="10.5")], value_limit=None, loss_limit=None),
        portfolio("P4", [position("a", quantity=None)]),
    ]}
    pnl, rejected = process_portfolios(documents(spark, document), DAY, market(spark))
    rows = {r["portfolio_id"]: r for r in pnl.collect()}
    assert set(rows) == {"P1", "P2", "P3"}
    assert rows["P1"]["position_count"] == 2
    assert rows["P1"]["total_market_value_usd"] == D("78.0000")  # 100 - 2 * 10 * 1.1
    assert rows["P1"]["total_unrealized_pnl_usd"] == D("50.0000")  # unknown cost: no gain
    assert not rows["P1"]["market_value_limit_breached"] and not rows["P1"]["daily_loss_limit_breached"]
    assert rows["P2"]["market_value_limit_breached"] and rows["P2"]["daily_loss_limit_breached"]
    assert rows["P3"]["market_value_limit_breached"] is None and rows["P3"]["daily_loss_limit_breached"] is None
    identifiers = sorted(r["record_identifier"] for r in rejected.collect())
    assert identifiers == ["P1:Q", "P4"]
    payloads = {r["record_identifier"]: json.loads(r["raw_record"]) for r in rejected.collect()}
    assert payloads["P4"] == {"portfolio_id": "P4", "symbol": "a", "position_currency": "USD", "average_cost": 5.0}


def test_loss_exactly_at_the_limit_is_no_breach(spark):
    document = {"run_date": "2026-08-03", "portfolios": [
        portfolio("P", [position("a", "100", cost="10.5")], value_limit="1000", loss_limit="50")]}
    (row,) = process_portfolios(documents(spark, document), DAY, market(spark))[0].collect()
    assert row["total_unrealized_pnl_usd"] == D(-50) and row["total_market_value_usd"] == D(1000)
    assert row["market_value_limit_breached"] is False and row["daily_loss_limit_breached"] is False


def test_two_sets_of_limits_give_two_rows(spark):
    document = {"run_date": "2026-08-03", "portfolios": [
        portfolio("P", [position("a")]), portfolio("P", [position("a")], value_limit="7")]}
    assert process_portfolios(documents(spark, document), DAY, market(spark))[0].count() == 2


def test_explode_keeps_every_position(spark):
    document = {"run_date": "2026-08-03", "portfolios": [
        portfolio("P1", [position("a"), None, position("b")]), None, portfolio("P2", [])]}
    rows = explode_positions(documents(spark, document)).collect()
    assert [(r["portfolio_id"], r["symbol"]) for r in rows] == [
        ("P1", "a"), ("P1", None), ("P1", "b"), (None, None), ("P2", None)]
