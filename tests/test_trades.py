from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.functions.text import extract_tag, normalize_symbol
from daybook.operators.trades import parse_tagged, process_trades, tag_trades

DAY = date(2026, 8, 3)
GOOD = {
    "8": "FIX.4.4", "35": "D", "11": "O1", "1": "P1", "55": "abc", "54": "1", "38": "10.5",
    "44": "100.25", "6": "99", "15": "usd", "60": "20260803-09:30:00",
}


def message(**changes):
    """A good message with tags replaced (t11="X") or left out (t11=None)."""
    fields = GOOD | {tag[1:]: value for tag, value in changes.items()}
    return "|".join(f"{t}={v}" for t, v in fields.items() if v is not None) + "|"


def rules(spark, lines, **options):
    raw = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, raw_record string")
    rows = tag_trades(raw, DAY, **options).orderBy("i").collect()
    return [row["rejection_rule"] for row in rows]


CASES = [
    ({}, None),
    ({"t11": None}, "TRADE_MISSING_ORDER_ID"),
    ({"t11": "  "}, "TRADE_MISSING_ORDER_ID"),
    ({"t1": None}, "TRADE_MISSING_PORTFOLIO_ID"),
    ({"t55": None}, "TRADE_MISSING_SYMBOL"),
    ({"t55": " "}, "TRADE_MISSING_SYMBOL"),
    ({"t54": "9"}, "TRADE_INVALID_SIDE"),
    ({"t54": None}, "TRADE_INVALID_SIDE"),
    ({"t38": "0"}, "TRADE_INVALID_QUANTITY"),
    ({"t38": "-1"}, "TRADE_INVALID_QUANTITY"),
    ({"t38": "abc"}, "TRADE_INVALID_QUANTITY"),
    ({"t38": None}, "TRADE_INVALID_QUANTITY"),
    ({"t38": "0.0001"}, None),
    ({"t44": "0"}, "TRADE_INVALID_PRICE"),
    ({"t44": "x"}, "TRADE_INVALID_PRICE"),
    ({"t6": "-0.00000001"}, "TRADE_INVALID_AVERAGE_COST"),
    ({"t6": None}, "TRADE_INVALID_AVERAGE_COST"),
    ({"t6": "0"}, None),
    ({"t15": "US"}, "TRADE_INVALID_CURRENCY"),
    ({"t15": "USDX"}, "TRADE_INVALID_CURRENCY"),
    ({"t15": None}, "TRADE_INVALID_CURRENCY"),
    ({"t15": "xyz"}, None),
    ({"t60": "INVALID"}, "TRADE_INVALID_TIMESTAMP"),
    ({"t60": "20260803-09:30:00.5"}, "TRADE_INVALID_TIMESTAMP"),
    ({"t60": None}, "TRADE_INVALID_TIMESTAMP"),
    ({"t60": "20260804-09:30:00"}, "TRADE_DATE_MISMATCH"),
    # The first broken rule names the row.
    ({"t11": None, "t55": None}, "TRADE_MISSING_ORDER_ID"),
    ({"t44": "-1", "t60": "INVALID"}, "TRADE_INVALID_PRICE"),
]


def test_every_rule(spark):
    assert rules(spark, [message(**c) for c, _ in CASES]) == [rule for _, rule in CASES]


def test_missing_side_can_pass(spark):
    lines = [message(t54=None), message(t54="9"), message()]
    assert rules(spark, lines, null_side_passes=True) == [None, "TRADE_INVALID_SIDE", None]


def test_lines_that_are_no_messages(spark):
    assert rules(spark, ["", "   ", "THIS IS NOT A MESSAGE", "||||"]) == ["TRADE_MISSING_ORDER_ID"] * 4


def test_values_and_reject_record(spark):
    raw = spark.createDataFrame(
        [(message(t55=" v o\td ", t15=" gbp "),), (message(t38="-1"),)], "raw_record string"
    )
    valid, rejected = process_trades(raw, DAY)
    (trade,) = valid.collect()
    assert (trade["symbol"], trade["side"], trade["currency"]) == ("VOD", "BUY", "GBP")
    assert trade["quantity"] == Decimal("10.5000")
    assert trade["trade_price"] == Decimal("100.25000000")
    assert trade["transact_time"] == datetime(2026, 8, 3, 9, 30)
    assert trade["trade_date"] == DAY
    (reject,) = rejected.collect()
    assert reject["source_name"] == "trades" and reject["run_date"] == DAY
    assert reject["record_identifier"] == "O1" and reject["raw_record"] == message(t38="-1")
    assert reject["rejection_reason"] == "FIX tag 38 must contain a positive quantity."
    assert rejected.columns == [
        "source_name", "run_date", "record_identifier", "raw_record",
        "rejection_rule", "rejection_reason", "rejected_at",
    ]


@pytest.mark.parametrize(
    "text, tag, value",
    [
        ("11=A|11=B|", "11", "A"),
        ("1=P|11=A|", "1", "P"),
        ("111=Z|11=A|", "11", "A"),
        ("8=x|11= A b |", "11", "A b"),
        ("8=x|11=", "11", None),
        ("8=x|11=|55=S", "11", None),
        ("8=x|11=a=b|", "11", "a=b"),
        ("x11=A|", "11", None),
        ("", "11", None),
        ("8=é漢|11=ü|", "11", "ü"),
    ],
)
def test_first_field_of_a_tag(spark, text, tag, value):
    df = spark.createDataFrame([(text,)], "raw_record string")
    assert df.select(extract_tag(F.col("raw_record"), tag)).first()[0] == value
    assert parse_tagged(df, {tag: "field"}).first()["field"] == value


def test_parsing_agrees_with_a_regular_expression(spark):
    lines = [message(), "THIS", "", "||11=A||11=B|", "11=|1=x", "|8=|35=|", message(t1=" p "), None]
    df = spark.createDataFrame([(line,) for line in lines], "raw_record string")
    for tag in GOOD:
        pattern = rf"(?:^|\|){tag}=([^|]*)"
        slow = F.nullif(F.trim(F.regexp_extract("raw_record", pattern, 1)), F.lit(""))
        wrong = parse_tagged(df, {tag: "field"}).where(~F.col("field").eqNullSafe(slow))
        assert wrong.count() == 0


def test_normalize_symbol(spark):
    df = spark.createDataFrame([(" a b\t c\n",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(normalize_symbol(F.col("s"))).collect()] == ["ABC", "", None]


def test_many_dates_at_once(spark):
    other = date(2026, 8, 4)
    raw = spark.createDataFrame(
        [(message(), DAY), (message(), other), (message(t60="20260804-10:00:00"), other)],
        "raw_record string, dt date",
    )
    valid, rejected = process_trades(raw, F.col("dt"))
    assert sorted(r["trade_date"] for r in valid.collect()) == [DAY, other]
    (reject,) = rejected.collect()
    assert (reject["run_date"], reject["rejection_rule"]) == (other, "TRADE_DATE_MISMATCH")


def test_random_messages_against_brute_force(spark):
    import random
    import re

    chance = random.Random(7)
    lines = ["".join(chance.choice("|||==115 5A") for _ in range(chance.randrange(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame([(line,) for line in lines], "raw_record string")
    for tag in ("1", "11", "55"):
        found = {r["raw_record"]: r["field"] for r in parse_tagged(df, {tag: "field"}).collect()}
        for line in lines:
            match = re.search(rf"(?:^|\|){tag}=([^|]*)", line)
            assert found[line] == ((match.group(1).strip(" ") or None) if match else None), line
