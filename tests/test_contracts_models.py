from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.operators import contracts as C
from daybook.plans import models as M
from daybook.plans import monitoring as V
from daybook.sources import warehouse as wh

DAY = date(2026, 8, 3)


def outcome(df):
    return {(r["column"], r["check"]): (r["failures"], r["status"]) for r in df.collect()}


def test_not_null_unique_and_accepted_values(spark):
    df = spark.createDataFrame([("a", "BUY"), ("a", "SELL"), (None, "HOLD"), (None, None), ("b", "HOLD")], "k string, side string")
    assert outcome(C.check_not_null(df, "t", ["k", "side"])) == {
        ("k", "not_null"): (2, "fail"), ("side", "not_null"): (1, "fail")}
    assert outcome(C.check_unique(df, "t", ["k"])) == {("k", "unique"): (1, "fail")}
    assert outcome(C.check_unique(df, "t", ["k", "side"])) == {("k, side", "unique"): (0, "pass")}
    assert outcome(C.check_accepted_values(df, "t", "side", ["BUY", "SELL"])) == {
        ("side", "accepted_values"): (1, "fail")}
    empty = df.where("false")
    assert outcome(C.check_not_null(empty, "t", ["k"])) == {("k", "not_null"): (0, "pass")}
    assert outcome(C.check_unique(empty, "t", ["k"])) == {("k", "unique"): (0, "pass")}


@pytest.mark.parametrize(
    "now, status",
    [("2026-08-04 12:00:00", "pass"), ("2026-08-04 12:00:01", "warn"),
     ("2026-08-05 12:00:00", "warn"), ("2026-08-05 12:00:01", "error")],
)
def test_freshness(spark, now, status):
    df = spark.createDataFrame([("2026-08-01 00:00:00",), ("2026-08-03 12:00:00",)], "t string")
    df = df.select(F.col("t").cast("timestamp").alias("loaded_at"))
    as_of = datetime.fromisoformat(now)
    assert C.check_freshness(df, "t", as_of=as_of).first()["status"] == status
    assert C.check_freshness(df.where("false"), "t", as_of=as_of).first()["status"] == "error"


def test_table_bounds_and_keys(spark):
    contract = S.TABLES["processed_trades"]
    row = {"order_id": "O", "portfolio_id": "P" * 51, "symbol": "S", "side": None, "quantity": D(1),
           "trade_price": D(1), "average_cost": D(1), "currency": "USD", "transact_time": datetime(2026, 8, 3),
           "trade_date": DAY, "market_currency": "EURO", "pnl_unresolvable": False}
    values = [row.get(c) for c in contract.columns] + [datetime(2026, 8, 3)]
    df = spark.createDataFrame([values, values], S.table_schema(contract))
    failed = {k: v[0] for k, v in outcome(C.check_table(df, contract)).items() if v[1] == "fail"}
    assert failed == {
        ("side", "not_null"): 2, ("order_id, trade_date", "primary_key"): 1,
        ("portfolio_id", "bounds"): 2, ("market_currency", "bounds"): 2,
    }
    wide = df.withColumn("quantity", F.lit("12345678901234567").cast("decimal(30,4)"))
    assert outcome(C.check_lengths(wide, contract))[("quantity", "bounds")] == (2, "fail")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_constraints_share_one_pass(spark, tmp_path):
    contract = S.TABLES["processed_trades"]
    spark.createDataFrame([], S.table_schema(contract)).write.parquet(f"{tmp_path}/t")
    text = plan(C.check_table(spark.read.parquet(f"{tmp_path}/t"), contract))
    assert text.count("FileScan") == 2  # one for all rows' constraints, one for the key
    assert "ReadSchema: struct<order_id:string,trade_date:date>" in text
    assert text.count("Exchange hashpartitioning") == 1


def incoming(spark):
    """Text cells: a good row, a repeated bad one, and NULLs in every column."""
    contract = S.TABLES["unresolvable_pnl"]
    good = {"order_id": "O", "portfolio_id": "P", "symbol": "S", "side": "BUY", "quantity": "1.00005",
            "trade_price": "2", "average_cost": "3", "currency": "USD", "transact_time": "2026-08-03 10:00:00",
            "trade_date": "2026-08-03", "unresolvable_reason": "why", "dt": "2026-08-03", "broken": "extra"}
    wide = good | {"quantity": "1e16", "symbol": "S" * 51}
    rows = [good, wide, wide, good | {"trade_date": "today"}, dict.fromkeys(good) | {"dt": "2026-08-03"}]
    names = list(good)
    frame = spark.createDataFrame([[r[c] for c in names] for r in rows], ", ".join(f"{c} string" for c in names))
    return contract, frame.withColumn("dt", F.col("dt").cast("date"))


def test_incoming_rows_are_loaded_or_set_aside(spark):
    contract, frame = incoming(spark)
    good, bad = C.split_by_contract(frame, contract, ["dt"])
    assert good.columns == contract.columns and good.schema["quantity"].dataType == S.QUANTITY
    assert [r["quantity"] for r in good.collect()] == [D("1.0001")]
    found = sorted((sorted(f"{v['column']} {v['check']}" for v in r["violations"]) for r in bad.collect()), key=len)
    assert found[0] == ["trade_date type"]
    assert found[1] == found[2] == ["quantity type", "symbol length"]
    assert found[3] == sorted(f"{c} not_null" for c in contract.required)
    assert all('"broken":' in r["record"] for r in bad.collect())
    empty = [df.count() for df in C.split_by_contract(frame.where("false"), contract)]
    assert empty == [0, 0]


@pytest.mark.parametrize("skipped, message", [(0, "(symbol|quantity) breaks its contract: (length|type)"), (1, "trade_date breaks its contract: not_null")])
def test_a_load_of_bad_rows_fails_or_sets_them_aside(spark, tmp_path, skipped, message):
    contract, frame = incoming(spark)
    root = str(tmp_path)
    wh.reload_dates(frame.where("quantity = '1.00005' and trade_date = '2026-08-03'"), root, contract, [DAY], enforce=True)
    with pytest.raises(Exception, match=message):
        bad = frame.where("trade_date is null" if skipped else "quantity = '1e16'")
        wh.reload_dates(bad, root, contract, [DAY], enforce=True)
    assert wh.read_table(spark, root, contract.name).count() == 1
    for _ in range(2):
        loaded = wh.reload_dates(wh.set_aside(frame, root, contract, [DAY]), root, contract, [DAY])
    assert loaded == {DAY: wh.Reload(1, 1)}
    assert wh.read_quarantine(spark, root, contract.name).count() == 4


def test_trading_mart(spark):
    rows = [("P", "A", "BUY", D(2), D(1), D(1), False), ("P", "A", "SELL", D(3), None, None, True),
            ("P", "B", "BUY", D(4), None, None, True)]
    df = spark.createDataFrame(
        rows, "portfolio_id string, symbol string, side string, quantity decimal(20,4), realized_pnl_local decimal(24,4), realized_pnl_usd decimal(24,4), pnl_unresolvable boolean"
    ).withColumn("trade_date", F.lit(DAY)).withColumn("loaded_at", F.current_timestamp())
    mart = {r["symbol"]: r for r in M.fct_daily_trading_pnl(df).collect()}
    assert (mart["A"]["buy_quantity"], mart["A"]["sell_quantity"], mart["A"]["trade_count"]) == (2, 3, 2)
    assert mart["A"]["realized_pnl_usd"] == 1 and mart["A"]["unresolvable_trade_count"] == 1
    assert mart["B"]["realized_pnl_usd"] is None and mart["B"]["sell_quantity"] == 0


def test_risk_mart(spark):
    contract = S.TABLES["portfolio_pnl"]

    def row(name, value, limit, value_flag, loss_flag):
        return (name, None, DAY, 1, D(value), D(0), limit, None, None, value_flag, loss_flag, datetime(2026, 8, 3))

    df = spark.createDataFrame(
        [row("a", -50, D(100), False, None), row("b", 200, D(100), True, None),
         row("c", 1, None, None, None), row("d", 1, D(0), None, True)],
        S.table_schema(contract),
    )
    mart = {r["portfolio_id"]: r for r in M.fct_portfolio_risk(M.stg_portfolio_pnl(df)).collect()}
    assert {k: r["risk_status"] for k, r in mart.items()} == {
        "a": "WITHIN_LIMIT", "b": "BREACH", "c": "WITHIN_LIMIT", "d": "BREACH"}
    assert {k: r["market_value_limit_utilization"] for k, r in mart.items()} == {
        "a": D("0.5"), "b": D(2), "c": None, "d": None}
    summary = V.v_portfolio_risk_summary(df).first()
    assert (summary["market_value_breach_count"], summary["daily_loss_breach_count"], summary["total_breached_portfolios"]) == (1, 1, 2)


def test_load_views(spark):
    at = datetime.fromisoformat
    rows = [
        (1, "d", "r1", DAY, "a", "p", 1, 10, "SUCCESS", at("2026-08-03 10:00:00"), at("2026-08-03 10:00:01.5"), None),
        (2, "d", "r1", DAY, "b", "p", 0, 0, "FAILED", at("2026-08-03 10:00:05"), None, "boom"),
    ]
    log = spark.createDataFrame(rows, S.LOAD_LOG)
    run = V.v_pipeline_load_summary(log).first()
    assert (run["load_task_count"], run["successful_load_count"], run["failed_load_count"]) == (2, 1, 1)
    assert run["load_duration_seconds"] == 1.5
    durations = {r["load_id"]: r["duration_seconds"] for r in V.v_table_load_metrics(log).collect()}
    assert durations == {1: 1.5, 2: None}
    assert [r["target_table"] for r in V.latest_loads(log, 1).collect()] == ["b"]


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "metric string, value bigint")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 4)], "metric string, value bigint")
    assert {r["metric"]: r["ok"] for r in V.reconcile(a, b).collect()} == {"x": True, "y": False, "z": False}
