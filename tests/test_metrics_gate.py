import json
from datetime import date
from decimal import Decimal as D

import pytest

from daybook.functions.dates import parse_run_date, resolve_run_date
from daybook.operators.gate import QualityGateFailed, quality_gate, require_passed
from daybook.operators.metrics import build_metrics, metrics_json, run_totals
from daybook.operators.rejects import rejection_counts, rejection_rollup, union_all_by_name
from daybook.plans import monitoring as V

DAY, NEXT, EMPTY = date(2026, 8, 3), date(2026, 8, 4), date(2026, 8, 5)


def frames(spark, valid=98, rejected=2, unresolvable=0, pnl="1.5000"):
    trades = spark.createDataFrame([(DAY,)] * valid, "run_date date")
    clean = spark.createDataFrame(
        [(DAY, i < unresolvable, None if i < unresolvable else D(pnl)) for i in range(valid)],
        "trade_date date, pnl_unresolvable boolean, realized_pnl_usd decimal(24,4)",
    )
    rejects = spark.createDataFrame(
        [(DAY, "trades", "T")] * rejected + [(DAY, "market_data", "M")] * 3 + [(NEXT, "portfolio", "Q")],
        "run_date date, source_name string, rejection_rule string",
    )
    portfolio = spark.createDataFrame([(DAY,)] * 4, "pnl_date date")
    return trades, clean, rejects, portfolio


def metrics(spark, **options):
    trades, clean, rejects, portfolio = frames(spark, **options)
    every = spark.createDataFrame([(d,) for d in (DAY, NEXT, EMPTY)], "run_date date")
    return build_metrics(run_totals(trades, clean, rejects, portfolio, every), rejects)


def test_metrics_document(spark):
    lines = {r["run_date"]: json.loads(r["value"]) for r in metrics_json(metrics(spark)).collect()}
    document = lines[DAY]
    assert list(document) == sorted(document)
    assert document == {
        "pipeline_name": "daily_feed_pipeline", "run_date": "2026-08-03",
        "total_trade_count": 100, "clean_trade_count": 98, "trade_rejection_count": 2,
        "total_rejection_count": 5, "rejection_count_by_rule": {"M": 3, "T": 2},
        "rejection_count_by_source": {"market_data": 3, "trades": 2},
        "trade_reject_rate": 0.02, "overall_reject_rate": 0.05, "pnl_unresolvable_count": 0,
        "total_realized_pnl_usd": "147.0000", "portfolio_pnl_count": 4,
        "quality_gate": {
            "trade_reject_rate": 0.02, "trade_reject_rate_threshold": 0.02,
            "pnl_unresolvable_count": 0, "pnl_unresolvable_threshold": 100, "passed": False,
        },
    }
    # No trades: rate 0, gate passes; no rejects: empty maps; no P&L: "0".
    assert lines[NEXT]["overall_reject_rate"] == 0 and lines[NEXT]["total_rejection_count"] == 1
    assert lines[EMPTY]["quality_gate"]["passed"] and lines[EMPTY]["rejection_count_by_rule"] == {}
    assert lines[EMPTY]["total_realized_pnl_usd"] == "0"


def test_zero_pnl_is_written_as_zero(spark):
    row = metrics(spark, pnl="0").where("run_date = '2026-08-03'").first()
    assert row["total_realized_pnl_usd"] == "0"


@pytest.mark.parametrize(
    "valid, rejected, unresolvable, passed",
    [(98, 2, 0, False), (99, 1, 0, True), (200, 1, 99, True), (200, 1, 100, False), (200, 1, 101, False)],
)
def test_both_thresholds_are_strict(spark, valid, rejected, unresolvable, passed):
    document = metrics(spark, valid=valid, rejected=rejected, unresolvable=unresolvable)
    row = quality_gate(document.where("run_date = '2026-08-03'")).first()
    assert (row["passed"], row["recorded_passed"], row["disagrees"]) == (passed, passed, False)


def test_gate_judges_anew(spark):
    row = quality_gate(metrics(spark).where("run_date = '2026-08-03'"), max_reject_rate=0.5).first()
    assert row["passed"] and not row["recorded_passed"] and row["disagrees"]


def test_missing_metrics_are_an_error(spark):
    schema = """run_date string, trade_reject_rate double, pnl_unresolvable_count bigint,
        quality_gate struct<passed:boolean,trade_reject_rate:double,pnl_unresolvable_count:bigint>"""
    df = spark.createDataFrame(
        [("a", 0.5, 1, None), ("b", 0.9, None, (True, 0.01, 5)), ("c", None, 7, None), ("d", None, None, None)],
        schema,
    )
    rows = {r["run_date"]: r for r in quality_gate(df).collect()}
    assert rows["a"]["passed"] is False and rows["a"]["disagrees"] is False
    assert rows["b"]["passed"] is True and rows["b"]["trade_reject_rate"] == 0.01
    assert rows["c"]["missing_metrics"] == "trade_reject_rate" and rows["c"]["passed"] is None
    assert rows["d"]["missing_metrics"] == "trade_reject_rate, pnl_unresolvable_count"
    with pytest.raises(Exception, match="Quality gate metrics are missing: trade_reject_rate"):
        quality_gate(df.where("run_date = 'c'"), strict=True).collect()
    with pytest.raises(QualityGateFailed, match="a, c, d"):
        require_passed(quality_gate(df))
    require_passed(quality_gate(df.where("run_date = 'b'")))


def test_rollup_levels(spark):
    rejects = frames(spark)[2].unionAll(spark.createDataFrame([(DAY, "portfolio", "T")], "a date, b string, c string"))
    rows = {(r["source_name"], r["rejection_rule"], r["level"]): r["rejected_record_count"]
            for r in rejection_rollup(rejects).collect()}
    assert rows == {
        ("trades", "T", "source_rule"): 2, ("market_data", "M", "source_rule"): 3,
        ("portfolio", "Q", "source_rule"): 1, ("portfolio", "T", "source_rule"): 1,
        ("trades", None, "source"): 2, ("market_data", None, "source"): 3, ("portfolio", None, "source"): 2,
        (None, "T", "rule"): 3, (None, "M", "rule"): 3, (None, "Q", "rule"): 1, (None, None, "total"): 7,
    }
    assert rejection_counts(rejects.where("false")).count() == 0


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y",)], "s string")
    rows = union_all_by_name([a, b]).collect()
    assert [(r["n"], r["s"]) for r in rows] == [(1, "x"), (None, "y")]
    with pytest.raises(ValueError):
        union_all_by_name([])


def test_run_dates():
    assert parse_run_date("2026-08-03") == DAY and parse_run_date(DAY) == DAY
    assert resolve_run_date(None, DAY) == DAY and resolve_run_date("2026-08-04", DAY) == NEXT
    for bad in ("2026-13-01", "03.08.2026", "", "20260803"):
        with pytest.raises(ValueError):
            parse_run_date(bad)


def test_quality_view_and_empty_days(spark):
    trades = spark.createDataFrame(
        [(DAY, "P", "A", "BUY", False, D(1)), (DAY, "P", "B", "SELL", True, None), (DAY, "Q", "A", "BUY", False, D(2))],
        "trade_date date, portfolio_id string, symbol string, side string, pnl_unresolvable boolean, realized_pnl_usd decimal(24,4)",
    )
    rejects = spark.createDataFrame(
        [(DAY, "trades", "T"), (NEXT, "market_data", "M")], "run_date date, source_name string, rejection_rule string")
    quality = {r["metric_date"]: r for r in V.v_daily_quality_metrics(trades, rejects).collect()}
    assert quality[DAY]["trade_reject_rate"] == 0.25 and not quality[DAY]["quality_gate_passed"]
    assert quality[NEXT]["trade_reject_rate"] == 0 and quality[NEXT]["quality_gate_passed"] is False
    assert quality[NEXT]["total_rejected_count"] == 1 and quality[NEXT]["accepted_trade_count"] == 0
    relaxed = V.v_daily_quality_metrics(trades, rejects, max_reject_rate=0.3).where("metric_date = '2026-08-03'")
    assert relaxed.first()["quality_gate_passed"]
    daily = V.v_daily_trade_metrics(trades).first()
    assert (daily["processed_trade_count"], daily["portfolio_count"], daily["symbol_count"]) == (3, 2, 2)
    assert (daily["buy_trade_count"], daily["sell_trade_count"], daily["unresolvable_trade_count"]) == (2, 1, 1)
    assert daily["total_realized_pnl_usd"] == 3
    nothing = V.v_daily_trade_metrics(trades.where("pnl_unresolvable")).first()
    assert nothing["total_realized_pnl_usd"] == 0
