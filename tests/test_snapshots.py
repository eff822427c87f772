"""Versioned tables: commits, failures in between, several writers, and what follows from them."""

import os
import subprocess
import sys
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas as S
from daybook.operators import identity
from daybook.operators.identity import COPIES_AT_ONCE, with_content_ids
from daybook.plans import pipeline
from daybook.sources import catalog, snapshots, warehouse as wh

DAY = date(2026, 8, 3)
DAYS = [DAY + timedelta(days=i) for i in range(4)]
SCHEMA = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("dt", T.DateType())])


def frame(spark, *rows):
    return spark.createDataFrame([(v, f"t{v}", d) for v, d in rows], SCHEMA)


def content(spark, root, **options):
    return sorted((r["v"], r["dt"]) for r in snapshots.read_dates(spark, root, SCHEMA, "dt", **options).collect())


def test_many_dates_change_by_one_commit(spark, tmp_path):
    root = str(tmp_path)
    assert snapshots.snapshot(spark, root) == snapshots.EMPTY and content(spark, root) == []
    first = snapshots.replace_dates(frame(spark, (1, DAYS[0]), (2, DAYS[1]), (3, DAYS[1]), (9, DAYS[3])), root, "dt", DAYS[:3])
    assert first == {DAYS[0]: snapshots.Reload(0, 1), DAYS[1]: snapshots.Reload(0, 2), DAYS[2]: snapshots.Reload(0, 0)}
    assert content(spark, root) == [(1, DAYS[0]), (2, DAYS[1]), (3, DAYS[1])]
    old = snapshots.read_dates(spark, root, SCHEMA, "dt")
    second = snapshots.replace_dates(frame(spark, (5, DAYS[2])), root, "dt", [DAYS[1], str(DAYS[2])])
    assert second == {DAYS[1]: snapshots.Reload(2, 0), DAYS[2]: snapshots.Reload(0, 1)}
    assert content(spark, root) == [(1, DAYS[0]), (5, DAYS[2])]
    assert content(spark, root, run_dates=[DAYS[2]]) == [(5, DAYS[2])]
    assert sorted(r["v"] for r in old.collect()) == [1, 2, 3]  # a reader keeps the state it started from
    state = snapshots.snapshot(spark, root)
    assert (state.number, state.total_rows(), state.rows(DAYS[1])) == (2, 2, 0)
    assert snapshots.snapshot(spark, root, 1).total_rows() == 3
    with pytest.raises(ValueError, match="No commit 7"):
        snapshots.snapshot(spark, root, 7)


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    snapshots.replace_dates(frame(spark, (1, DAY)), root, "dt", [DAY])
    broken = frame(spark, (2, DAY), (3, DAY)).withColumn("v", F.when(F.col("v") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        snapshots.replace_dates(broken, root, "dt", [DAY])
    assert content(spark, root) == [(1, DAY)]
    with monkeypatch.context() as m:  # killed after the files, before the commit
        m.setattr(snapshots, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            snapshots.replace_dates(frame(spark, (4, DAY)), root, "dt", [DAY])
    assert content(spark, root) == [(1, DAY)] and snapshots.snapshot(spark, root).number == 1
    assert len(snapshots.remove_unused(spark, root)) == 2
    assert content(spark, root) == [(1, DAY)]


def test_two_writers_at_once_both_come_in(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    snapshots.replace_dates(frame(spark, (1, DAYS[0])), root, "dt", DAYS[:1])
    plain, other = snapshots._encoded, []

    def slow(state):
        if not other:  # another writer commits between reading the state and storing the next
            other.append(1)
            snapshots.replace_dates(frame(spark, (2, DAYS[1])), root, "dt", [DAYS[1]])
        return plain(state)

    monkeypatch.setattr(snapshots, "_encoded", slow)
    assert snapshots.replace_dates(frame(spark, (3, DAYS[2])), root, "dt", [DAYS[2]]) == {DAYS[2]: snapshots.Reload(0, 1)}
    assert content(spark, root) == [(1, DAYS[0]), (2, DAYS[1]), (3, DAYS[2])]
    assert snapshots.snapshot(spark, root).number == 3
    assert not [n for n in os.listdir(f"{root}/commits") if n.startswith("_")]


def test_restore_and_removal(spark, tmp_path):
    root = str(tmp_path)
    for v in (1, 2, 3):
        snapshots.replace_dates(frame(spark, (v, DAY)), root, "dt", [DAY])
    assert snapshots.restore(spark, root, 1).number == 4
    assert content(spark, root) == [(1, DAY)]
    assert len(snapshots.remove_unused(spark, root, keep=1)) == 2
    assert content(spark, root) == [(1, DAY)]
    with pytest.raises(ValueError):
        snapshots.restore(spark, root, 2)


RETRIES = """
import sys
from datetime import date

sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from daybook.sources import snapshots

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()


def once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost after its rows")


df = spark.range(1000, numPartitions=4).select(F.col("id"), F.lit("2026-08-03").cast("date").alias("dt"))
result = snapshots.replace_dates(df.mapInArrow(once, df.schema), sys.argv[2], "dt", ["2026-08-03"])
rows = snapshots.read_dates(spark, sys.argv[2], df.schema, "dt")
assert result == {date(2026, 8, 3): snapshots.Reload(0, 1000)}, result
assert rows.count() == rows.distinct().count() == 1000
print("counted once")
"""


def test_counts_hold_when_every_task_runs_twice(tmp_path):
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RETRIES, top, f"{tmp_path}/t"], capture_output=True, text=True, cwd=tmp_path, timeout=120)
    assert "counted once" in done.stdout, done.stderr[-2000:]


def test_reading_a_date_lists_its_folder_alone(spark, tmp_path):
    root = str(tmp_path)
    snapshots.replace_dates(frame(spark, *[(i, d) for i, d in enumerate(DAYS)]), root, "dt", DAYS)
    one = snapshots.read_dates(spark, root, SCHEMA, "dt", [DAYS[1]])
    assert len(one.inputFiles()) == 1
    plan = snapshots.read_dates(spark, root, SCHEMA, "dt").where(F.col("dt") == DAYS[2]).select("v")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text and "ReadSchema: struct<v:int>" in text


def trades(spark, *rows):
    """Clean trades (order, day, quantity); all else is constant."""
    contract = S.TABLES["processed_trades"]
    fixed = {"portfolio_id": "P", "symbol": "S", "side": "BUY", "currency": "USD", "pnl_unresolvable": False}
    known = spark.createDataFrame(rows, "order_id string, trade_date date, quantity int")
    return known.select(*[
        F.col(c).cast(contract.types[c]) if c in known.columns else F.lit(fixed.get(c)).cast(contract.types[c]).alias(c)
        for c in contract.columns])


def test_marts_follow_changed_dates_only(spark, tmp_path):
    root, contract = str(tmp_path), S.TABLES["processed_trades"]
    wh.create_tables(spark, root)
    wh.reload_dates(trades(spark, *[(f"o{i}", DAYS[i % 3], i) for i in range(9)]), root, contract, DAYS[:3])
    catalog.register_staging(spark, root)

    def totals():
        return {r["trade_date"]: (r["trade_count"], int(r["buy_quantity"])) for r in catalog.read_mart(spark, root, "fct_daily_trading_pnl").collect()}

    assert catalog.build_marts(spark, root)["fct_daily_trading_pnl"] == DAYS[:3]
    assert totals() == {DAYS[0]: (3, 9), DAYS[1]: (3, 12), DAYS[2]: (3, 15)}
    assert catalog.build_marts(spark, root) == {name: [] for name in catalog.MARTS}
    path = catalog.mart_path(root, "fct_daily_trading_pnl")
    before = snapshots.snapshot(spark, path)
    wh.reload_dates(trades(spark, ("n", DAYS[1], 100)), root, contract, [DAYS[1]])
    wh.reload_dates(trades(spark), root, contract, [DAYS[2]])
    wh.reload_dates(trades(spark, ("m", DAYS[3], 7)), root, contract, [DAYS[3]])
    assert catalog.build_marts(spark, root)["fct_daily_trading_pnl"] == DAYS[1:]
    assert totals() == {DAYS[0]: (3, 9), DAYS[1]: (1, 100), DAYS[3]: (1, 7)}
    after = snapshots.snapshot(spark, path)
    assert after.dates[DAYS[0]] == before.dates[DAYS[0]] and after.number == before.number + 1
    assert catalog.build_marts(spark, root)["fct_daily_trading_pnl"] == []
    assert catalog.build_marts(spark, root, rebuild=True)["fct_daily_trading_pnl"] == [DAYS[0], DAYS[1], DAYS[3]]
    assert totals() == {DAYS[0]: (3, 9), DAYS[1]: (1, 100), DAYS[3]: (1, 7)}
    only = catalog.staged(spark, root, "stg_processed_trades", [DAYS[1]])
    assert len(only.inputFiles()) == 1


def test_kept_aggregates_equal_views_over_the_tables(spark, tmp_path):
    root, contract = str(tmp_path), S.TABLES["processed_trades"]
    wh.create_tables(spark, root)

    def same():
        plain, kept = (pipeline.monitoring_views(spark, root, maintained=m) for m in (False, True))
        assert plain.keys() == kept.keys()
        for name in plain:
            assert kept[name].columns == plain[name].columns
            assert sorted(map(str, kept[name].collect())) == sorted(map(str, plain[name].collect())), name
        return kept

    same()  # empty tables
    wh.reload_dates(trades(spark, *[(f"o{i}", DAYS[i % 3], i) for i in range(9)]), root, contract, DAYS[:3])
    assert same()["v_daily_quality_metrics"].count() == 3
    assert catalog.refresh_aggregates(spark, root) == {"daily_trades": [], "daily_rejections": [], "daily_risk": []}
    wh.reload_dates(trades(spark, ("n", DAYS[1], 100)), root, contract, [DAYS[1]])
    wh.reload_dates(trades(spark), root, contract, [DAYS[2]])
    assert catalog.refresh_aggregates(spark, root)["daily_trades"] == DAYS[1:3]
    assert same()["v_daily_trade_metrics"].count() == 2
    assert catalog.refresh_aggregates(spark, root, rebuild=True)["daily_trades"] == DAYS[:2]


def test_content_ids(spark):
    n = 2 * COPIES_AT_ONCE + 5
    rows = [("hot", None, DAY)] * n + [("hot", "x", DAY), ("a", None, None), ("a", None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "text string, key string, stamp date").repartition(7)
    first = with_content_ids(df, "id", ("stamp",))
    assert first.columns == ["id", "text", "key", "stamp"]
    got = first.collect()
    assert Counter((r["text"], r["key"], r["stamp"]) for r in got) == Counter(rows)
    assert len({r["id"] for r in got}) == len(rows)
    later = df.withColumn("stamp", F.when(F.rand(1) < 0.5, F.lit(DAY))).repartition(3, "key")
    again = with_content_ids(later, "id", ("stamp",)).collect()
    assert Counter((r["id"], r["text"], r["key"]) for r in again) == Counter((r["id"], r["text"], r["key"]) for r in got)
    assert with_content_ids(df.where("false"), "id").count() == 0
    more = with_content_ids(df.unionByName(df.where("text = 'a'")), "id", ("stamp",)).collect()
    assert {r["id"] for r in got} < {r["id"] for r in more}


def test_rows_without_copies_are_not_shuffled_for_ids(spark, monkeypatch):
    rows = [(f"t{i}", DAY) for i in range(50)] + [("twice", DAY), ("twice", None)]
    df = spark.createDataFrame(rows, "text string, stamp date")
    few = with_content_ids(df, "id", ("stamp",))
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    monkeypatch.setattr(identity, "BROADCAST_HASHES", 0)
    many = with_content_ids(df, "id", ("stamp",))
    assert "LeftAnti" not in many._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(few.collect()) == Counter(many.collect()) and few.select("id").distinct().count() == len(rows)
