"""What the optimizer makes of the operators."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import feeds as X
from daybook.operators.market import process_market
from daybook.operators.portfolio import process_portfolios
from daybook.operators.trades import process_trades, trade_pnl
from daybook.plans import models as M
from daybook.plans import monitoring as V
from daybook.sources import readers
from daybook.sources.writers import write_partitions

DAY = date(2026, 8, 3)
SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Feeds as Parquet, so that plans show the operators alone."""
    root = str(tmp_path_factory.mktemp("plans"))
    X.messages(spark, SF).write.parquet(f"{root}/messages")
    X.market(spark, SF).write.parquet(f"{root}/market")
    X.documents(spark, SF).write.parquet(f"{root}/documents")
    return {n: spark.read.parquet(f"{root}/{n}") for n in ("messages", "market", "documents")}


def test_splitting_parses_each_tag_once(stored):
    for half in process_trades(stored["messages"], DAY):
        text = plan(half)
        assert text.count("locate(|60=") == 1
        assert "Exchange" not in text


def test_trades_are_priced_without_a_shuffle(stored):
    market = process_market(stored["market"], DAY)[0]
    for df in trade_pnl(process_trades(stored["messages"], DAY)[0], market):
        text = plan(df)
        assert "BroadcastHashJoin" in text
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
        assert "Python" not in text


def test_large_price_tables_are_not_broadcast(spark, stored):
    market = process_market(stored["market"], DAY)[0]
    clean = trade_pnl(process_trades(stored["messages"], DAY)[0], market, small=False)[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(clean)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "key_salt" in text
    assert "Limit" not in text and "TakeOrdered" not in text  # every frequent key is salted


def test_portfolio_needs_one_shuffle(stored):
    market = process_market(stored["market"], DAY)[0]
    pnl, rejected = process_portfolios(stored["documents"], DAY, market)
    assert plan(pnl).count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning" not in plan(rejected)


def test_marts_aggregate_before_the_shuffle(stored):
    market = process_market(stored["market"], DAY)[0]
    clean = trade_pnl(process_trades(stored["messages"], DAY)[0], market)[0]
    mart = plan(M.fct_daily_trading_pnl(clean.withColumn("loaded_at", F.current_timestamp())))
    assert "partial_sum" in mart and mart.count("Exchange hashpartitioning") == 1


def test_dates_prune_folders_and_columns(spark, tmp_path):
    df = spark.range(10).select(
        "id", F.col("id").cast("string").alias("text"), F.date_add(F.lit(DAY), (F.col("id") % 2).cast("int")).alias("dt"))
    write_partitions(df, f"{tmp_path}/t", [DAY, date(2026, 8, 4)])
    table = spark.read.parquet(f"{tmp_path}/t")
    text = V.on_run_date(table, "dt", DAY).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text and "ReadSchema: struct<id:bigint>" in text
    assert readers.read_partition(spark, f"{tmp_path}/t", DAY).count() == 5
