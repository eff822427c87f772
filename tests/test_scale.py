"""What keeps work in proportion to the tables: documents by positions, rows derived once, rare keys left alone."""

from collections import Counter
from datetime import date
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks import feeds as X
from checks import job_queries as J
from checks import table_queries as T
from daybook import schemas as S
from daybook.operators import prices as P
from daybook.operators.portfolio import explode_positions
from daybook.operators.trades import PRICED_COLUMNS, process_trades, trade_pnl
from tests.test_prices import MARKET
from tests.test_trades import message

DAY = date(2026, 8, 3)


def positions(spark, root, held):
    """Tables in which customer c holds the parts ``held[c]``, one order of one item each."""
    items = [(i, c, p) for i, (c, p) in enumerate((c, p) for c, parts in held.items() for p in parts)]
    spark.createDataFrame([(c, 1) for c in held], "c_custkey bigint, c_nationkey int").write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{root}/nation.parquet")
    spark.createDataFrame([(i, c) for i, c, _ in items], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{root}/orders.parquet")
    lines = "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_linestatus string"
    spark.createDataFrame([(i, p, 1, 2.0, 10.0, "F") for i, _, p in items], lines).write.parquet(f"{root}/lineitem.parquet")
    return str(root)


def test_documents_grow_with_positions_not_with_parts(spark, tmp_path):
    held = {c: [c * 100_003 + k * 50_021 for k in range(4)] for c in range(1, 21)} | {21: []}
    root = positions(spark, tmp_path, held)
    assert X.document_lines(spark, root).count() == 1
    rows = explode_positions(X.documents(spark, root)).groupBy("portfolio_name").agg(F.count("*"), F.count("position_quantity")).collect()
    assert {tuple(r) for r in rows} == {(f"Portfolio {c}", max(1, len(p)), sum(x % 60 != 0 for x in p)) for c, p in held.items()}


def test_large_portfolios_are_split_over_documents(spark, tmp_path):
    root = positions(spark, tmp_path, {2: range(1, 1301), 3: range(1, 11)})
    assert X.document_lines(spark, root).count() == 3
    assert explode_positions(X.documents(spark, root)).count() == 1310


def test_feeds_on_two_days_hold_the_same_rows(spark, tmp_path):
    root = positions(spark, tmp_path / "in", {2: range(1, 30)})
    X.write_documents(spark, root, f"{tmp_path}/out", days=2)
    texts = spark.read.text(f"{tmp_path}/out").groupBy("dt").agg(F.collect_set("value").alias("values")).collect()
    assert {r["dt"] for r in texts} == {DAY, date(2026, 8, 4)} and texts[0]["values"] == texts[1]["values"]


def test_shuffled_join_parses_its_rows_once(spark):
    raw = spark.createDataFrame([(message(t11=f"O{i}"),) for i in range(20)], "raw_record string")
    market = spark.createDataFrame([("ABC", DAY, D(100), "USD", D(1))], MARKET)
    clean = trade_pnl(process_trades(raw, DAY)[0], market, small=False)[0]
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "locate(" not in plan and "unpriced" in plan
    assert clean.count() == 20


def test_frequent_keys_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(P, "KEY_BUCKETS", 3)  # every hash holds rare and frequent keys
    keys = [(f"S{i % 7}", DAY) for i in range(70)] + [("HOT", DAY)] * 41 + [("WARM", DAY)] * 21 + [(None, DAY), ("HOT", None)] * 50
    keyed = spark.createDataFrame(keys, "key_symbol string, key_day date")
    want = {s: -(-n // 20) for (s, d), n in Counter(keys).items() if s and d and n > 20}
    assert {r["hot_symbol"]: r["salts"] for r in P._frequent_keys(keyed, 20).collect()} == want


def counted(rows, column, seen):
    """The rows, with a column that counts in ``seen`` how often they are derived."""
    same = F.udf(lambda value: (seen.add(1), value)[1], "string").asNondeterministic()
    return rows.withColumn(column, same(column))


def test_rejects_are_derived_once_for_both_sides(spark, tmp_path, monkeypatch):
    columns = "source_name string, run_date date, record_identifier string, raw_record string, rejection_rule string, rejection_reason string, rejected_at timestamp"
    rejects = [("trades", DAY, None, f"r{i % 4}", "RULE", "why", None) for i in range(7)] + [("portfolio", DAY, "P", None, "RULE", "why", None)] * 2
    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(J, "all_rejects", lambda *_: counted(spark.createDataFrame(rejects, columns), "rejection_reason", seen))
    rows = J.serial_ids.__wrapped__(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows} == {("trades", 7, 7, 7, 4), ("portfolio", 2, 2, 2, 1)}
    assert seen.value == len(rejects)


def test_months_are_derived_once(spark, tmp_path, monkeypatch):
    days = [date(2026, month, 1) for month in (1, 2, 3)]
    trades = spark.createDataFrame([(f"O{i}", days[i % 3], 1) for i in range(30)], "order_id string, dt date, quantity int")
    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(J, "monthly_trades", lambda *_: counted(trades, "order_id", seen).where("order_id is not null"))
    last = J.read_partition.__wrapped__(spark, str(tmp_path)).collect()
    assert sorted(r["order_id"] for r in last) == sorted(f"O{i}" for i in range(30) if i % 3 == 2)
    assert seen.value == 30


def test_documents_are_gathered_where_positions_are_numbered(spark, tmp_path, monkeypatch):
    root = positions(spark, tmp_path, {c: range(1, 20) for c in range(1, 200)})
    monkeypatch.setattr(X, "LINES_PER_PARTITION", 100)
    lines = X.document_lines(spark, root)
    above = lines._jdf.queryExecution().executedPlan().toString().split("Window [")[0]
    assert "Exchange" not in above
    # Partitions follow the line items, so that none outgrows its task.
    assert X.positions(spark, root).rdd.getNumPartitions() >= 199 * 19 // 100


def test_positions_are_those_of_the_feed(spark, tmp_path):
    root = positions(spark, tmp_path, {c: range(c, c + 3) for c in (1, 2, 49, 50, 51, 2048, 4097)} | {7: []})
    feed = X.feed(spark, root, "feed_positions")
    rows = X.positions(spark, root)
    assert Counter(rows.drop("customers").collect()) == Counter(feed.collect())
    assert {(r["c_custkey"], r["customers"]) for r in rows.collect()} == {(c, c // 2048) for c in (1, 2, 7, 49, 50, 51, 2048, 4097)}


def test_trades_of_two_loads_are_derived_once(spark, tmp_path, monkeypatch):
    fields = {c: "cast(null as string)" for c in PRICED_COLUMNS} | {
        "order_id": "'O' || id", "portfolio_id": "'P'", "side": "if(id % 2 = 0, 'BUY', 'SELL')", "quantity": "cast(id as decimal(20,4))",
        "currency": "'USD'", "trade_date": f"date'{DAY}'", "pnl_unresolvable": "false"}
    clean = spark.range(50).select(*[F.expr(e).cast(S.TABLES["processed_trades"].types[c]).alias(c) for c, e in fields.items()])
    for query, want in ((J.reload_partition, {(25, 50, 25)}), (J.contract_quarantine, None)):
        seen = spark.sparkContext.accumulator(0)
        monkeypatch.setattr(J, "clean_trades", SimpleNamespace(__wrapped__=lambda *_: counted(clean, "order_id", seen)))
        rows = query.__wrapped__(spark, str(tmp_path)).collect()
        assert want is None or {(r["trades"], r["rows_deleted"], r["rows_inserted"]) for r in rows} == want
        assert seen.value == 50


def test_message_stays_out_of_the_join(spark):
    raw = spark.createDataFrame([(message(t11="O"),)], "raw_record string")
    market = spark.createDataFrame([("ABC", DAY, D(100), "USD", D(1))], MARKET)
    clean = trade_pnl(process_trades(raw, DAY)[0], market, small=False)[0]
    (path,) = {p.rsplit("/", 1)[0] for p in clean.inputFiles() if "/unpriced-" in p}
    assert "raw_record" not in spark.read.parquet(path).columns


def test_reconciliations_stage_the_feeds_once(spark, tmp_path, monkeypatch):
    calls = []

    def staged(*_):
        calls.append(1)
        raise InterruptedError

    monkeypatch.setattr(T, "staged", staged)
    monkeypatch.setattr("checks.feed_queries.staged", lambda *_: calls.append("again"))
    for query in (T.metrics_reconciliation, T.sources_reconciliation):
        with pytest.raises(InterruptedError):
            query.__wrapped__(spark, str(tmp_path))
    assert calls == [1, 1]


def test_prices_of_given_positions_are_those_of_the_feed(spark, tmp_path):
    root = positions(spark, tmp_path, {c: range(c, c + 3) for c in range(1, 9)})
    spark.range(1, 9).selectExpr("id p_partkey", "'T' p_type", "cast(id as int) p_size", "1.5D p_retailprice").write.parquet(f"{root}/part.parquet")
    held = X.positions(spark, root, X.DAILY)
    want = X.market(spark, root, X.DAILY, portfolio_prices=True).collect()
    assert Counter(X.market(spark, root, X.DAILY, portfolio_prices=True, held=held).collect()) == Counter(want) and want
    given = explode_positions(X.documents(spark, root, X.DAILY, held)).collect()
    assert Counter(given) == Counter(explode_positions(X.documents(spark, root, X.DAILY)).collect())
