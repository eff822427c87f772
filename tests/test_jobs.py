import json
import os
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.operators.gate import QualityGateFailed
from daybook.operators.portfolio import explode_positions
from daybook.plans import monitoring as V
from daybook.plans import pipeline
from daybook.sources import catalog, readers, warehouse as wh
from daybook.sources.session import work_folder
from daybook.sources.writers import (
    project_contract, write_delimited, write_metrics, write_partitions, write_portfolio_lines,
)
from daybook.streaming.ingest import ingest_new_files
from daybook.streaming.jobs import DailyJob, complete_dates, run_batch, run_on_arrival
from tests.test_market_portfolio import portfolio, position
from tests.test_trades import message

DAY, NEXT = date(2026, 8, 3), date(2026, 8, 4)
HEADER = "symbol,asset_class,close_price,currency,fx_rate_to_usd,price_date,loaded_at\n"


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)


def write_inputs(root, day, trades):
    compact = day.strftime("%Y%m%d")
    lines = [message(**({"t11": f"O{i}", "t60": f"{compact}-10:00:00"} | t)) for i, t in enumerate(trades)]
    put(f"{root}/trades/dt={day}/trades.fix", "\n".join(lines) + "\n")
    put(f"{root}/market_data/dt={day}/equities.csv",
        HEADER + f"abc,EQUITY,110,USD,,{day},{day}T00:00:00Z\nshort,EQUITY\n")
    put(f"{root}/market_data/dt={day}/fx.csv", HEADER + f"eur,FX,-1,EUR,1.1,{day},\nbad,FX,oops,EUR,1.1,{day},\n")
    document = {"run_date": str(day), "portfolios": [portfolio("P1", [position("abc"), position("zz")])]}
    put(f"{root}/portfolio/dt={day}/portfolio.json", json.dumps(document, indent=2))


@pytest.fixture()
def root(tmp_path):
    write_inputs(f"{tmp_path}/in", DAY, [{}, {"t54": "2"}, {"t55": "none"}, {"t38": "-1"}, {"t11": None}])
    write_inputs(f"{tmp_path}/in", NEXT, [{}])
    return str(tmp_path)


def run(spark, root, days, **options):
    metrics = pipeline.run_pipeline(spark, f"{root}/in", f"{root}/out", days, **options)
    return {r["run_date"]: r for r in metrics.collect()}


def test_pipeline_over_two_dates(spark, root):
    metrics = run(spark, root, [DAY, NEXT], max_reject_rate=0.5)
    first, second = metrics["2026-08-03"], metrics["2026-08-04"]
    assert (first["total_trade_count"], first["clean_trade_count"], first["trade_rejection_count"]) == (5, 3, 2)
    assert first["pnl_unresolvable_count"] == 1 and first["portfolio_pnl_count"] == 1
    assert first["rejection_count_by_rule"] == {
        "TRADE_INVALID_QUANTITY": 1, "TRADE_MISSING_ORDER_ID": 1, "MARKET_INVALID_PRICE_DATE": 1,
        "MARKET_NON_POSITIVE_CLOSE_PRICE": 1, "MARKET_NULL_CLOSE_PRICE": 1,
        "PORTFOLIO_MARKET_PRICE_UNAVAILABLE": 1,
    }
    assert first["total_realized_pnl_usd"] == "0" and first["quality_gate"]["passed"]
    assert second["total_realized_pnl_usd"] == "115.5000" and second["trade_rejection_count"] == 0
    trades = readers.read_partition(spark, f"{root}/out/processed/trades", DAY)
    assert trades.columns == S.TABLES["processed_trades"].columns + ["dt"]
    assert trades.count() == 3
    unresolvable = readers.read_partition(spark, f"{root}/out/processed/unresolvable_pnl", NEXT)
    assert unresolvable.count() == 0
    # Work folders are gone, and running one date again replaces just that date.
    leftovers = spark.conf.get("spark.checkpoint.dir")
    assert not [n for n in os.listdir(leftovers) if n.startswith("run-")]
    write_inputs(f"{root}/in", DAY, [{"t11": None}])
    again = run(spark, root, [DAY])["2026-08-03"]
    assert again["clean_trade_count"] == 0 and not again["quality_gate"]["passed"]
    everything = spark.read.parquet(f"{root}/out/processed/trades").groupBy("dt").count().collect()
    assert {r["dt"]: r["count"] for r in everything} == {NEXT: 1}


def test_shuffled_join_gives_the_same_outputs(spark, root, monkeypatch):
    broadcast = run(spark, root, [DAY, NEXT])
    monkeypatch.setattr(pipeline, "fits_broadcast", lambda prices: False)
    assert run(spark, root, [DAY, NEXT]) == broadcast


def test_pipeline_needs_every_date(spark, root):
    with pytest.raises(FileNotFoundError, match="trades 2026-08-09, market_data 2026-08-09, portfolio 2026-08-09"):
        run(spark, root, [DAY, date(2026, 8, 9)])
    assert not os.path.exists(f"{root}/out")


def test_empty_source_date_leaves_everything_as_it_is(spark, root):
    run(spark, root, [DAY, NEXT], max_reject_rate=0.5)
    before = spark.read.parquet(f"{root}/out/processed/trades").count()
    for feed in ("trades", "portfolio"):
        for name in os.listdir(f"{root}/in/{feed}/dt={NEXT}"):
            os.remove(f"{root}/in/{feed}/dt={NEXT}/{name}")
    with pytest.raises(FileNotFoundError, match=f"for: trades {NEXT}, portfolio {NEXT}$"):
        run(spark, root, [DAY, NEXT], max_reject_rate=0.5)
    assert spark.read.parquet(f"{root}/out/processed/trades").count() == before
    put(f"{root}/in/trades/dt={NEXT}/trades.fix", "")
    put(f"{root}/in/portfolio/dt={NEXT}/portfolio.json", json.dumps({"run_date": str(NEXT), "portfolios": []}))
    metrics = run(spark, root, [NEXT])
    assert metrics[str(NEXT)]["total_trade_count"] == 0 and metrics[str(NEXT)]["quality_gate"]["passed"]


def test_warehouse_models_and_views(spark, root):
    run(spark, root, [DAY, NEXT], max_reject_rate=0.5)
    out, warehouse = f"{root}/out", f"{root}/wh"
    with pytest.raises(QualityGateFailed, match="2026-08-03"):
        pipeline.load_warehouse(spark, out, warehouse, DAY, "r0")
    with pytest.raises(QualityGateFailed, match="2026-08-03"):
        pipeline.load_warehouse(spark, out, warehouse, [DAY, NEXT], "r0")
    assert not os.path.exists(warehouse)
    loaded = pipeline.load_warehouse(spark, out, warehouse, DAY, "r1", max_reject_rate=0.5)
    assert loaded["processed_trades"] == {DAY: wh.Reload(rows_deleted=0, rows_inserted=3)}
    pipeline.load_warehouse(spark, out, warehouse, NEXT, "r2")
    before = V.table_row_counts(wh.read_tables(spark, warehouse))
    counts = before.collect()
    ids = wh.read_table(spark, warehouse, "rejected_records").select("rejection_id")
    first_ids = {r[0] for r in ids.collect()}
    again = pipeline.load_warehouse(spark, out, warehouse, [DAY, NEXT], "r3", max_reject_rate=0.5)
    assert again["processed_trades"] == {DAY: wh.Reload(3, 3), NEXT: wh.Reload(1, 1)}
    assert wh.table_snapshot(spark, warehouse, "processed_trades").number == 3
    assert V.table_row_counts(wh.read_tables(spark, warehouse)).collect() == counts
    log = wh.read_load_log(spark, warehouse)
    assert log.count() == 16 and log.select("load_id").distinct().count() == 16
    newest = {r["airflow_run_id"] for r in log.orderBy(F.desc("load_id")).limit(8).collect()}
    assert newest == {"r3"}
    ids = wh.read_table(spark, warehouse, "rejected_records").select("rejection_id")
    assert ids.count() == ids.distinct().count() == 10 and {r[0] for r in ids.collect()} == first_ids

    checks = pipeline.build_models(spark, warehouse).collect()
    assert len(checks) == 23 and {c["status"] for c in checks} == {"pass"}
    assert {c["status"] for c in pipeline.contract_report(spark, warehouse).collect()} == {"pass"}
    assert [tuple(r) for r in catalog.list_models(spark, warehouse).collect()] == [
        ("marts", "fct_daily_data_quality", 10), ("marts", "fct_daily_trading_pnl", 3),
        ("marts", "fct_portfolio_risk", 2), ("staging", "stg_portfolio_pnl", 2),
        ("staging", "stg_processed_trades", 4), ("staging", "stg_rejected_records", 10)]
    assert catalog.ref(spark, "fct_daily_trading_pnl").agg(F.sum("trade_count")).first()[0] == 4
    views = pipeline.monitoring_views(spark, warehouse)
    assert len(views) == 7
    assert spark.table("v_daily_quality_metrics").count() == 2
    metrics = readers.read_metrics(spark, f"{out}/metrics", [DAY])
    checked = V.reconcile_metrics(metrics, wh.read_tables(spark, warehouse), DAY).collect()
    assert len(checked) == 4 and all(r["ok"] for r in checked)


def test_failed_load_is_logged_and_keeps_the_table(spark, root):
    run(spark, root, [DAY], max_reject_rate=0.5)
    warehouse = f"{root}/wh"
    wh.create_tables(spark, warehouse)
    wh.load_table(spark, f"{root}/out", warehouse, "processed_trades", DAY, "r1")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        wh.load_table(spark, f"{root}/nowhere", warehouse, "processed_trades", DAY, "r2")
    assert wh.read_table(spark, warehouse, "processed_trades").count() == 3
    failed = wh.read_load_log(spark, warehouse).where("load_status = 'FAILED'").first()
    assert failed["rows_inserted"] == 0 and "PATH_NOT_FOUND" in failed["error_message"]
    assert len(failed["error_message"]) <= 5000
    absent = wh.missing_loads(wh.read_load_log(spark, warehouse), [DAY, NEXT], "r1").collect()
    assert sorted(map(tuple, absent)) == sorted(
        (f"raw.{t}", d) for t in S.TABLES for d in (DAY, NEXT) if (t, d) != ("processed_trades", DAY))
    with pytest.raises(ValueError, match="Unknown warehouse table"):
        wh.load_table(spark, f"{root}/out", warehouse, "nothing", DAY, "r")


def test_empty_reload_empties_the_date(spark, root):
    run(spark, root, [DAY, NEXT], max_reject_rate=0.5)
    warehouse, contract = f"{root}/wh", S.TABLES["processed_trades"]
    wh.create_tables(spark, warehouse)
    for day in (DAY, NEXT):
        wh.reload_partition(readers.read_partition(spark, f"{root}/out/processed/trades", day), warehouse, contract, day)
    nothing = readers.read_partition(spark, f"{root}/out/processed/trades", DAY).where("false")
    assert wh.reload_partition(nothing, warehouse, contract, DAY) == wh.Reload(3, 0)
    left = wh.read_table(spark, warehouse, "processed_trades")
    assert [r["trade_date"] for r in left.collect()] == [NEXT]
    assert wh.reload_partition(nothing, warehouse, contract, DAY) == wh.Reload(0, 0)


def test_readers_keep_blank_lines_and_bad_cells(spark, tmp_path):
    put(f"{tmp_path}/t/dt=2026-08-03/a.fix", "one\n\n  \nlast")
    lines = readers.read_tagged_text(spark, f"{tmp_path}/t", [DAY])
    assert [r["raw_record"] for r in lines.collect()] == ["one", "", "  ", "last"]
    assert lines.first()["dt"] == DAY
    put(f"{tmp_path}/m/dt=2026-08-03/a.csv", HEADER + "a,EQ,12.5,USD,,2026-08-03,\nb,EQ,x,USD,,nope,\nc\n")
    rows = {r["symbol"]: r for r in readers.read_market_csv(spark, f"{tmp_path}/m").collect()}
    assert rows["a"]["close_price"] == D("12.5") and rows["b"]["close_price"] is None
    assert rows["b"]["price_date"] is None and rows["c"]["currency"] is None


def test_metrics_files(spark, tmp_path):
    put(f"{tmp_path}/dt=2026-08-03/part-00001", '{"run_date": "second"}')
    put(f"{tmp_path}/dt=2026-08-03/part-00000", '{"run_date": "first", "trade_reject_rate": 0.5}')
    row = readers.read_metrics(spark, str(tmp_path), [DAY]).first()
    assert row["run_date"] == "first" and row["trade_reject_rate"] == 0.5 and row["quality_gate"] is None
    write_metrics(readers.read_metrics(spark, str(tmp_path), [DAY]).withColumn("run_date", F.lit("2026-08-04")), f"{tmp_path}/w")
    assert readers.read_metrics(spark, f"{tmp_path}/w", [NEXT]).first()["trade_reject_rate"] == 0.5
    put(f"{tmp_path}/bad/dt=2026-08-03/part-00000", "{not json")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_metrics(spark, f"{tmp_path}/bad", [DAY]).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_metrics(spark, str(tmp_path), [NEXT])


def test_source_inventory(spark, tmp_path):
    put(f"{tmp_path}/trades/a", "12345")
    put(f"{tmp_path}/trades/more/b", "123")
    os.makedirs(f"{tmp_path}/market_data")
    paths = {name: f"{tmp_path}/{name}" for name in S.SOURCES}
    inventory = readers.source_inventory(spark, paths)
    assert [tuple(r) for r in inventory.collect()] == [("trades", 2, 8)]
    assert readers.source_objects(spark, paths).count() == 2
    with pytest.raises(FileNotFoundError, match="market_data, portfolio"):
        readers.require_sources(inventory)
    readers.require_sources(inventory, ["trades"])


def test_files_below_a_date_count_at_any_depth(spark, tmp_path):
    """Flat and nested layouts pass; hidden files, empty folders and absent dates do not."""
    root = str(tmp_path)
    put(f"{root}/trades/dt={DAY}/a", "12345")
    put(f"{root}/trades/dt={DAY}/b", "")
    put(f"{root}/market_data/dt={DAY}/file=x/more/a", "123")
    put(f"{root}/portfolio/dt={DAY}/_temporary/a", "1")
    put(f"{root}/portfolio/dt={DAY}/.a.crc", "1")
    os.makedirs(f"{root}/portfolio/dt={NEXT}/file=x")
    put(f"{root}/portfolio/_old/dt={NEXT}/a", "1")
    rows = readers.dated_inventory(spark, root, [DAY, NEXT]).collect()
    assert {tuple(r) for r in rows} == {
        ("trades", DAY, 2, 5), ("trades", NEXT, 0, 0), ("market_data", DAY, 1, 3), ("market_data", NEXT, 0, 0),
        ("portfolio", DAY, 0, 0), ("portfolio", NEXT, 0, 0)}
    with pytest.raises(FileNotFoundError, match=f"for: portfolio {DAY}$"):
        readers.require_source_dates(spark, root, [DAY])
    readers.require_source_dates(spark, root, [DAY], ["trades", "market_data"])


def test_pipeline_takes_nested_files(spark, root):
    flat = run(spark, root, [DAY, NEXT], max_reject_rate=0.5)
    for day in (DAY, NEXT):
        for feed in S.SOURCES:
            folder = f"{root}/in/{feed}/dt={day}"
            for name in os.listdir(folder):
                os.makedirs(f"{root}/deep/{feed}/dt={day}/file={name}")
                with open(f"{folder}/{name}", encoding="utf-8") as handle:
                    put(f"{root}/deep/{feed}/dt={day}/file={name}/{name}", handle.read())
    metrics = pipeline.run_pipeline(spark, f"{root}/deep", f"{root}/out2", [DAY, NEXT], max_reject_rate=0.5)
    assert {r["run_date"]: r for r in metrics.collect()} == flat


def test_manifest(spark, tmp_path):
    put(f"{tmp_path}/manifest.json", json.dumps({"run_date": "2026-08-03", "expected_metrics": {"total_trades": 5}}, indent=2))
    assert [tuple(r) for r in readers.read_manifest(spark, f"{tmp_path}/manifest.json").collect()] == [(DAY, "total_trades", 5)]


def test_contract_projection(spark):
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 0.5, None)], "a int, b double, c string")
    assert [tuple(r) for r in project_contract(df, ["c", "b"]).collect()] == [("x", None), (None, 0.5)]
    with pytest.raises(ValueError, match="missing: d, e"):
        project_contract(df, ["a", "d", "e"])


def test_delimited_lines(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "hi", you', None, datetime(2026, 8, 3, 1, 2, 3))], "a int, b string, c string, t timestamp")
    write_delimited(df.coalesce(1), f"{tmp_path}/out")
    (name,) = [n for n in os.listdir(f"{tmp_path}/out") if n.startswith("part-")]
    with open(f"{tmp_path}/out/{name}", encoding="utf-8") as handle:
        assert handle.read() == '1,"say ""hi"", you",\\N,2026-08-03 01:02:03.000000Z\n'


def test_write_partitions_replaces_only_given_dates(spark, tmp_path):
    def frame(*rows):
        return spark.createDataFrame(list(rows), "v int, dt date")

    path = f"{tmp_path}/t"
    write_partitions(frame((1, DAY), (2, NEXT)), path, [DAY, NEXT])
    write_partitions(frame((3, DAY), (9, NEXT)), path, [DAY])
    assert {(r["v"], r["dt"]) for r in spark.read.parquet(path).collect()} == {(3, DAY), (2, NEXT)}
    write_partitions(frame().where("false"), path, [DAY])
    assert {(r["v"], r["dt"]) for r in spark.read.parquet(path).collect()} == {(2, NEXT)}


def test_stream_takes_each_file_once(spark, tmp_path):
    feed, target, state = f"{tmp_path}/feed", f"{tmp_path}/lines", f"{tmp_path}/state"
    put(f"{feed}/dt=2026-08-03/a.fix", "one\ntwo\n")
    ingest_new_files(spark, feed, target, state, files_per_batch=1)
    assert spark.read.parquet(target).count() == 2
    ingest_new_files(spark, feed, target, state)
    put(f"{feed}/dt=2026-08-04/b.fix", "three\n")
    ingest_new_files(spark, feed, target, state)
    rows = spark.read.parquet(target).collect()
    assert sorted((r["raw_record"], r["dt"]) for r in rows) == [("one", DAY), ("three", NEXT), ("two", DAY)]
    assert all(r["file_path"].endswith(".fix") for r in rows)


def test_work_folder_follows_the_session(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_portfolio_lines_equal_documents(spark, tmp_path):
    rows = [
        {"run_date": "2026-08-03", "portfolios": [portfolio("P1", [position("abc"), position("zz")]), portfolio("P2", []), {}]},
        {"run_date": None, "portfolios": [portfolio("P1", [position("abc")])] * 2},
        {"run_date": "2026-08-03", "portfolios": []},
    ]
    for i, row in enumerate(rows):
        put(f"{tmp_path}/documents/dt=2026-08-03/{i}.json", json.dumps(row, indent=1))
    documents = readers.read_portfolio_json(spark, f"{tmp_path}/documents", [DAY])
    for _ in range(2):  # replaced, not added
        write_portfolio_lines(documents, f"{tmp_path}/lines")
    lines = readers.read_portfolio_lines(spark, f"{tmp_path}/lines", [DAY])

    def positions(df):
        return sorted(map(str, explode_positions(df.select("run_date", "portfolios", "dt")).collect()))

    assert positions(lines) == positions(documents) and len(positions(lines)) == 7
    put(f"{tmp_path}/bad/dt=2026-08-03/x.json", "no json\n{}\n")
    assert [tuple(r) for r in readers.read_portfolio_lines(spark, f"{tmp_path}/bad").collect()] == [(None, None, DAY)] * 2


def test_portfolio_lines_are_split_over_tasks(spark, tmp_path):
    many = json.dumps(portfolio("P", [position("abc")] * 50) | {"run_date": "2026-08-03"})
    put(f"{tmp_path}/lines/dt=2026-08-03/x.json", (many + "\n") * 400)
    put(f"{tmp_path}/documents/dt=2026-08-03/x.json", json.dumps({"run_date": "2026-08-03", "portfolios": [portfolio("P", [position("abc")] * 50)] * 400}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        assert readers.read_portfolio_lines(spark, f"{tmp_path}/lines").rdd.getNumPartitions() > 4
        assert readers.read_portfolio_json(spark, f"{tmp_path}/documents").rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_pipeline_over_portfolio_lines(spark, root):
    whole = run(spark, root, [DAY, NEXT])
    rows = [(d, json.load(open(f"{root}/in/portfolio/dt={d}/portfolio.json"))) for d in (DAY, NEXT)]
    for day, document in rows:
        os.remove(f"{root}/in/portfolio/dt={day}/portfolio.json")
        put(f"{root}/in/portfolio/dt={day}/lines.json",
            "".join(json.dumps({"run_date": document["run_date"]} | p) + "\n" for p in document["portfolios"]))
    assert run(spark, root, [DAY, NEXT], portfolio_form="lines") == whole


def test_arrivals_bring_up_complete_dates(spark, root, tmp_path):
    job = DailyJob(f"{root}/in", f"{root}/out", f"{root}/wh", "t", max_reject_rate=0.3)
    os.rename(f"{root}/in/portfolio/dt={NEXT}", f"{root}/held")
    assert complete_dates(spark, job.in_root, [NEXT, DAY, DAY]) == [DAY]
    run_on_arrival(spark, job, f"{root}/checkpoint")
    assert not wh.read_load_log(spark, job.warehouse).count()  # the one complete date fails the gate
    assert readers.read_metrics(spark, f"{root}/out/metrics", [DAY]).first()["clean_trade_count"] == 3
    # A file in a folder below its date completes the next one.
    os.makedirs(f"{root}/in/portfolio/dt={NEXT}")
    os.rename(f"{root}/held", f"{root}/in/portfolio/dt={NEXT}/file=a")
    run_on_arrival(spark, job, f"{root}/checkpoint")
    run_on_arrival(spark, job, f"{root}/checkpoint")  # nothing new
    log = wh.read_load_log(spark, job.warehouse).collect()
    assert {(r["run_date"], r["airflow_run_id"]) for r in log} == {(NEXT, "t-1")} and len(log) == 4
    # Late messages repair the first date; all of it is done again.
    put(f"{root}/in/trades/dt={DAY}/late.fix",
        "".join(message(t11=f"L{i}", t60="20260803-11:00:00") + "\n" for i in range(5)))
    run_on_arrival(spark, job, f"{root}/checkpoint")
    held = wh.read_table(spark, job.warehouse, "processed_trades").groupBy("trade_date").count().collect()
    assert {r["trade_date"]: r["count"] for r in held} == {DAY: 8, NEXT: 1}


def test_a_batch_run_again_changes_nothing(spark, root):
    job = DailyJob(f"{root}/in", f"{root}/out", f"{root}/wh", "t", max_reject_rate=0.5)
    arrived = spark.createDataFrame([("trades", DAY), ("trades", DAY), ("portfolio", NEXT)], "source_name string, run_date date")
    assert run_batch(spark, job, arrived, 7) == [DAY, NEXT]
    commits = {name: wh.table_snapshot(spark, job.warehouse, name) for name in S.TABLES}
    assert run_batch(spark, job, arrived, 7) == [DAY, NEXT]
    assert {name: wh.table_snapshot(spark, job.warehouse, name) for name in S.TABLES} == commits
    assert wh.read_load_log(spark, job.warehouse).count() == 8
    assert run_batch(spark, job, arrived.where("false"), 8) == []
