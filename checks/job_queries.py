"""Queries through files: readers, writers, reloads, jobs and streaming ingest.

Each writes the feeds derived from the test tables into a work folder of its
own and runs the library on them.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks import feeds as X
from checks.feed_queries import MARKET_SQL, PRICED_SQL, all_rejects, clean_trades
from checks.feed_queries import POSITION, POSITION_SQL, prices, trades
from checks.oracles import expect, expect_daily
from checks.registry import query
from checks.table_queries import load_log, processed_trades
from daybook import schemas as S
from daybook.operators.market import process_market
from daybook.operators.identity import with_content_ids
from daybook.operators.portfolio import explode_positions
from daybook.operators.rejects import union_all_by_name
from daybook.operators.trades import trade_pnl
from daybook.plans import monitoring as V
from daybook.plans import pipeline
from daybook.sources import catalog, readers, warehouse as wh
from daybook.sources.session import lean_writes, stored, work_folder
from daybook.sources.writers import (
    project_contract,
    write_delimited,
    write_metrics,
    write_partitions,
    write_portfolio_lines,
)
from daybook.streaming.ingest import ingest_new_files
from daybook.streaming.jobs import DailyJob, run_batch, run_on_arrival

DAY = X.RUN_DATE


# --- readers and writers ----------------------------------------------------------------


@query("tagged_text_scan", expect("SELECT raw_record, run_date AS dt FROM message_fields"), dates="dt")
def tagged_text_scan(spark, sf_dir):
    root = work_folder(spark, "text")
    X.write_messages(spark, sf_dir, root)
    return readers.read_tagged_text(spark, root, [DAY])


@query("market_csv_scan", expect(
    f"SELECT {MARKET_SQL} FROM valid_prices"),
    dates="price_date")
def market_csv_scan(spark, sf_dir):
    root = work_folder(spark, "csv")
    X.write_market(spark, sf_dir, root)
    valid = process_market(readers.read_market_csv(spark, root, [DAY]), F.col("dt"))[0]
    return valid.select(*MARKET_SQL.replace("\n", "").replace(" ", "").split(","))


@query("portfolio_json_scan", expect(f"SELECT {POSITION_SQL} FROM judged_positions"),
       dates="source_run_date")
def portfolio_json_scan(spark, sf_dir):
    root = work_folder(spark, "json")
    X.write_documents(spark, sf_dir, root)
    return explode_positions(readers.read_portfolio_json(spark, root, [DAY])).select(*POSITION)


@query("portfolio_lines_scan", expect(f"""
    SELECT {POSITION_SQL} FROM judged_positions"""), dates="source_run_date")
def portfolio_lines_scan(spark, sf_dir):
    """Documents turned into one portfolio a line, and those lines read."""
    root = work_folder(spark, "lines")
    write_portfolio_lines(X.documents(spark, sf_dir), root)
    return explode_positions(readers.read_portfolio_lines(spark, root, [DAY])).select(*POSITION)


def monthly_trades(spark, sf_dir):
    """Clean trades of every date, with the first day of their month as ``dt``."""
    valid = trades(spark, sf_dir, X.DAILY)[0]
    clean = trade_pnl(valid, prices(spark, sf_dir, X.DAILY))[0]
    return clean.withColumn("dt", F.trunc("trade_date", "month"))


@query("write_partitions", expect_daily("""
    SELECT CAST(date_trunc('month', trade_date) AS DATE) AS dt, count(*) AS trades,
      CAST(sum(quantity) AS DECIMAL(30,4)) AS quantity
    FROM clean_trades WHERE month(trade_date) <> 2 GROUP BY 1"""), dates="dt")
def write_partitions_(spark, sf_dir):
    """All months are written, then written again with February left empty."""
    root = work_folder(spark, "partitions")
    months = stored(monthly_trades(spark, sf_dir), "months", lean=True)
    dates = [row["dt"] for row in months.select("dt").distinct().collect()]
    write_partitions(months, root, dates)
    february = [d for d in dates if d.month == 2]
    if february:
        write_partitions(months.where("false"), root, february)
    return spark.read.parquet(root).groupBy("dt").agg(
        F.count("*").alias("trades"), F.sum("quantity").alias("quantity")
    )


@query("read_partition", expect_daily(f"""
    SELECT {PRICED_SQL} FROM clean_trades WHERE date_trunc('month', trade_date) =
      (SELECT max(date_trunc('month', trade_date)) FROM clean_trades)"""),
    dates="transact_time trade_date")
def read_partition(spark, sf_dir):
    """All months are written; the last is read by its folder alone."""
    root = work_folder(spark, "partition")
    # The dates are taken from the rows that are written, which are derived once.
    months = stored(monthly_trades(spark, sf_dir), "months", lean=True)
    dates = [row["dt"] for row in months.select("dt").distinct().collect()]
    write_partitions(months, root, dates)
    return readers.read_partition(spark, root, max(dates)).drop("dt")


@query("project_contract", """
    SELECT vec_id AS id, CASE WHEN vec_id % 2 = 0 THEN label END AS label,
      CASE WHEN vec_id % 3 <> 0 THEN vec_id::DOUBLE END AS score FROM embeddings""")
def project_contract_(spark, sf_dir):
    """Extra columns go, order is fixed, NaN becomes NULL."""
    vectors = X.table(spark, sf_dir, "embeddings")
    frame = vectors.select(
        "embedding",
        F.when(F.col("vec_id") % 3 == 0, float("nan")).otherwise(F.col("vec_id").cast("double")).alias("score"),
        F.when(F.col("vec_id") % 2 == 0, F.col("label")).alias("label"),
        F.col("vec_id").alias("id"),
    )
    return project_contract(frame, ["id", "label", "score"])


@query("delimited_export", expect(f"SELECT {PRICED_SQL} FROM clean_trades"),
       dates="transact_time trade_date")
def delimited_export(spark, sf_dir):
    """Exported lines with NULL markers read back into the same rows."""
    path = work_folder(spark, "delimited")
    clean = clean_trades.__wrapped__(spark, sf_dir)
    write_delimited(clean, path)
    return (
        spark.read.schema(clean.schema)
        .option("nullValue", "\\N")
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
        .csv(path)
    )


@query("source_inventory", X.oracle("""
    SELECT 'trades' AS source_name, CAST(min(dt) AS VARCHAR) AS first_date, CAST(max(dt) AS VARCHAR) AS last_date,
      count(DISTINCT dt) AS object_count, CAST(sum(octet_length(encode(raw_record)) + 1) AS BIGINT) AS total_size_bytes
    FROM feed_messages
    UNION ALL
    SELECT 'notes', '2026-08-03', '2026-08-03', count(*), CAST(sum(octet_length(encode(n_name)) + 1) AS BIGINT) FROM nation
    UNION ALL SELECT 'market_data', NULL, NULL, 0, 0 WHERE (SELECT count(*) FROM part) > 0""", variant=X.DAILY))
def source_inventory(spark, sf_dir):
    """Files and bytes of a flat feed of all dates, of one in folders below its date, and of one without files."""
    root = work_folder(spark, "inventory")
    lines = X.messages(spark, sf_dir, X.DAILY)
    days = [row["dt"] for row in lines.select("dt").distinct().collect()]
    lines.repartition("dt").write.partitionBy("dt").text(f"{root}/trades")
    notes = X.table(spark, sf_dir, "nation").select("n_name", "n_nationkey", F.lit(DAY).alias("dt"))
    notes.write.partitionBy("dt", "n_nationkey").text(f"{root}/notes")
    inventory = readers.dated_inventory(spark, root, [*days, DAY], ["trades", "notes", "market_data"])
    present = F.when(F.col("object_count") > 0, F.col("run_date").cast("string"))
    return inventory.groupBy("source_name").agg(
        F.min(present).alias("first_date"),
        F.max(present).alias("last_date"),
        F.sum("object_count").alias("object_count"),
        F.sum("total_size_bytes").alias("total_size_bytes"),
    )


@query("missing_sources", """
    SELECT 'portfolio' AS source_name WHERE (SELECT count(*) FROM lineitem) > 0
      AND (SELECT count(*) FROM part) > 0""")
def missing_sources(spark, sf_dir):
    """The one feed of three that has not arrived."""
    root = work_folder(spark, "missing")
    X.write_messages(spark, sf_dir, f"{root}/trades")
    X.write_market(spark, sf_dir, f"{root}/market_data")
    inventory = readers.source_inventory(spark, {s: f"{root}/{s}/dt={DAY}" for s in S.SOURCES})
    return readers.missing_sources(inventory)


@query("stream_ingest", expect("""
    SELECT run_date AS dt, count(*) AS messages, count(DISTINCT raw_record) AS different
    FROM message_fields GROUP BY 1
    UNION ALL SELECT CAST(run_date + INTERVAL 1 DAY AS DATE), count(*), count(DISTINCT raw_record)
    FROM message_fields GROUP BY run_date"""), dates="dt")
def stream_ingest(spark, sf_dir):
    """A second day arrives after the first was taken in; each file counts once."""
    root = work_folder(spark, "ingest")
    feed, target, checkpoint = f"{root}/feed", f"{root}/lines", f"{root}/checkpoint"
    first = X.messages(spark, sf_dir)
    with lean_writes(spark):
        first.write.options(**X.COMPRESSED).partitionBy("dt").text(feed)
    ingest_new_files(spark, feed, target, checkpoint)
    later = X.messages(spark, sf_dir).withColumn("dt", F.date_add("dt", 1))
    with lean_writes(spark):
        later.write.mode("append").options(**X.COMPRESSED).partitionBy("dt").text(feed)
    ingest_new_files(spark, feed, target, checkpoint)
    ingest_new_files(spark, feed, target, checkpoint)
    return spark.read.parquet(target).groupBy("dt").agg(
        F.count("*").alias("messages"), F.count_distinct("raw_record").alias("different")
    )


# --- warehouse --------------------------------------------------------------------------


@query("reload_partition", expect("""
    SELECT trade_date, side, count(*) AS trades, CAST(sum(quantity) AS DECIMAL(30,4)) AS quantity,
      (SELECT count(*) FROM clean_trades) AS rows_deleted,
      (SELECT count(*) FROM clean_trades WHERE side = 'BUY') AS rows_inserted
    FROM clean_trades WHERE side = 'BUY' GROUP BY ALL"""), dates="trade_date")
def reload_partition(spark, sf_dir):
    """A date loaded whole, then reloaded with its buys only."""
    root = work_folder(spark, "warehouse")
    contract = S.TABLES["processed_trades"]
    wh.create_tables(spark, root)
    # Both loads read the trades, which are derived once.
    clean = stored(clean_trades.__wrapped__(spark, sf_dir), "clean", lean=True)
    wh.reload_partition(clean, root, contract, DAY)
    second = wh.reload_partition(clean.where("side = 'BUY'"), root, contract, DAY)
    return wh.read_table(spark, root, contract.name).groupBy("trade_date", "side").agg(
        F.count("*").alias("trades"),
        F.sum("quantity").alias("quantity"),
        F.lit(second.rows_deleted).cast("bigint").alias("rows_deleted"),
        F.lit(second.rows_inserted).cast("bigint").alias("rows_inserted"),
    )


@query("serial_ids", expect_daily("""
    SELECT source_name, count(*) AS records, count(*) AS different_ids, count(*) AS same_after_reload,
      count(DISTINCT row(source_name, run_date, record_identifier, raw_record, rejection_rule)) AS different_contents
    FROM rejected_records GROUP BY 1"""))
def serial_ids(spark, sf_dir):
    """Ids of all rejects: one for each, equal rows included, and the same when the rows come in other partitions."""
    # The rejects are derived once; both sides read them from files.
    rows = stored(all_rejects(spark, sf_dir, X.DAILY, True), "rejects", lean=True)
    first = with_content_ids(rows, "rejection_id", ("rejected_at",))
    again = stored(rows.withColumn("rejected_at", F.current_timestamp()).repartition(5, "raw_record"), "again", lean=True)
    second = with_content_ids(again, "rejection_id", ("rejected_at",)).select("rejection_id", F.lit(1).alias("again"))
    # Counted by id and by content apart: one aggregation with both distinct counts would double the rows.
    ids = first.select("source_name", "rejection_id").join(second, "rejection_id", "left").groupBy("rejection_id", "source_name").agg(
        F.count("*").alias("records"), F.count("again").alias("again"),
    ).groupBy("source_name").agg(
        F.sum("records").alias("records"),
        F.count("rejection_id").alias("different_ids"),
        F.sum("again").alias("same_after_reload"),
    )
    contents = rows.select("source_name", "run_date", "record_identifier", "raw_record", "rejection_rule").distinct()
    return ids.join(contents.groupBy("source_name").agg(F.count("*").alias("different_contents")), "source_name")


@query("load_audit", X.oracle("""
    SELECT target_table, count(*) AS loads, count(*) FILTER (WHERE load_status = 'FAILED') AS failed,
      CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, max(length(error_message)) AS longest_message
    FROM (SELECT * REPLACE (left(error_message, 5000) AS error_message) FROM feed_load_log) t
    GROUP BY target_table"""))
def load_audit(spark, sf_dir):
    """The load log as stored: messages cut to 5,000 characters."""
    root = work_folder(spark, "audit")
    log = load_log(spark, sf_dir).select(*[F.col(f.name).cast(f.dataType) for f in S.LOAD_LOG])
    wh.append_load_log(log, root)
    return wh.read_load_log(spark, root).groupBy("target_table").agg(
        F.count("*").alias("loads"),
        F.count_if(F.col("load_status") == "FAILED").alias("failed"),
        F.sum("rows_inserted").alias("rows_inserted"),
        F.max(F.length("error_message")).alias("longest_message"),
    )


# --- jobs -------------------------------------------------------------------------------

NEXT = X.RUN_DATE + timedelta(days=1)
#: The derived feeds are dirtier than the gate allows; its own thresholds are used by the query gate_disagreement and in tests of the load.
MAX_RATE, MAX_UNRESOLVABLE = 2.0, 10**9


def run_job(spark, sf_dir, days=(DAY,)):
    """Feeds as files, through the pipeline; returns (root, metrics).

    On a second day the same files arrive again: of their rows only those dated one day late are good then.
    """
    root = work_folder(spark, "job")
    X.write_feeds(spark, sf_dir, f"{root}/in", days=2 if NEXT in days else 1)
    metrics = pipeline.run_pipeline(
        spark, f"{root}/in", f"{root}/out", list(days),
        max_reject_rate=MAX_RATE, max_unresolvable=MAX_UNRESOLVABLE,
    )
    return root, metrics


_outputs: dict[tuple[str, str], str] = {}


def two_days(spark, sf_dir):
    """Root of the outputs of two dates, which are only read; written once for each application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _outputs:
        _outputs[key] = run_job(spark, sf_dir, (DAY, NEXT))[0]
    return _outputs[key]


def loaded(spark, sf_dir):
    """(outputs, a new warehouse with both dates loaded)."""
    out, warehouse = f"{two_days(spark, sf_dir)}/out", work_folder(spark, "wh")
    pipeline.load_warehouse(spark, out, warehouse, [DAY, NEXT], "first", MAX_RATE, MAX_UNRESOLVABLE)
    return out, warehouse


# What the second day keeps: trades that were one day early on the first.
LATE_SQL = "SELECT * FROM judged_trades WHERE rule = 'TRADE_DATE_MISMATCH' AND trade_date = run_date + 1"
COUNTS_SQL = f"""
    SELECT 'processed_trades' AS table_name, run_date, count(*) AS n FROM (SELECT trade_date AS run_date FROM clean_trades
      UNION ALL SELECT trade_date FROM ({LATE_SQL}) l) t GROUP BY ALL
    UNION ALL SELECT 'unresolvable_pnl', run_date, count(*) FROM (SELECT trade_date AS run_date FROM clean_trades WHERE pnl_unresolvable
      UNION ALL SELECT trade_date FROM ({LATE_SQL}) l) t GROUP BY ALL
    UNION ALL SELECT 'portfolio_pnl', pnl_date, count(*) FROM portfolio_pnl GROUP BY ALL
    UNION ALL SELECT 'rejected_records', run_date, count(*) FROM rejected_records GROUP BY ALL
    UNION ALL SELECT 'rejected_records', CAST(min(run_date) + INTERVAL 1 DAY AS DATE), count(*)
        + (SELECT count(*) FROM judged_market) + (SELECT count(*) FROM judged_positions) - (SELECT count(*) FROM ({LATE_SQL}) l)
      FROM judged_trades"""


@query("pipeline_run", expect("""
    SELECT CAST(min(run_date) AS VARCHAR) AS run_date, count(*) AS total_trade_count,
      count(*) FILTER (WHERE rule IS NULL) AS clean_trade_count,
      count(*) FILTER (WHERE rule IS NOT NULL) AS trade_rejection_count,
      (SELECT count(*) FROM rejected_records) AS total_rejection_count,
      (SELECT count(*) FROM clean_trades WHERE pnl_unresolvable) AS pnl_unresolvable_count,
      (SELECT count(*) FROM portfolio_pnl) AS portfolio_pnl_count,
      (SELECT CAST(CAST(sum(realized_pnl_usd) AS DECIMAL(24,4)) AS VARCHAR) FROM clean_trades) AS total_realized_pnl_usd,
      TRUE AS passed
    FROM judged_trades"""))
def pipeline_run(spark, sf_dir):
    """From files of one date to the metrics file."""
    return run_job(spark, sf_dir)[1].select(
        "run_date", "total_trade_count", "clean_trade_count", "trade_rejection_count",
        "total_rejection_count", "pnl_unresolvable_count", "portfolio_pnl_count",
        "total_realized_pnl_usd", F.col("quality_gate.passed").alias("passed"),
    )


@query("metrics_roundtrip", expect_daily("""
    SELECT CAST(trade_date AS VARCHAR) AS run_date, count(*) AS clean_trade_count
    FROM clean_trades GROUP BY trade_date"""))
def metrics_roundtrip(spark, sf_dir):
    """Metrics files of every date, written and read back."""
    root = work_folder(spark, "metrics")
    daily = V.v_daily_trade_metrics(processed_trades(spark, sf_dir))
    known = {"run_date": F.col("metric_date"), "clean_trade_count": F.col("processed_trade_count")}
    document = daily.select(*[
        known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in S.METRICS_DOCUMENT
    ])
    write_metrics(document, root)
    return readers.read_metrics(spark, root, None).select("run_date", "clean_trade_count")


@query("warehouse_load", expect(f"""
    SELECT table_name, run_date, n AS row_count, n AS rows_deleted, n AS rows_inserted FROM ({COUNTS_SQL}) c"""), dates="run_date")
def warehouse_load(spark, sf_dir):
    """Two dates loaded twice, each time by one commit of each table: tables hold them once, the log says so."""
    out, warehouse = loaded(spark, sf_dir)
    pipeline.load_warehouse(spark, out, warehouse, [DAY, NEXT], "second", MAX_RATE, MAX_UNRESOLVABLE)
    counts = [
        df.groupBy(F.col(S.TABLES[name].partition_column).alias("run_date")).agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "run_date", "row_count")
        for name, df in wh.read_tables(spark, warehouse).items()
    ]
    log = wh.read_load_log(spark, warehouse).where("airflow_run_id = 'second'").select(
        F.regexp_replace("target_table", "^raw\\.", "").alias("table_name"), "run_date", "rows_deleted", "rows_inserted"
    )
    return union_all_by_name(counts).join(log, ["table_name", "run_date"])


@query("missing_loads", expect("""
    SELECT 'raw.unresolvable_pnl' AS target_table, min(run_date) AS run_date FROM typed_trades"""), dates="run_date")
def missing_loads(spark, sf_dir):
    """The one table and date of four tables and two dates that a run has not loaded."""
    out, warehouse = f"{two_days(spark, sf_dir)}/out", work_folder(spark, "wh")
    wh.create_tables(spark, warehouse)
    for name in S.TABLES:
        wh.load_table(spark, out, warehouse, name, [NEXT] if name == "unresolvable_pnl" else [DAY, NEXT], "run")
    return wh.missing_loads(wh.read_load_log(spark, warehouse), [DAY, NEXT], "run")


@query("rerun_stability", expect("""
    SELECT 'same' AS reload, table_name, CAST(n AS BIGINT) AS rows_before, CAST(n AS BIGINT) AS rows_after, FALSE AS changed FROM c
    UNION ALL
    SELECT 'other', table_name, CAST(c.n AS BIGINT),
      CAST(CASE table_name WHEN 'processed_trades' THEN c.n - (SELECT count(*) FROM clean_trades) + b.n ELSE c.n END AS BIGINT),
      table_name = 'processed_trades' AND b.n <> (SELECT count(*) FROM clean_trades)
    FROM c, b""",
    ("c", f"SELECT table_name, sum(n) AS n FROM ({COUNTS_SQL}) k GROUP BY 1"),
    ("b", "SELECT count(*) AS n FROM clean_trades WHERE side = 'BUY'")))
def rerun_stability(spark, sf_dir):
    """Row counts before and after a reload of the same outputs, and after one with the buys of one date only."""
    out, warehouse = loaded(spark, sf_dir)
    before = V.table_row_counts(wh.read_tables(spark, warehouse))
    pipeline.load_warehouse(spark, out, warehouse, [DAY, NEXT], "again", MAX_RATE, MAX_UNRESOLVABLE)
    same = V.changed_row_counts(before, V.table_row_counts(wh.read_tables(spark, warehouse)))
    buys = wh.read_table(spark, warehouse, "processed_trades", [DAY]).where("side = 'BUY'")
    wh.reload_dates(buys, warehouse, S.TABLES["processed_trades"], [DAY])
    other = V.changed_row_counts(before, V.table_row_counts(wh.read_tables(spark, warehouse)))
    return same.select(F.lit("same").alias("reload"), "*").unionByName(other.select(F.lit("other").alias("reload"), "*"))


_RISK = """CASE WHEN market_value_limit_breached OR daily_loss_limit_breached THEN 'BREACH' ELSE 'WITHIN_LIMIT' END"""
#: Model -> (rows behind it, its not-null columns) for the expected checks.
_MODELS = {
    "stg_processed_trades": ("all_trades", "order_id portfolio_id trade_date side quantity pnl_unresolvable"),
    "stg_portfolio_pnl": ("portfolio_pnl", "portfolio_id pnl_date"),
    "stg_rejected_records": ("rejects", "rejection_id source_name rejection_rule"),
    "fct_daily_trading_pnl": ("daily", "trade_date portfolio_id symbol trade_count"),
    "fct_portfolio_risk": ("portfolio_pnl", "portfolio_id pnl_date"),
    "fct_daily_data_quality": ("quality", "run_date source_name rejection_rule"),
}
_ALL_TRADES = (
    "all_trades",
    f"""SELECT order_id, portfolio_id, symbol, side, quantity, trade_date, realized_pnl_usd, pnl_unresolvable FROM clean_trades
    UNION ALL SELECT order_id, portfolio_id, symbol, side, quantity, trade_date, NULL, TRUE FROM ({LATE_SQL}) l""",
)
_REJECTS = ("rejects", "SELECT row_number() OVER () AS rejection_id, * FROM rejected_records")
_DAILY = ("daily", "SELECT trade_date, portfolio_id, symbol, count(*) AS trade_count FROM all_trades GROUP BY ALL")
_QUALITY = ("quality", "SELECT run_date, source_name, rejection_rule FROM rejects GROUP BY ALL")


@query("models_build", expect(" UNION ALL ".join([
    f"""SELECT '{model}' AS "table", '{column}' AS "column", 'not_null' AS "check", count(*) FILTER ({column} IS NULL) AS failures FROM {rows}"""
    for model, (rows, columns) in _MODELS.items() for column in columns.split()
] + [
    """SELECT 'stg_rejected_records', 'rejection_id', 'unique', count(*) - count(DISTINCT rejection_id) FROM rejects""",
    """SELECT 'stg_processed_trades', 'side', 'accepted_values', count(DISTINCT side) FILTER (side NOT IN ('BUY', 'SELL')) FROM all_trades""",
    f"""SELECT 'fct_portfolio_risk', 'risk_status', 'accepted_values', count(DISTINCT s) FILTER (s NOT IN ('BREACH', 'WITHIN_LIMIT'))
        FROM (SELECT {_RISK} AS s FROM portfolio_pnl) r""",
]), _ALL_TRADES, _REJECTS, _DAILY, _QUALITY))
def models_build(spark, sf_dir):
    """Staging views and marts over a loaded warehouse, with all their column tests."""
    _, warehouse = loaded(spark, sf_dir)
    return pipeline.build_models(spark, warehouse).drop("status")


# Declared constraints by table: rows behind it, columns with a value, keys, text lengths, digits before the point.
_TRADE_BOUNDS = ({"order_id": 100, "portfolio_id": 50, "symbol": 50, "side": 10, "currency": 3}, {"quantity": 16, "trade_price": 12, "average_cost": 12})
_TRADE_FIELDS = "order_id portfolio_id symbol side quantity trade_price average_cost currency transact_time trade_date"
_CONTRACTS = {
    "processed_trades": ("stored_trades", f"{_TRADE_FIELDS} pnl_unresolvable loaded_at", "order_id, trade_date",
        _TRADE_BOUNDS[0] | {"market_currency": 3},
        _TRADE_BOUNDS[1] | {"close_price": 12, "fx_rate_to_usd": 10, "realized_pnl_local": 20, "realized_pnl_usd": 20}),
    "unresolvable_pnl": ("stored_unresolvable", f"{_TRADE_FIELDS} unresolvable_reason loaded_at", "order_id, trade_date", *_TRADE_BOUNDS),
    "portfolio_pnl": ("stored_portfolio", "portfolio_id pnl_date position_count loaded_at", "portfolio_id, pnl_date",
        {"portfolio_id": 50, "portfolio_name": 255},
        {"total_market_value_usd": 20, "total_unrealized_pnl_usd": 20, "max_market_value_usd": 20, "max_daily_loss_usd": 20,
         "max_position_concentration_pct": 6}),
    "rejected_records": ("stored_rejects", "rejection_id source_name run_date rejection_rule rejection_reason rejected_at loaded_at", "rejection_id",
        {"source_name": 50, "record_identifier": 255, "rejection_rule": 100}, {}),
}
_STORED = (
    ("stored_trades", f"""SELECT order_id, portfolio_id, symbol, side, quantity, trade_price, average_cost, currency, transact_time, trade_date,
      close_price, market_currency, fx_rate_to_usd, realized_pnl_local, realized_pnl_usd, pnl_unresolvable, 1 AS loaded_at FROM clean_trades
      UNION ALL SELECT order_id, portfolio_id, symbol, side, quantity, trade_price, average_cost, currency, transact_time, trade_date,
      NULL, NULL, NULL, NULL, NULL, TRUE, 1 FROM ({LATE_SQL}) l"""),
    ("stored_unresolvable", "SELECT *, 1 AS unresolvable_reason FROM stored_trades WHERE pnl_unresolvable"),
    ("stored_portfolio", "SELECT *, 1 AS loaded_at FROM portfolio_pnl"),
    ("stored_rejects", "SELECT row_number() OVER () AS rejection_id, *, 1 AS rejected_at, 1 AS loaded_at FROM rejected_records"),
)


@query("contract_report", expect(" UNION ALL ".join(
    f"""SELECT '{table}' AS "table", '{column}' AS "column", '{check}' AS "check", CAST({failures} AS BIGINT) AS failures FROM {rows}"""
    for table, (rows, required, key, lengths, digits) in _CONTRACTS.items()
    for column, check, failures in [
        *[(c, "not_null", f"count(*) FILTER ({c} IS NULL)") for c in required.split()],
        *[(c, "bounds", f"count(*) FILTER (length({c}) > {n})") for c, n in lengths.items()],
        *[(c, "bounds", f"count(*) FILTER (abs({c}) >= 1e{n})") for c, n in digits.items()],
        (key, "primary_key", f"(SELECT count(*) FROM (SELECT 1 FROM {rows} GROUP BY {key} HAVING count(*) > 1) d) + 0 * count(*)"),
    ]), *_STORED))
def contract_report(spark, sf_dir):
    """All declared constraints of the four tables of a loaded warehouse."""
    _, warehouse = loaded(spark, sf_dir)
    return pipeline.contract_report(spark, warehouse).drop("status")


_INCOMING = """
    SELECT order_id, side, CASE WHEN quantity > 45 THEN 1 ELSE 0 END AS wide,
      CASE WHEN quantity < 5 THEN 1 ELSE 0 END AS wordy, CASE WHEN side = 'SELL' AND quantity < 10 THEN 1 ELSE 0 END AS absent
    FROM clean_trades"""


@query("contract_quarantine", expect("""
    SELECT 'loaded ' || side AS part, '' AS "column", '' AS "check", count(*) AS row_count FROM t WHERE wide + wordy + absent = 0 GROUP BY ALL
    UNION ALL SELECT 'set aside', '', '', count(*) FROM t WHERE wide + wordy + absent > 0
    UNION ALL SELECT 'violation', 'quantity', 'type', count(*) FROM t WHERE wide = 1
    UNION ALL SELECT 'violation', 'portfolio_id', 'length', count(*) FROM t WHERE wordy = 1
    UNION ALL SELECT 'violation', 'currency', 'not_null', count(*) FROM t WHERE absent = 1""", ("t", _INCOMING)))
def contract_quarantine(spark, sf_dir):
    """Trades that come as text, some with a quantity too wide, a portfolio too long or no currency: loaded and set aside."""
    root = work_folder(spark, "quarantine")
    # Read for the rows set aside and for those loaded, derived once.
    clean = stored(clean_trades.__wrapped__(spark, sf_dir), "clean", lean=True)
    quantity = F.col("quantity")
    incoming = clean.select(
        *[F.col(c).cast("string").alias(c) for c in clean.columns if c not in ("quantity", "portfolio_id", "currency")],
        F.when(quantity > 45, F.concat(quantity.cast("string"), F.lit("e15"))).otherwise(quantity.cast("string")).alias("quantity"),
        F.when(quantity < 5, F.rpad("portfolio_id", 51, "x")).otherwise(F.col("portfolio_id")).alias("portfolio_id"),
        F.when(~((F.col("side") == "SELL") & (quantity < 10)), F.col("currency")).alias("currency"),
        F.lit(DAY).alias("dt"),
    )
    contract = S.TABLES["processed_trades"]
    wh.reload_dates(wh.set_aside(incoming, root, contract, [DAY]), root, contract, [DAY])
    none = F.lit("")
    aside = wh.read_quarantine(spark, root, contract.name, [DAY])
    kept = wh.read_table(spark, root, contract.name).groupBy(F.concat(F.lit("loaded "), "side").alias("part")).agg(F.count("*").alias("row_count"))
    broken = aside.select(F.inline("violations")).groupBy("column", "check").agg(F.count("*").alias("row_count"))
    return union_all_by_name([
        kept.select("part", none.alias("column"), none.alias("check"), "row_count"),
        aside.agg(F.count("*").alias("row_count")).select(F.lit("set aside").alias("part"), none.alias("column"), none.alias("check"), "row_count"),
        broken.select(F.lit("violation").alias("part"), "column", "check", "row_count"),
    ])


@query("marts_incremental", expect("""
    SELECT trade_date, portfolio_id, symbol, count(*) AS trade_count,
      CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE 0 END) AS DECIMAL(30,4)) AS buy_quantity,
      CAST(sum(CASE WHEN side = 'SELL' THEN quantity ELSE 0 END) AS DECIMAL(30,4)) AS sell_quantity,
      CAST(sum(realized_pnl_usd) AS DECIMAL(34,4)) AS realized_pnl_usd,
      count(*) FILTER (pnl_unresolvable) AS unresolvable_trade_count, '2026-08-03' AS rebuilt
    FROM all_trades WHERE side = 'BUY' OR trade_date > (SELECT min(run_date) FROM typed_trades) GROUP BY ALL""", _ALL_TRADES),
    dates="trade_date")
def marts_incremental(spark, sf_dir):
    """A whole mart after one of its dates was reloaded with the buys only, and the dates rebuilt for that."""
    _, warehouse = loaded(spark, sf_dir)
    pipeline.build_models(spark, warehouse)
    buys = wh.read_table(spark, warehouse, "processed_trades", [DAY]).where("side = 'BUY'")
    wh.reload_dates(buys, warehouse, S.TABLES["processed_trades"], [DAY])
    rebuilt = catalog.build_marts(spark, warehouse)["fct_daily_trading_pnl"]
    mart = catalog.ref(spark, "fct_daily_trading_pnl").drop("realized_pnl_local", "latest_loaded_at")
    return mart.withColumn("rebuilt", F.lit(",".join(map(str, rebuilt))))


@query("monitoring_maintained", expect(f"""
    SELECT t.*, r.* EXCLUDE (day), '2026-08-03' AS recomputed
    FROM (SELECT trade_date AS metric_date, count(*) AS processed_trade_count, count(*) FILTER (side = 'BUY') AS buy_trade_count,
        count(*) FILTER (pnl_unresolvable) AS unresolvable_trade_count, count(DISTINCT portfolio_id) AS portfolio_count,
        count(DISTINCT symbol) AS symbol_count, CAST(coalesce(sum(realized_pnl_usd), 0) AS DECIMAL(24,4)) AS total_realized_pnl_usd
      FROM all_trades WHERE side = 'BUY' OR trade_date > (SELECT min(run_date) FROM typed_trades) GROUP BY 1) t
    JOIN (SELECT run_date AS day, CAST(n AS BIGINT) AS total_rejected_count,
        CAST(CASE WHEN run_date = (SELECT min(run_date) FROM typed_trades) THEN (SELECT count(*) FROM judged_trades WHERE rule IS NOT NULL)
          ELSE (SELECT count(*) FROM judged_trades) - (SELECT count(*) FROM ({LATE_SQL}) l) END AS BIGINT) AS rejected_trade_count
      FROM ({COUNTS_SQL}) c WHERE table_name = 'rejected_records') r ON r.day = t.metric_date""", _ALL_TRADES), dates="metric_date")
def monitoring_maintained(spark, sf_dir):
    """Daily views of a loaded warehouse from kept aggregates, after one date was reloaded with its buys only."""
    _, warehouse = loaded(spark, sf_dir)
    pipeline.monitoring_views(spark, warehouse, maintained=True)
    buys = wh.read_table(spark, warehouse, "processed_trades", [DAY]).where("side = 'BUY'")
    wh.reload_dates(buys, warehouse, S.TABLES["processed_trades"], [DAY])
    recomputed = sorted({str(day) for days in catalog.refresh_aggregates(spark, warehouse).values() for day in days})
    views = pipeline.monitoring_views(spark, warehouse, maintained=True)
    trades = views["v_daily_trade_metrics"].select(
        "metric_date", "processed_trade_count", "buy_trade_count", "unresolvable_trade_count", "portfolio_count", "symbol_count",
        F.col("total_realized_pnl_usd").cast(S.MONEY).alias("total_realized_pnl_usd"),
    )
    quality = views["v_daily_quality_metrics"].select("metric_date", "total_rejected_count", "rejected_trade_count")
    return trades.join(quality, "metric_date").withColumn("recomputed", F.lit(",".join(recomputed)))


@query("model_catalog", expect(f"""
    SELECT 'staging' AS table_schema, 'stg_' || table_name AS table_name, CAST(sum(n) AS BIGINT) AS row_count
    FROM ({COUNTS_SQL}) c WHERE table_name <> 'unresolvable_pnl' GROUP BY ALL
    UNION ALL SELECT 'marts', 'fct_daily_trading_pnl', count(*) FROM daily
    UNION ALL SELECT 'marts', 'fct_portfolio_risk', count(*) FROM (SELECT DISTINCT portfolio_id, portfolio_name, pnl_date,
      position_count, total_market_value_usd, total_unrealized_pnl_usd, max_market_value_usd, max_daily_loss_usd FROM portfolio_pnl) p
    UNION ALL SELECT 'marts', 'fct_daily_data_quality', count(*) FROM (
      SELECT source_name, rejection_rule, run_date FROM rejects GROUP BY ALL
      UNION ALL SELECT DISTINCT 'trades', CASE WHEN rule IS NULL OR rule = 'TRADE_DATE_MISMATCH' THEN 'TRADE_DATE_MISMATCH' ELSE rule END, run_date + 1
        FROM judged_trades WHERE NOT (rule IS NOT DISTINCT FROM 'TRADE_DATE_MISMATCH' AND trade_date = run_date + 1)
      UNION ALL SELECT DISTINCT 'market_data', CASE WHEN rule IN ('MARKET_MISSING_SYMBOL', 'MARKET_INVALID_PRICE_DATE') THEN rule
        ELSE 'MARKET_DATE_MISMATCH' END, run_date + 1 FROM judged_market
      UNION ALL SELECT DISTINCT 'portfolio', CASE WHEN source_run_date IS NOT NULL THEN 'PORTFOLIO_DATE_MISMATCH'
        ELSE rule END, run_date + 1 FROM judged_positions) q""", _ALL_TRADES, _REJECTS, _DAILY))
def model_catalog(spark, sf_dir):
    """Registered models in order, with their rows."""
    _, warehouse = loaded(spark, sf_dir)
    pipeline.build_models(spark, warehouse)
    return catalog.list_models(spark, warehouse)


#: Between the shares of rejected trades of the two days.
_STREAM_RATE = 0.9


@query("stream_pipeline", expect(f"""
    SELECT c.table_name, c.run_date, CAST(n AS BIGINT) AS row_count, CAST(1 AS BIGINT) AS loads FROM ({COUNTS_SQL}) c
    JOIN rates r ON r.run_date = c.run_date WHERE r.rate < {_STREAM_RATE}
    UNION ALL SELECT 'blocked', run_date, 0, 0 FROM rates WHERE rate >= {_STREAM_RATE}""",
    ("rates", f"""
      SELECT min(run_date) AS run_date, count(*) FILTER (rule IS NOT NULL)::DOUBLE / count(*) AS rate FROM judged_trades
      UNION ALL SELECT CAST(min(run_date) + INTERVAL 1 DAY AS DATE), 1 - (SELECT count(*) FROM ({LATE_SQL}) l)::DOUBLE / count(*) FROM judged_trades""")),
    dates="run_date")
def stream_pipeline(spark, sf_dir):
    """Feeds arrive one by one, then a day that the gate blocks; a batch run twice loads once."""
    root = work_folder(spark, "arrivals")
    feeds = f"{two_days(spark, sf_dir)}/in"
    job = DailyJob(f"{root}/in", f"{root}/out", f"{root}/wh", "feeds", _STREAM_RATE, MAX_UNRESOLVABLE)

    def arrive(source, day):
        # Headers and documents belong to their file, so each is sent as a file of its own.
        whole = source != S.TRADES
        lines = spark.read.option("recursiveFileLookup", True).text(f"{feeds}/{source}/dt={day}", wholetext=whole)
        sent = lines.select("value", F.xxhash64("_metadata.file_path").alias("file")) if whole else lines
        writer = sent.write.partitionBy("file") if whole else sent.write
        with lean_writes(spark):
            writer.options(**X.COMPRESSED).text(f"{root}/in/{source}/dt={day}")

    for day in (DAY, NEXT):
        for source in S.SOURCES:
            arrive(source, day)
            if source == S.MARKET_DATA:
                run_on_arrival(spark, job, f"{root}/checkpoint")
    run_on_arrival(spark, job, f"{root}/checkpoint")
    again = spark.createDataFrame([(S.TRADES, DAY)], "source_name string, run_date date")
    last = wh.read_load_log(spark, job.warehouse).agg(F.max(F.regexp_extract("airflow_run_id", "[0-9]+$", 0).cast("int"))).first()[0]
    run_batch(spark, job, again, last)
    counts = [
        df.groupBy(F.col(S.TABLES[name].partition_column).alias("run_date")).agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "run_date", "row_count")
        for name, df in wh.read_tables(spark, job.warehouse).items()
    ]
    loads = wh.read_load_log(spark, job.warehouse).groupBy(
        F.regexp_replace("target_table", "^raw\\.", "").alias("table_name"), "run_date"
    ).agg(F.count("*").alias("loads"))
    metrics = readers.read_metrics(spark, f"{root}/out/metrics", [DAY, NEXT])
    blocked = metrics.where(~F.col("quality_gate.passed")).select(
        F.lit("blocked").alias("table_name"), F.col("run_date").cast("date").alias("run_date"),
        F.lit(0).cast("bigint").alias("row_count"), F.lit(0).cast("bigint").alias("loads"),
    )
    return union_all_by_name(counts).join(loads, ["table_name", "run_date"]).unionByName(blocked)
