"""The three feeds and the load log, derived from the test tables.

The SQL runs in Spark and in DuckDB, so queries and their SQL start from the
same rows. Spark then goes through the raw encodings (tagged text, CSV lines,
nested JSON), the SQL side uses the columns.

Every feed comes in two variants: ``fixed`` puts all rows on one run date,
``daily`` spreads them over many (trades by ship date, documents by nation).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook import schemas as S
from daybook.sources.session import lean_writes

RUN_DATE = date(2026, 8, 3)
FIXED, DAILY = "fixed", "daily"
TABLES = ["customer", "nation", "orders", "lineitem", "part", "events"]

# One price row per part; p_partkey % 40 picks the kind of dirt.
_PRICE_COLUMNS = """
  p_partkey,
  CASE WHEN p_partkey%40=5 THEN '  ' ELSE ' p ' || CAST(p_partkey AS string) || ' ' END AS symbol,
  p_type AS asset_class,
  CASE WHEN p_partkey%40=0 THEN NULL WHEN p_partkey%40=1 THEN CAST(-10 AS decimal(20,8))
       ELSE CAST(CAST(p_retailprice AS decimal(20,2)) AS decimal(20,8)) END AS close_price,
  CASE WHEN p_partkey%40=2 THEN 'US' WHEN p_size%4=0 THEN 'USD' WHEN p_size%4=1 THEN ' gbp'
       WHEN p_size%4=2 THEN 'EUR' ELSE 'JPY' END AS currency,
  CAST(CASE WHEN p_partkey%40=3 THEN 0 WHEN p_size%4=0 THEN NULL WHEN p_size%4=1 THEN 1.285
       WHEN p_size%4=2 THEN 1.09 ELSE 0.0067 END AS decimal(20,10)) AS fx_rate_to_usd,
  CASE WHEN p_partkey%40=4 THEN NULL WHEN p_partkey%40=6 THEN CAST(dt - interval '1' day AS date)
       ELSE dt END AS price_date,
  dt
"""

_PRICED_DAYS = {
    FIXED: "SELECT p.*, DATE '2026-08-03' AS dt FROM {part} p",
    # The parts traded on a day have a price that day, but for one pair in eleven.
    DAILY: """
      SELECT p.*, k.dt FROM {part} p JOIN (
        SELECT DISTINCT l_partkey, CAST(l_shipdate AS date) AS dt FROM {lineitem}
        WHERE (l_partkey + extract(day FROM l_shipdate)) % 11 <> 0
      ) k ON p_partkey = k.l_partkey""",
}

_TRADE_DAY = {FIXED: "DATE '2026-08-03'", DAILY: "CAST(l_shipdate AS date)"}

# One trade per line item; d picks the kind of dirt.
_TRADES = """
SELECT d, dt,
  CASE WHEN d=0 THEN NULL ELSE 'ORD-' || CAST(l_orderkey AS string) || '-' || CAST(l_linenumber AS string)
       || '-' || CAST(l_partkey AS string) || '-' || CAST(l_suppkey AS string) END AS t11,
  CASE WHEN d=1 THEN NULL ELSE 'PORT' || lpad(CAST(o_custkey%20+1 AS string),4,'0') END AS t1,
  CASE WHEN d=2 THEN '  ' WHEN d BETWEEN 20 AND 22 THEN 'MISSING' || CAST(d AS string)
       ELSE 'p' || CAST(l_partkey AS string) END AS t55,
  CASE WHEN d=3 THEN '9' WHEN d=10 THEN NULL WHEN l_linestatus='F' THEN '1' ELSE '2' END AS t54,
  CASE WHEN d=4 THEN '-10' WHEN d=11 THEN 'abc'
       ELSE CAST(CAST(l_quantity AS decimal(20,4)) AS string) END AS t38,
  CASE WHEN d=5 THEN '0' ELSE CAST(CAST(l_extendedprice AS decimal(20,2)) AS string) END AS t44,
  CASE WHEN d=6 THEN '-1' WHEN d=12 THEN '0'
       ELSE CAST(CAST(CAST(l_extendedprice AS decimal(20,2))*(1-CAST(l_discount AS decimal(4,2)))*0.02
            AS decimal(20,8)) AS string) END AS t6,
  CASE WHEN d=7 THEN 'US' ELSE 'usd' END AS t15,
  CASE WHEN d=8 THEN 'INVALID'
       ELSE replace(CAST(CASE WHEN d=9 THEN CAST(dt + interval '1' day AS date) ELSE dt END AS string),'-','')
            || '-' || lpad(CAST(CAST(floor(s/3600) AS int) AS string),2,'0')
            || ':' || lpad(CAST(CAST(floor((s%3600)/60) AS int) AS string),2,'0')
            || ':' || lpad(CAST(s%60 AS string),2,'0') END AS t60
FROM (
  SELECT l.*, o.o_custkey, $day AS dt,
    (l_orderkey*13+l_linenumber*7+l_partkey)%1000 AS d, 34200+l_orderkey%28800 AS s
  FROM {lineitem} l JOIN {orders} o ON l_orderkey=o_orderkey
) x
"""

_MESSAGES = """
SELECT *, CASE WHEN d=13 THEN 'THIS IS NOT A MESSAGE'
  ELSE '8=FIX.4.4|35=D|' || coalesce('11=' || t11 || '|','') || coalesce('1=' || t1 || '|','')
    || '55=' || t55 || '|' || coalesce('54=' || t54 || '|','') || '38=' || t38 || '|44=' || t44
    || '|6=' || t6 || '|15=' || t15 || '|60=' || t60 || '|' END AS raw_record
FROM feed_trades
"""

_DOCUMENT_DAY = {
    FIXED: "DATE '2026-08-03'",
    DAILY: "CAST(DATE '2026-08-03' + n_nationkey * interval '1' day AS date)",
}

# One position per customer and part; customers without any keep one empty row.
_POSITION_COLUMNS = """c_custkey, n_nationkey, $day AS dt,
  CASE WHEN n_nationkey=24 THEN CAST($day - interval '1' day AS date)
       WHEN n_nationkey=23 THEN NULL ELSE $day END AS source_run_date,
  CASE WHEN c_custkey%50=1 THEN NULL ELSE 'PORT' || CAST(c_custkey AS string) END AS portfolio_id,
  'Portfolio ' || CAST(c_custkey AS string) AS portfolio_name,
  CASE WHEN c_custkey%25=3 THEN NULL ELSE CAST(20000+c_custkey*100 AS decimal(24,4)) END AS max_market_value_usd,
  CAST(1000+c_custkey AS decimal(24,4)) AS max_daily_loss_usd,
  CAST(20 AS decimal(10,4)) AS max_position_concentration_pct,
  CASE WHEN l_partkey%60=2 THEN ' ' ELSE 'p' || CAST(l_partkey AS string) END AS symbol,
  l_partkey,
  CASE WHEN l_partkey%60=0 THEN NULL ELSE q END AS position_quantity,
  CASE WHEN l_partkey IS NULL THEN NULL WHEN l_partkey%60=1 THEN 'US' ELSE 'usd' END AS currency,
  CASE WHEN l_partkey%60=3 THEN NULL ELSE a END AS average_cost
"""
_HELD_QUANTITY = "CAST(sum(CAST(l_quantity AS decimal(20,4))*CASE WHEN l_linestatus='F' THEN 1 ELSE -1 END) AS decimal(20,4))"
_HELD_COST = "CAST(min(CAST(l_extendedprice AS decimal(20,2))*0.02) AS decimal(20,8))"
_POSITIONS = f"""
SELECT {_POSITION_COLUMNS}FROM {{customer}} JOIN {{nation}} ON c_nationkey=n_nationkey
LEFT JOIN (
  SELECT o_custkey, l_partkey,
    {_HELD_QUANTITY} AS q,
    {_HELD_COST} AS a
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey=o_orderkey GROUP BY o_custkey, l_partkey
) h ON h.o_custkey=c_custkey AND c_custkey%50<>0
"""

_LOAD_LOG = """
SELECT event_id AS load_id, 'daily' AS dag_id, 'run-' || CAST(user_id AS string) AS airflow_run_id,
  CAST(ts AS date) AS run_date, event_type AS target_table, 'feeds/' || event_type AS source_path,
  CAST(floor(value) AS bigint) AS rows_deleted, CAST(floor(value*10) AS bigint) AS rows_inserted,
  CASE WHEN event_type='error' THEN 'FAILED' ELSE 'SUCCESS' END AS load_status,
  ts AS started_at, ts + CAST(floor(value) AS int)*interval '1' second AS completed_at,
  CASE WHEN event_type='error' THEN repeat(props, 500) END AS error_message
FROM {events}
"""

_POSITION_PRICED_DAYS = {
    FIXED: _PRICED_DAYS[FIXED],
    DAILY: """
      SELECT p.*, k.dt FROM {part} p JOIN (
        SELECT DISTINCT l_partkey, dt FROM feed_positions WHERE l_partkey IS NOT NULL
      ) k ON p_partkey = k.l_partkey""",
}


def ctes(variant: str = FIXED, portfolio_prices: bool = False) -> list[tuple[str, str]]:
    """(name, SQL) of the feeds, each readable by those after it.

    ``portfolio_prices`` prices the days of the portfolio documents instead of
    the days of the trades; with one run date both are the same.
    """
    priced = (_POSITION_PRICED_DAYS if portfolio_prices else _PRICED_DAYS)[variant]
    return [
        ("feed_positions", _POSITIONS.replace("$day", _DOCUMENT_DAY[variant])),
        ("feed_prices", f"SELECT {_PRICE_COLUMNS} FROM ({priced}) priced"),
        ("feed_trades", _TRADES.replace("$day", _TRADE_DAY[variant])),
        ("feed_messages", _MESSAGES),
        ("feed_load_log", _LOAD_LOG),
    ]


def needed(name: str, parts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The parts that feed ``name`` is built from, itself included."""
    sql = dict(parts)
    wanted, open_names = set(), [name]
    while open_names:
        current = open_names.pop()
        wanted.add(current)
        open_names += [n for n in sql if n in sql[current] and n not in wanted]
    return [(n, text) for n, text in parts if n in wanted]


def with_clause(parts: list[tuple[str, str]]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts) + "\n"


def oracle(select: str, *more: tuple[str, str], variant: str = FIXED, portfolio_prices=False) -> str:
    """DuckDB text: the feeds, further named parts, and the final SELECT."""
    text = with_clause([*ctes(variant, portfolio_prices), *more])
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text + select


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table for a feed; line items, which come as one row group, are dealt out by the key they are joined on."""
    df = table(spark, sf_dir, name)
    return df.repartition("l_orderkey") if name == "lineitem" else df


def feed(
    spark: SparkSession, sf_dir: str, name: str, variant: str = FIXED, portfolio_prices=False, held=None
) -> DataFrame:
    """One feed as a Spark DataFrame of typed columns (or message text).

    ``held`` gives the rows of ``feed_positions`` where the caller has them already.
    """
    parts, given = ctes(variant, portfolio_prices), {}
    if held is not None:
        parts = [(n, "SELECT * FROM {held}" if n == "feed_positions" else text) for n, text in parts]
    sql = with_clause(needed(name, parts)) + f"SELECT * FROM {name}"
    if "{held}" in sql:
        given["held"] = held
    used = [t for t in TABLES if "{" + t + "}" in sql]
    # Days with a price are made distinct where the line items are read, without dealing these out first.
    read = spread_table if "{orders}" in sql else table
    return spark.sql(sql, **given, **{t: read(spark, sf_dir, t) for t in used})


def messages(spark: SparkSession, sf_dir: str, variant: str = FIXED) -> DataFrame:
    """Trade messages: raw_record, dt."""
    return feed(spark, sf_dir, "feed_messages", variant).select("raw_record", "dt")


#: Files of feeds: compressed to some quarter of their text. One task reads such a file, so its lines are bounded.
COMPRESSED = {"compression": "gzip", "maxRecordsPerFile": 500_000}
CSV_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def market_columns(
    spark: SparkSession, sf_dir: str, variant: str = FIXED, portfolio_prices=False, held=None
) -> DataFrame:
    prices = feed(spark, sf_dir, "feed_prices", variant, portfolio_prices, held)
    return prices.withColumn("loaded_at", F.lit(None).cast("timestamp")).select(
        *S.MARKET_FEED.names, "dt"
    )


def market(
    spark: SparkSession, sf_dir: str, variant: str = FIXED, portfolio_prices=False, held=None
) -> DataFrame:
    """Price rows after a trip through CSV lines, with dt."""
    columns = market_columns(spark, sf_dir, variant, portfolio_prices, held)
    line = F.to_csv(F.struct(*S.MARKET_FEED.names), CSV_SPACES)
    row = F.from_csv(line, S.MARKET_FEED.simpleString()[len("struct<"):-1].replace(":", " "), CSV_SPACES)
    return columns.select(row.alias("row"), "dt").select("row.*", "dt")


# A document holds at most 2,048 customers times 512 positions of each: its size does not
# grow with the tables, and their number grows with the positions, not with customers times parts.
_CUSTOMERS_PER_DOCUMENT, _POSITIONS_PER_DOCUMENT = 2048, 512

#: Line items per partition of positions, so that sorting and gathering these stays within a task's memory.
LINES_PER_PARTITION = 250_000


def _partitions(spark: SparkSession, sf_dir: str) -> int:
    """How many partitions positions are dealt out to; it follows the line items, counted by the files' footers."""
    lines = table(spark, sf_dir, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, -(-lines // LINES_PER_PARTITION))


def positions(spark: SparkSession, sf_dir: str, variant: str = FIXED) -> DataFrame:
    """The rows of ``feed_positions`` with ``customers``, the number of their block of customers.

    Line items are dealt out by customer once, for adding them up and joining them.
    """
    lines, parts = table(spark, sf_dir, "lineitem"), _partitions(spark, sf_dir)
    bought = lines.repartition("l_orderkey").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("o_custkey", "l_partkey", "l_quantity", "l_linestatus", "l_extendedprice")
    held = bought.repartition(parts, "o_custkey").groupBy("o_custkey", "l_partkey").agg(
        F.expr(_HELD_QUANTITY).alias("q"), F.expr(_HELD_COST).alias("a")
    )
    nations = F.broadcast(table(spark, sf_dir, "nation"))
    customers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    own = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("c_custkey") % 50 != 0)
    joined = customers.select("c_custkey", "n_nationkey").repartition(parts, "c_custkey").join(held, own, "left")
    blocks = joined.withColumn("customers", F.floor(F.col("c_custkey") / _CUSTOMERS_PER_DOCUMENT))
    columns = _POSITION_COLUMNS.replace("$day", _DOCUMENT_DAY[variant])
    return spark.sql(f"SELECT {columns}, customers FROM {{blocks}}", blocks=blocks)


def document_lines(spark: SparkSession, sf_dir: str, variant: str = FIXED, held=None) -> DataFrame:
    """Nested JSON documents: (dt, file, document), one document per row.

    Positions, those given as ``held`` or new ones, are dealt out by block once, for all steps.
    """
    blocks = held if held is not None else positions(spark, sf_dir, variant)
    number = F.row_number().over(Window.partitionBy("customers", "c_custkey").orderBy("l_partkey"))
    counted = F.when(F.col("l_partkey").isNotNull(), number).otherwise(1)
    rows = blocks.repartition(_partitions(spark, sf_dir), "customers").withColumn(
        "parts", F.floor((counted - 1) / _POSITIONS_PER_DOCUMENT)
    )
    document_key = ["dt", "source_run_date", "customers", "parts"]
    position = F.struct(
        "symbol",
        F.col("position_quantity").cast("string").alias("position_quantity"),
        "currency",
        F.col("average_cost").cast("string").alias("average_cost"),
    )
    limits = ["max_market_value_usd", "max_daily_loss_usd", "max_position_concentration_pct"]
    portfolios = rows.groupBy(
        *document_key, "c_custkey", "portfolio_id", "portfolio_name", *limits
    ).agg(F.collect_list(F.when(F.col("l_partkey").isNotNull(), position)).alias("positions"))
    portfolio = F.struct(
        "portfolio_id",
        "portfolio_name",
        F.lit("USD").alias("base_currency"),
        "positions",
        F.struct(
            F.struct(*[F.col(c).cast("string").alias(c) for c in limits]).alias("risk_limits")
        ).alias("metadata"),
    )
    documents = portfolios.groupBy(*document_key).agg(F.collect_list(portfolio).alias("portfolios"))
    file = F.concat_ws("-", F.coalesce(F.col("source_run_date").cast("string"), F.lit("none")),
                       F.col("customers").cast("string"), F.col("parts").cast("string"))
    document = F.to_json(F.struct(F.col("source_run_date").alias("run_date"), "portfolios"))
    return documents.select("dt", file.alias("file"), document.alias("document"))


def documents(spark: SparkSession, sf_dir: str, variant: str = FIXED, held=None) -> DataFrame:
    """Portfolio documents after a trip through JSON text, with dt."""
    parsed = F.from_json("document", S.PORTFOLIO_DOCUMENT)
    return document_lines(spark, sf_dir, variant, held).select(
        parsed.alias("d"), "dt"
    ).select("d.*", "dt")


def write_feeds(
    spark: SparkSession, sf_dir: str, root: str, variant: str = FIXED, days: int = 1
) -> None:
    """The three feeds as files under ``root``, laid out by date; the same files come again on each of ``days``."""
    write_messages(spark, sf_dir, f"{root}/trades", variant, days)
    write_market(spark, sf_dir, f"{root}/market_data", variant, days)
    write_documents(spark, sf_dir, f"{root}/portfolio", variant, days)


def _on_days(rows: DataFrame, days: int) -> DataFrame:
    """The rows again on each of the next days, so that a feed is derived once for all of them."""
    if days == 1:
        return rows
    return rows.withColumn("dt", F.explode(F.array(*[F.date_add("dt", n) for n in range(days)])))


def write_messages(spark, sf_dir, root, variant=FIXED, days=1) -> None:
    rows = _on_days(messages(spark, sf_dir, variant), days)
    with lean_writes(spark):
        rows.write.options(**COMPRESSED).partitionBy("dt").text(root)


def write_market(spark, sf_dir, root, variant=FIXED, days=1) -> None:
    rows = _on_days(market_columns(spark, sf_dir, variant), days)
    with lean_writes(spark):
        rows.write.options(header=True, **CSV_SPACES, **COMPRESSED).partitionBy("dt").csv(root)


def write_documents(spark, sf_dir, root, variant=FIXED, days=1) -> None:
    lines = _on_days(document_lines(spark, sf_dir, variant), days)
    with lean_writes(spark):
        lines.write.options(**COMPRESSED).partitionBy("dt", "file").text(root)
