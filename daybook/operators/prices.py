"""Joining rows to the market price of the same day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.sources.session import stored

# A price row is some 150 bytes in memory, so this bounds the broadcast at about 75 MB.
BROADCAST_ROWS = 500_000
BROADCAST_SYMBOL_BYTES = 32 * 1024 * 1024

# Above this many rows of one symbol and day, the shuffled join splits the key.
ROWS_PER_SALT = 1_000_000

# Keys are first counted by this many hashes, so that rare ones stay out of the shuffle.
KEY_BUCKETS = 65_536


def price_lookup(market: DataFrame) -> DataFrame:
    """The five columns of valid market rows that joins need."""
    return market.select(
        F.col("normalized_symbol").alias("market_symbol"),
        "price_date",
        "close_price",
        F.col("currency").alias("market_currency"),
        F.col("effective_fx_rate_to_usd").alias("fx_rate_to_usd"),
    )


def fits_broadcast(
    prices: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_SYMBOL_BYTES,
) -> bool:
    """Measure whether a price table is small enough to send to every executor."""
    size = prices.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length("market_symbol")), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def attach_prices(
    rows: DataFrame,
    market: DataFrame,
    symbol: str,
    day: str,
    eligible: Column | None = None,
    small: bool | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
    in_files: bool = False,
) -> DataFrame:
    """LEFT join ``rows`` to the price with the same symbol on the same day.

    Every price row matches, so a symbol priced twice gives two rows; rows for
    which ``eligible`` is not true are kept once, without a price. A price
    table measured as small is broadcast (pass ``small`` where the caller knows
    already). Otherwise both sides are shuffled, with frequent keys split over
    as many salts as their row count asks for; ``rows`` are then read more than
    once and written first, unless they come straight from files (``in_files``).
    """
    prices = price_lookup(market)
    if small is None:
        prices = stored(prices, "prices", lean=True)
        small = fits_broadcast(prices)

    matchable = F.lit(True) if eligible is None else eligible
    keyed = rows.withColumns(
        {
            "key_symbol": F.when(matchable, F.col(symbol)),
            "key_day": F.when(matchable, F.col(day)),
        }
    )
    same_key = (F.col("key_symbol") == F.col("market_symbol")) & (
        F.col("key_day") == F.col("price_date")
    )
    if small:
        joined = keyed.join(F.broadcast(prices), same_key, "left")
    else:
        if not in_files:
            keyed = stored(keyed, "unpriced", lean=True)
        keyed, prices = _salt_frequent_keys(keyed, prices, rows.columns, rows_per_salt)
        joined = keyed.join(
            prices, same_key & (F.col("key_salt") == F.col("price_salt")), "left"
        ).drop("key_salt", "price_salt")
    return joined.drop("key_symbol", "key_day", "market_symbol", "price_date")


def _frequent_keys(keyed: DataFrame, rows_per_salt: int, max_keys: int = BROADCAST_ROWS) -> DataFrame:
    """(hot_symbol, hot_day, salts) of every key with more rows than a salt takes.

    The keys are counted by the doublings of ``rows_per_salt`` they hold; it is
    doubled until at most ``max_keys`` keys remain. None of these is left out:
    a key with too many rows has a hash with too many, and keys of other hashes
    are not counted one by one.
    """
    bucket = F.pmod(F.xxhash64("hot_symbol", "hot_day"), F.lit(KEY_BUCKETS))
    keys = (
        keyed.select(F.col("key_symbol").alias("hot_symbol"), F.col("key_day").alias("hot_day"))
        .where(F.col("hot_symbol").isNotNull() & F.col("hot_day").isNotNull())
        .withColumn("bucket", bucket)
    )
    full = keys.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > rows_per_salt).select("bucket")
    counts = (
        keys.join(F.broadcast(full), "bucket")
        .groupBy("hot_symbol", "hot_day")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > rows_per_salt)
    )
    counts = stored(counts, "frequent-keys", lean=True)
    doublings = F.floor(F.log2((F.col("n") - 1) / rows_per_salt)).alias("doublings")
    sizes = {r["doublings"]: r["count"] for r in counts.groupBy(doublings).count().collect()}
    steps = 0
    while sum(count for held, count in sizes.items() if held >= steps) > max_keys:
        steps += 1
    rows = rows_per_salt * 2**steps
    return counts.where(F.col("n") > rows).select("hot_symbol", "hot_day", F.ceil(F.col("n") / rows).alias("salts"))


def _salt_frequent_keys(
    keyed: DataFrame, prices: DataFrame, row_columns: list[str], rows_per_salt: int
) -> tuple[DataFrame, DataFrame]:
    """Give each row one salt and each price every salt of its key.

    Only frequent keys get more than one salt, so the price side hardly grows.
    The salt comes from the row's content, which gives the same answer when a
    lost executor's task is run again; adaptive execution splits what identical
    copies of one row still leave in a large partition.
    """
    frequent = F.broadcast(_frequent_keys(keyed, rows_per_salt))
    salts = F.coalesce(F.col("salts"), F.lit(1))
    content = F.xxhash64(*row_columns)

    # Without a key a row matches nothing: any salt will do, so spread them all.
    row_salt = F.when(
        F.col("key_symbol").isNull() | F.col("key_day").isNull(), content
    ).otherwise(F.pmod(content, salts))
    hot_row = (F.col("key_symbol") == F.col("hot_symbol")) & (F.col("key_day") == F.col("hot_day"))
    salted_rows = (
        keyed.join(frequent, hot_row, "left")
        .withColumn("key_salt", row_salt)
        .drop("hot_symbol", "hot_day", "salts")
    )

    hot_price = (F.col("market_symbol") == F.col("hot_symbol")) & (
        F.col("price_date") == F.col("hot_day")
    )
    salted_prices = (
        prices.join(frequent, hot_price, "left")
        .withColumn("price_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
        .drop("hot_symbol", "hot_day", "salts")
    )
    return salted_rows, salted_prices
