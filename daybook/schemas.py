"""Column types, feed schemas and table contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

PRICE = T.DecimalType(20, 8)
QUANTITY = T.DecimalType(20, 4)
FX_RATE = T.DecimalType(20, 10)
MONEY = T.DecimalType(24, 4)
PERCENTAGE = T.DecimalType(10, 4)
SIDE_SIGN = T.DecimalType(2, 0)

# Message tag -> column, in message order.
TAG_COLUMNS = {
    "8": "begin_string",
    "35": "message_type",
    "49": "sender_comp_id",
    "56": "target_comp_id",
    "34": "message_sequence_number",
    "11": "order_id",
    "1": "portfolio_id",
    "55": "symbol",
    "54": "side_code",
    "38": "quantity",
    "44": "trade_price",
    "6": "average_cost",
    "15": "currency",
    "60": "transact_time",
}

# Formats, side codes and source names the feeds use.
MESSAGE_TIME_FORMAT = "yyyyMMdd-HH:mm:ss"
SIDES = {"1": "BUY", "2": "SELL"}
TRADES = "trades"
MARKET_DATA = "market_data"
PORTFOLIO = "portfolio"
SOURCES = [TRADES, MARKET_DATA, PORTFOLIO]

_STRING, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
_DATE, _TIMESTAMP, _BOOLEAN = T.DateType(), T.TimestampType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    """A struct of nullable fields in the given order."""
    return T.StructType([T.StructField(name, type_) for name, type_ in fields.items()])


MARKET_FEED = struct(
    symbol=_STRING,
    asset_class=_STRING,
    close_price=PRICE,
    currency=_STRING,
    fx_rate_to_usd=FX_RATE,
    price_date=_DATE,
    loaded_at=_TIMESTAMP,
)

_POSITION = struct(
    symbol=_STRING, position_quantity=QUANTITY, currency=_STRING, average_cost=PRICE
)
_RISK_LIMITS = struct(
    max_market_value_usd=MONEY,
    max_daily_loss_usd=MONEY,
    max_position_concentration_pct=PERCENTAGE,
)
_PORTFOLIO = struct(
    portfolio_id=_STRING,
    portfolio_name=_STRING,
    base_currency=_STRING,
    positions=T.ArrayType(_POSITION),
    metadata=struct(risk_limits=_RISK_LIMITS, source_system=_STRING, loaded_at=_TIMESTAMP),
)
PORTFOLIO_DOCUMENT = struct(run_date=_DATE, portfolios=T.ArrayType(_PORTFOLIO))
#: The same, with one portfolio a line: each line says its document's date.
PORTFOLIO_LINE = T.StructType([T.StructField("run_date", _DATE), *_PORTFOLIO.fields])

METRICS_DOCUMENT = struct(
    clean_trade_count=_LONG,
    overall_reject_rate=_DOUBLE,
    pipeline_name=_STRING,
    pnl_unresolvable_count=_LONG,
    portfolio_pnl_count=_LONG,
    quality_gate=struct(
        passed=_BOOLEAN,
        pnl_unresolvable_count=_LONG,
        pnl_unresolvable_threshold=_LONG,
        trade_reject_rate=_DOUBLE,
        trade_reject_rate_threshold=_DOUBLE,
    ),
    rejection_count_by_rule=T.MapType(_STRING, _LONG),
    rejection_count_by_source=T.MapType(_STRING, _LONG),
    run_date=_STRING,
    total_realized_pnl_usd=_STRING,
    total_rejection_count=_LONG,
    total_trade_count=_LONG,
    trade_reject_rate=_DOUBLE,
    trade_rejection_count=_LONG,
)


@dataclass(frozen=True)
class TableContract:
    """What a warehouse table promises: columns, types, keys and bounds."""

    name: str
    output_path: str | None
    partition_column: str | None
    columns: list[str]
    types: dict[str, T.DataType]
    required: list[str]
    primary_key: list[str]
    max_lengths: dict[str, int] = field(default_factory=dict)
    serial_column: str | None = None
    processing_stamps: tuple[str, ...] = ()

    @property
    def table_columns(self) -> list[str]:
        """Stored columns: serial id first, load stamp last."""
        serial = [self.serial_column] if self.serial_column else []
        return serial + self.columns + ["loaded_at"]


_TRADE_TYPES = {
    "order_id": _STRING,
    "portfolio_id": _STRING,
    "symbol": _STRING,
    "side": _STRING,
    "quantity": QUANTITY,
    "trade_price": PRICE,
    "average_cost": PRICE,
    "currency": _STRING,
    "transact_time": _TIMESTAMP,
    "trade_date": _DATE,
}
_TRADE_LENGTHS = {"order_id": 100, "portfolio_id": 50, "symbol": 50, "side": 10, "currency": 3}

_PRICED_TYPES = _TRADE_TYPES | {
    "close_price": PRICE,
    "market_currency": _STRING,
    "fx_rate_to_usd": FX_RATE,
    "realized_pnl_local": MONEY,
    "realized_pnl_usd": MONEY,
    "pnl_unresolvable": _BOOLEAN,
}

_PORTFOLIO_TYPES = {
    "portfolio_id": _STRING,
    "portfolio_name": _STRING,
    "pnl_date": _DATE,
    "position_count": _LONG,
    "total_market_value_usd": MONEY,
    "total_unrealized_pnl_usd": MONEY,
    "max_market_value_usd": MONEY,
    "max_daily_loss_usd": MONEY,
    "max_position_concentration_pct": PERCENTAGE,
    "market_value_limit_breached": _BOOLEAN,
    "daily_loss_limit_breached": _BOOLEAN,
}

_REJECT_TYPES = {
    "source_name": _STRING,
    "run_date": _DATE,
    "record_identifier": _STRING,
    "raw_record": _STRING,
    "rejection_rule": _STRING,
    "rejection_reason": _STRING,
    "rejected_at": _TIMESTAMP,
}

_UNRESOLVABLE_TYPES = _TRADE_TYPES | {"unresolvable_reason": _STRING}

_LOAD_LOG_TYPES = {
    "dag_id": _STRING,
    "airflow_run_id": _STRING,
    "run_date": _DATE,
    "target_table": _STRING,
    "source_path": _STRING,
    "rows_deleted": _LONG,
    "rows_inserted": _LONG,
    "load_status": _STRING,
    "started_at": _TIMESTAMP,
    "completed_at": _TIMESTAMP,
    "error_message": _STRING,
}

TABLES = {
    t.name: t
    for t in [
        TableContract(
            name="processed_trades",
            output_path="processed/trades",
            partition_column="trade_date",
            columns=list(_PRICED_TYPES),
            types=_PRICED_TYPES,
            required=[*_TRADE_TYPES, "pnl_unresolvable"],
            primary_key=["order_id", "trade_date"],
            max_lengths=_TRADE_LENGTHS | {"market_currency": 3},
        ),
        TableContract(
            name="portfolio_pnl",
            output_path="processed/portfolio_pnl",
            partition_column="pnl_date",
            columns=list(_PORTFOLIO_TYPES),
            types=_PORTFOLIO_TYPES,
            required=["portfolio_id", "pnl_date", "position_count"],
            primary_key=["portfolio_id", "pnl_date"],
            max_lengths={"portfolio_id": 50, "portfolio_name": 255},
        ),
        TableContract(
            name="rejected_records",
            output_path="rejected",
            partition_column="run_date",
            columns=list(_REJECT_TYPES),
            types=_REJECT_TYPES,
            required=["source_name", "run_date", "rejection_rule", "rejection_reason", "rejected_at"],
            primary_key=["rejection_id"],
            max_lengths={"source_name": 50, "record_identifier": 255, "rejection_rule": 100},
            serial_column="rejection_id",
            processing_stamps=("rejected_at",),
        ),
        TableContract(
            name="unresolvable_pnl",
            output_path="processed/unresolvable_pnl",
            partition_column="trade_date",
            columns=list(_UNRESOLVABLE_TYPES),
            types=_UNRESOLVABLE_TYPES,
            required=list(_UNRESOLVABLE_TYPES),
            primary_key=["order_id", "trade_date"],
            max_lengths=_TRADE_LENGTHS,
        ),
    ]
}

LOAD_LOG = struct(load_id=_LONG, **_LOAD_LOG_TYPES)


def table_schema(contract: TableContract) -> T.StructType:
    """Spark schema of a stored warehouse table."""
    types = contract.types | {"loaded_at": _TIMESTAMP}
    if contract.serial_column:
        types = {contract.serial_column: _LONG} | types
    return struct(**{c: types[c] for c in contract.table_columns})
