"""Declared schemas of the three data sets the library is built around.

Nothing is inferred: JSON is always read against one of these (or a caller's own) ``StructType``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
OPEN_END = "9999-12-31"

def _fields(kind, names: str) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


def _text(names: str) -> list[T.StructField]:
    return _fields(T.StringType(), names)


def _number(names: str) -> list[T.StructField]:
    return _fields(T.DoubleType(), names)


def _record(*parts: list[T.StructField]) -> T.StructType:
    return T.StructType([f for part in parts for f in part])


# Field names and types of the landed records, declared so that results line up with
# the data producers' contract.

BILLING = _record(
    _text("billing_account_id cost currency"),
    _number("currency_conversion_rate"),
    _text("export_time"),
    _fields(_record(_text("month publisher_type")), "invoice"),
    _fields(T.ArrayType(_record(_text("key value"))), "labels"),
    _text("location project"),
    _fields(_record(_text("description id")), "service sku"),
    _fields(
        _record(_text("amount"), _number("amount_in_pricing_units"), _text("pricing_unit unit")),
        "usage",
    ),
    _text("usage_end_time usage_start_time"),
    _text(CORRUPT),
)

BILLING_KEY_FIELDS = ("billing_account_id", "cost", "currency", "project", "service", "sku")

_TRADE_DETAILS = {
    "order": _record(
        _text("order_id order_type time_in_force"),
        _number("limit_price stop_price filled_quantity average_fill_price"),
        _text("execution_venue execution_time"),
    ),
    "market_data": _record(
        _number("bid ask last_trade"),
        _fields(T.LongType(), "volume"),
        _number("vwap high_52w low_52w"),
    ),
    "risk_metrics": _record(_number("beta volatility_30d var_95 portfolio_weight")),
    "fees": _record(_number("commission sec_fee exchange_fee")),
    "tags": T.ArrayType(T.StringType()),
    "dividend_info": _record(
        _number("yield"),
        _text("ex_date pay_date"),
        _number("amount_per_share"),
        _text("frequency"),
    ),
    "analyst_ratings": _record(
        _fields(T.IntegerType(), "buy hold sell"), _number("target_price")
    ),
    "bond_info": _record(_number("duration yield_to_maturity"), _text("credit_quality")),
    "etf_info": _record(
        _number("expense_ratio aum_billions"),
        _fields(T.IntegerType(), "holdings_count"),
        _text("tracking_index"),
    ),
    "realized_pnl": _record(
        _number("cost_basis proceeds gain_loss gain_loss_pct"),
        _fields(T.IntegerType(), "holding_period_days"),
        _text("tax_treatment"),
    ),
}

TRADE = _record(
    _text("record_id trade_date portfolio_id account_id ticker_symbol trade_type"),
    _number("quantity price"),
    _text("currency"),
    [T.StructField("trade_details", T.StructType([T.StructField(*d) for d in _TRADE_DETAILS.items()]))],
    _text("source_system"),
    _text(CORRUPT),
)


@dataclass(frozen=True)
class TargetColumn:
    """One column of a target table and how it is filled from a parsed record.

    ``source`` names the parsed column (a dotted path is fine); ``None`` means the column is a load
    stamp. ``pattern`` is the date pattern of a text source.
    """

    name: str
    type: str
    source: str | None = None
    required: bool = False
    pattern: str | None = None

    @property
    def is_stamp(self) -> bool:
        return self.source is None


TRADE_TARGET = (
    TargetColumn("RECORD_ID", "string", "record_id", required=True),
    TargetColumn("TRADE_DATE", "date", "trade_date", pattern="yyyy-MM-dd"),
    TargetColumn("CREATED_AT", "timestamp_ntz"),
    TargetColumn("PORTFOLIO_ID", "string", "portfolio_id"),
    TargetColumn("ACCOUNT_ID", "string", "account_id"),
    TargetColumn("TICKER_SYMBOL", "string", "ticker_symbol"),
    TargetColumn("TRADE_TYPE", "string", "trade_type"),
    TargetColumn("QUANTITY", "decimal(18,4)", "quantity"),
    TargetColumn("PRICE", "decimal(18,6)", "price"),
    TargetColumn("CURRENCY", "string", "currency"),
    TargetColumn("TRADE_DETAILS", "variant", "trade_details"),
    TargetColumn("SOURCE_SYSTEM", "string", "source_system"),
    TargetColumn("LOAD_TIMESTAMP", "timestamp_ntz"),
)

# One row is one metric value of one instrument under one scenario, year and percentile; versions
# of a row are told apart by the effective dates, the open one ending on OPEN_END.
RISK = _record(
    _fields(T.DateType(), "as_of_date risk_date"),
    _text("version identifier_type identifier scenario_name_internal scenario_name"),
    _text("scenario_year scenario_percentile asset_class metric_name metric_name_internal"),
    _number("metric_value"),
    _text("metric_value_string"),
    _fields(T.VariantType(), "metric_value_additional"),
    _text("is_proxied status"),
    _fields(T.TimestampNTZType(), "updated_dts created_dts"),
    _text("fund_modeling_method data_source data_derivation_type identifier_reference"),
    _text("segment_name_internal segment_name"),
    _fields(T.ArrayType(T.StringType()), "segment_attribute_internal segment_attribute"),
    _text("region_internal region"),
    _fields(T.VariantType(), "id_attributes"),
    _fields(T.DateType(), "effective_start_date effective_end_date"),
    _text("file_name"),
)

RISK_REQUIRED = (
    "as_of_date", "risk_date", "version", "identifier_type", "identifier",
    "metric_name_internal", "updated_dts", "created_dts",
)

RISK_CLUSTERING = ("file_name", "effective_end_date", "identifier_type", "asset_class")


def target_columns(
    schema: T.StructType, required: Sequence[str] = ()
) -> tuple[TargetColumn, ...]:
    """A target spec that takes every column of ``schema`` as it is."""
    return tuple(
        TargetColumn(f.name, f.dataType.simpleString(), f.name, required=f.name in required)
        for f in schema.fields
    )


RISK_TARGET = target_columns(RISK, RISK_REQUIRED)
