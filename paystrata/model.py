"""The data model: enumerations, keys and the column list of every table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, MapType, StringType,
    StructField, StructType, TimestampType,
)

# Fixed values of the model
CURRENCIES = ["CNY", "USD", "EUR"]
TRANSACTION_TYPES = ["PAYMENT", "REFUND"]
CUSTOMER_LEVELS = ["V1", "V2", "V3", "V4"]
ACCOUNT_TYPES = ["SAVINGS", "CHECKING", "CREDIT"]
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH"]
STATUSES = ["ACTIVE", "DELETED"]
CUSTOMER_LOOKUP_PREFIX = "dim:customer:"
MERCHANT_LOOKUP_PREFIX = "dim:merchant:"
LARGE_AMOUNT = 10000
FIRST_ID = 10000          # the id before the first one handed out in an empty dimension

MONEY = DecimalType(18, 2)

_SHORT = {"str": StringType(), "money": MONEY, "time": TimestampType(), "date": DateType(), "long": LongType(),
          "int": IntegerType(), "real": DoubleType(), "flag": BooleanType(),
          "map": MapType(StringType(), StringType())}


def _schema(**columns: str | DataType) -> StructType:
    return StructType([StructField(name, _SHORT.get(kind, kind)) for name, kind in columns.items()])


TRANSACTION = _schema(
    transaction_id="str", amount="money", currency="str", customer_id="str", account_id="str", merchant_id="str",
    transaction_type="str", event_time="time")
CUSTOMER = _schema(customer_id="str", level="str", region="str", register_time="time", status="str")
MERCHANT = _schema(merchant_id="str", category="str", region="str", risk_level="str", status="str")
ACCOUNT = _schema(account_id="str", customer_id="str", account_type="str", open_time="time")

# Streamed transaction after enrichment: attributes come from a string lookup, so all are strings
TRANSACTION_ONLINE = _schema(
    transaction_id="str", event_time="time", customer_id="str", account_id="str", merchant_id="str", amount="money",
    currency="str", transaction_type="str", customer_level="str", customer_region="str",
    customer_register_time="str", merchant_category="str", merchant_risk_level="str")

REALTIME_AGG = _schema(
    window_type="str", window_start="time", window_end="time", customer_id="str", total_amount="money",
    avg_amount="real", max_amount="money", min_amount="money", transaction_count="long", merchant_count="long",
    account_count="long", currency_count="long", txn_type_count="long", high_risk_txn_count="long",
    large_txn_amount="money", first_txn_time="time", last_txn_time="time")

LOOKUP = _schema(key="str", data="map")

LATE_TRANSACTION = _schema(
    transaction_id="str", event_time="time", customer_id="str", account_id="str", merchant_id="str", amount="money",
    currency="str", transaction_type="str")

# Columns of every warehouse table; writes are conformed to these and unknown tables are refused
TABLES: dict[str, StructType] = {
    "fact_transaction": StructType([*TRANSACTION.fields, StructField("dt", DateType())]),
    "ods_transaction": StructType([*TRANSACTION.fields, StructField("dt", DateType())]),
    "ods_customer": CUSTOMER,
    "ods_merchant": MERCHANT,
    "dim_customer": CUSTOMER,
    "dim_merchant": MERCHANT,
    "dim_account": ACCOUNT,
    "dwd_transaction": StructType([
        *TRANSACTION.fields, StructField("dt", DateType()),
        *_schema(customer_level="str", customer_region="str", customer_register_time="time",
                 merchant_category="str", merchant_region="str", merchant_risk_level="str").fields]),
    "dws_customer_daily": _schema(
        dt="date", customer_id="str", txn_count="long", total_amount="money", avg_amount="real", pay_count="long",
        pay_amount="money", refund_count="long", refund_amount="money"),
    "dws_merchant_daily": _schema(
        dt="date", merchant_id="str", txn_count="long", customer_count="long", account_count="long",
        total_amount="money", avg_amount="real", max_amount="money", pay_count="long", pay_amount="money",
        refund_count="long", refund_amount="money", currency_count="long", cny_amount="money", usd_amount="money",
        eur_amount="money", high_risk_txn_count="long", high_risk_customer_count="long", refund_rate="real"),
    "ads_customer_profile": _schema(
        dt="date", customer_id="str", txn_count="long", total_amount="money", pay_count="long", pay_amount="money",
        refund_count="long", refund_amount="money", avg_ticket_amount="real", refund_txn_rate="real",
        pay_amount_ratio="real", has_refund="flag", amount_tier="str", ma7_total_amount="money",
        ma7_txn_count="real", dod_amount_change="money"),
    "ads_daily_report": _schema(
        dt="date", month="str", active_merchant_count="long", total_txn_count="long", total_amount="money",
        pay_count="long", pay_amount="money", refund_count="long", refund_amount="money", cny_amount="money",
        usd_amount="money", eur_amount="money", high_risk_txn_count="long", max_amount="money",
        avg_ticket_amount="real", refund_rate="real", high_risk_txn_ratio="real", prev_refund_rate="real",
        refund_rate_diff="real", month_total_txn_count="long", month_total_amount="money"),
    "ads_merchant_top10": _schema(
        dt="date", rank_no="int", merchant_id="str", txn_count="long", customer_count="long", total_amount="money",
        amount_share="real"),
    "lookup_customer": LOOKUP,
    "lookup_merchant": LOOKUP,
}

# Row order inside a written file, so that min/max statistics prune reads by these columns
SORT_KEYS: dict[str, list[str]] = {
    "ods_transaction": ["transaction_id"],
    "dwd_transaction": ["customer_id", "merchant_id"],
    "dws_customer_daily": ["customer_id"],
    "dws_merchant_daily": ["merchant_id"],
    "ads_customer_profile": ["customer_id"],
    "ads_merchant_top10": ["rank_no"],
    "lookup_customer": ["key"],
    "lookup_merchant": ["key"],
}

ONLINE_KEY = ["transaction_id", "event_time", "customer_id"]
WINDOW_KEY = ["window_type", "window_start", "window_end", "customer_id"]
LATE_KEY = ["transaction_id", "event_time"]
