"""Serving queries: recent transactions, live statistics, newest profile, and all of a customer in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.operators.latest import latest_by_key

TRANSACTION_COLUMNS = ["transaction_id", "event_time", "customer_id", "account_id", "merchant_id", "amount",
                       "currency", "transaction_type"]
PROFILE_COLUMNS = ["dt", "customer_id", "txn_count", "total_amount", "avg_ticket_amount", "refund_txn_rate",
                   "has_refund", "amount_tier", "ma7_total_amount", "ma7_txn_count", "dod_amount_change"]


def _of_customer(df: DataFrame, customer_id: str | None) -> DataFrame:
    return df.filter(F.col("customer_id") == customer_id) if customer_id is not None else df


def recent_transactions(online: DataFrame, customer_id: str | None = None, limit: int = 20,
                        columns: list[str] | None = None) -> DataFrame:
    """The newest ``limit`` transactions; the other columns break ties. Each task keeps only ``limit`` rows."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    ties = [name for name in TRANSACTION_COLUMNS if name != "event_time"]
    return (_of_customer(online, customer_id).orderBy(F.desc("event_time"), *ties).limit(limit)
            .select(*(columns or TRANSACTION_COLUMNS)))


def customer_stats(online: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Amount and count per customer and transaction type."""
    return (_of_customer(online, customer_id).groupBy("customer_id", "transaction_type")
            .agg(F.sum("amount").alias("amount_sum"), F.count(F.lit(1)).alias("transaction_count")))


def latest_profile(ads: DataFrame, customer_id: str | None = None) -> DataFrame:
    """The newest daily profile of each customer."""
    rows = _of_customer(ads, customer_id).select(*PROFILE_COLUMNS)
    return latest_by_key(rows, ["customer_id"], ["dt"])


def full_profile(online: DataFrame, ads: DataFrame, customer_id: str | None = None) -> DataFrame:
    """One row per customer: live statistics as an array, newest offline profile as a struct or NULL.

    Both inputs are aggregated to customers before they meet, so the join sees one row per customer and the array
    has one entry per transaction type. Asking for one unknown customer gives an empty list and no profile.
    """
    if customer_id == "":
        raise ValueError("a customer id has at least one character")
    stats = (customer_stats(online, customer_id).groupBy("customer_id").agg(F.sort_array(F.collect_list(F.struct(
        "transaction_type", "amount_sum", "transaction_count"))).alias("realtime_stats")))
    profile = latest_profile(ads, customer_id)
    profile = profile.select("customer_id", F.struct(
        *[name for name in PROFILE_COLUMNS if name != "customer_id"]).alias("offline_profile"))
    merged = stats.join(profile, "customer_id", "full_outer")
    if customer_id is not None:
        asked = online.sparkSession.createDataFrame([(customer_id,)], "customer_id string")
        merged = asked.join(merged, "customer_id", "left")
    nothing = F.array().cast(stats.schema["realtime_stats"].dataType)
    return merged.select("customer_id", F.coalesce("realtime_stats", nothing).alias("realtime_stats"),
                         "offline_profile")
