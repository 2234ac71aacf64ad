"""Daily totals per customer and per merchant (DWS)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.functions.columns import is_type, mean, ratio
from paystrata.model import CURRENCIES


def customer_daily(dwd: DataFrame) -> DataFrame:
    """One row per customer and day. Every measure combines before the shuffle, so a hot customer is no problem."""
    pay, refund, amount = is_type("PAYMENT"), is_type("REFUND"), F.col("amount")
    return dwd.groupBy("customer_id", "dt").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        mean("amount").alias("avg_amount"),
        F.count_if(pay).alias("pay_count"),
        F.sum(F.when(pay, amount).otherwise(0)).alias("pay_amount"),
        F.count_if(refund).alias("refund_count"),
        F.sum(F.when(refund, amount).otherwise(0)).alias("refund_amount"))


def merchant_daily(dwd: DataFrame) -> DataFrame:
    """One row per merchant and day; sums over no matching row are NULL.

    Several distinct counts in one aggregate would copy every row once per distinct set. Each set is aggregated on
    its own instead, over just its columns, and the pieces, one row per merchant and day each, are put together by
    a last group. A distinct set is shuffled by merchant, day *and* value, so one hot merchant spreads over all
    tasks, and grouping (unlike joining) keeps rows whose merchant is NULL.
    """
    keys = ["merchant_id", "dt"]
    pay, refund, amount = is_type("PAYMENT"), is_type("REFUND"), F.col("amount")
    high = F.col("merchant_risk_level") == "HIGH"

    measures = dwd.groupBy(*keys).agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        mean("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
        F.count_if(pay).alias("pay_count"),
        F.sum(F.when(pay, amount)).alias("pay_amount"),
        F.count_if(refund).alias("refund_count"),
        F.sum(F.when(refund, amount)).alias("refund_amount"),
        F.count_distinct("currency").alias("currency_count"),
        *[F.sum(F.when(F.col("currency") == code, amount)).alias(f"{code.lower()}_amount") for code in CURRENCIES],
        F.count_if(high).alias("high_risk_txn_count"))
    customers = (dwd.groupBy(*keys, "customer_id").agg(F.max(high).alias("seen_high"))
                 .groupBy(*keys).agg(
                     F.count("customer_id").alias("customer_count"),
                     F.count_if(F.col("seen_high") & F.col("customer_id").isNotNull())
                      .alias("high_risk_customer_count")))
    accounts = dwd.groupBy(*keys).agg(F.count_distinct("account_id").alias("account_count"))

    pieces = (measures.unionByName(customers, allowMissingColumns=True)
              .unionByName(accounts, allowMissingColumns=True))
    whole = pieces.groupBy(*keys).agg(*[F.max(name).alias(name) for name in pieces.columns if name not in keys])
    return whole.withColumn("refund_rate", ratio("refund_count", "txn_count", 4))
