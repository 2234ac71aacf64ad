"""Cleaned and enriched transactions (DWD)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_clean(require_customer: bool = False) -> Column:
    """The row has an id, a positive amount and a time; the stream also requires a customer."""
    keep = F.col("transaction_id").isNotNull() & (F.col("amount") > 0) & F.col("event_time").isNotNull()
    return keep & F.col("customer_id").isNotNull() if require_customer else keep


def clean_transactions(df: DataFrame, require_customer: bool = False) -> DataFrame:
    return df.filter(is_clean(require_customer))


def enrich_customer(df: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join: a transaction of an unknown customer keeps NULL attributes.

    No join hint: Catalyst broadcasts the pruned dimension only while its size is under the broadcast limit, and
    AQE splits hot customer ids of a sort-merge join.
    """
    return df.join(customers.select("customer_id", F.col("level").alias("customer_level"),
                                    F.col("region").alias("customer_region"),
                                    F.col("register_time").alias("customer_register_time")),
                   "customer_id", "left")


def enrich_merchant(df: DataFrame, merchants: DataFrame) -> DataFrame:
    return df.join(merchants.select("merchant_id", F.col("category").alias("merchant_category"),
                                    F.col("region").alias("merchant_region"),
                                    F.col("risk_level").alias("merchant_risk_level")),
                   "merchant_id", "left")


def enrich(df: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    return enrich_merchant(enrich_customer(df, customers), merchants)
