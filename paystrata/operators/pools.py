"""Entities that new transactions may refer to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.operators.quality import QualityError


def active_pool(customers: DataFrame, accounts: DataFrame, merchants: DataFrame) -> dict[str, DataFrame]:
    """ACTIVE customers and merchants, and the accounts of ACTIVE customers with their opening time.

    Accounts stay one row each, keyed by customer, rather than one map per customer: a customer with very many
    accounts then needs no single large row.
    """
    active = customers.filter(F.col("status") == "ACTIVE").select("customer_id")
    return {
        "customers": active,
        "merchants": merchants.filter(F.col("status") == "ACTIVE").select("merchant_id"),
        "accounts": accounts.join(active, "customer_id", "left_semi").select("customer_id", "account_id",
                                                                             "open_time"),
    }


def require_pool(pool: dict[str, DataFrame]) -> None:
    empty = [name for name in ("customers", "merchants") if pool[name].isEmpty()]
    if empty:
        raise QualityError(f"no ACTIVE {' and '.join(empty)}: load the dimensions first")
