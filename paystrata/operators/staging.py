"""Source rows aligned to the model (ODS): types only, no row is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.model import MONEY


def ods_transaction(raw: DataFrame) -> DataFrame:
    """Typed time and amount, and the UTC day as ``dt``."""
    typed = raw.withColumns({"event_time": F.col("event_time").cast("timestamp"),
                             "amount": F.col("amount").cast(MONEY)})
    return typed.withColumn("dt", F.to_date("event_time"))


def ods_customer(raw: DataFrame) -> DataFrame:
    """A register time that cannot be read becomes NULL and is left for the check to stop."""
    if dict(raw.dtypes)["register_time"] == "string":
        return raw.withColumn("register_time", F.try_to_timestamp("register_time"))
    return raw.withColumn("register_time", F.col("register_time").cast("timestamp"))


def ods_merchant(raw: DataFrame) -> DataFrame:
    return raw


def with_status(dim: DataFrame) -> DataFrame:
    """Files written before soft deletes have no ``status``: those rows are ACTIVE."""
    if "status" in dim.columns:
        return dim.withColumn("status", F.coalesce("status", F.lit("ACTIVE")))
    return dim.withColumn("status", F.lit("ACTIVE"))
