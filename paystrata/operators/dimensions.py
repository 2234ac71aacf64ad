"""Clean dimension tables (DIM)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.functions.columns import not_blank
from paystrata.operators.latest import latest_by_key


def dim_customer(ods: DataFrame) -> DataFrame:
    """Rows with an id, a level and a register time. Deleted customers stay: old transactions refer to them."""
    return ods.filter(not_blank("customer_id") & not_blank("level") & F.col("register_time").isNotNull())


def dim_merchant(ods: DataFrame) -> DataFrame:
    return ods


#: The column of each dimension that names its rows.
KEYS = {"dim_customer": "customer_id", "dim_merchant": "merchant_id"}
_DELETED = "status <=> 'DELETED'"


def one_per_key(rows: DataFrame, pk: str) -> DataFrame:
    """The newest row of each key, so that a join on it never adds rows.

    Rows that repeat a key tell no order of their own. The one with the latest register time counts; of those as late a
    deletion, which comes after everything else that can happen to a row; then the order of the other columns.
    """
    newer = [name for name in ("register_time",) if name in rows.columns]
    marked = rows.withColumn("_deleted", F.expr(_DELETED))
    return latest_by_key(marked, [pk], [*newer, "_deleted"]).select(*rows.columns)
