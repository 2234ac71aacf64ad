"""Dimension lookup: key to a map of strings, published as a table and joined to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.columns import text_or_empty
from paystrata.operators.quality import Rule
from paystrata.sources.lake import Lake

_EMPTY = "CAST(map() AS MAP<STRING, STRING>)"


def to_lookup(dim: DataFrame, pk: str, prefix: str) -> DataFrame:
    """One row per dimension row: ``prefix + pk``, and every other field as text with '' for NULL."""
    fields = []
    for name in dim.columns:
        if name != pk:
            fields += [F.lit(name), text_or_empty(name)]
    return dim.select(F.concat(F.lit(prefix), F.col(pk)).alias("key"), F.create_map(*fields).alias("data"))


def publish_lookup(lake: Lake, dim: DataFrame, table: str, pk: str, prefix: str) -> int:
    """Publish the dimension for look-ups; returns the number of keys.

    The written folder is checked before it goes live: one key for each row of the dimension, each under the prefix and
    none twice. A lookup that fails leaves the one before it in use.
    """
    expected = dim.count()
    strange = Rule("key_without_prefix", ~F.coalesce(F.col("key").startswith(prefix), F.lit(False)))
    return lake.replace_table(to_lookup(dim, pk, prefix), table, [strange], max(expected, 1), "key", expected)["row_count"]


def lookup(df: DataFrame, table: DataFrame, key: Column, as_: str) -> DataFrame:
    """Add the map found under ``key``; a missing or NULL key gives an empty map and keeps the row."""
    found = table.select(F.col("key").alias("_lookup_key"), F.col("data").alias("_lookup_data"))
    return (df.join(found, key == F.col("_lookup_key"), "left")
            .withColumn(as_, F.coalesce("_lookup_data", F.expr(_EMPTY)))
            .drop("_lookup_key", "_lookup_data"))
