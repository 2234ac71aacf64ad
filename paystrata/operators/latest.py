"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the highest ``version`` per key; the other columns break ties, so the result is fixed.

    ``max`` of a struct combines before the shuffle: a key with very many versions sends one row per task. ``version``
    alone would not fix the row where two versions are equal.
    """
    rest = [name for name in df.columns if name not in keys and name not in version]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*version, *rest)).alias("newest"))
    return newest.select(*[F.col(name) if name in keys else F.col(f"newest.{name}").alias(name)
                           for name in df.columns])
