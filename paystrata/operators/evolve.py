"""Daily change of a dimension: new rows with the next ids, attribute updates, soft deletes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paystrata.functions.columns import id_number
from paystrata.model import FIRST_ID
from paystrata.operators.quality import QualityError

# Attributes an update may change; id, register time and status are never touched
UPDATABLE = {"customer_id": ["level", "region"], "merchant_id": ["category", "region", "risk_level"]}
ID_PREFIX = {"customer_id": "C", "merchant_id": "M", "account_id": "A"}


@dataclass
class Changes:
    """One day's changes. ``adds`` has a unique ``ref`` per row; updates and deletes name existing ids."""
    adds: DataFrame | None = None
    updates: DataFrame | None = None
    deletes: DataFrame | None = None


def highest_id(dim: DataFrame, pk: str) -> int:
    return dim.agg(F.coalesce(F.max(id_number(pk)), F.lit(FIRST_ID))).first()[0]


def number_new(dim: DataFrame, adds: DataFrame, pk: str) -> DataFrame:
    """Give every new row the next id, in the order of the hash of ``ref`` and then ``ref`` itself.

    Rows are counted per hash bucket (4096 at most), the bucket counts become offsets, and rows are numbered inside
    their bucket; no task sees all of them. The order depends on the data alone, so a repeated run hands out the
    same ids.
    """
    bucketed = adds.withColumn("_bucket", F.substring(F.md5(F.coalesce(F.col("ref").cast("string"), F.lit(""))), 1, 3))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows_here"))
               .select("_bucket", F.coalesce(F.sum("rows_here").over(before), F.lit(0)).alias("_before")))
    inside = W.partitionBy("_bucket").orderBy("ref")
    number = F.lit(highest_id(dim, pk)) + F.col("_before") + F.row_number().over(inside)
    # at most 4096 offsets, so the broadcast cannot grow
    return (bucketed.join(F.broadcast(offsets), "_bucket")
            .withColumn(pk, F.concat(F.lit(ID_PREFIX[pk]), number.cast("string")))
            .drop("_bucket", "_before"))


def require_refs(adds: DataFrame) -> None:
    """Every new row has a reference of its own."""
    _stop(_faults(adds.select(F.lit("adds").alias("change"), F.col("ref").cast("string").alias("id"))))


def _counted(named: DataFrame, active_ids: DataFrame | None = None) -> DataFrame:
    """(change, id, times, known): how often each kind of change names an id, and whether it is among the ACTIVE ones."""
    counted = named.groupBy("change", "id").agg(F.count(F.lit(1)).alias("times"))
    if active_ids is None:
        return counted.withColumn("known", F.lit(True))
    known = active_ids.select(active_ids.columns[0], F.lit(True).alias("known")).toDF("id", "known")
    return counted.join(known, "id", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def _faults(named: DataFrame, active_ids: DataFrame | None = None) -> dict[str, Row]:
    """Per kind of change: ids that are missing, that occur more than once, and that are not among the ACTIVE ones."""
    found = _counted(named, active_ids).groupBy("change").agg(
        F.count_if(F.col("id").isNull()).alias("missing"), F.count_if(F.col("times") > 1).alias("doubled"),
        F.count_if(~F.col("known")).alias("unknown"))
    return {row["change"]: row for row in found.collect()}       # one row for each kind of change


def _stop(faults: dict[str, Row], pk: str = "ref") -> None:
    for change, found in faults.items():
        if change == "adds" and (found.missing or found.doubled):
            raise QualityError(f"adds: ref is missing, or {found.doubled} of its values occur more than once")
        if change != "adds" and (found.unknown or found.doubled):
            raise QualityError(f"{change}: {found.unknown} {pk} values are missing or deleted, "
                               f"{found.doubled} occur more than once")


def check_changes(dim: DataFrame, pk: str, changes: Changes) -> None:
    """Stop at changes that cannot be applied, told by one job over all of them and the ids of the dimension."""
    named = _named(pk, changes)
    if named is not None:
        _stop(_faults(named, _active(dim, pk)), pk)


def _named(pk: str, changes: Changes) -> DataFrame | None:
    parts = {"adds": (changes.adds, "ref"), "updates": (changes.updates, pk), "deletes": (changes.deletes, pk)}
    named = [rows.select(F.lit(change).alias("change"), F.col(column).cast("string").alias("id"))
             for change, (rows, column) in parts.items() if rows is not None]
    return reduce(DataFrame.unionByName, named) if named else None


def _active(dim: DataFrame, pk: str) -> DataFrame:
    return dim.filter(F.col("status") == "ACTIVE").select(pk)


def refused_changes(dim: DataFrame, pk: str, changes: Changes) -> DataFrame:
    """(change, id, reason): what stops a day's changes, one row for each kind of change and id.

    A missing id, one that a kind of change names more than once, and an update or delete of an id that is not ACTIVE. A day can be
    applied when there is no row; the caller may set these aside and apply the rest.
    """
    reason = (F.when(F.col("id").isNull(), "missing").when(F.col("times") > 1, "repeated")
              .when((F.col("change") != "adds") & ~F.col("known"), "not active"))
    named = _named(pk, changes)
    if named is None:
        return dim.sparkSession.createDataFrame([], "change string, id string, reason string")
    return (_counted(named, _active(dim, pk)).withColumn("reason", reason)
            .filter("reason IS NOT NULL").select("change", "id", "reason"))


def evolve(dim: DataFrame, pk: str, changes: Changes) -> DataFrame:
    """Add, update and delete in one pass over the dimension; changes to ids that are not ACTIVE are an error.

    A NULL in an update keeps the old value; a deleted row stays, as DELETED. New rows are ACTIVE unless they say
    otherwise. Updates and deletes name ids that were there before, so they never meet the new rows.
    """
    check_changes(dim, pk, changes)
    after = dim
    if changes.updates is not None or changes.deletes is not None:
        columns, merged = [], None
        if changes.updates is not None:
            columns = [name for name in UPDATABLE[pk] if name in changes.updates.columns]
            merged = changes.updates.select(pk, *[F.col(name).alias(f"_new_{name}") for name in columns])
        if changes.deletes is not None:
            gone = changes.deletes.select(pk, F.lit(True).alias("_deleted"))
            merged = gone if merged is None else merged.join(gone, pk, "full_outer")
        else:
            merged = merged.withColumn("_deleted", F.lit(None).cast("boolean"))
        after = dim.join(merged, pk, "left").withColumns({
            **{name: F.coalesce(f"_new_{name}", name) for name in columns},
            "status": F.when(F.col("_deleted"), "DELETED").otherwise(F.col("status"))}).select(*dim.columns)
    if changes.adds is not None:
        numbered = number_new(dim, changes.adds, pk)
        if "status" in dim.columns and "status" not in numbered.columns:
            numbered = numbered.withColumn("status", F.lit("ACTIVE"))
        after = after.unionByName(numbered.select(*dim.columns))
    return after
