"""Dated snapshots of the dimensions, which make a day's changes repeatable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.functions.days import parse_day
from paystrata.model import TABLES
from paystrata.operators.evolve import Changes, evolve, number_new, require_refs
from paystrata.operators.quality import QualityError
from paystrata.operators.staging import with_status
from paystrata.sources.files import Folder
from paystrata.sources.lake import Lake

DIMENSIONS = {"dim_customer": "customer_id", "dim_merchant": "merchant_id", "dim_account": "account_id"}


def _require_owners(accounts: DataFrame, customers: Changes | None) -> None:
    """Every new account has a reference of its own and belongs to a customer added the same day."""
    require_refs(accounts)
    owned = accounts.select(F.col("customer_ref").cast("string").alias("customer_ref"))
    if customers is None or customers.adds is None:
        stray = owned.count()
    else:
        known = customers.adds.select(F.col("ref").cast("string").alias("customer_ref"))
        stray = owned.join(known, "customer_ref", "left_anti").count()
    if stray:
        raise QualityError(f"{stray} new accounts name no customer that is added")


class DimensionHistory:
    """``history/dt=<day>/<table>``: the dimensions as they were before the changes of that day."""

    def __init__(self, lake: Lake):
        self.lake = lake
        self._root = f"{lake.root}/history"
        self._folder = Folder(lake.spark, self._root)

    def days(self) -> list[str]:
        return [name[3:] for name in self._folder.children()
                if name.startswith("dt=") and self._folder.exists(f"{name}/_COMPLETE")]

    def snapshot(self, day: str) -> None:
        day = parse_day(day).isoformat()
        for table in DIMENSIONS:
            if self.lake.exists(table):
                self.lake.read(table).write.mode("overwrite").parquet(f"{self._root}/dt={day}/{table}")
        self._folder.write_text(f"dt={day}/_COMPLETE", "")

    def restore(self, day: str) -> None:
        day = parse_day(day).isoformat()
        for table in DIMENSIONS:
            if self._folder.exists(f"dt={day}/{table}"):
                saved = self.lake.spark.read.schema(TABLES[table]).parquet(f"{self._root}/dt={day}/{table}")
                self.lake.replace_table(saved, table)

    def guard_backfill(self, day: str) -> None:
        day = parse_day(day).isoformat()
        newer = [known for known in self.days() if known > day]
        if newer:
            raise QualityError(f"snapshots newer than {day} exist ({', '.join(newer)}): no back-fill")

    def base_for(self, day: str) -> None:
        """Put the dimensions into the state they had before ``day``: restore on a re-run, else snapshot."""
        day = parse_day(day).isoformat()
        if day in self.days():
            self.restore(day)
        else:
            self.guard_backfill(day)
            self.snapshot(day)

    def evolve_day(self, day: str, customers: Changes | None = None, merchants: Changes | None = None,
                   new_accounts: DataFrame | None = None) -> None:
        """Apply one day's changes; running the day again gives the same tables.

        ``new_accounts`` belong to new customers and name them by ``customer_ref``, the ``ref`` of the added row. An
        account that names none of them is an error, found before anything is written, as are accounts without new customers.
        """
        day = parse_day(day).isoformat()
        if new_accounts is not None:
            _require_owners(new_accounts, customers)
        self.base_for(day)
        before = with_status(self.lake.read("dim_customer"))
        if customers:
            if new_accounts is not None:
                owners = number_new(before, customers.adds, "customer_id").select(
                    F.col("ref").alias("customer_ref"), "customer_id")
                known = self.lake.read("dim_account")
                opened = number_new(known, new_accounts.join(owners, "customer_ref"), "account_id")
                self.lake.append(opened, "dim_account")
            self.lake.replace_table(evolve(before, "customer_id", customers), "dim_customer")
        if merchants:
            self.lake.replace_table(evolve(with_status(self.lake.read("dim_merchant")), "merchant_id", merchants),
                                    "dim_merchant")
