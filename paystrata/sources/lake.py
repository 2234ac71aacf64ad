"""Warehouse tables as partitioned Parquet, with the live folders of each table named in a manifest.

Every write of a table goes to a folder of its own, ``<root>/<table>/w=<n>/`` (with ``dt=<day>`` folders for tables by day),
and is checked there. Then a new manifest, ``<root>/<table>/_manifest/<n>``, names the folders that make up the table; the
newest finished manifest is the table. Replacing a day is a manifest that names the new folder of that day in place of
the old ones. Nothing is renamed or overwritten: a broken-off write changes nothing, whoever reads keeps the files of the
manifest it began with, and object stores need no copy. Folders that no kept manifest names are deleted later.

Checks read what was written: their counts stay exact when tasks are retried. One writer per table is assumed.
"""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paystrata.functions.days import month_to_date, parse_day, trailing_days
from paystrata.model import SORT_KEYS, TABLES
from paystrata.operators.quality import Rule, enforce
from paystrata.sources.files import Folder

_END = "end"


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns, order and types of a registered table; an unregistered table is an error."""
    if table not in TABLES:
        raise KeyError(f"no definition of table {table!r}")
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in TABLES[table]])


def scan_source(spark: SparkSession, roots: dict[str, str | Lake], bucket: str, name: str,
                day: str | None = None) -> DataFrame:
    """A source object such as ``master/dim_customer``; ``day`` keeps one UTC day of ``event_time``.

    A bucket is a folder of Parquet files, or a lake that holds the object as a table. Files of different age are read
    with the columns of the model: what a file lacks is NULL. Types are those of the files where they have the column.
    """
    if bucket not in roots:
        raise ValueError(f"unknown bucket type {bucket!r}, choose from {sorted(roots)}")
    root = roots[bucket]
    if isinstance(root, Lake):
        return root.read_days(name, day) if day else root.read(name)
    path = f"{root}/{name}.parquet"
    found = {field.name: field.dataType for field in spark.read.parquet(path).schema}
    declared = [field for field in TABLES[name] if field.name != "dt"]
    rows = spark.read.schema(StructType([StructField(field.name, found.get(field.name, field.dataType))
                                         for field in declared])).parquet(path)
    return rows.filter(F.to_date("event_time") == F.lit(parse_day(day))) if day else rows


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._folder = Folder(spark, self.root)

    # ---- manifests

    def _numbers(self, table: str) -> list[int]:
        return sorted(int(name) for name in self._folder.children(f"{table}/_manifest") if name.isdigit())

    def _entries(self, table: str, number: int) -> list[str] | None:
        """The live folders of a manifest, None if it was not finished."""
        *folders, end = self._folder.read_text(f"{table}/_manifest/{number}").split("\n")
        return folders if end == _END else None

    def _live(self, table: str) -> list[str] | None:
        """The folders that make up the table, None if it has not been written."""
        for number in reversed(self._numbers(table)):
            entries = self._entries(table, number)
            if entries is not None:
                return entries
        return None

    def _next(self, table: str) -> int:
        written = [int(name[2:]) for name in self._folder.children(table) if name.startswith("w=")]
        return max([0, *written, *self._numbers(table)]) + 1

    def _publish(self, table: str, number: int, folders: list[str]) -> None:
        self._folder.write_text(f"{table}/_manifest/{number}", "\n".join([*folders, _END]))

    def _written(self, table: str, number: int, by_day: bool) -> list[str]:
        if not by_day:
            return [f"w={number}"]
        return [f"w={number}/{name}" for name in self._folder.children(f"{table}/w={number}") if name.startswith("dt=")]

    def exists(self, table: str) -> bool:
        return self._live(table) is not None

    def drop_old_versions(self, table: str, keep: int = 2, grace_seconds: float = 0) -> None:
        """Forget all but the newest ``keep`` manifests, and delete folders that none of these names.

        What was changed less than ``grace_seconds`` ago stays: a writer may be about to name it, a reader about to read.
        """
        finished = [n for n in self._numbers(table) if self._entries(table, n) is not None]
        kept = finished[-keep:] if keep else []
        if not kept:
            return
        named = {folder for n in kept for folder in self._entries(table, n)}
        before = time.time() - grace_seconds
        for number in self._numbers(table):
            if number < kept[0] and self._folder.changed(f"{table}/_manifest/{number}") <= before:
                self._folder.delete(f"{table}/_manifest/{number}")
        still = {folder for n in self._numbers(table) for folder in self._entries(table, n) or []} | named
        for write in [name for name in self._folder.children(table) if name.startswith("w=")]:
            below = [f"{write}/{name}" for name in self._folder.children(f"{table}/{write}") if name.startswith("dt=")]
            for folder in below or [write]:
                if folder not in still and self._folder.changed(f"{table}/{folder}") <= before:
                    self._folder.delete(f"{table}/{folder}")
            if below and not any(folder.startswith(f"{write}/") for folder in still):
                if not any(name.startswith("dt=") for name in self._folder.children(f"{table}/{write}")):
                    self._folder.delete(f"{table}/{write}")

    # ---- reads

    def read(self, table: str) -> DataFrame:
        live = self._live(table)
        if live is None:
            raise FileNotFoundError(f"table {table!r} has not been written to {self.root}")
        return self._load(table, live)

    def _load(self, table: str, folders: list[str]) -> DataFrame:
        schema = TABLES[table]
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        return (self.spark.read.schema(StructType([*schema.fields, StructField("w", LongType())]))
                .option("basePath", base).parquet(*[f"{base}/{folder}" for folder in folders]).select(*schema.names))

    def read_between(self, table: str, first: date, last: date) -> DataFrame:
        return self.read(table).filter(F.col("dt").between(F.lit(first), F.lit(last)))

    def read_days(self, table: str, day: str | date, days: int = 1) -> DataFrame:
        """The ``days`` calendar days that end at ``day``; only their folders are read."""
        return self.read_between(table, *trailing_days(day, days))

    def read_month(self, table: str, day: str | date) -> DataFrame:
        return self.read_between(table, *month_to_date(day))

    def has_day(self, table: str, day: str | date) -> bool:
        return any(folder.endswith(f"/dt={parse_day(day).isoformat()}") for folder in self._live(table) or [])

    def register_views(self) -> list[str]:
        """Make every written table a temporary view, for queries in SQL."""
        written = [table for table in TABLES if self.exists(table)]
        for table in written:
            self.read(table).createOrReplaceTempView(table)
        return written

    # ---- writes

    def _write(self, df: DataFrame, table: str, path: str, by_day: bool, gather: bool = True) -> None:
        if by_day and gather:
            # rows of one day come together, in as many evenly sized parts as the day needs
            df = df.hint("rebalance", F.col("dt"))
        keys = SORT_KEYS.get(table, [])
        if keys:        # without keys the writer itself sorts by day, unless the rows come so
            df = df.sortWithinPartitions(*(["dt"] if by_day else []), *keys)
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy("dt") if by_day else writer).parquet(f"{self.root}/{path}")

    def replace_table(self, df: DataFrame, table: str, rules: list[Rule] | None = None,
                      min_rows: int = 0, unique: str | None = None, max_rows: int | None = None,
                      gather: bool = True) -> dict[str, int]:
        """Write a new version of the whole table, check it, publish it; returns what the check counted.

        Rows read from another table by day lie in its day files: with ``gather`` off they are not shuffled by day again, and
        the table has at most as many files as the tasks read pieces of files.

        With ``unique``, a table in which two rows have the same key, or one has none, is not published.
        """
        rows, number = conform(df, table), self._next(table)
        by_day = "dt" in rows.columns
        self._write(rows, table, f"{table}/w={number}", by_day, gather)
        folders = self._written(table, number, by_day)
        found = enforce(self._load(table, folders), rules or [], min_rows, max_rows, unique)
        self._publish(table, number, folders)
        return found

    def replace_day(self, df: DataFrame, table: str, day: str | date, rules: list[Rule] | None = None,
                    min_rows: int = 0, max_rows: int | None = None) -> dict[str, int]:
        """Replace one day. A day without rows becomes empty; a row of another day stops the write."""
        day = parse_day(day)
        fits = F.when(F.col("dt") == F.lit(day), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"row outside {day}: dt is "),
                                   F.coalesce(F.col("dt").cast("string"), F.lit("NULL")))).cast("boolean"))
        rows = conform(df, table).filter(fits)
        number = self._next(table)
        folder = f"w={number}/dt={day.isoformat()}"
        self._write(rows.drop("dt"), table, f"{table}/{folder}", by_day=False)
        found = enforce(self._load(table, [folder]), rules or [], min_rows, max_rows)
        others = [entry for entry in self._live(table) or [] if not entry.endswith(f"/dt={day.isoformat()}")]
        self._publish(table, number, [*others, folder])
        return found

    def append(self, df: DataFrame, table: str, gather: bool = True) -> None:
        """Add rows to a table; nothing is read back. With ``gather`` off the rows lie together by day already."""
        rows, number = conform(df, table), self._next(table)
        by_day = "dt" in rows.columns
        self._write(rows, table, f"{table}/w={number}", by_day, gather)
        self._publish(table, number, [*(self._live(table) or []), *self._written(table, number, by_day)])
