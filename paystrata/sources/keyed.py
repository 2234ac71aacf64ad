"""Keyed tables for streaming sinks: an append log by batch, read as the newest row per key.

Files have Bloom filters on the text columns of the key and on the column reads filter by, as small as their values
allow, so a read of one customer or one transaction skips the row groups that can't hold it.

Writing batch *n* again replaces folder ``batch_id=n``, so a replayed micro-batch changes nothing. ``compact``
folds finished batches into one base so that reads stay proportional to the number of keys; the log does so by itself
every ``COMPACT_EVERY`` batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from paystrata.operators.latest import latest_by_key
from paystrata.sources.files import Folder

COMPACT_EVERY = 50


class KeyedLog:
    """``near`` names the column that reads filter by; files keep its values together and in order.

    ``compact_every`` is the number of batches after which the log is folded, 0 for never.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str],
                 near: str | None = None, compact_every: int = COMPACT_EVERY):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self._near, self._every = near, compact_every
        self._stored = StructType([*schema.fields, StructField("batch_id", LongType())])
        self._folder = Folder(spark, self.path)

    def upsert(self, df: DataFrame, batch_id: int, gather: bool = True) -> None:
        """Write the rows of a batch; the last batch that holds a key wins.

        Rows are gathered into files of even size first: a stream has as many output tasks as state partitions, and
        a small file from each, in each batch, would soon be too many. A batch job, whose tasks are large as they are, may
        do without (``gather``) and shuffle nothing; compaction brings the rows of a ``near`` value together later.
        """
        rows = df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in self.schema])
        self._write(rows, f"log/batch_id={batch_id}", gather)
        if self._every and batch_id % self._every == self._every - 1:
            self.compact()

    def _write(self, rows: DataFrame, name: str, gather: bool) -> None:
        if gather:
            rows = rows.hint("rebalance", *([F.col(self._near)] if self._near else []))
        if self._near:
            rows = rows.sortWithinPartitions(self._near)
        writer = rows.write.mode("overwrite").option("compression", "zstd").option("parquet.bloom.filter.adaptive.enabled", "true")
        for column in {*self.keys, self._near} - {None}:
            if self.schema[column].dataType == StringType():        # ids; times have their minima and maxima
                writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(f"{self.path}/{name}")

    def batch(self, batch_id: int) -> DataFrame:
        """The rows one batch wrote."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/log/batch_id={batch_id}")

    def _base(self) -> int:
        """Highest batch folded into a finished base, -1 when there is none."""
        done = [int(name.split("=")[1]) for name in self._folder.children("base")
                if self._folder.exists(f"base/{name}/_SUCCESS")]
        return max(done, default=-1)

    def rows(self) -> DataFrame:
        """Base and newer batches, with ``batch_id``; a key may occur more than once."""
        base = self._base()
        parts = []
        if self._folder.exists("log"):
            parts.append(self.spark.read.schema(self._stored).parquet(f"{self.path}/log")
                         .filter(F.col("batch_id") > base))
        if base >= 0:
            parts.append(self.spark.read.schema(self._stored).parquet(f"{self.path}/base/upto={base}"))
        if not parts:
            return self.spark.createDataFrame([], self._stored)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def latest(self) -> DataFrame:
        return latest_by_key(self.rows(), self.keys, ["batch_id"]).select(*self.schema.names)

    def newest(self, time: str, limit: int, condition: Column | None = None) -> DataFrame:
        """Rows of :meth:`latest`, among them those with the ``limit`` highest values of ``time``, a column of the key, ties included.

        ``condition`` may look at columns of the key only. Versions of a key share their time, so only rows from some time on need to be folded. That time is found from
        the highest times in the log; it moves back while too few different keys are left. Nothing else is shuffled.
        """
        if time not in self.keys:
            raise ValueError(f"{time} is not part of the key")
        rows = self.rows() if condition is None else self.rows().filter(condition)
        asked = 2 * limit
        while True:
            least, seen = (rows.select(time).filter(F.col(time).isNotNull()).orderBy(F.desc(time)).limit(asked)
                           .agg(F.min(time), F.count("*")).first())
            # fewer times than asked for: every row is needed, also those without a time
            taken = rows if seen < asked else rows.filter(F.col(time) >= F.lit(least))
            kept = latest_by_key(taken, self.keys, ["batch_id"]).select(*self.schema.names)
            if seen < asked or kept.limit(limit).count() == limit:
                return kept
            asked *= 4

    def compact(self) -> None:
        """Fold all batches but the last, which may still be replayed, into a new base."""
        batches = sorted(int(name.split("=")[1]) for name in self._folder.children("log")
                         if name.startswith("batch_id="))
        old_base = self._base()
        if len(batches) < 2 or batches[-2] <= old_base:
            return
        upto = batches[-2]
        newest = latest_by_key(self.rows().filter(F.col("batch_id") <= upto), self.keys, ["batch_id"])
        # the fold's own shuffle is by key, which adaptive planning has made even
        self._write(newest.select(*self._stored.names), f"base/upto={upto}", gather=self._near is not None)
        for batch in batches:
            if batch <= old_base:       # readers that started before this base still find the last one's log
                self._folder.delete(f"log/batch_id={batch}")
        for name in self._folder.children("base"):
            if int(name.split("=")[1]) < old_base:
                self._folder.delete(f"base/{name}")
