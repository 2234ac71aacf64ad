"""One pass over raw messages for all sinks: late rows, and the newest row of each transaction.

Both need what the engine knows between micro-batches, so one stateful step tags rows: ``late`` for a row older than the
engine's own watermark, ``newest`` for the newest row of a transaction when it changed. A row can be both, or neither.

State is kept by bucket of the transaction id: the time and rank among equal times of the newest row of each transaction. A
bucket of few transactions has an entry for each; a larger one packs them into cells by hash, of at most 64 on average, and
doubles its cells as it grows. So a batch costs a call to the state for each cell it meets, not for each transaction. An entry
goes once the watermark is ``ttl`` past its time; a timer of the bucket sees to it, so the state holds the transactions of the
last ``ttl`` and not all there ever were. What arrives later than that counts as new.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from paystrata.model import TRANSACTION
from paystrata.operators.detail import is_clean
from paystrata.streaming.windows import DELAY

#: Buckets of transactions. Fixed for the life of a checkpoint; more than any number of state partitions.
BUCKETS = 4096
TTL_SECONDS = 7 * 86_400
#: Transactions a bucket may hold as an entry each, and in a cell on average.
FEW, FULL = 8, 64

TAGGED = "kind string, value string"


def _cells(count: int) -> int:
    """The number of cells for so many transactions, half full; 0 where each is an entry of its own."""
    return 0 if count <= FEW else 1 << ((count - 1) // (FULL // 2)).bit_length()


def _cell(transaction_id: str, cells: int) -> str:
    return str(crc32(transaction_id.encode()) % cells) if cells else transaction_id


class NewestAndLate(StatefulProcessor):
    """Tags the rows (transaction_id, micros, rank, value) of a bucket; ``transaction_id`` is null for a row that is not clean."""

    def __init__(self, ttl_millis: int):
        self.ttl = ttl_millis

    def init(self, handle) -> None:
        self.handle = handle
        # a cell is JSON: {transaction_id: [micros, rank]}
        self.newest = handle.getMapState("newest", StructType().add("cell", StringType()),
                                         StructType().add("entries", StringType()))
        # how many cells and transactions the bucket has, and when its timer is due
        self.shape = handle.getValueState("shape", StructType().add("cells", IntegerType()).add("count", LongType())
                                          .add("millis", LongType()))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        best: dict[str, tuple[int, str, str]] = {}
        for row in rows:
            transaction_id, micros, rank, value = (row[name] for name in ("transaction_id", "micros", "rank", "value"))
            if micros < watermark * 1000:
                yield Row(kind="late", value=value)
            if transaction_id is not None:
                known = best.get(transaction_id)
                if known is None or (micros, rank) > known[:2]:
                    best[transaction_id] = micros, rank, value
        if best:
            for value in self._changed(best, watermark):
                yield Row(kind="newest", value=value)

    def _changed(self, best: dict[str, tuple[int, str, str]], watermark: int) -> list[str]:
        """Keep what is newer than the state, and return its messages."""
        cells, count, millis = self.shape.get() or (0, 0, None)
        met, touched = defaultdict(dict), None
        if count + len(best) > (cells * FULL or FEW):
            wider = _cells(count + len(best))
            if count:
                for entries in self._all().values():
                    for transaction_id, known in entries.items():
                        met[_cell(transaction_id, wider)][transaction_id] = known
                self.newest.clear()
            cells, touched = wider, met.keys()
        changed, written = [], set()
        for transaction_id, own in best.items():
            cell = _cell(transaction_id, cells)
            if touched is None and cell not in met:
                met[cell] = self._entries(self.newest.getValue((cell,)))
            known = met[cell].get(transaction_id)
            if known is None or own[:2] > tuple(known):
                count += known is None
                met[cell][transaction_id] = own[:2]
                written.add(cell)
                changed.append(own[2])
        self._write(met, written if touched is None else met)
        if millis is None:
            millis = self._look_again(min(own[0] for own in best.values()) // 1000, watermark)
        if changed or touched is not None:
            self.shape.update((cells, count, millis))
        return changed

    @staticmethod
    def _entries(value: tuple | None) -> dict[str, list]:
        return json.loads(value[0]) if value else {}

    def _all(self) -> dict[str, dict[str, list]]:
        return {cell: self._entries(value) for (cell,), value in self.newest.iterator()}

    def _write(self, held: dict[str, dict], cells) -> None:
        for cell in cells:
            if held[cell]:
                self.newest.updateValue((cell,), (json.dumps(held[cell], ensure_ascii=False, separators=(",", ":")),))
            else:
                self.newest.removeKey((cell,))

    def _look_again(self, oldest: int, watermark: int) -> int:
        """Wake up when the oldest entry ends, and not before a tenth of the time to live has passed."""
        at = max(oldest + self.ttl + 1, watermark + self.ttl // 10 + 1)
        self.handle.registerTimer(at)
        return at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        cells, before, _ = self.shape.get()
        held = self._all()
        left = {cell: {transaction_id: own for transaction_id, own in entries.items()
                       if own[0] // 1000 + self.ttl >= watermark} for cell, entries in held.items()}
        count = sum(map(len, left.values()))
        if not count:
            self.newest.clear()
            self.shape.clear()
            return iter(())
        if cells > 4 * _cells(count):
            cells, packed = _cells(count), defaultdict(dict)
            for entries in left.values():
                for transaction_id, own in entries.items():
                    packed[_cell(transaction_id, cells)][transaction_id] = own
            self.newest.clear()
            self._write(packed, packed)
        else:
            self._write(left, [cell for cell in held if len(left[cell]) < len(held[cell])])
        oldest = min(own[0] for entries in left.values() for own in entries.values()) // 1000
        self.shape.update((cells, count, self._look_again(oldest, watermark)))
        return iter(())

    def close(self) -> None:
        pass


def _rank() -> Column:
    """The other columns as one text that sorts like them; amounts of clean rows are positive."""
    cents = F.lpad((F.col("amount") * 100).cast("decimal(20,0)").cast("string"), 20, "0")
    others = [F.coalesce(name, F.lit("")) for name in ("currency", "customer_id", "account_id", "merchant_id", "transaction_type")]
    return F.concat_ws("\x00", cents, *others)


def tagged(messages: DataFrame, ttl_seconds: int = TTL_SECONDS, delay: str = DELAY) -> DataFrame:
    """(kind, value) of a stream of messages; run in update mode. Equal times are ordered by the other columns.

    A message without a time, or one that can't be read, is neither late nor a transaction and goes. Messages travel as
    the text they came as, and are read again after the step: its Python process sees an id, a time and a text.
    """
    parsed = messages.select("value", F.inline(F.array(F.from_json("value", TRANSACTION, {"mode": "PERMISSIVE"}))))
    timed = parsed.filter("event_time IS NOT NULL").withWatermark("event_time", delay)
    clean_id = F.when(F.coalesce(is_clean(require_customer=True), F.lit(False)), F.col("transaction_id"))
    # the column that carries the watermark ends here: the step is to see late rows, not to lose them
    rows = timed.select(clean_id.alias("transaction_id"), F.unix_micros("event_time").alias("micros"),
                        F.when(clean_id.isNotNull(), _rank()).alias("rank"), "value")
    bucket = F.pmod(F.xxhash64(F.coalesce("transaction_id", "value")), F.lit(BUCKETS)).cast("int")
    return (rows.withColumn("bucket", bucket).groupBy("bucket")
            .transformWithState(NewestAndLate(ttl_seconds * 1000), TAGGED, "Update", "EventTime"))


def of_kind(rows: DataFrame, kind: str) -> DataFrame:
    """The messages of one kind."""
    return rows.filter(F.col("kind") == kind).select("value")
