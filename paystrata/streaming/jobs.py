"""The streaming queries: clean-and-enrich with its late rows, and windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paystrata.model import CUSTOMER_LOOKUP_PREFIX, LATE_TRANSACTION, MERCHANT_LOOKUP_PREFIX, TRANSACTION_ONLINE
from paystrata.session import adaptive
from paystrata.sources.keyed import KeyedLog
from paystrata.sources.lake import Lake
from paystrata.sources.lookup import lookup
from paystrata.sources.topics import parse_messages, to_messages
from paystrata.streaming.newest import TTL_SECONDS, of_kind, tagged
from paystrata.streaming.windows import DELAY, both_windows

EVERY = {"processingTime": "10 seconds"}       # as often as checkpoints are taken
BACKLOG = {"availableNow": True}               # work off what is there and stop


def enrich_online(rows: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """Attributes from the lookup tables, as text; NULL where the key is unknown, '' where the field is empty."""
    found = lookup(rows, customers, F.concat(F.lit(CUSTOMER_LOOKUP_PREFIX), F.col("customer_id")), "c")
    found = lookup(found, merchants, F.concat(F.lit(MERCHANT_LOOKUP_PREFIX), F.col("merchant_id")), "m")
    return found.withColumns({
        "customer_level": F.col("c")["level"], "customer_region": F.col("c")["region"],
        "customer_register_time": F.col("c")["register_time"],
        "merchant_category": F.col("m")["category"], "merchant_risk_level": F.col("m")["risk_level"],
    }).select(*TRANSACTION_ONLINE.names)


def start(df: DataFrame, mode: str, checkpoint: str, trigger: dict,
          write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    def write_adaptively(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            write(batch, batch_id)
    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger)
            .foreachBatch(write_adaptively).start())


def start_clean_job(messages: DataFrame, lake: Lake, online: KeyedLog, late: KeyedLog,
                    publish: Callable[[DataFrame, int], None] | None, checkpoint: str, trigger: dict = EVERY,
                    ttl_seconds: int = TTL_SECONDS) -> StreamingQuery:
    """Late rows, the newest rows enriched, and the next topic, from one read of the raw messages.

    What is late is told by the engine's watermark; late rows also stay in the main flow. The newest row of a transaction is
    kept for ``ttl_seconds`` of event time. A batch is tagged once and kept on disk for its sinks.

    The lookup tables are opened anew in each batch, so a dimension published meanwhile is seen. The topic is fed
    from the batch as the online table holds it: nothing is computed twice, and nothing is lost with an executor.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.DISK_ONLY)
        try:
            late.upsert(parse_messages(of_kind(held, "late")).select(*LATE_TRANSACTION.names), batch_id)
            rows = parse_messages(of_kind(held, "newest"))
            online.upsert(enrich_online(rows, lake.read("lookup_customer"), lake.read("lookup_merchant")), batch_id)
        finally:
            held.unpersist()
        if publish:
            publish(to_messages(online.batch(batch_id), ["transaction_id"]), batch_id)
    return start(tagged(messages, ttl_seconds), "update", checkpoint, trigger, write)


def start_window_job(rows: DataFrame, sink: KeyedLog, checkpoint: str, trigger: dict = EVERY,
                     windows: Callable[[DataFrame], DataFrame] = both_windows, dedup: bool = False) -> StreamingQuery:
    """Window totals of enriched rows, written once the watermark has passed the end of a window.

    ``dedup`` lets a row through once that arrives again with the same time, as after a clock that stepped back.
    """
    marked = rows.withWatermark("event_time", DELAY)
    if dedup:
        marked = marked.dropDuplicates(["transaction_id", "event_time"])
    return start(windows(marked), "append", checkpoint, trigger, sink.upsert)
