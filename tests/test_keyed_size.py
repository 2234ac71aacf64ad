"""F6, F8, F9: what a keyed table shuffles and writes."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paystrata.model import TRANSACTION
from paystrata.sources.keyed import KeyedLog


def _gathered(monkeypatch, frame, work) -> int:
    """How often ``work`` asks for a shuffle of its own before it writes."""
    asked, hint = [], type(frame).hint

    def counted(self, name, *values):
        asked.append(name)
        return hint(self, name, *values)
    with monkeypatch.context() as patch:
        patch.setattr(type(frame), "hint", counted)
        work()
    return asked.count("rebalance")


@pytest.mark.parametrize("near", [None, "customer_id"])
def test_a_batch_job_gathers_nothing_and_a_fold_only_to_bring_rows_near(spark, tmp_path, monkeypatch, near):
    log = KeyedLog(spark, str(tmp_path), TRANSACTION, ["transaction_id"], near)

    def rows(first, last):
        return spark.range(first, last).select(
            F.concat(F.lit("T"), "id").alias("transaction_id"), F.col("id").cast("decimal(18,2)").alias("amount"),
            F.lit("CNY").alias("currency"), F.concat(F.lit("C"), F.col("id") % 7).alias("customer_id"), F.lit("A").alias("account_id"),
            F.lit("M").alias("merchant_id"), F.lit("PAYMENT").alias("transaction_type"),
            F.timestamp_seconds(F.col("id")).alias("event_time"))
    for number in (0, 1, 2):
        assert _gathered(monkeypatch, rows(0, 1), lambda: log.upsert(rows(number * 500, 1000 + number * 500), number, gather=False)) == 0
    assert _gathered(monkeypatch, rows(0, 1), log.compact) == (0 if near is None else 1)
    assert log.latest().count() == 2000 and log.latest().agg(F.sum("amount")).first()[0] == sum(range(2000))
    files = glob.glob(f"{tmp_path}/*/*/*.parquet")
    kinds = {pq.ParquetFile(path).metadata.row_group(0).column(0).compression for path in files
             if pq.ParquetFile(path).metadata.num_row_groups}
    assert kinds == {"ZSTD"}
    if near:
        for path in files:
            column = pq.read_table(path, columns=[near])[near].to_pylist()
            assert column == sorted(column)
