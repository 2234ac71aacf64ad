"""Rows of window state by the size of the input."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from paystrata.streaming import windows


def test_panes_have_rows_by_part_not_by_transaction(spark):
    """the state of a pane does not grow with its transactions."""
    start = datetime(2026, 9, 4)
    data = spark.range(20_000).select(
        F.concat(F.lit("T"), (F.col("id") % 9000).cast("string")).alias("transaction_id"),
        F.expr("timestamp_seconds(unix_seconds(TIMESTAMP '2026-09-04 00:00:00') + id % 600)").alias("event_time"),
        F.lit("C1").alias("customer_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("A"), F.col("id"))).alias("account_id"),
        F.lit("M1").alias("merchant_id"), F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit("CNY").alias("currency"),
        F.lit("PAYMENT").alias("transaction_type"), F.lit("HIGH").alias("merchant_risk_level"))
    assert windows.panes(data, windows.TUMBLE).count() <= 2 * (2 * windows.PARTS + 3 + 1)
    expected = data.agg(F.countDistinct("transaction_id"), F.countDistinct("account_id"), F.sum("amount")).first()
    hops = {row.window_start: row for row in windows.both_windows(data).filter("window_type = 'HOP'").collect()}
    whole = hops[start]
    assert (whole.transaction_count, whole.account_count, whole.total_amount) == tuple(expected)
    assert whole.merchant_count == whole.currency_count == 1 and whole.window_end == start + timedelta(minutes=10)
