"""Report tables (ADS): customer profile, daily report, top merchants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paystrata.functions.columns import amount_tier, month_key, ratio


def customer_profile(dws: DataFrame) -> DataFrame:
    """Customer-day rows with ratios, tier, 7-row moving averages and change against the previous active day.

    The windows run over daily totals, so a customer has at most one row per day in a window, however many
    transactions there are.
    """
    history = W.partitionBy("customer_id").orderBy("dt")
    last_seven = history.rowsBetween(-6, W.currentRow)
    return (dws
            .select("customer_id", "dt", "txn_count", "total_amount", "pay_count", "pay_amount",
                    "refund_count", "refund_amount")
            .withColumn("paid", F.coalesce("pay_amount", F.lit(0)))
            .withColumns({
                "avg_ticket_amount": ratio("total_amount", "txn_count", 2),
                "refund_txn_rate": ratio("refund_count", "txn_count", 4),
                "pay_amount_ratio": ratio("paid", "total_amount", 4),
                "has_refund": F.col("refund_count") > 0,
                "amount_tier": amount_tier(),
                "ma7_total_amount": F.round(F.avg("total_amount").over(last_seven), 2),
                "ma7_txn_count": F.avg("txn_count").over(last_seven),
                "dod_amount_change": F.col("total_amount") - F.lag("total_amount").over(history)})
            .drop("paid"))


def daily_report(dws: DataFrame) -> DataFrame:
    """One row per day, rolled up from merchant days, with change against the previous day and month-to-date sums.

    The windows see one row per day, so the series over all days is small whatever the data size.
    """
    series = W.orderBy("dt")
    month_so_far = W.partitionBy("month").orderBy("dt").rowsBetween(W.unboundedPreceding, W.currentRow)
    daily = (dws
             .groupBy("dt", month_key().alias("month"))
             .agg(F.count("*").alias("active_merchant_count"),
                  F.sum("txn_count").alias("total_txn_count"),
                  *[F.sum(name).alias(name) for name in (
                      "total_amount", "pay_count", "pay_amount", "refund_count", "refund_amount", "cny_amount",
                      "usd_amount", "eur_amount", "high_risk_txn_count")],
                  F.max("max_amount").alias("max_amount")))
    rated = daily.withColumns({
        "avg_ticket_amount": ratio("total_amount", "total_txn_count", 2),
        "refund_rate": ratio("refund_count", "total_txn_count", 4),
        "high_risk_txn_ratio": ratio("high_risk_txn_count", "total_txn_count", 4)})
    return (rated
            .withColumn("prev_refund_rate", F.lag("refund_rate").over(series))
            .withColumn("refund_rate_diff", F.round(F.col("refund_rate") - F.col("prev_refund_rate"), 4))
            .withColumns({"month_total_txn_count": F.sum("total_txn_count").over(month_so_far),
                          "month_total_amount": F.sum("total_amount").over(month_so_far)}))


def merchant_top(dws: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` merchants with the highest daily amount and their share of the day.

    The rank has no other window beside it, so Catalyst keeps only ``k`` rows per day and task before the shuffle
    (WindowGroupLimit); a day total taken by window would bring a whole day into one task. The day totals are one
    row per day. The merchant id makes the order of ties fixed.
    """
    by_amount = W.partitionBy("dt").orderBy(F.desc("total_amount"), F.desc("txn_count"), "merchant_id")
    leaders = dws.withColumn("rank_no", F.row_number().over(by_amount)).filter(F.col("rank_no") <= k)
    totals = dws.groupBy("dt").agg(F.sum("total_amount").alias("day_total_amount"))
    return (leaders.join(totals, "dt")
            .withColumn("amount_share", ratio("total_amount", "day_total_amount", 4))
            .select("dt", "rank_no", "merchant_id", "txn_count", "customer_count", "total_amount", "amount_share"))
