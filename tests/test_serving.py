"""Serving queries."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paystrata.model import ONLINE_KEY, TABLES, TRANSACTION, TRANSACTION_ONLINE
from paystrata.operators import serving
from paystrata.sources.keyed import KeyedLog
from paystrata.sources.lake import conform


@pytest.fixture
def online(spark):
    return spark.createDataFrame(
        [(f"T{n}", datetime(2026, 9, 4, n), f"C{n % 2}", "A1", "M1", Decimal(n), "CNY",
          "REFUND" if n == 3 else "PAYMENT", "V1", None, None, None, None) for n in range(1, 6)], TRANSACTION_ONLINE)


@pytest.fixture
def profiles(spark):
    names = TABLES["ads_customer_profile"].names
    base = dict.fromkeys(names, None)
    data = [{**base, "dt": date(2026, 9, d), "customer_id": c, "txn_count": d, "has_refund": False}
            for c, d in (("C1", 2), ("C1", 3), ("C7", 1))]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in data], TABLES["ads_customer_profile"])


def test_recent_transactions(online):
    assert [r.transaction_id for r in serving.recent_transactions(online, limit=2).collect()] == ["T5", "T4"]
    mine = serving.recent_transactions(online, "C0", columns=TRANSACTION_ONLINE.names)
    assert [r.transaction_id for r in mine.collect()] == ["T4", "T2"] and len(mine.columns) == 13
    with pytest.raises(ValueError):
        serving.recent_transactions(online, limit=0)
    assert "TakeOrderedAndProject" in serving.recent_transactions(online)._jdf.queryExecution().executedPlan().toString()


def test_full_profile_merges_live_and_offline(online, profiles):
    found = {r.customer_id: r for r in serving.full_profile(online, profiles).collect()}
    assert [(s.transaction_type, int(s.amount_sum), s.transaction_count) for s in found["C1"].realtime_stats] == [
        ("PAYMENT", 6, 2), ("REFUND", 3, 1)]
    assert found["C1"].offline_profile.dt == date(2026, 9, 3)
    assert found["C0"].offline_profile is None
    assert found["C7"].realtime_stats == [] and found["C7"].offline_profile.txn_count == 1


def test_an_unknown_customer_has_an_empty_profile(online, profiles):
    [row] = serving.full_profile(online, profiles, "C99").collect()
    assert (row.customer_id, row.realtime_stats, row.offline_profile) == ("C99", [], None)
    [row] = serving.full_profile(online, profiles, "C7").collect()
    assert row.offline_profile.txn_count == 1
    assert conform(profiles, "ads_customer_profile").count() == 3


def test_one_customer_is_found_by_pushed_filters(spark, tmp_path, online):
    log = KeyedLog(spark, str(tmp_path / "online"), TRANSACTION_ONLINE, ONLINE_KEY, "customer_id")
    log.upsert(online, 0)
    mine = serving.customer_stats(log.latest(), "C1")
    assert {(r.transaction_type, r.transaction_count) for r in mine.collect()} == {("PAYMENT", 2), ("REFUND", 1)}
    assert "EqualTo(customer_id,C1)" in mine._jdf.queryExecution().executedPlan().toString()


def test_a_point_read_skips_what_cannot_hold_it(spark, tmp_path):
    """One customer, and one transaction by its Bloom filter, read few of the rows."""
    log = KeyedLog(spark, str(tmp_path / "online"), TRANSACTION, ["transaction_id"], "customer_id")
    rows = spark.range(40_000).select(
        F.concat(F.lit("T"), F.xxhash64("id").cast("string")).alias("transaction_id"), F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.lit("CNY").alias("currency"), F.concat(F.lit("C"), F.col("id") % 1000).alias("customer_id"), F.lit("A").alias("account_id"),
        F.lit("M").alias("merchant_id"), F.lit("PAYMENT").alias("transaction_type"), F.current_timestamp().alias("event_time"))
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        log.upsert(rows.select(*TRANSACTION.names), 0)
    finally:
        spark.conf.unset("parquet.block.size")

    def scanned(condition):
        found = log.rows().filter(condition)
        n = len(found.collect())
        plan = found._jdf.queryExecution().executedPlan()
        return n, plan.collectLeaves().head().metrics().apply("numOutputRows").value()

    known = rows.first().transaction_id
    n, read = scanned(F.col("customer_id") == "C7")
    assert n == 40 and read < 10_000
    n, read = scanned(F.col("transaction_id") == known)
    assert n == 1 and read < 20_000
    n, read = scanned(F.col("transaction_id") == "T123")      # within the bounds of every row group, in none
    assert n == 0 and read == 0
