"""Registered queries on tables where one key holds a third of all rows, and on tables without rows."""

import os
import shutil

import pytest

import __spark_entry__ as driver
from compare import connect, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"

SKEWED = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_orderkey % 3 = 1 THEN 3 ELSE l_suppkey END AS l_suppkey) FROM lineitem""",
    "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 1 THEN '{"k": 2}' ELSE props END AS props) FROM events""",
}
EMPTY = {name: f"SELECT * FROM {name} LIMIT 0" for name in ("lineitem", "events")}
QUERIES = ["dwd_transaction", "dws_customer_daily", "dws_merchant_daily", "ads_customer_profile", "ads_daily_report",
           "ads_merchant_top10", "full_profile", "upsert_latest", "window_union", "stream_clean_enrich",
           "stream_dedup_latest", "late_transactions", "day_replace_rerun"]


def _tables(folder, changes):
    db = connect(SF_DIR)
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        if table in changes:
            db.execute(f"COPY ({changes[table]}) TO '{folder}/{name}' (FORMAT parquet)")
        else:
            shutil.copy(f"{SF_DIR}/{name}", f"{folder}/{name}")
    return str(folder)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    return _tables(tmp_path_factory.mktemp("skewed"), SKEWED)


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    return _tables(tmp_path_factory.mktemp("empty"), EMPTY)


@pytest.mark.parametrize("name", QUERIES)
def test_one_key_with_a_third_of_the_rows(spark, skewed, name):
    found = spark_rows(driver.queries()[name](spark, skewed))
    assert found == sql_rows(connect(skewed), driver.oracle_sql()[name]) and found[1]


@pytest.mark.parametrize("name", QUERIES)
def test_no_rows(spark, empty, name):
    columns, rows = spark_rows(driver.queries()[name](spark, empty))
    assert columns == sql_rows(connect(empty), driver.oracle_sql()[name])[0] and rows == []
