"""The command line drives a day and the streaming jobs over folders."""

import json
from datetime import datetime
from decimal import Decimal

import pytest

from paystrata.__main__ import main
from paystrata.model import (
    CUSTOMER, LATE_KEY, LATE_TRANSACTION, MERCHANT, ONLINE_KEY, REALTIME_AGG, TRANSACTION, TRANSACTION_ONLINE,
    WINDOW_KEY,
)
from paystrata.sources.keyed import KeyedLog
from paystrata.sources.topics import to_messages, write_folder


def test_day_and_streams(spark, tmp_path, capsys):
    lake, sources, topics = (str(tmp_path / name) for name in ("lake", "sources", "topics"))
    rows = spark.createDataFrame(
        [(f"T{n}", Decimal(n), "CNY", "C1", "A1", "M1", "PAYMENT", datetime(2026, 9, 4, 10, n)) for n in range(1, 30)],
        TRANSACTION)
    rows.write.parquet(f"{sources}/transaction/fact_transaction.parquet")
    spark.createDataFrame([("C1", "V1", "x", datetime(2025, 1, 1), "ACTIVE")], CUSTOMER).write.parquet(
        f"{sources}/master/dim_customer.parquet")
    spark.createDataFrame([("M1", "k", "x", "HIGH", "ACTIVE")], MERCHANT).write.parquet(
        f"{sources}/master/dim_merchant.parquet")
    main(["day", "2026-09-04", "--lake", lake, "--sources", sources])
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["dwd_transaction"]["row_count"] == 29
    main(["table", "ads_daily_report", "2026-09-04", "--lake", lake, "--sources", sources])

    write_folder(to_messages(rows, ["customer_id"], decimals_as_text=True), f"{topics}/transaction", 0)
    for job in ("clean", "windows"):
        main(["stream", job, "--lake", lake, "--topics", topics, "--backlog"])
    online = KeyedLog(spark, f"{lake}/keyed/dwd_transaction_online", TRANSACTION_ONLINE, ONLINE_KEY)
    assert {r.merchant_risk_level for r in online.latest().collect()} == {"HIGH"}
    windows = KeyedLog(spark, f"{lake}/keyed/dws_realtime_agg", REALTIME_AGG, WINDOW_KEY)
    assert windows.latest().filter("window_type = 'TUMBLE'").count() == 5
    assert KeyedLog(spark, f"{lake}/keyed/late_transaction", LATE_TRANSACTION, LATE_KEY).latest().count() == 0

    capsys.readouterr()
    main(["recent", "--lake", lake, "--customer", "C1", "--limit", "2"])
    found = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert [row["transaction_id"] for row in found] == ["T29", "T28"] and len(found[0]) == 8
    with pytest.raises(ValueError, match="limit must be"):
        main(["recent", "--lake", lake, "--limit", "100001"])
    with pytest.raises(ValueError, match="at least one character"):
        main(["profile", "", "--lake", lake])
    main(["compact", "--lake", lake, "--grace", "0"])
    main(["profile", "C1", "--lake", lake])
    [profile] = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert profile["realtime_stats"][0]["transaction_count"] == 29
    assert profile["offline_profile"]["txn_count"] == 29
    main(["profile", "C404", "--lake", lake])
    assert json.loads(capsys.readouterr().out) == {"customer_id": "C404", "realtime_stats": []}
