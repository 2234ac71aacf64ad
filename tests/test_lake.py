"""Table writes: idempotent days, checks before publishing, layer order."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paystrata.operators import detail, quality, reports, rollups, staging
from paystrata.plans.tables import LAYERS, Warehouse, run_day, run_table
from paystrata.sources.keyed import KeyedLog
from paystrata.sources.lake import Lake, conform, scan_source
from paystrata.model import TABLES, TRANSACTION

DAY = date(2026, 9, 4)


def ods(spark, data):
    return staging.ods_transaction(spark.createDataFrame(
        [(i, Decimal(a), "CNY", c, "A1", m, "PAYMENT", datetime(2026, 9, d, 12)) for i, a, c, m, d in data],
        TRANSACTION))


def content(df):
    names = sorted(df.columns)
    return sorted((tuple(row) for row in df.select(*names).collect()), key=repr)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_replacing_a_day_twice_leaves_one_copy(spark, lake, tmp_path):
    lake.replace_table(ods(spark, [("T1", 1, "C1", "M1", 3), ("T2", 2, "C1", "M1", 4)]), "ods_transaction")
    day = ods(spark, [("T3", 3, "C1", "M1", 4), ("T4", 4, "C1", "M1", 4)])
    for _ in range(2):
        lake.replace_day(day, "ods_transaction", DAY)
    assert {r.transaction_id for r in lake.read("ods_transaction").collect()} == {"T1", "T3", "T4"}
    lake.drop_old_versions("ods_transaction", keep=1)
    assert lake.read("ods_transaction").count() == 3
    assert len(list((tmp_path / "lake").rglob("dt=2026-09-04"))) == 1       # nothing is left beside the day


def test_a_day_without_rows_is_cleared(spark, lake):
    rows = ods(spark, [("T1", 1, "C1", "M1", 3), ("T2", 2, "C1", "M1", 4)])
    lake.replace_table(rows, "ods_transaction")
    lake.replace_day(rows.limit(0), "ods_transaction", DAY)
    assert [r.transaction_id for r in lake.read("ods_transaction").collect()] == ["T1"]
    assert lake.has_day("ods_transaction", DAY) and not lake.has_day("ods_transaction", date(2026, 9, 5))


def test_rows_of_another_day_stop_the_write(spark, lake):
    lake.replace_day(ods(spark, [("T1", 1, "C1", "M1", 4)]), "ods_transaction", DAY)
    with pytest.raises(Exception, match="row outside 2026-09-04"):
        lake.replace_day(ods(spark, [("T2", 1, "C1", "M1", 4), ("T3", 1, "C1", "M1", 5)]), "ods_transaction", DAY)
    assert [r.transaction_id for r in lake.read("ods_transaction").collect()] == ["T1"]


def test_a_failed_check_leaves_the_live_data(spark, lake):
    good, bad = ods(spark, [("T1", 1, "C1", "M1", 4)]), ods(spark, [("T2", -1, "C1", "M1", 4)])
    lake.replace_table(good, "ods_transaction", quality.detail_rules())
    with pytest.raises(quality.QualityError, match="amount_not_positive"):
        lake.replace_table(bad, "ods_transaction", quality.detail_rules())
    with pytest.raises(quality.QualityError, match="amount_not_positive"):
        lake.replace_day(bad, "ods_transaction", DAY, quality.detail_rules())
    assert [r.transaction_id for r in lake.read("ods_transaction").collect()] == ["T1"]


def test_versions_append_and_unknown_tables(spark, lake):
    first = ods(spark, [("T1", 1, "C1", "M1", 3)])
    lake.append(first, "ods_transaction")
    lake.append(ods(spark, [("T2", 1, "C1", "M1", 4)]), "ods_transaction")
    assert lake.read("ods_transaction").count() == 2
    for _ in range(3):
        lake.replace_table(first, "ods_transaction")
    lake.drop_old_versions("ods_transaction", keep=1)
    assert lake.read("ods_transaction").count() == 1
    with pytest.raises(KeyError):
        conform(first, "no_such_table")
    with pytest.raises(FileNotFoundError):
        lake.read("dim_customer")


def test_a_write_that_breaks_off_changes_nothing(spark, lake, monkeypatch):
    lake.replace_table(ods(spark, [("T1", 1, "C1", "M1", 3), ("T2", 2, "C1", "M1", 4)]), "ods_transaction")
    new = ods(spark, [("T3", 3, "C1", "M1", 4)])

    def broken(*_, **__):
        raise OSError("broken off")

    for step in ("_write", "_load", "_publish"):
        with monkeypatch.context() as patch:
            patch.setattr(lake, step, broken)
            with pytest.raises(OSError):
                lake.replace_day(new, "ods_transaction", DAY)
        lake.drop_old_versions("ods_transaction", keep=1)
        assert {r.transaction_id for r in lake.read("ods_transaction").collect()} == {"T1", "T2"}
    # a manifest that was not finished is none
    lake._folder.write_text("ods_transaction/_manifest/99", "w=1/dt=2026-09-03")
    assert {r.transaction_id for r in lake.read("ods_transaction").collect()} == {"T1", "T2"}
    lake.replace_day(new, "ods_transaction", DAY)
    lake.drop_old_versions("ods_transaction", keep=1)
    assert {r.transaction_id for r in lake.read("ods_transaction").collect()} == {"T1", "T3"}


def test_readers_keep_their_files_and_young_folders_stay(spark, lake):
    lake.replace_table(ods(spark, [("T1", 1, "C1", "M1", 4)]), "ods_transaction")
    reader = lake.read("ods_transaction")
    lake.replace_day(ods(spark, [("T2", 1, "C1", "M1", 4)]), "ods_transaction", DAY)
    lake.drop_old_versions("ods_transaction", keep=1, grace_seconds=3600)
    assert [r.transaction_id for r in reader.collect()] == ["T1"]
    assert [r.transaction_id for r in lake.read("ods_transaction").collect()] == ["T2"]


def test_an_empty_table_by_day_can_be_read(spark, lake):
    lake.replace_table(ods(spark, []), "ods_transaction")
    assert lake.exists("ods_transaction") and lake.read("ods_transaction").count() == 0


def test_master_files_of_different_age(spark, tmp_path):
    """Old files have no status and the register time as text; new ones may hold deleted customers."""
    path = f"{tmp_path}/master/dim_customer.parquet"
    spark.createDataFrame([("C1", "V1", "x", "2025-01-01 00:00:00")],
                          ["customer_id", "level", "region", "register_time"]).coalesce(1).write.parquet(path)
    spark.createDataFrame([("C2", "V2", "x", "2025-01-01 00:00:00", "DELETED")],
                          ["customer_id", "level", "region", "register_time", "status"]).coalesce(1).write.mode(
        "append").parquet(path)
    house = Warehouse(Lake(spark, str(tmp_path / "lake")), {"master": str(tmp_path / "master")})
    run_table(house, "ods_customer")
    assert {(r.customer_id, r.status) for r in house.lake.read("ods_customer").collect()} == {
        ("C1", "ACTIVE"), ("C2", "DELETED")}


def test_a_lake_of_facts_is_a_source(spark, tmp_path):
    facts = Lake(spark, str(tmp_path / "facts"))
    house = Warehouse(Lake(spark, str(tmp_path / "lake")), {"transaction": facts})
    facts.append(ods(spark, [("T1", 1, "C1", "M1", 3), ("T2", 2, "C1", "M1", 4)]), "fact_transaction")
    facts.append(ods(spark, [("T3", 3, "C1", "M1", 4)]), "fact_transaction")
    run_table(house, "ods_transaction", "2026-09-04")
    assert {r.transaction_id for r in house.lake.read("ods_transaction").collect()} == {"T2", "T3"}
    facts.replace_day(ods(spark, [("T4", 4, "C1", "M1", 4)]), "fact_transaction", DAY)
    run_table(house, "ods_transaction", "2026-09-04")
    assert {r.transaction_id for r in house.lake.read("ods_transaction").collect()} == {"T4"}
    day = scan_source(spark, house.sources, "transaction", "fact_transaction", "2026-09-04")
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()


def test_day_reads_touch_only_their_folders(spark, lake):
    lake.replace_table(ods(spark, [(f"T{d}", 1, "C1", "M1", d) for d in range(1, 9)]), "ods_transaction")
    week = lake.read_days("ods_transaction", "2026-09-08", days=7)
    assert {r.dt.day for r in week.collect()} == {2, 3, 4, 5, 6, 7, 8}
    assert "PartitionFilters: [isnotnull(dt" in week._jdf.queryExecution().executedPlan().toString()
    assert {r.dt.day for r in lake.read_month("ods_transaction", "2026-09-03").collect()} == {1, 2, 3}


def test_source_scan_pushes_the_day_to_parquet(spark, tmp_path):
    roots = {"transaction": str(tmp_path), "master": str(tmp_path)}
    ods(spark, [("T1", 1, "C1", "M1", 3), ("T2", 1, "C1", "M1", 4)]).drop("dt").write.parquet(
        f"{tmp_path}/fact_transaction.parquet")
    day = scan_source(spark, roots, "transaction", "fact_transaction", "2026-09-04")
    assert [r.transaction_id for r in day.collect()] == ["T2"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_time,2026-09-04" in plan
    with pytest.raises(ValueError, match="unknown bucket"):
        scan_source(spark, roots, "archive", "fact_transaction")


@pytest.fixture
def house(spark, tmp_path):
    sources = {"transaction": str(tmp_path / "transaction"), "master": str(tmp_path / "master")}
    data = [(f"T{n}", 50 * n + 1, f"C{n % 5}", f"M{n % 13}", 1 + n % 4) for n in range(1, 300)]
    data += [("T1000", -5, "C1", "M1", 3), ("T1001", 10, "C77", "M1", 3)]
    ods(spark, data).drop("dt").write.parquet(f"{sources['transaction']}/fact_transaction.parquet")
    spark.createDataFrame([(f"C{n}", f"V{1 + n % 4}", "x", "2025-01-01 00:00:00") for n in range(5)],
                          ["customer_id", "level", "region", "register_time"]).write.parquet(
        f"{sources['master']}/dim_customer.parquet")
    spark.createDataFrame([(f"M{n}", "k", "x", "HIGH" if n % 3 else "LOW", "ACTIVE") for n in range(13)],
                          ["merchant_id", "category", "region", "risk_level", "status"]).write.parquet(
        f"{sources['master']}/dim_merchant.parquet")
    return Warehouse(Lake(spark, str(tmp_path / "lake")), sources)


def test_days_build_up_and_a_rerun_changes_nothing(spark, house):
    days = [f"2026-09-0{d}" for d in range(1, 5)]
    for day in days:
        run_day(house, day)
    tables = [name for layer in LAYERS for name in layer]
    before = {name: content(house.lake.read(name)) for name in tables if not name.startswith("lookup")}
    counts = run_day(house, "2026-09-03")
    assert counts["dwd_transaction"]["filtered"] == 1 and counts["ads_daily_report"]["row_count"] == 1
    assert set(house.lake.register_views()) == set(tables)
    assert spark.sql("SELECT count(DISTINCT dt) FROM ads_daily_report").first()[0] == 4
    after = {name: content(house.lake.read(name)) for name in before}
    assert before == after

    # the day-by-day tables equal the functions over the whole history (all days lie within one week)
    clean = detail.clean_transactions(staging.ods_transaction(
        scan_source(spark, house.sources, "transaction", "fact_transaction")))
    dwd = detail.enrich(clean, house.lake.read("dim_customer"), house.lake.read("dim_merchant"))
    customer_days, merchant_days = rollups.customer_daily(dwd), rollups.merchant_daily(dwd)
    for name, whole in {"dws_customer_daily": customer_days, "dws_merchant_daily": merchant_days,
                        "ads_customer_profile": reports.customer_profile(customer_days),
                        "ads_merchant_top10": reports.merchant_top(merchant_days),
                        "ads_daily_report": reports.daily_report(merchant_days)}.items():
        assert content(conform(whole, name)) == after[name], name
    assert house.lake.read("lookup_customer").count() == 5


def test_a_missing_upstream_day_is_refused(house):
    with pytest.raises(quality.QualityError, match="ods_transaction has no such day"):
        run_table(house, "dwd_transaction", "2026-09-04")
    with pytest.raises(ValueError):
        run_table(house, "dwd_transaction")
    with pytest.raises(KeyError):
        run_table(house, "no_such_table")
    assert set(TABLES) >= {name for layer in LAYERS for name in layer}


def test_bad_master_data_stops_before_publishing(spark, house):
    spark.createDataFrame([("C1", "V9", "x", "2025-01-01 00:00:00")],
                          ["customer_id", "level", "region", "register_time"]).write.mode("overwrite").parquet(
        f"{house.sources['master']}/dim_customer.parquet")
    with pytest.raises(quality.QualityError, match="bad_level"):
        run_table(house, "ods_customer")
    assert not house.lake.exists("ods_customer")


def test_keyed_log_replay_and_compaction(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), TRANSACTION, ["transaction_id"])
    assert log.latest().count() == 0
    batches = [[("T1", 1, "C1", "M1", 4), ("T2", 1, "C1", "M1", 4)], [("T1", 2, "C1", "M1", 3)],
               [("T3", 3, "C1", "M1", 4)], [("T2", 9, "C1", "M1", 4), ("T3", 9, "C1", "M1", 4)]]
    expected = []
    for number, data in enumerate(batches):
        for _ in range(2):
            log.upsert(ods(spark, data), number)
        expected.append({r.transaction_id: int(r.amount) for r in log.latest().collect()})
        log.compact()
        assert {r.transaction_id: int(r.amount) for r in log.latest().collect()} == expected[-1]
    assert expected[-1] == {"T1": 2, "T2": 9, "T3": 9}
    log.upsert(ods(spark, batches[3]), 3)       # a replay after the compaction
    assert {r.transaction_id: int(r.amount) for r in log.latest().collect()} == expected[-1]


def test_newest_rows_without_folding_the_whole_log(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), TRANSACTION, ["transaction_id", "event_time"], compact_every=3)
    for number in range(5):     # every batch repeats the newest transactions of the one before
        log.upsert(ods(spark, [(f"T{n}", number + 1, "C1", "M1", 1 + n % 28) for n in range(10 * number, 10 * number + 25)]),
                   number)
    assert [name for name in log._folder.children("base")] == ["upto=1"]        # folded by itself
    untimed = spark.createDataFrame([("TX", Decimal(1), "CNY", "C1", "A1", "M1", "PAYMENT", None)], TRANSACTION)
    log.upsert(untimed, 5)
    whole = [tuple(r) for r in log.latest().orderBy(F.desc("event_time"), "transaction_id").collect()]
    for limit in (1, 3, 20, 40, 100):
        found = log.newest("event_time", limit).orderBy(F.desc("event_time"), "transaction_id").limit(limit).collect()
        assert [tuple(r) for r in found] == whole[:limit]
    some = F.col("transaction_id").isin("T3", "T30")
    assert log.newest("event_time", 5, some).count() == 2
    plan = log.newest("event_time", 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(event_time" in plan
    with pytest.raises(ValueError):
        log.newest("amount", 1)


def test_scratch_needs_a_shared_folder_on_any_cluster(spark):
    from types import SimpleNamespace

    from paystrata.session import scratch_dir
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                                  sparkContext=SimpleNamespace(master=master))
        with pytest.raises(RuntimeError):
            scratch_dir(session, "x")
