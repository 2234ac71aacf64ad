"""Dimension changes, snapshots, pools and lookups."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from paystrata.operators import pools
from paystrata.operators.dimensions import one_per_key
from paystrata.operators.evolve import Changes, evolve, number_new
from paystrata.operators.quality import QualityError
from paystrata.operators.staging import with_status
from paystrata.plans.history import DimensionHistory
from paystrata.sources.lake import Lake
from paystrata.sources.lookup import lookup, publish_lookup, to_lookup

T = datetime(2025, 1, 1)
SCHEMA = "customer_id string, level string, region string, register_time timestamp, status string"


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([("C5", "V1", "north", T, "ACTIVE"), ("C12", "V2", "south", T, "ACTIVE"),
                                  ("C7", "V3", None, T, "DELETED")], SCHEMA)


def adds(spark, count):
    return spark.range(count).select(F.concat(F.lit("ref"), "id").alias("ref"), F.lit("V1").alias("level"),
                                     F.lit("x").alias("region"), F.lit(T).alias("register_time"))


def test_new_ids_are_the_next_ones_whatever_the_partitioning(spark, customers):
    first = {r.ref: r.customer_id for r in number_new(customers, adds(spark, 5000).repartition(7),
                                                      "customer_id").collect()}
    again = {r.ref: r.customer_id for r in number_new(customers, adds(spark, 5000).repartition(3, "ref"),
                                                      "customer_id").collect()}
    assert first == again
    assert sorted(int(i[1:]) for i in first.values()) == list(range(13, 5013))
    empty = customers.limit(0)
    assert [r.customer_id for r in number_new(empty, adds(spark, 1), "customer_id").collect()] == ["C10001"]


def test_evolve_adds_updates_and_deletes(spark, customers):
    changes = Changes(adds(spark, 1), spark.createDataFrame([("C5", "V4", None)], "customer_id string, level string, "
                                                            "region string"),
                      spark.createDataFrame([("C12",)], ["customer_id"]))
    found = {r.customer_id: r for r in evolve(customers, "customer_id", changes).collect()}
    assert (found["C5"].level, found["C5"].region, found["C5"].register_time) == ("V4", "north", T)
    assert found["C12"].status == "DELETED" and found["C7"].status == "DELETED"
    assert found["C13"].status == "ACTIVE" and len(found) == 4


@pytest.mark.parametrize("ids", [["C7"], ["C999"], ["C5", "C5"]])
def test_changes_to_unusable_ids_are_refused(spark, customers, ids):
    change = spark.createDataFrame([(i, "V4") for i in ids], ["customer_id", "level"])
    with pytest.raises(QualityError):
        evolve(customers, "customer_id", Changes(updates=change))
    with pytest.raises(QualityError):
        evolve(customers, "customer_id", Changes(deletes=change))


def test_double_references_are_refused(spark, customers):
    double = adds(spark, 2).withColumn("ref", F.lit("same"))
    with pytest.raises(QualityError, match="more than once"):
        evolve(customers, "customer_id", Changes(adds=double))


def _load(spark, tmp_path, customers):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.replace_table(customers, "dim_customer")
    lake.replace_table(spark.createDataFrame([("A3", "C5", "SAVINGS", T), ("A4", "C7", "CREDIT", T)],
                                             ["account_id", "customer_id", "account_type", "open_time"]), "dim_account")
    lake.replace_table(spark.createDataFrame([("M1", "k", "x", "LOW", "ACTIVE")],
                                             ["merchant_id", "category", "region", "risk_level", "status"]),
                       "dim_merchant")
    return lake


def test_running_a_day_again_gives_the_same_tables(spark, tmp_path, customers):
    lake = _load(spark, tmp_path, customers)
    history = DimensionHistory(lake)
    accounts = spark.createDataFrame([("a", "ref0", "SAVINGS", T), ("b", "ref0", "CREDIT", T), ("c", "ref1",
                                      "CREDIT", T)], ["ref", "customer_ref", "account_type", "open_time"])

    def run(day):
        history.evolve_day(day, Changes(adds(spark, 2)), Changes(deletes=spark.createDataFrame(
            [("M1",)], ["merchant_id"])), accounts)
        return [sorted(map(tuple, lake.read(t).collect()), key=repr)
                for t in ("dim_customer", "dim_account", "dim_merchant")]

    first = run("2026-09-04")
    assert run("2026-09-04") == first
    assert [len(table) for table in first] == [5, 5, 1]
    owners = {r[1] for r in first[1]}
    assert owners == {"C5", "C7", "C13", "C14"}
    history.evolve_day("2026-09-05", Changes(adds(spark, 1)))
    with pytest.raises(QualityError, match="no back-fill"):
        history.evolve_day("2026-09-03", Changes(adds(spark, 1)))
    assert lake.read("dim_customer").count() == 6


def test_pool_keeps_active_entities_only(spark, tmp_path, customers):
    lake = _load(spark, tmp_path, customers)
    pool = pools.active_pool(customers, lake.read("dim_account"), lake.read("dim_merchant"))
    assert [tuple(r) for r in pool["accounts"].collect()] == [("C5", "A3", T)]
    pools.require_pool(pool)
    with pytest.raises(QualityError, match="no ACTIVE customers"):
        pools.require_pool(pools.active_pool(customers.limit(0), lake.read("dim_account"),
                                             lake.read("dim_merchant")))


def test_status_defaults_to_active(spark):
    assert [r.status for r in with_status(spark.createDataFrame([("C1",)], ["customer_id"])).collect()] == ["ACTIVE"]
    mixed = spark.createDataFrame([("C1", None), ("C2", "DELETED")], "customer_id string, status string")
    assert {r.customer_id: r.status for r in with_status(mixed).collect()} == {"C1": "ACTIVE", "C2": "DELETED"}


def test_lookup_tells_missing_keys_from_empty_fields(spark, tmp_path, customers):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert publish_lookup(lake, customers, "lookup_customer", "customer_id", "dim:customer:") == 3
    rows = spark.createDataFrame([("a", "C7"), ("b", "C99"), ("c", None), ("d", "C5")], "id string, customer_id string")
    found = {r.id: r for r in lookup(rows, lake.read("lookup_customer"), F.concat(F.lit("dim:customer:"),
                                     F.col("customer_id")), "c").select("id", F.col("c")["region"].alias("region"),
                                                                        F.size("c").alias("n")).collect()}
    assert found["a"].region == "" and found["b"].region is None and found["d"].region == "north"
    assert (found["b"].n, found["c"].n) == (0, 0)
    before = sorted(map(str, lake.read("lookup_customer").collect()))
    nameless = customers.withColumn("customer_id", F.when(F.col("customer_id") != "C7", F.col("customer_id")))
    for wrong in (customers.unionAll(customers.limit(1)), nameless, customers.limit(0)):
        with pytest.raises(QualityError):
            publish_lookup(lake, wrong, "lookup_customer", "customer_id", "dim:customer:")
        assert sorted(map(str, lake.read("lookup_customer").collect())) == before       # the failed one never went live


def test_a_repeated_key_is_one_row_and_never_published_twice(spark, tmp_path, customers):
    later, gone = T.replace(day=2), "DELETED"
    rows = customers.union(spark.createDataFrame([("C5", "V4", "east", later, "ACTIVE"), ("C12", "V1", "west", T, gone),
                                                  ("C5", "V2", "north", T, gone)], SCHEMA)).union(customers)
    found = {r.customer_id: (r.level, r.status) for r in one_per_key(rows, "customer_id").collect()}
    assert found == {"C5": ("V4", "ACTIVE"), "C12": ("V1", gone), "C7": ("V3", gone)}
    assert one_per_key(rows, "customer_id").count() == 3
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.replace_table(one_per_key(rows, "customer_id"), "dim_customer", unique="customer_id")
    with pytest.raises(QualityError, match="customer_id"):
        lake.replace_table(rows, "dim_customer", unique="customer_id")
    assert lake.read("dim_customer").count() == 3


def test_accounts_without_a_new_owner_stop_the_day(spark, tmp_path, customers):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.replace_table(customers, "dim_customer")
    kind = "account_id string, customer_id string, account_type string, open_time timestamp"
    lake.replace_table(spark.createDataFrame([("A1", "C5", "SAVINGS", T)], kind), "dim_account")
    opened = spark.createDataFrame([("a0", "ref0", "SAVINGS", T), ("a1", "ref9", "SAVINGS", T)],
                                   "ref string, customer_ref string, account_type string, open_time timestamp")
    history = DimensionHistory(lake)
    for changes in (Changes(adds(spark, 2)), None, Changes(deletes=spark.createDataFrame([("C12",)], ["customer_id"]))):
        with pytest.raises(QualityError, match="accounts name no customer"):
            history.evolve_day("2026-09-04", changes, None, opened)
    assert history.days() == [] and lake.read("dim_account").count() == 1 and lake.read("dim_customer").count() == 3
    history.evolve_day("2026-09-04", Changes(adds(spark, 2)), None, opened.filter("ref = 'a0'"))
    owners = {r.account_id: r.customer_id for r in lake.read("dim_account").collect()}
    assert len(owners) == 2 and set(owners.values()) <= {"C5", "C13", "C14"}


def test_an_add_without_a_reference_is_refused(spark):
    known = spark.createDataFrame([("C10001", "V1", "x", None, "ACTIVE")],
                                  "customer_id string, level string, region string, register_time timestamp, status string")
    adds = spark.createDataFrame([("a", "V1", "x", None), (None, "V2", "y", None)],
                                 "ref string, level string, region string, register_time timestamp")
    with pytest.raises(QualityError, match="ref is missing"):
        evolve(known, "customer_id", Changes(adds=adds))
    assert number_new(known, adds, "customer_id").count() == 2      # and numbering alone loses none
