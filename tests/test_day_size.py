"""facts are shuffled by day as numbers and not as texts, and the tables of a layer are made side by side."""

import threading

import pytest

from paystrata.operators import staging
from paystrata.plans import queries, tables
from paystrata.plans.tables import LAYERS, Warehouse, run_day
from paystrata.sources import samples
from paystrata.sources.lake import Lake

SF = "/root/testdata/sf0.001"


def test_facts_come_together_by_day_while_they_are_numbers(spark, monkeypatch):
    gathered = []
    hint = type(spark.range(1)).hint
    with monkeypatch.context() as patch:
        patch.setattr(type(spark.range(1)), "hint", lambda self, name, *values: gathered.append(self.columns) or
                      hint(self, name, *values))
        house = queries._house(spark, SF)
    assert gathered and all("dt" in columns and "transaction_id" not in columns for columns in gathered)
    facts = house.sources["transaction"].read("fact_transaction")
    whole = staging.ods_transaction(samples.transactions(spark, SF)).select(*facts.columns)
    assert facts.count() == whole.count() and facts.exceptAll(whole).count() == 0
    live = house.sources["transaction"]._live("fact_transaction")
    assert len(live) == len({folder.split("/")[1] for folder in live}) == 61


def test_rows_in_order_of_day_are_not_sorted_again_as_texts(spark, tmp_path):
    plans = []
    write = Lake._write

    class Spy(Lake):
        def _write(self, df, *rest):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            write(self, df, *rest)
    numbers = samples.lines(spark, SF).hint("rebalance", "dt").sortWithinPartitions("dt")
    Spy(spark, str(tmp_path)).append(samples.as_transactions(numbers), "fact_transaction", gather=False)
    sorts, = [[line for line in plan.split("\n") if "Sort [" in line] for plan in plans]
    assert len(sorts) == 1 and "dt" in sorts[0]
    assert Lake(spark, str(tmp_path)).read("fact_transaction").count() == samples.transactions(spark, SF).count()


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(Lake(spark, str(tmp_path / "lake")), {})


def test_tables_of_a_layer_are_made_side_by_side(spark, house, monkeypatch):
    meet = {name: barrier for layer in LAYERS for barrier in [threading.Barrier(len(layer))] for name in layer}
    begun = []

    def job(house, name, day):
        meet[name].wait(timeout=30)
        begun.append(name)
        return {"row_count": 1, "group": spark.sparkContext.getLocalProperty("f4.group")}
    monkeypatch.setattr(tables, "run_table", job)
    spark.sparkContext.setLocalProperty("f4.group", "day")
    try:
        done = run_day(house, "2026-09-04")
    finally:
        spark.sparkContext.setLocalProperty("f4.group", None)
    assert list(done) == [name for layer in LAYERS for name in layer]
    assert all(found == {"row_count": 1, "group": "day"} for found in done.values())
    ends = [{name for name in begun[k:k + len(layer)]} == set(layer)
            for k, layer in zip([sum(map(len, LAYERS[:n])) for n in range(len(LAYERS))], LAYERS)]
    assert all(ends)            # a layer begins after the one before it


def test_a_failed_table_ends_its_layer_and_stops_the_next(house, monkeypatch):
    begun = []

    def job(house, name, day):
        begun.append(name)
        if name == "dim_customer":
            raise tables.quality.QualityError("no good")
        return {"row_count": 1}
    monkeypatch.setattr(tables, "run_table", job)
    with pytest.raises(tables.quality.QualityError, match="no good"):
        run_day(house, "2026-09-04")
    assert sorted(begun) == sorted(LAYERS[0] + LAYERS[1])
