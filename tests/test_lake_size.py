"""a fact table that is kept by day is loaded without another shuffle by day."""

import glob

import pytest
from pyspark.sql import functions as F

from paystrata.plans.tables import Warehouse, run_table
from paystrata.sources.lake import Lake


@pytest.mark.parametrize("from_lake", [True, False])
def test_load_of_a_fact_table(spark, tmp_path, monkeypatch, from_lake):
    rows = spark.range(4000).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"), F.col("id").cast("decimal(18,2)").alias("amount"),
        F.lit("CNY").alias("currency"), F.lit("C1").alias("customer_id"), F.lit("A1").alias("account_id"),
        F.lit("M1").alias("merchant_id"), F.lit("PAYMENT").alias("transaction_type"),
        F.when(F.col("id") % 9 != 0, F.timestamp_seconds(1788480000 + F.col("id") * 300)).alias("event_time"))
    dated = rows.withColumn("dt", F.to_date("event_time"))
    facts = Lake(spark, str(tmp_path / "facts"))
    facts.append(dated.filter("amount < 1500"), "fact_transaction")
    facts.append(dated.filter("amount >= 1500"), "fact_transaction")
    rows.write.parquet(str(tmp_path / "files/fact_transaction.parquet"))
    house = Warehouse(Lake(spark, str(tmp_path / "lake")), {"transaction": facts if from_lake else str(tmp_path / "files")})
    asked, hint = [], type(rows).hint
    with monkeypatch.context() as patch:
        patch.setattr(type(rows), "hint", lambda self, name, *values: asked.append(name) or hint(self, name, *values))
        run_table(house, "ods_transaction")
    assert asked == ([] if from_lake else ["rebalance"])
    assert house.lake.read("ods_transaction").exceptAll(dated).count() == 0
    assert house.lake.read("ods_transaction").count() == 4000
    if from_lake:
        written = glob.glob(f"{tmp_path}/lake/ods_transaction/*/*/*.parquet")
        assert len(written) <= len(glob.glob(f"{tmp_path}/facts/fact_transaction/*/*/*.parquet"))
