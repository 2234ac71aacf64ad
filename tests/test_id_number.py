"""the number of an id, and what ids without one cost."""

import time

from pyspark.sql import functions as F

from paystrata.functions.columns import id_number


def test_values_are_those_of_a_cast(spark):
    ids = ["C12", "A12-3", "M", "", None, "C-5", "C+5", "C 7 ", "C\t8\n", "C12x", "C1e5", "C1.5", "C.5", "C99999999999999999999",
           "C1 2", "C007", "Cx", "C--1", "C9223372036854775807", "C-9223372036854775808"]
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    found = rows.select(id_number("id").alias("a"), F.expr("try_cast(substring(id, 2) AS BIGINT)").alias("b")).collect()
    assert all(row.a == row.b for row in found) and found[0].a == 12 and found[1].a is None


def test_ids_of_two_numbers_cost_no_exceptions(spark):
    rows = spark.range(0, 800_000, 1, 1).select(F.concat(F.lit("A"), "id", F.lit("-"), F.col("id") % 5).alias("id"))
    rows.limit(10).agg(F.max(id_number("id"))).first()
    start = time.perf_counter()
    assert rows.agg(F.max(id_number("id"))).first()[0] is None
    assert time.perf_counter() - start < 8
