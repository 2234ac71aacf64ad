"""The given test tables seen as transactions, master data and a transaction stream.

``lineitem`` with ``orders`` gives transactions, ``customer`` and ``supplier`` with ``nation`` give master data, and
``events`` gives the stream. Only built-in expressions are used, so filters and column pruning reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_id(prefix: str, *parts: Column) -> Column:
    pieces = [F.lit(prefix), parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("-"), part.cast("string")]
    return F.concat(*pieces)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their customer and day, still as numbers: less than half as wide as the transactions they become."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    day = F.date_add(F.lit("2026-08-01").cast("date"),
                     (F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-02").cast("date")) % 61).cast("int"))
    return table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").withColumn("dt", day)


def as_transactions(numbers: DataFrame, dirty: bool = False) -> DataFrame:
    """Lines as transactions with ``dt``; a step without a shuffle that leaves the rows where they are."""
    amount = ((F.expr("CAST(round(l_extendedprice * 100) AS BIGINT) div 10").cast("decimal(18,0)"))
              * F.expr("0.01BD")).cast("decimal(18,2)")
    identifier = _text_id("T", F.col("l_orderkey"), F.col("l_linenumber"))
    second = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 61) % 86400
    event_time = F.timestamp_seconds(F.unix_date("dt").cast("bigint") * 86400 + second)
    currency = F.expr("CASE l_returnflag WHEN 'A' THEN 'CNY' WHEN 'N' THEN 'USD' ELSE 'EUR' END")
    kind = F.expr("CASE l_linestatus WHEN 'F' THEN 'REFUND' ELSE 'PAYMENT' END")
    if dirty:
        currency = F.when(F.col("l_quantity") == 13, "GBP").otherwise(currency)
        kind = F.when(F.col("l_quantity") == 17, "CHARGEBACK").otherwise(kind)
        amount = F.when(F.col("l_linenumber") == 7, -amount).otherwise(amount).cast("decimal(18,2)")
        identifier = F.when(F.col("l_quantity") != 50, identifier)
        event_time = F.when(F.col("l_tax") != 0.08, event_time)
    return numbers.select(
        identifier.alias("transaction_id"),
        amount.alias("amount"),
        currency.alias("currency"),
        _text_id("C", F.col("o_custkey")).alias("customer_id"),
        _text_id("A", F.col("o_custkey"), F.col("l_linenumber") % 5).alias("account_id"),
        _text_id("M", F.col("l_suppkey")).alias("merchant_id"),
        kind.alias("transaction_type"),
        event_time.alias("event_time"),
        "dt")


def transactions(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Transactions without ``dt``; ``dirty`` adds negative amounts, missing ids and times, and unknown kinds."""
    return as_transactions(lines(spark, sf_dir), dirty).drop("dt")


def _with_region(df: DataFrame, nations: DataFrame, nation_key: str) -> DataFrame:
    return df.join(nations.select(F.col("n_nationkey").alias(nation_key), F.col("n_name").alias("region")),
                   nation_key, "left")


def _status(balance: str) -> Column:
    return F.when(F.col(balance) < 0, "DELETED").otherwise("ACTIVE").alias("status")


def customers(spark: SparkSession, sf_dir: str, with_gaps: bool = False) -> DataFrame:
    """Customer master data; ``with_gaps`` leaves out every twentieth one so that joins miss."""
    source = table(spark, sf_dir, "customer")
    if with_gaps:
        source = source.filter(F.col("c_custkey") % 20 != 0)
    key = F.col("c_custkey")
    return _with_region(source, table(spark, sf_dir, "nation"), "c_nationkey").select(
        _text_id("C", key).alias("customer_id"),
        _text_id("V", 1 + key % 4).alias("level"),
        "region",
        F.timestamp_seconds(F.lit(1735689600) + key * 3600).alias("register_time"),
        _status("c_acctbal"))


def customers_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows as they arrive: the register time is text, and some rows are unusable."""
    key = F.regexp_extract("customer_id", "[0-9]+", 0).cast("bigint")
    clean = customers(spark, sf_dir)
    return clean.select(
        F.when(key % 50 == 7, "").otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(key % 50 == 17, "V9").when(key % 50 != 11, F.col("level")).alias("level"),
        "region",
        F.when(key % 50 == 13, "not a time")
         .otherwise(F.date_format("register_time", "yyyy-MM-dd HH:mm:ss")).alias("register_time"),
        F.when(key % 50 == 19, "GONE").otherwise(F.col("status")).alias("status"))


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("s_acctbal")
    return _with_region(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"), "s_nationkey").select(
        _text_id("M", F.col("s_suppkey")).alias("merchant_id"),
        _text_id("K", F.col("s_suppkey") % 7).alias("category"),
        "region",
        F.when(balance < 2000, "HIGH").when(balance < 6000, "MEDIUM").otherwise("LOW").alias("risk_level"),
        _status("s_acctbal"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five accounts for each customer, opened one hour apart after registration."""
    key = F.col("c_custkey")
    return (table(spark, sf_dir, "customer")
            .select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("slot"))
            .select(_text_id("A", key, F.col("slot")).alias("account_id"),
                    _text_id("C", key).alias("customer_id"),
                    F.expr("CASE slot % 3 WHEN 0 THEN 'SAVINGS' WHEN 1 THEN 'CHECKING' ELSE 'CREDIT' END")
                     .alias("account_type"),
                    F.timestamp_seconds(F.lit(1735689600) + key * 3600 + (F.col("slot") + 1) * 3600)
                     .alias("open_time")))


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as transactions, a month squeezed into about seven hours."""
    events = table(spark, sf_dir, "events")
    squeezed = F.lit(1788480000000000) + F.expr("(unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) div 100")
    return events.select(
        _text_id("T", F.col("event_id")).alias("transaction_id"),
        F.timestamp_micros(squeezed).alias("event_time"),
        _text_id("C", F.col("user_id") % 20).alias("customer_id"),
        _text_id("A", F.col("user_id")).alias("account_id"),
        F.concat(F.lit("M"), F.get_json_object("props", "$.k")).alias("merchant_id"),
        F.round(F.col("value") * 100).cast("bigint").cast("decimal(18,2)").alias("amount"),
        F.expr("CASE event_id % 3 WHEN 0 THEN 'CNY' WHEN 1 THEN 'USD' ELSE 'EUR' END").alias("currency"),
        F.expr("CASE WHEN event_type IN ('purchase', 'view', 'click') THEN 'PAYMENT' ELSE 'REFUND' END")
         .alias("transaction_type"))
