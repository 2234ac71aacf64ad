"""Checks on tables. Every set of checks is one aggregation over one scan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.columns import outside
from paystrata.model import CURRENCIES, CUSTOMER_LEVELS, RISK_LEVELS, STATUSES, TRANSACTION_TYPES


class QualityError(AssertionError):
    pass


@dataclass(frozen=True)
class Rule:
    """A named condition that no row may meet."""
    name: str
    bad: Column


def ods_customer_rules() -> list[Rule]:
    return [Rule("bad_register_time", F.col("register_time").isNull()),
            Rule("bad_level", outside("level", CUSTOMER_LEVELS)),
            Rule("bad_status", outside("status", STATUSES))]


def ods_merchant_rules() -> list[Rule]:
    return [Rule("bad_risk_level", outside("risk_level", RISK_LEVELS)),
            Rule("bad_status", outside("status", STATUSES))]


def detail_rules() -> list[Rule]:
    return [Rule("missing_transaction_id", F.col("transaction_id").isNull()),
            Rule("amount_not_positive", F.coalesce(F.col("amount") <= 0, F.lit(True)))]


def rollup_rules() -> list[Rule]:
    return [Rule("negative_amount", F.col("total_amount") < 0)]


def count_bad(df: DataFrame, rules: list[Rule], unique: str | None = None) -> DataFrame:
    """One row: ``row_count``, the number of bad rows per rule, and the different values of ``unique``.

    With ``unique`` the rows of a key are counted first and the keys added up, so that a hot key combines in the tasks and
    no task keeps a set of keys. A missing key is no value.
    """
    bad = [F.count_if(rule.bad).alias(rule.name) for rule in rules]
    if unique is None:
        return df.agg(F.count(F.lit(1)).alias("row_count"), *bad)
    per_key = df.groupBy(unique).agg(F.count(F.lit(1)).alias("row_count"), *bad)
    return per_key.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
                       *[F.coalesce(F.sum(rule.name), F.lit(0)).alias(rule.name) for rule in rules],
                       F.count(unique).alias("key_count"))


def enforce(df: DataFrame, rules: list[Rule], min_rows: int = 0, max_rows: int | None = None,
            unique: str | None = None) -> dict[str, int]:
    """Measure in one pass and raise when a rule is broken, the row count is out of bounds, or ``unique`` is no key.

    A key is unique when every row has one and no two rows share it.
    """
    found = count_bad(df, rules, unique).first().asDict()
    faults = [f"{found[rule.name]} rows: {rule.name}" for rule in rules if found[rule.name]]
    if unique is not None and found.pop("key_count") != found["row_count"]:
        faults.append(f"{unique} is missing in a row, or in several rows alike")
    if found["row_count"] < min_rows:
        faults.append(f"{found['row_count']} rows, at least {min_rows} expected")
    if max_rows is not None and found["row_count"] > max_rows:
        faults.append(f"{found['row_count']} rows, at most {max_rows} expected")
    if faults:
        raise QualityError("; ".join(faults))
    return found


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of NULLs per column, for the attributes that a join added."""
    return df.agg(*[F.avg(F.col(name).isNull().cast("int")).alias(f"{name}_null_rate") for name in columns])


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys of the fact that the dimension lacks, with their row counts.

    Facts are counted per key first, so the join sees each key once, however hot it is.
    """
    return (fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
            .join(dim.select(key), key, "left_anti"))


CONTRACT_FIELDS = ["transaction_id", "customer_id", "account_id", "merchant_id", "event_time"]


def judge_contract(df: DataFrame) -> DataFrame:
    """Add ``reasons``, the ways in which a transaction breaks the record contract; empty when it meets it."""
    def reason(bad: Column, text: str) -> Column:
        return F.when(bad, F.lit(text))

    checks = [reason(F.col(name).isNull(), f"{name} missing") for name in CONTRACT_FIELDS]
    checks += [
        reason(F.coalesce(F.col("amount") <= 0, F.lit(True)), "amount not positive"),
        reason(F.coalesce(~F.col("currency").isin(CURRENCIES), F.lit(True)), "currency unknown"),
        reason(F.coalesce(~F.col("transaction_type").isin(TRANSACTION_TYPES), F.lit(True)),
               "transaction_type unknown")]
    return df.withColumn("reasons", F.array_compact(F.array(*checks)))


def split_contract(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transactions that meet the record contract, and the others with their reasons."""
    judged = judge_contract(df)
    return judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0)


def stacked(rows: list[DataFrame]) -> DataFrame:
    """One-row measurements from several tables as ``(table_name, measure, value)`` rows."""
    return reduce(DataFrame.unionByName, rows)


def long_form(measured: DataFrame, table: str) -> DataFrame:
    """Turn a one-row measurement into one row per measure."""
    return measured.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("measure"),
                 F.col(name).cast("double").alias("value")) for name in measured.columns])))
