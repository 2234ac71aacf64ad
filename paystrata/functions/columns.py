"""Column expressions used by more than one operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paystrata.model import LARGE_AMOUNT, MONEY


def ratio(numerator: str, denominator: str, places: int) -> Column:
    """``numerator / denominator`` rounded half up, as DOUBLE; NULL where the denominator is 0.

    Both sides are cast to narrow decimals first: the quotient of wide ones keeps so few places that it would be
    rounded twice.
    """
    top, bottom = F.col(numerator).cast(MONEY), F.col(denominator).cast(MONEY)
    return F.round(F.try_divide(top, bottom), places).cast("double")


def mean(column: str) -> Column:
    """Average as DOUBLE without the rounding of a decimal average; NULL where no value is set."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def is_type(kind: str) -> Column:
    return F.col("transaction_type") == kind


def amount_tier(total: str = "total_amount") -> Column:
    return F.when(F.col(total) >= 10000, "HIGH").when(F.col(total) >= 1000, "MID").otherwise("LOW")


def large_amount(amount: Column) -> Column:
    """The amount where it is above the large-payment limit, else 0."""
    return F.when(amount > LARGE_AMOUNT, amount).otherwise(F.lit(0))


def month_key(day: str = "dt") -> Column:
    return F.date_format(day, "yyyy-MM")


def not_blank(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def outside(column: str, allowed: list[str]) -> Column:
    """True where a value is set and not in the list; NULL is neither in nor out, so it is not flagged."""
    return F.coalesce(~F.col(column).isin(allowed), F.lit(False))


def id_number(column: str) -> Column:
    """The digits behind the one-letter prefix of an id; NULL where there is more than one number.

    A failing ``try_cast`` is an exception inside, 30 microseconds a row: texts that are no one number don't get there.
    """
    digits = f"substring({column}, 2)"
    return F.expr(f"CASE WHEN {digits} RLIKE '^[^0-9A-Za-z]*[0-9.]+[^0-9A-Za-z]*$' THEN try_cast({digits} AS BIGINT) END")


def text_or_empty(column: str) -> Column:
    """String form of a value, with '' for NULL."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def to_millis(moment: Column) -> Column:
    return F.date_trunc("MILLISECOND", moment)
