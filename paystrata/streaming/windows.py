"""Event-time windows per customer, from panes.

A pane is a window as long as the slide. Rows are reduced once, to panes; windows are then made of panes, by aggregates that
follow each other on the panes' own event time. Results leave once the watermark has passed the end of a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.columns import large_amount
from paystrata.model import MONEY, REALTIME_AGG

DELAY = "5 seconds"
TUMBLE = "5 minutes"
HOP = ("10 minutes", "5 minutes")       # size, slide

# Output name of each distinct count and the column it counts; transaction_id rows carry the measures
_DISTINCT = {"transaction_count": "transaction_id", "merchant_count": "merchant_id", "account_count": "account_id",
             "currency_count": "currency", "txn_type_count": "transaction_type"}


#: Parts by hash into which the values of a pane, customer and counted column are split, each a set of its own.
PARTS = 64

#: What is kept of the rows of a group, and how it is merged.
_MERGED = {"total": F.sum, "amounts": F.sum, "largest": F.max, "smallest": F.min, "high": F.sum, "large": F.sum,
           "first": F.min, "last": F.max}


def panes(df: DataFrame, pane: str) -> DataFrame:
    """Per pane (``window``), customer, counted column and part of its values: the set of values, and the measures of the rows.

    This is all that is computed on rows. A row is five members before the first shuffle, one for each distinct count,
    however many windows it is in; members of one pane and part combine in the tasks. A hot customer is spread over all
    tasks by the parts. The state has a row for each part, not for each transaction, so its rows do not grow with the input.
    """
    rows = df.filter((F.col("amount") > 0) & F.col("customer_id").isNotNull())
    nothing = F.lit(None)
    members = []
    for column in _DISTINCT.values():
        carries = column == "transaction_id"
        members.append(F.struct(
            F.lit(column).alias("counted"), F.col(column).alias("value"),
            (F.col("amount") if carries else nothing.cast(df.schema["amount"].dataType)).alias("amount"),
            (F.coalesce(F.col("merchant_risk_level") == "HIGH", F.lit(False)) if carries else F.lit(False))
            .alias("high_risk")))
    part = F.pmod(F.xxhash64("value"), F.lit(PARTS)).cast("int").alias("part")
    return (rows.select("event_time", "customer_id", F.inline(F.array(*members)))
            .groupBy(F.window("event_time", pane).alias("window"), "customer_id", "counted", part)
            .agg(F.collect_set("value").alias("values"), F.sum("amount").alias("total"), F.count("amount").alias("amounts"),
                 F.max("amount").alias("largest"), F.min("amount").alias("smallest"),
                 F.count_if("high_risk").alias("high"), F.sum(large_amount(F.col("amount"))).alias("large"),
                 F.min("event_time").alias("first"), F.max("event_time").alias("last")))


def _totals(window_type: str, window: Column, among: Column | None = None, prefix: str = "") -> Column:
    """The aggregate that makes an output row from the rows by part among which a condition holds, one for each part."""
    among = F.lit(True) if among is None else among
    of = {name: merge(F.when(among, F.col(f"{prefix}{name}"))) for name, merge in _MERGED.items()}
    distinct = F.col(f"{prefix}distinct")
    counts = [F.sum(F.when(among & (F.col("counted") == column), distinct).otherwise(0)) for column in _DISTINCT.values()]
    made = {"window_type": F.lit(window_type), "window_start": window["start"], "window_end": window["end"],
            "total_amount": of["total"].cast(MONEY),
            "avg_amount": F.try_divide(of["total"].cast("double"), of["amounts"]), "max_amount": of["largest"],
            "min_amount": of["smallest"], "high_risk_txn_count": of["high"], "large_txn_amount": of["large"].cast(MONEY),
            "first_txn_time": of["first"], "last_txn_time": of["last"], "customer_id": F.col("customer_id")}
    named = {**{name: column.alias(name) for name, column in made.items()}, **dict(zip(_DISTINCT, counts))}
    return F.struct(*[named[name].cast(REALTIME_AGG[name].dataType).alias(name) for name in REALTIME_AGG.names])


def _spanned(df: DataFrame, size: str, slide: str) -> DataFrame:
    """The panes of ``df`` in all windows of ``size`` that hold them (``span``)."""
    return panes(df, slide).select("*", F.window("window", size, slide).alias("span"))


def _all_distinct() -> Column:
    """The number of values in the sets of the panes of a group."""
    return F.size(F.array_distinct(F.flatten(F.collect_list("values")))).alias("distinct")


def tumbling(df: DataFrame, size: str = TUMBLE) -> DataFrame:
    """Totals per window and customer; on a stream, give ``df`` a watermark and use append mode."""
    per_part = panes(df, size).withColumn("distinct", F.size("values"))
    found = per_part.groupBy("window", "customer_id").agg(_totals("TUMBLE", F.col("window")).alias("out"))
    return found.select("out.*")


def hopping(df: DataFrame, size: str = HOP[0], slide: str = HOP[1]) -> DataFrame:
    """Totals per overlapping window and customer, from panes of ``slide``, of which ``size`` is a multiple."""
    per_part = _spanned(df, size, slide).groupBy("span", "customer_id", "counted", "part").agg(
        _all_distinct(), *[merge(name).alias(name) for name, merge in _MERGED.items()])
    return per_part.groupBy("span", "customer_id").agg(_totals("HOP", F.col("span")).alias("out")).select("out.*")


def both_windows(df: DataFrame) -> DataFrame:
    """Tumbling and hopping results in one frame, told apart by ``window_type``, from one set of panes.

    A tumbling window is the newest pane of the hopping window that ends with it, so one row of the last aggregate gives
    both: there is one state for each step, not one for each shape.
    """
    if TUMBLE != HOP[1]:
        raise ValueError("a tumbling window must be as long as the hopping windows' slide")
    newest = F.col("window.end") == F.col("span.end")
    per_part = _spanned(df, *HOP).groupBy("span", "customer_id", "counted", "part").agg(
        _all_distinct(), F.max(F.when(newest, F.size("values"))).alias("new_distinct"),
        *[merge(name).alias(name) for name, merge in _MERGED.items()],
        *[merge(F.when(newest, F.col(name))).alias(f"new_{name}") for name, merge in _MERGED.items()],
        F.max(newest).alias("new"))
    end = F.col("span")["end"]
    pane = F.struct((end - F.expr(f"INTERVAL {TUMBLE}")).alias("start"), end.alias("end"))
    found = per_part.groupBy("span", "customer_id").agg(
        _totals("HOP", F.col("span")).alias("hop"),
        _totals("TUMBLE", pane, F.col("new"), "new_").alias("tumble"), F.max("new").alias("new"))
    return found.select(F.inline(F.when(F.col("new"), F.array("hop", "tumble")).otherwise(F.array("hop"))))
