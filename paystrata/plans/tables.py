"""One job per warehouse table, in layer order."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from paystrata.functions.days import parse_day
from paystrata.model import CUSTOMER_LOOKUP_PREFIX, MERCHANT_LOOKUP_PREFIX
from paystrata.operators import detail, dimensions, quality, reports, rollups, staging
from paystrata.sources.lake import Lake, scan_source
from paystrata.sources.lookup import publish_lookup

LAYERS = [
    ["ods_transaction", "ods_customer", "ods_merchant"],
    ["dim_customer", "dim_merchant"],
    ["dwd_transaction"],
    ["dws_customer_daily", "dws_merchant_daily"],
    ["ads_customer_profile", "ads_daily_report", "ads_merchant_top10"],
    ["lookup_customer", "lookup_merchant"],
]

# Day tables that must hold the day before a table can be made
UPSTREAM = {
    "dwd_transaction": "ods_transaction",
    "dws_customer_daily": "dwd_transaction", "dws_merchant_daily": "dwd_transaction",
    "ads_customer_profile": "dws_customer_daily", "ads_daily_report": "dws_merchant_daily",
    "ads_merchant_top10": "dws_merchant_daily",
}


@dataclass
class Warehouse:
    """A lake of tables and where its source objects are (``master`` and ``transaction``): folders, or lakes."""
    lake: Lake
    sources: dict[str, str | Lake]

    @property
    def spark(self):
        return self.lake.spark


def _require_upstream(lake: Lake, name: str, day: str | None) -> None:
    source = UPSTREAM.get(name)
    if source is None:
        return
    if day is None:
        raise ValueError(f"{name} is made day by day: give a day")
    if not lake.has_day(source, day):
        raise quality.QualityError(f"{name} for {day}: {source} has no such day yet")


def run_table(house: Warehouse, name: str, day: str | None = None) -> dict[str, int]:
    """Read, transform, write beside the live data, check, publish; returns the counts of the check."""
    lake = house.lake
    _require_upstream(lake, name, day)
    if name not in _JOBS:
        raise KeyError(f"no job makes table {name!r}")
    return _JOBS[name](house, name, day)


def _ods_transaction(house: Warehouse, name: str, day: str | None) -> dict[str, int]:
    raw = scan_source(house.spark, house.sources, "transaction", "fact_transaction", day)
    rows, expected = staging.ods_transaction(raw), raw.count()
    if day:
        return house.lake.replace_day(rows, name, day, min_rows=expected)
    by_day_already = isinstance(house.sources["transaction"], Lake)
    return house.lake.replace_table(rows, name, min_rows=expected, gather=not by_day_already)


def _ods_dimension(house: Warehouse, name: str, day: str | None) -> dict[str, int]:
    source = name.replace("ods", "dim")
    raw = staging.with_status(scan_source(house.spark, house.sources, "master", source))
    if name == "ods_customer":
        return house.lake.replace_table(staging.ods_customer(raw), name, quality.ods_customer_rules(), raw.count())
    return house.lake.replace_table(staging.ods_merchant(raw), name, quality.ods_merchant_rules(), raw.count())


def _dimension(house: Warehouse, name: str, day: str | None) -> dict[str, int]:
    """One row per key: source files may repeat a customer or merchant, and every join below counts on one."""
    clean, pk = dimensions.dim_customer if name == "dim_customer" else dimensions.dim_merchant, dimensions.KEYS[name]
    rows = dimensions.one_per_key(clean(house.lake.read(name.replace("dim", "ods"))), pk)
    return house.lake.replace_table(rows, name, min_rows=1, unique=pk)


def _detail(house: Warehouse, name: str, day: str) -> dict[str, int]:
    ods = house.lake.read_days("ods_transaction", day)
    rows = detail.enrich(detail.clean_transactions(ods), house.lake.read("dim_customer"),
                         house.lake.read("dim_merchant"))
    found = house.lake.replace_day(rows, name, day, quality.detail_rules(), min_rows=1)
    return {**found, "filtered": ods.count() - found["row_count"]}


def _rollup(house: Warehouse, name: str, day: str) -> dict[str, int]:
    dwd = house.lake.read_days("dwd_transaction", day)
    roll_up = rollups.customer_daily if name == "dws_customer_daily" else rollups.merchant_daily
    return house.lake.replace_day(roll_up(dwd), name, day, quality.rollup_rules(), min_rows=1, max_rows=dwd.count())


def _customer_profile(house: Warehouse, name: str, day: str) -> dict[str, int]:
    """The moving averages reach back six days; only the day itself is written."""
    week = reports.customer_profile(house.lake.read_days("dws_customer_daily", day, days=7))
    return house.lake.replace_day(week.filter(F.col("dt") == F.lit(parse_day(day))), name, day)


def _daily_report(house: Warehouse, name: str, day: str) -> dict[str, int]:
    """Month-to-date sums need the month so far, and the change of the 1st needs the day before it."""
    month = reports.daily_report(house.lake.read_month("dws_merchant_daily", day))
    return house.lake.replace_day(month.filter(F.col("dt") == F.lit(parse_day(day))), name, day)


def _merchant_top(house: Warehouse, name: str, day: str) -> dict[str, int]:
    return house.lake.replace_day(reports.merchant_top(house.lake.read_days("dws_merchant_daily", day)), name, day)


def _lookup(house: Warehouse, name: str, day: str | None) -> dict[str, int]:
    pk, prefix = {"lookup_customer": ("customer_id", CUSTOMER_LOOKUP_PREFIX),
                  "lookup_merchant": ("merchant_id", MERCHANT_LOOKUP_PREFIX)}[name]
    dim = house.lake.read(name.replace("lookup", "dim"))
    return {"row_count": publish_lookup(house.lake, dim, name, pk, prefix)}


_JOBS = {
    "ods_transaction": _ods_transaction, "ods_customer": _ods_dimension, "ods_merchant": _ods_dimension,
    "dim_customer": _dimension, "dim_merchant": _dimension, "dwd_transaction": _detail,
    "dws_customer_daily": _rollup, "dws_merchant_daily": _rollup, "ads_customer_profile": _customer_profile,
    "ads_daily_report": _daily_report, "ads_merchant_top10": _merchant_top,
    "lookup_customer": _lookup, "lookup_merchant": _lookup,
}


def run_day(house: Warehouse, day: str, grace_seconds: float = 86_400) -> dict[str, dict[str, int]]:
    """All tables of one day, layer by layer, then the clean-up; running it again changes nothing.

    The tables of a layer do not read each other: their jobs share the cluster instead of waiting for each other's last
    tasks. If one fails, the others of its layer are finished and later layers are not begun.
    """
    done = {}
    for layer in LAYERS:
        with ThreadPoolExecutor(len(layer)) as pool:
            # wrapped anew for each table: a wrapper holds its own copy of this thread's job properties
            jobs = {name: pool.submit(inheritable_thread_target(house.spark)(run_table), house, name, day)
                    for name in layer}
        done |= {name: job.result() for name, job in jobs.items()}
    for name in done:
        house.lake.drop_old_versions(name, grace_seconds=grace_seconds)
    return done
