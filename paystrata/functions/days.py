"""Which days a table needs in order to produce one day."""

from __future__ import annotations

from datetime import date, timedelta


def parse_day(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def trailing_days(day: str | date, days: int = 1) -> tuple[date, date]:
    """First and last day of the ``days`` calendar days that end at ``day``."""
    if days < 1:
        raise ValueError("days must be at least 1")
    last = parse_day(day)
    return last - timedelta(days=days - 1), last


def month_to_date(day: str | date) -> tuple[date, date]:
    """From the last day of the previous month, which the day-over-day change of the 1st needs, to ``day``."""
    last = parse_day(day)
    return last.replace(day=1) - timedelta(days=1), last
