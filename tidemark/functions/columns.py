"""Names, days and rounding as column expressions."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def align_project(project: Column) -> Column:
    """``fr.wikipedia.org`` -> ``fr.wikipedia``; only the suffix goes."""
    return F.regexp_replace(project, r"\.org$", "")


def readable_title(title: Column) -> Column:
    """Dump spelling to edit spelling: underscores become spaces."""
    return F.translate(title, "_", " ")


def dump_title(title: Column) -> Column:
    """Edit spelling to dump spelling: spaces become underscores."""
    return F.translate(title, " ", "_")


def language_of(project: Column) -> Column:
    """``fr.wikipedia.org`` -> ``fr``."""
    return F.substring_index(project, ".", 1)


def day_key(ts: Column) -> Column:
    """UTC day of an instant as ``yyyyMMdd``."""
    return F.date_format(ts, "yyyyMMdd")


def half_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled value, the rule of the array libraries.

    Whole-second lags in minutes hit exact halves often, so the rule is visible.
    """
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def day_text(day: date) -> str:
    return f"{day:%Y%m%d}"


def run_day(interval_start: datetime | None) -> date:
    """Day a run handles: its data interval's start, at UTC midnight."""
    if interval_start is None:
        raise ValueError("a run needs a data interval; start it with an explicit date")
    if isinstance(interval_start, datetime):
        return interval_start.date()
    return interval_start


def event_day(day: date) -> date:
    """The lead-lag of run day D describes the day before, whose follow-up D completes."""
    return day - timedelta(days=1)


def midnight(day: date) -> datetime:
    """UTC midnight of a day."""
    return datetime(day.year, day.month, day.day, tzinfo=timezone.utc)


def instant(moment: datetime) -> Column:
    """A UTC instant as a foldable timestamp, independent of the driver's zone."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.to_timestamp(F.lit(moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")))


def between_days(ts: Column, first: date, last: date) -> Column:
    """Instants from the start of ``first`` to the end of ``last``; reaches the scan as a range."""
    return (ts >= instant(midnight(first))) & (ts < instant(midnight(last + timedelta(days=1))))
