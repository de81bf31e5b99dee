"""Trending over a range of days in one pass, as reports and backfills need it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import between_days
from tidemark.operators import aggregates, emergence, languages
from tidemark.params import DEFAULTS, Params
from tidemark.session import WorkTables

DAY = ["day"]


def _dated(rows: DataFrame, instant: str, first: date, last: date) -> DataFrame:
    return rows.filter(between_days(F.col(instant), first, last)).withColumn("day", F.to_date(instant))


def trending_period(
    edits: DataFrame, ids: DataFrame, hourly: DataFrame, top: DataFrame, first: date, last: date,
    params: Params = DEFAULTS,
) -> DataFrame:
    """The trending rows of every day from ``first`` to ``last``, with ``day`` as a date.

    Each day has the rows it would have alone. The edits are read and counted once, from the
    first day's history on: the windows of all days are ranges of these counts. The counts are
    written, as scores, languages and observed days all start from them.
    """
    start, _ = emergence.history_window(first, params)
    counted = aggregates.edit_volumes(_dated(edits, "timestamp_utc", start, last), DAY)
    work = WorkTables(edits.sparkSession, "period")
    work.write(counted, "volumes")
    volumes = work.read("volumes", counted.schema)
    flagged = aggregates.join_entities(emergence.flag_period(volumes, first, last, params), ids)
    read = aggregates.readership(
        _dated(hourly, "hour_utc", first, last), _dated(top, "date_utc", first, last), params, DAY
    )
    joined = aggregates.join_readership(flagged, read, params, DAY)
    edited = flagged.withColumnRenamed("project", "edit_project")
    signed = languages.add_language_signature(aggregates.with_trending_score(joined), edited, DAY)
    return signed.select("day", *schemas.TRENDING.fieldNames())


def events_period(trending: DataFrame) -> DataFrame:
    """Entities edited in at least two languages, day by day."""
    return languages.cross_language_events(trending, DAY)
