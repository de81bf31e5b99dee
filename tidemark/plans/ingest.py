"""Raw to formatted: one job per source and day, each gated before it writes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark import StorageLevel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import between_days, day_text, readable_title
from tidemark.operators import quality
from tidemark.operators.entities import request_batches
from tidemark.params import DEFAULTS, Params
from tidemark.plans.history import update_counts
from tidemark.sources import edits, entities, views
from tidemark.sources.lake import Lake, MissingInput
from tidemark.streaming.drain import require_day


def format_edits(spark: SparkSession, lake: Lake, day: date, params: Params = DEFAULTS) -> str:
    """Landed messages of a day to the clean edits table, and its counts."""
    raw = require_day(spark, lake, day_text(day))
    clean = edits.normalize_edits(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        quality.enforce(quality.edit_rules(clean, day, params), "Edits")
        target = lake.write_day(clean, "formatted", "Edits", day_text(day))
        update_counts(spark, lake, [day_text(day)])
        return target
    finally:
        clean.unpersist()


def format_hourly_views(
    spark: SparkSession, lake: Lake, dumps: str, day: date, params: Params = DEFAULTS
) -> str:
    """A day's dump files to hourly views of recently edited articles plus language totals.

    Articles edited on the day or the day before are followed. One of the two days may be
    missing; without any there is nothing to follow. All 24 hours must be there, once each;
    hours of other days are left out.
    """
    wanted = [day_text(day - timedelta(days=1)), day_text(day)]
    present = [d for d in wanted if lake.has_day(spark, "formatted", "Edits", d)]
    if not present:
        raise MissingInput(f"no edited article to follow on {wanted}")
    edited = lake.days(spark, "formatted", "Edits", present, schemas.EDITS)
    candidates = views.candidate_articles(edited)
    problems = views.dump_problems(views.dump_files(spark, dumps), day).orderBy("problem", "name").collect()
    if problems:
        raise MissingInput("dumps: " + ", ".join(f"{p['problem']}: {p['name']}" for p in problems))
    lines = views.read_dump_lines(spark, dumps)
    hour = views.hour_of_stamp(views.stamp_of_dump(F.col("file_name")))
    parsed = views.parse_dump_lines(lines.filter(between_days(hour, day, day)), params)
    hourly = views.merge_hour(parsed, candidates, params)
    table = hourly.select("hour_utc", "project", readable_title(F.col("title")).alias("title"), "views")
    return lake.write_day(table, "formatted", "PageviewsHourly", day_text(day))


def format_hourly_tsv(spark: SparkSession, lake: Lake, path: str, day: date) -> str:
    """Hourly rows that were already filtered and landed as tab-separated text."""
    table = views.normalize_hourly(views.read_hourly_tsv(spark, path))
    return lake.write_day(table, "formatted", "PageviewsHourly", day_text(day))


def format_daily_top(
    spark: SparkSession, lake: Lake, folder: str, day: date, params: Params = DEFAULTS
) -> str:
    """All languages' top lists in one job; what arrived is written, missing languages are named."""
    top = views.read_daily_top(spark, folder, day_text(day))
    target = lake.write_day(top, "formatted", "Pageviews", day_text(day))
    seen = spark.read.parquet(target).select(F.concat("project", F.lit(".org")).alias("project"))
    missing = sorted(r["project"] for r in quality.missing_projects(seen, params).collect())
    if missing:
        raise MissingInput(f"no top list for: {', '.join(m.removesuffix('.org') for m in missing)}")
    return target


def plan_entity_requests(spark: SparkSession, lake: Lake, day: date, params: Params = DEFAULTS) -> str:
    """Titles of a day's edits as lookup requests for the client that talks to the service."""
    edited = lake.days(spark, "formatted", "Edits", [day_text(day)], schemas.EDITS)
    return lake.write_day(request_batches(edited, params), "raw", "WikidataRequests", day_text(day))


def format_entities(
    spark: SparkSession, lake: Lake, responses: str, day: date, params: Params = DEFAULTS
) -> str:
    """Landed lookup responses to the id of each title; a title asked for but not answered fails the day."""
    landed = entities.read_responses(spark, responses).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        entities.require_usable(landed)
        asked = lake.days(spark, "raw", "WikidataRequests", [day_text(day)], schemas.ENTITY_REQUESTS).drop("day")
        entities.require_answered(asked, landed)
        ids = entities.ids_from_responses(landed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            quality.enforce(quality.id_rules(ids, params), "Wikidata")
            return lake.write_day(ids, "formatted", "Wikidata", day_text(day))
        finally:
            ids.unpersist()
    finally:
        landed.unpersist()
