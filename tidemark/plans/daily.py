"""Formatted to usage: trending articles, cross-language events, ratios and hourly lead-lag."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import day_text, event_day
from tidemark.operators import aggregates, emergence, languages, leadlag, quality
from tidemark.operators.joins import followed
from tidemark.params import DEFAULTS, Params
from tidemark.plans.history import past_counts
from tidemark.plans.period import events_period, trending_period
from tidemark.sources import documents
from tidemark.sources.lake import Lake


def joined_articles(
    edits: DataFrame, ids: DataFrame, hourly: DataFrame, top: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """A day's edited articles with ids, views and rank."""
    edited = aggregates.join_entities(aggregates.edit_volumes(edits), ids)
    return aggregates.join_readership(edited, aggregates.readership(hourly, top, params), params)


def trending_articles(
    edits: DataFrame,
    history: DataFrame,
    days: Column | int,
    ids: DataFrame,
    hourly: DataFrame,
    top: DataFrame,
    params: Params = DEFAULTS,
) -> DataFrame:
    """The whole trending table of a day, one row per article and language.

    ``history`` holds daily counts of the past and ``days`` how many days were observed.
    Ids and history share the edits' key, so they are joined before the views, whose key
    is spelled differently: three joins cost one more shuffle of the articles, not three.
    """
    edited = aggregates.join_entities(aggregates.edit_volumes(edits), ids)
    flagged = emergence.flag_emerging(edited, history, days, params)
    joined = aggregates.join_readership(flagged, aggregates.readership(hourly, top, params), params)
    scored = aggregates.with_trending_score(joined)
    signed = languages.add_language_signature(scored, edited.withColumnRenamed("project", "edit_project"))
    return signed.select(*schemas.TRENDING.fieldNames())


def combine_day(spark: SparkSession, lake: Lake, day: date, params: Params = DEFAULTS) -> dict[str, str]:
    """Publish the day's usage tables together once the gate has passed.

    The trending frame is computed once and kept; gate and tables all read it.
    """
    today = day_text(day)
    lake.require(spark, [("formatted", table, today) for table in ("Edits", "PageviewsHourly", "Pageviews")])
    edits = lake.days(spark, "formatted", "Edits", [today], schemas.EDITS).drop("day")
    hourly = lake.days(spark, "formatted", "PageviewsHourly", [today], schemas.HOURLY_VIEWS).drop("day")
    top = lake.days(spark, "formatted", "Pageviews", [today], schemas.DAILY_TOP).drop("day")
    ids = lake.optional_day(spark, "formatted", "Wikidata", today, schemas.ENTITY_IDS)
    history, days = past_counts(spark, lake, day, params)

    trending = trending_articles(
        edits, followed(history, edits), days, ids, hourly, top, params
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        quality.enforce(quality.trending_rules(trending, params), "TrendingArticles")
        tables = usage_tables(trending, languages.cross_language_events(trending))
        tables["CrossLanguageTitles"] = languages.ordered_titles(trending)
        lake.publish("usage", {name: df.withColumn("day", F.lit(today)) for name, df in tables.items()}, [today])
        return {name: lake.path("usage", name) for name in tables}
    finally:
        trending.unpersist()


def usage_tables(trending: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    """The three published tables of a trending frame, each file with its strongest rows first."""
    ratios = aggregates.edit_to_view(trending)
    passed = [c for c in trending.columns if c == "day"]
    return {
        "EditLeadLag": ratios.select(*passed, *schemas.EDIT_TO_VIEW.fieldNames()).sortWithinPartitions(
            F.desc("edit_to_view_ratio"), "edit_project", "title"
        ),
        "TrendingArticles": trending.sortWithinPartitions(F.desc("trending_score"), "edit_project", "title"),
        "CrossLanguageEvents": events.sortWithinPartitions(F.desc("language_count"), F.desc("sum_editors"), "wikidata_id"),
    }


def combine_period(spark: SparkSession, lake: Lake, first: date, last: date, params: Params = DEFAULTS) -> dict[str, str]:
    """The usage tables of all days of a range, computed in one pass and published together.

    Each day needs its three inputs and passes its own gate; nothing is published otherwise.
    Edits count on the day they are dated, as long as a folder of the range or its history
    holds them.
    """
    days = [day_text(first + timedelta(days=n)) for n in range((last - first).days + 1)]
    lake.require(spark, [("formatted", table, d) for d in days for table in ("Edits", "PageviewsHourly", "Pageviews")])
    past, _ = emergence.history_window(first, params)
    edits = lake.scan(spark, "formatted", "Edits", schemas.EDITS).filter(F.col("day").between(day_text(past), days[-1]))
    of_days = lambda table, schema: lake.days(spark, "formatted", table, days, schema).drop("day")
    ids = lake.scan_if_present(spark, "formatted", "Wikidata", schemas.ENTITY_IDS)
    known = spark.createDataFrame([], schemas.ENTITY_IDS) if ids is None else newest_ids(ids.filter(F.col("day") <= days[-1]))
    trending = trending_period(
        edits.drop("day"), known, of_days("PageviewsHourly", schemas.HOURLY_VIEWS),
        of_days("Pageviews", schemas.DAILY_TOP), first, last, params,
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for n, day in enumerate(days):
            of_day = trending.filter(F.col("day") == F.lit(first + timedelta(days=n)))
            quality.enforce(quality.trending_rules(of_day, params), f"TrendingArticles of {day}")
        tables = usage_tables(trending, events_period(trending))
        lake.publish("usage", {name: df.withColumn("day", F.date_format("day", "yyyyMMdd")) for name, df in tables.items()}, days)
        return {name: lake.path("usage", name) for name in tables}
    finally:
        trending.unpersist()


def newest_ids(ids: DataFrame) -> DataFrame:
    """One id per article, from the last day that had the article."""
    return ids.groupBy("project", "title").agg(F.max_by("wikidata_id", "day").alias("wikidata_id"))


def leadlag_day(spark: SparkSession, lake: Lake, run: date, params: Params = DEFAULTS) -> str:
    """Hourly lead-lag of the day before the run, whose readers the run's day completes."""
    event = event_day(run)
    days = [day_text(event), day_text(run)]
    lake.require(spark, [("formatted", table, d) for table in ("Edits", "PageviewsHourly") for d in days])
    edits = lake.days(spark, "formatted", "Edits", days, schemas.EDITS).drop("day")
    hourly = lake.days(spark, "formatted", "PageviewsHourly", days, schemas.HOURLY_VIEWS).drop("day")
    editing = leadlag.edit_series(leadlag.hourly_edits(edits, event, params), params).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        reading = leadlag.view_series(leadlag.hourly_views(followed(hourly, editing), event, params))
        factors = leadlag.diurnal_factors(hourly, event, params)
        series = leadlag.paired_series(editing, reading, factors, params)
        result = leadlag.measured_pairs(series, event, params)
        rows = result.select(*schemas.LEADLAG_HOURLY.fieldNames(), F.lit(day_text(event)).alias("day"))
        lake.publish("usage", {"EditLeadLagHourly": rows}, [day_text(event)])
        return lake.path("usage", "EditLeadLagHourly")
    finally:
        editing.unpersist()


def publish_day(spark: SparkSession, lake: Lake, run: date) -> dict[str, str]:
    """Documents of the run day's tables."""
    daily = [index for index, spec in documents.TABLES.items() if not spec.event_day]
    return {index: documents.publish_table(spark, lake, index, day_text(run)) for index in daily}


def publish_leadlag(spark: SparkSession, lake: Lake, run: date) -> dict[str, str]:
    """Documents of the hourly lead-lag, dated on its event day; separate, as dumps come later."""
    hourly = [index for index, spec in documents.TABLES.items() if spec.event_day]
    return {
        index: documents.publish_table(spark, lake, index, day_text(event_day(run))) for index in hourly
    }
