"""Reports and dashboard panels over the published tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.leadlag import DECORRELATED, EDIT_LED

# The columns of the saved multilingual search.
SEARCH_COLUMNS = (
    "titles", "language_count", "first_language", "spread_minutes", "sum_editors", "total_pageviews",
    "emerging_languages",
)
PANEL_DAYS = 30


def rolling(rows: DataFrame, day: date, days: int = PANEL_DAYS) -> DataFrame:
    """Rows (column ``day``, a date) of the last ``days`` days up to and including ``day``."""
    return rows.filter(F.col("day").between(F.lit(day - timedelta(days=days)), F.lit(day)))


def article_count(trending: DataFrame) -> DataFrame:
    return trending.agg(F.count("*").alias("articles"))


def emerging_count(trending: DataFrame) -> DataFrame:
    return trending.agg(F.count_if("is_emerging").alias("emerging"))


def multilingual_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("subjects"))


def edit_led_count(leadlag: DataFrame) -> DataFrame:
    return leadlag.agg(F.count_if(F.col("pattern") == EDIT_LED).alias("edit_led"))


def emerging_table(trending: DataFrame, titles: int = 50, languages: int = 5) -> DataFrame:
    """Top titles by their highest z, within each the top languages, with five maxima.

    The titles are a bounded top-n, so they are broadcast back to the grouped rows; the
    inner ranking then sees only their languages.
    """
    emerging = trending.filter("is_emerging")
    cells = emerging.groupBy("title", "edit_project").agg(
        F.max("unique_editors").alias("editors"),
        F.max("baseline_editors").alias("baseline"),
        F.max("z_editors").alias("z"),
        F.max("pageviews").alias("views"),
        F.max("language_count").alias("languages"),
    )
    best = cells.groupBy("title").agg(F.max("z").alias("title_z"))
    leaders = best.orderBy(F.desc("title_z"), "title").limit(titles)
    order = Window.partitionBy("title").orderBy(F.desc("z"), "edit_project")
    return (
        cells.join(F.broadcast(leaders), "title")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= languages)
        .select("title", "title_z", "edit_project", "place", "editors", "baseline", "z", "views", "languages")
    )


def emerging_per_day(trending: DataFrame, first: date, last: date, languages: int = 5) -> DataFrame:
    """Emerging articles per day and language for the top languages; days without any count 0."""
    counted = (
        trending.filter("is_emerging")
        .filter(F.col("day").between(F.lit(first), F.lit(last)))
        .groupBy("day", "edit_project")
        .agg(F.count("*").alias("emerging"))
    )
    top = (
        counted.groupBy("edit_project")
        .agg(F.sum("emerging").alias("total"))
        .orderBy(F.desc("total"), "edit_project")
        .limit(languages)
    )
    calendar = top.select("edit_project", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    return calendar.join(counted, ["day", "edit_project"], "left").select(
        "day", "edit_project", F.coalesce("emerging", F.lit(0)).cast("bigint").alias("emerging")
    )


def multilingual_search(events: DataFrame) -> DataFrame:
    return events.orderBy(F.desc("language_count"), F.desc("sum_editors"), "wikidata_id").select(*SEARCH_COLUMNS)


def first_languages(events: DataFrame, limit: int = 5) -> DataFrame:
    """Which language edits first."""
    return (
        events.groupBy("first_language")
        .agg(F.count("*").alias("subjects"))
        .orderBy(F.desc("subjects"), "first_language")
        .limit(limit)
    )


def lag_histogram(leadlag: DataFrame) -> DataFrame:
    """Articles per lag and pattern, articles without a link left out."""
    return (
        leadlag.filter(F.col("pattern") != DECORRELATED)
        .groupBy("best_lag_hours", "pattern")
        .agg(F.count("*").alias("articles"))
        .orderBy("best_lag_hours", "pattern")
    )


def pattern_counts(leadlag: DataFrame) -> DataFrame:
    return leadlag.groupBy("pattern").agg(F.count("*").alias("articles")).orderBy(F.desc("articles"), "pattern")


def _share_of_all(count: Column) -> Column:
    """Share of a count among all groups. The window spans the groups, of which there are at most four."""
    return count / F.sum(count).over(Window.partitionBy())


def pattern_share(leadlag: DataFrame, limit: int = 4) -> DataFrame:
    """Percent of articles per pattern."""
    counted = leadlag.groupBy("pattern").agg(F.count("*").alias("articles"))
    shared = counted.withColumn("percent", F.round(_share_of_all(F.col("articles")) * 100, 4))
    return shared.orderBy(F.desc("articles"), "pattern").limit(limit)


def pattern_profile(leadlag: DataFrame) -> DataFrame:
    """Share and median lag per pattern.

    Lags take few values, so they are counted first and the median is read off the
    counts: a pattern holding most articles is still a handful of rows.
    """
    by_lag = leadlag.groupBy("pattern", "best_lag_hours").agg(F.count("*").alias("articles"))
    order = Window.partitionBy("pattern").orderBy("best_lag_hours")
    known = F.when(F.col("best_lag_hours").isNotNull(), F.col("articles")).otherwise(0)
    running = by_lag.withColumns(
        {
            "upto": F.sum(known).over(order),
            "known": F.sum(known).over(Window.partitionBy("pattern")),
        }
    )
    # 1-based middle positions; equal for an odd count
    low, high = F.floor((F.col("known") + 1) / 2), F.floor(F.col("known") / 2) + 1
    lag = F.col("best_lag_hours")
    grouped = running.groupBy("pattern").agg(
        F.sum("articles").alias("articles"),
        F.min(F.when(F.col("upto") >= low, lag)).alias("low"),
        F.min(F.when(F.col("upto") >= high, lag)).alias("high"),
    )
    return grouped.select(
        "pattern",
        "articles",
        F.round(_share_of_all(F.col("articles")), 4).alias("share"),
        ((F.col("low") + F.col("high")) / F.lit(2.0)).alias("median_lag_hours"),
    )


def headline_totals(edits: DataFrame, trending: DataFrame, events: DataFrame) -> DataFrame:
    """Edits, article-days, emerging articles and multilingual subjects over the days given."""
    def metric(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), value.alias("value"))

    def counted(rows: DataFrame, **metrics: Column) -> DataFrame:
        """All metrics of one source from one pass over it."""
        summary = rows.agg(*[value.alias(name) for name, value in metrics.items()])
        return summary.select(F.inline(F.array(*[metric(name, F.col(name)) for name in metrics])))

    return (
        counted(edits, edits=F.count("*"))
        .unionByName(counted(trending, article_days=F.count("*"), emerging=F.count_if("is_emerging")))
        .unionByName(counted(events, multilingual_subjects=F.count("*")))
    )
