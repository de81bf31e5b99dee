"""Languages: which ones edit the same subject, who came first, how late the others were."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import half_even, language_of
from tidemark.operators.joins import join_under_skew, numbered

MICROS_PER_MINUTE = 60_000_000.0


def entity_key(wikidata_id: Column, project: Column, title: Column) -> Column:
    """The entity, or the article itself where no id is known."""
    return F.coalesce(wikidata_id, F.concat_ws("|", project, title))


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(MICROS_PER_MINUTE)


def entity_languages(articles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per entity: languages in order of first edit.

    Articles are first reduced to one row per entity and language, so the list collected
    per entity is as long as the list of languages, however many articles it has.
    """
    per_language = articles.groupBy(*by, "entity_key", "edit_project").agg(F.min("first_edit").alias("first_edit"))
    arrivals = per_language.groupBy(*by, "entity_key").agg(
        F.array_sort(F.collect_list(F.struct("first_edit", "edit_project"))).alias("arrivals")
    )
    return arrivals.select(
        *by,
        "entity_key",
        F.size("arrivals").cast("bigint").alias("language_count"),
        F.array_join(F.col("arrivals.edit_project"), ",").alias("languages_editing"),
        F.col("arrivals")[0]["edit_project"].alias("first_language"),
        F.col("arrivals")[0]["first_edit"].alias("entity_first_edit"),
    )


def keyed_by_entity(articles: DataFrame) -> DataFrame:
    key = entity_key(F.col("wikidata_id"), F.col("edit_project"), F.col("title"))
    return articles.withColumn("entity_key", key)


def add_language_signature(
    articles: DataFrame, edited: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Add entity_key, language_count, languages_editing, first_language, language_lag_minutes.

    Aggregated and joined back rather than computed over a window: a window would put all
    articles of one entity in one task, this join is broadcast or split. ``edited``
    may hold the same articles before costly columns were added; only ids and first edits
    are read from it. With ``by`` an entity is looked at apart for each value, such as each day.
    """
    arrivals = entity_languages(keyed_by_entity(articles if edited is None else edited), by)
    lag = minutes_between(F.col("entity_first_edit"), F.col("first_edit"))
    return join_under_skew(keyed_by_entity(articles), arrivals, [*by, "entity_key"]).select(
        *articles.columns,
        "entity_key",
        "language_count",
        "languages_editing",
        "first_language",
        half_even(lag, 1).alias("language_lag_minutes"),
    )


def multilingual(trending: DataFrame) -> DataFrame:
    """Articles whose entity is known and edited in at least two languages."""
    return trending.filter(F.col("wikidata_id").isNotNull() & (F.col("language_count") >= 2))


def cross_language_titles(trending: DataFrame) -> DataFrame:
    """One row per article of a multilingual entity: the long form of ``titles``."""
    return multilingual(trending).select(
        "wikidata_id",
        "first_edit",
        "edit_project",
        "title",
        F.concat(language_of(F.col("edit_project")), F.lit(":"), F.col("title")).alias("language_title"),
    )


def ordered_titles(trending: DataFrame) -> DataFrame:
    """``cross_language_titles`` with each article's ``position`` in its entity, from 0 by first edit.

    The order of ``titles`` without its one cell: an entity with very many articles is
    numbered in many tasks, and its rows stay rows.
    """
    return numbered(cross_language_titles(trending), "wikidata_id", ["first_edit", "edit_project", "title"])


def cross_language_events(trending: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per entity edited in at least two languages the same day, per value of ``by`` if given.

    Titles are ordered by first edit. They are sorted and joined per minute of first
    edit, then the minutes are joined in order: an entity with very many articles is
    sorted in many tasks, and only its finished pieces meet.
    """
    minute = F.floor(F.unix_micros("first_edit") / F.lit(MICROS_PER_MINUTE))
    label = F.concat(language_of(F.col("edit_project")), F.lit(":"), F.col("title"))
    pieces = (
        multilingual(trending)
        .groupBy(*by, "wikidata_id", minute.alias("minute"))
        .agg(
            F.max("language_count").alias("language_count"),
            F.max("languages_editing").alias("languages_editing"),
            F.max("first_language").alias("first_language"),
            F.min("first_edit").alias("first_edit"),
            F.max("language_lag_minutes").alias("spread_minutes"),
            F.array_sort(
                F.collect_list(F.struct("first_edit", "edit_project", "title", label.alias("label")))
            ).alias("articles"),
            F.sum("edit_count").alias("total_edits"),
            F.sum("unique_editors").alias("sum_editors"),
            F.sum("pageviews").alias("total_pageviews"),
            F.count_if("is_emerging").alias("emerging"),
        )
        .withColumn("titles", F.array_join("articles.label", " | "))
        .drop("articles")
    )
    in_order = F.array_sort(F.collect_list(F.struct("minute", "titles")))
    return pieces.groupBy(*by, "wikidata_id").agg(
        F.max("language_count").alias("language_count"),
        F.max("languages_editing").alias("languages_editing"),
        F.max("first_language").alias("first_language"),
        F.min("first_edit").alias("first_edit"),
        F.max("spread_minutes").alias("spread_minutes"),
        F.array_join(in_order["titles"], " | ").alias("titles"),
        F.sum("total_edits").alias("total_edits"),
        F.sum("sum_editors").alias("sum_editors"),
        F.sum("total_pageviews").alias("total_pageviews"),
        F.sum("emerging").cast("int").alias("emerging_languages"),
        (F.sum("emerging") > 0).alias("is_emerging"),
    )


def by_reach(events: DataFrame) -> DataFrame:
    """Most languages first, then most editors."""
    return events.orderBy(F.desc("language_count"), F.desc("sum_editors"), "wikidata_id")
