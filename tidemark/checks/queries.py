"""One entry per operator: (session, folder of the tables) -> DataFrame.

Instants come back without a zone (UTC), the way the test tables store them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checks import tables as t
from tidemark.functions.columns import between_days, day_key
from tidemark.operators import (
    aggregates, emergence, entities, languages, leadlag, quality, reports,
)
from tidemark import schemas
from tidemark.plans.daily import joined_articles, trending_articles
from tidemark.plans.history import past_counts, update_counts
from tidemark.plans.period import events_period, trending_period
from tidemark.session import shared_folder
from tidemark.sources import documents, edits, views
from tidemark.sources import entities as landed
from tidemark.sources.lake import Lake, MissingInput
from tidemark.streaming.live import land_live_hours
from tidemark.streaming.drain import drain, edits_per_day, file_messages, message_counts, require_day

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DOCUMENT = T.StructType([T.StructField(c, T.StringType()) for c in documents.DOCUMENT_COLUMNS])
P, D, E = t.PARAMS, t.RUN_DAY, t.EVENT_DAY


def query(build: Callable[[t.Tables], DataFrame]) -> Query:
    """Register under the function's name; instants lose their zone on the way out."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = build(t.Tables(spark, folder))
        instants = {c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"}
        return df.withColumns(instants) if instants else df

    QUERIES[build.__name__] = run
    return run


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one."""
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


def landed_once(d: t.Tables, rows: DataFrame) -> DataFrame:
    """The rows written to a new folder and read back, where several writes start from them."""
    path = scratch(d.spark)
    rows.write.parquet(path)
    return d.spark.read.schema(rows.schema).parquet(path)


# ---- inputs shared by several queries


def _today(d: t.Tables) -> DataFrame:
    return t.on_day(d.edits, D)


def _past(d: t.Tables) -> DataFrame:
    return emergence.past_edits(d.edits, D, P)


def _hourly_today(d: t.Tables) -> DataFrame:
    return t.on_day(d.hourly, D, "hour_utc")


def _top_today(d: t.Tables) -> DataFrame:
    return t.on_day(d.top, D, "date_utc")


def _trending(d: t.Tables) -> DataFrame:
    past = d.once(_past)
    return trending_articles(
        d.once(_today), emergence.daily_history(past), emergence.history_days(past), d.ids, d.once(_hourly_today),
        d.once(_top_today), P,
    )


def _events(d: t.Tables) -> DataFrame:
    return languages.cross_language_events(d.once(_trending))


def _leadlag(d: t.Tables) -> DataFrame:
    return leadlag.day_patterns(d.edits, d.hourly, E, P)


def _period(d: t.Tables) -> DataFrame:
    return trending_period(d.edits, d.ids, d.hourly, d.top, t.FIRST_DAY, t.LAST_DAY, P)


def _period_events(d: t.Tables) -> DataFrame:
    return events_period(d.once(_period))


# ---- edits


@query
def change_events(d: t.Tables) -> DataFrame:
    """Event-stream text to tracked edits."""
    return edits.edits_from_change_events(edits.change_events_from_lines(d.capture_lines))


@query
def messages_by_event_day(d: t.Tables) -> DataFrame:
    """Decode messages, skip invalid ones, file by event day."""
    decoded = edits.decode_messages(d.messages).filter(edits.is_valid_message())
    return edits.with_event_day(decoded).groupBy("day", "project").agg(F.count("*").alias("edits"))


@query
def stream_drain(d: t.Tables) -> DataFrame:
    """The same messages through the streaming drain, run twice; the second run adds nothing."""
    folder = scratch(d.spark)
    d.messages.write.text(f"{folder}/topic")
    for _ in range(2):
        stream = d.spark.readStream.text(f"{folder}/topic")
        drain(stream, f"{folder}/raw", f"{folder}/state").awaitTermination()
    return edits_per_day(d.spark, f"{folder}/raw")


@query
def drain_skipped(d: t.Tables) -> DataFrame:
    """Messages received and skipped, from what a drain in several batches has landed."""
    folder = scratch(d.spark)
    d.messages.repartition(12).write.text(f"{folder}/topic")
    drain(file_messages(d.spark, f"{folder}/topic", 2), f"{folder}/raw", f"{folder}/state").awaitTermination()
    return message_counts(d.spark, f"{folder}/raw")


@query
def live_hours(d: t.Tables) -> DataFrame:
    """Hours closed by the live counts, in two runs: the first half of the days sent twice, then the others."""
    folder = scratch(d.spark)
    when = F.get_json_object("value", "$.timestamp").cast("bigint")
    early = when < F.unix_seconds(F.lit(f"{E:%Y-%m-%d} 00:00:00").cast("timestamp"))
    first = d.messages.filter(F.coalesce(early, F.lit(True)))
    for part in (first.unionByName(first), d.messages.filter(~early)):
        part.write.mode("append").text(f"{folder}/topic")
        messages = file_messages(d.spark, f"{folder}/topic")
        land_live_hours(messages, f"{folder}/hours", f"{folder}/state").awaitTermination()
    return d.spark.read.parquet(f"{folder}/hours").select("hour_utc", "project", "title", "edits")


@query
def raw_committed(d: t.Tables) -> DataFrame:
    """The run day as the drain's log has it, beside rows that something else left in the day's folder."""
    folder = scratch(d.spark)
    d.messages.write.text(f"{folder}/topic")
    drain(file_messages(d.spark, f"{folder}/topic"), f"{folder}/raw", f"{folder}/state").awaitTermination()
    stray = d.edits.select(F.unix_seconds("timestamp_utc").alias("timestamp"), "project", "title")
    stray.write.mode("append").json(f"{folder}/raw/day={D:%Y%m%d}")
    raw = edits.read_raw_edits(d.spark, f"{folder}/raw", f"{D:%Y%m%d}")
    return raw.groupBy("project").agg(F.count("*").alias("edits"), F.count_distinct("rev_id").alias("revisions"))


@query
def edits_normalized(d: t.Tables) -> DataFrame:
    return edits.normalize_edits(d.raw_edits)


@query
def edits_aggregated(d: t.Tables) -> DataFrame:
    return aggregates.edit_volumes(d.edits)


@query
def lake_days(d: t.Tables) -> DataFrame:
    """Write all days, replace one of them by a rerun, read the counts back."""
    lake = Lake(scratch(d.spark))
    dated = d.edits.withColumn("day", day_key(F.col("timestamp_utc")))
    lake.write_days(dated, "formatted", "Edits")
    lake.write_days(dated.filter(F.col("day") == f"{D:%Y%m%d}"), "formatted", "Edits")
    return (
        lake.scan(d.spark, "formatted", "Edits", d.edits.schema)
        .groupBy("day")
        .agg(F.count("*").alias("edits"), F.count_distinct("rev_id").alias("revisions"))
    )


def _dated_lake(d: t.Tables, without: str = "") -> Lake:
    """A new lake with the edits of each day but one."""
    lake = Lake(scratch(d.spark))
    dated = d.edits.withColumn("day", day_key(F.col("timestamp_utc")))
    lake.write_days(dated.filter(F.col("day") != without), "formatted", "Edits")
    return lake


@query
def days_united(d: t.Tables) -> DataFrame:
    """A week of day folders, all of them required, as one table."""
    week = [f"{D - timedelta(days=n):%Y%m%d}" for n in range(7)]
    rows = _dated_lake(d).days(d.spark, "formatted", "Edits", week, d.edits.schema)
    return rows.groupBy("day", "project").agg(F.count("*").alias("edits"), F.sum("edit_size").alias("edit_size"))


@query
def inputs_absent(d: t.Tables) -> DataFrame:
    """What a run over January would name as missing: a lost day, days nothing happened on, a table never written."""
    lake = _dated_lake(d, without="20240115")
    month = [f"{t.FIRST_DAY + timedelta(days=n):%Y%m%d}" for n in range(31)]
    needed = [("formatted", name, day) for name in ("Edits", "PageviewsHourly") for day in month]
    absent = lake.absent(d.spark, needed)
    return d.spark.createDataFrame(absent, "layer STRING, table_name STRING, day STRING")


@query
def optional_entities(d: t.Tables) -> DataFrame:
    """Articles of two days with their entity ids, where the first day's lookup never ran."""
    lake, first, second = _dated_lake(d), f"{D - timedelta(days=1):%Y%m%d}", f"{D:%Y%m%d}"
    lake.write_day(d.ids, "formatted", "Wikidata", second)

    def known(day: str) -> DataFrame:
        edited = lake.days(d.spark, "formatted", "Edits", [day], d.edits.schema).drop("day")
        ids = lake.optional_day(d.spark, "formatted", "Wikidata", day, d.ids.schema)
        return aggregates.join_entities(aggregates.edit_volumes(edited), ids).withColumn("day", F.lit(day))

    both = known(first).unionByName(known(second))
    return both.select("day", "project", "title", "edit_count", "wikidata_id")


@query
def target_day(d: t.Tables) -> DataFrame:
    """What a formatting run finds of a day after the drain: its edits, or that there are none."""
    lake = Lake(scratch(d.spark))
    d.messages.write.text(f"{lake.root}/topic")
    drain(file_messages(d.spark, f"{lake.root}/topic"), lake.path("raw", "Edits"), f"{lake.root}/state").awaitTermination()

    def found(day: str) -> DataFrame:
        try:
            rows = require_day(d.spark, lake, day)
        except MissingInput:
            return d.spark.range(1).select(F.lit(day).alias("day"), F.lit("missing").alias("status"), F.lit(0).cast("bigint").alias("edits"))
        return rows.agg(F.count("*").alias("edits")).select(F.lit(day).alias("day"), F.lit("landed").alias("status"), "edits")

    return found(f"{D:%Y%m%d}").unionByName(found("20231201"))


@query
def history_counts(d: t.Tables) -> DataFrame:
    """The history window from the counts kept beside the edits.

    Every twentieth edit lies in the next day's folder, one day has no folder, and one folder is counted again.
    """
    lake = Lake(scratch(d.spark))
    instant = F.col("timestamp_utc")
    filed = F.when(F.col("rev_id") % 20 == 0, instant + F.expr("INTERVAL 1 DAY")).otherwise(instant)
    lacking = [f for f in schemas.EDITS.fields if f.name not in d.edits.columns]
    rows = d.edits.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in lacking])
    rows = rows.withColumn("day", day_key(filed)).filter(F.col("day") != "20240115")
    lake.write_days(rows, "formatted", "Edits")
    folders = lake.observed_days(d.spark, "formatted", "Edits", schemas.EDITS, "20240101", "20240131")
    update_counts(d.spark, lake, folders)
    update_counts(d.spark, lake, ["20240116"])
    counts, days = past_counts(d.spark, lake, D, P)
    return counts.withColumn("history_days", F.lit(days))


@query
def published_tables(d: t.Tables) -> DataFrame:
    """Rows per table and day after all days were published, one of them again, and a run that never finished."""
    lake = Lake(scratch(d.spark))
    text = F.date_format("day", "yyyyMMdd")
    period = landed_once(d, d.once(_period).withColumn("day", text))
    tables = {"TrendingArticles": period, "CrossLanguageEvents": events_period(period)}
    days = [f"{t.FIRST_DAY + timedelta(days=n):%Y%m%d}" for n in range((t.LAST_DAY - t.FIRST_DAY).days + 1)]
    lake.publish("usage", tables, days)
    today = f"{D:%Y%m%d}"
    lake.publish("usage", {"TrendingArticles": period.filter(F.col("day") == today).filter("language_count = 1")}, [today])
    unfinished = period.withColumn("run", F.lit("99999999999999999999-lost"))
    unfinished.write.mode("append").partitionBy("run", "day").parquet(lake.path("usage", "TrendingArticles"))
    kinds = {"TrendingArticles": schemas.TRENDING, "CrossLanguageEvents": schemas.CROSS_LANGUAGE}
    read = [
        lake.published(d.spark, "usage", name, kind).groupBy("day").agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(name))
        for name, kind in kinds.items()
    ]
    return read[0].unionByName(read[1])


# ---- views


@query
def dump_parsed(d: t.Tables) -> DataFrame:
    parsed = views.parse_dump_lines(d.dump_lines)
    return parsed.select(views.hour_of_stamp(F.col("stamp")).alias("hour_utc"), "project", "title", "views")


@query
def hourly_merged(d: t.Tables) -> DataFrame:
    """Candidates' hourly views and the totals of all titles. Articles edited on D-1 or D follow."""
    candidates = views.candidate_articles(d.edits.filter(between_days(F.col("timestamp_utc"), D - timedelta(days=1), D)))
    return views.merge_hour(views.parse_dump_lines(d.dump_lines), candidates)


@query
def dump_hours_missing(d: t.Tables) -> DataFrame:
    """Hours of D without a dump or with several, and unreadable names.

    Each pair of a language and an hour with a click is a file here; the Russian ones have lost their name.
    """
    named = F.date_format(F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR"), "'pageviews-'yyyyMMdd-HHmmss")
    lost = F.date_format("ts", "'lost-'HH")
    name = F.when(F.col("project") == "ru.wikipedia", lost).otherwise(F.concat(named, F.lit(".gz")))
    files = d.events.filter(F.col("event_type") == "click").select(name.alias("file_name"), "project")
    return views.dump_problems(files.distinct(), D)


@query
def hourly_tsv(d: t.Tables) -> DataFrame:
    """Rows landed as tab-separated text, titles with quotes, in several files, read back."""
    folder = scratch(d.spark)
    title = F.concat(F.lit('"The"_'), "title", F.when(F.col("views") % 2 == 0, F.lit('"')).otherwise(F.lit("")))
    line = F.concat_ws("\t", F.date_format("hour_utc", "yyyy-MM-dd HH:mm:ss"), "project", title, F.col("views").cast("string"))
    d.hourly.select(line.alias("value")).repartition(5).write.text(folder)
    return views.normalize_hourly(views.read_hourly_tsv(d.spark, folder))


@query
def hourly_normalized(d: t.Tables) -> DataFrame:
    """Landed rows with text hours and underscored titles."""
    raw = d.hourly.select(
        F.date_format("hour_utc", "yyyy-MM-dd HH:mm:ss").alias("hour_utc"),
        "project",
        F.concat_ws("_", F.lit("The"), "title").alias("title"),
        "views",
    )
    return views.normalize_hourly(raw)


@query
def daily_views(d: t.Tables) -> DataFrame:
    """Views per article, totals left out: the side of ``readership`` that comes from hours."""
    return aggregates.readership(d.hourly, d.top).filter("views IS NOT NULL").select("project", "title", "views")


@query
def top_exploded(d: t.Tables) -> DataFrame:
    """Nested JSON lists back to rows."""
    article = F.struct(F.concat_ws("_", F.lit("The"), "article").alias("article"), "views", "rank")
    nested = (
        d.top.groupBy("date_utc", "project")
        .agg(F.array(F.struct(F.collect_list(article).alias("articles"))).alias("items"))
    )
    return views.explode_top(nested)


@query
def top_lists(d: t.Tables) -> DataFrame:
    """The run day's lists as landed, one file of several lines per language, read back by their names."""
    folder = scratch(d.spark)
    article = F.struct(F.concat_ws("_", F.lit("The"), "article").alias("article"), "views", "rank")
    lists = _top_today(d).groupBy("project").agg(F.array(F.struct(F.collect_list(article).alias("articles"))).alias("items"))
    body = F.to_json(F.struct("items"), {"pretty": "true"})
    named = lists.select(body.alias("value"), F.translate("project", ".", "_").alias("name"))
    named.write.partitionBy("name").text(f"{folder}/parts")
    path = d.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(d.spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{folder}/landed"))
    # a file per tracked language, under the name the download gives it
    for part in files.globStatus(path(f"{folder}/parts/name=*/part-*")):
        name = part.getPath().getParent().getName().removeprefix("name=")
        files.rename(part.getPath(), path(f"{folder}/landed/pageviews_{name}.json"))
    return views.read_daily_top(d.spark, f"{folder}/landed", f"{D:%Y%m%d}")


@query
def top_ranks(d: t.Tables) -> DataFrame:
    """Best rank per article: the side of ``readership`` that comes from the lists."""
    return aggregates.readership(d.hourly, d.top).filter("rank IS NOT NULL").select("project", "title", "rank")


# ---- trending


@query
def joined_readership(d: t.Tables) -> DataFrame:
    return joined_articles(d.once(_today), d.ids, d.once(_hourly_today), d.once(_top_today), P)


@query
def trending_scores(d: t.Tables) -> DataFrame:
    """The flagship of a whole period: every article of all days, scored."""
    joined = joined_articles(d.edits, d.ids, d.hourly, d.top, P)
    return aggregates.with_trending_score(joined)


@query
def edit_to_view(d: t.Tables) -> DataFrame:
    joined = joined_articles(d.once(_today), d.ids, d.once(_hourly_today), d.once(_top_today), P)
    return aggregates.by_ratio(aggregates.edit_to_view(joined))


@query
def observed_days(d: t.Tables) -> DataFrame:
    return emergence.observed_days(d.once(_past))


@query
def history(d: t.Tables) -> DataFrame:
    return emergence.daily_history(d.once(_past), d.once(_today))


@query
def emergence_scores(d: t.Tables) -> DataFrame:
    today = aggregates.edit_volumes(d.once(_today)).select("project", "title", "edit_count", "unique_editors")
    past = d.once(_past)
    return emergence.flag_emerging(today, emergence.daily_history(past), emergence.history_days(past), P)


@query
def trending(d: t.Tables) -> DataFrame:
    return d.once(_trending)


@query
def top_emerging(d: t.Tables) -> DataFrame:
    return emergence.top_emerging(d.once(_trending))


# ---- languages


@query
def language_signature(d: t.Tables) -> DataFrame:
    """Over all days at once: who edits the same entity, in which order, how late."""
    edited = aggregates.join_entities(aggregates.edit_volumes(d.edits), d.ids)
    articles = edited.withColumnRenamed("project", "edit_project")
    return languages.add_language_signature(
        articles.select("edit_project", "title", "wikidata_id", "first_edit", "edit_count")
    )


@query
def cross_language_events(d: t.Tables) -> DataFrame:
    return languages.by_reach(d.once(_events))


@query
def ordered_titles(d: t.Tables) -> DataFrame:
    """Every day's articles of multilingual entities, numbered within their entity over all days."""
    return languages.ordered_titles(d.once(_period))


@query
def cross_language_titles(d: t.Tables) -> DataFrame:
    return languages.cross_language_titles(d.once(_trending))


# ---- lead-lag


@query
def hourly_edits(d: t.Tables) -> DataFrame:
    return leadlag.hourly_edits(d.edits, E, P)


@query
def active_articles(d: t.Tables) -> DataFrame:
    return leadlag.active_articles(leadlag.hourly_edits(d.edits, E, P), P)


@query
def diurnal_factors(d: t.Tables) -> DataFrame:
    factors = leadlag.diurnal_factors(d.hourly, E, P)
    return factors.select("project", F.explode("factors").alias("slot", "factor")).select(
        "project", "slot", F.round("factor", 8).alias("factor")
    )


@query
def views_adjusted(d: t.Tables) -> DataFrame:
    by_hour = leadlag.hourly_views(d.hourly, E, P)
    adjusted = leadlag.adjusted_views(by_hour, leadlag.diurnal_factors(d.hourly, E, P))
    return adjusted.withColumn("views_adj", F.round("views_adj", 6))


@query
def lag_correlations(d: t.Tables) -> DataFrame:
    series = leadlag.article_series(d.edits, d.hourly, E, P)
    return leadlag.lag_correlations(series, P).withColumn("corr", F.round("corr", 6))


@query
def lead_lag(d: t.Tables) -> DataFrame:
    return d.once(_leadlag).withColumn("p_value", F.round("p_value", 6))


@query
def top_edit_led(d: t.Tables) -> DataFrame:
    return leadlag.top_edit_led(d.once(_leadlag))


# ---- reports and panels


@query
def pattern_counts(d: t.Tables) -> DataFrame:
    return reports.pattern_counts(d.once(_leadlag))


@query
def pattern_share(d: t.Tables) -> DataFrame:
    return reports.pattern_share(d.once(_leadlag))


@query
def pattern_profile(d: t.Tables) -> DataFrame:
    return reports.pattern_profile(d.once(_leadlag))


@query
def panel_lag_histogram(d: t.Tables) -> DataFrame:
    return reports.lag_histogram(d.once(_leadlag))


@query
def panel_edit_led(d: t.Tables) -> DataFrame:
    return reports.edit_led_count(d.once(_leadlag))


@query
def panel_articles(d: t.Tables) -> DataFrame:
    return reports.article_count(d.once(_trending))


@query
def panel_emerging(d: t.Tables) -> DataFrame:
    return reports.emerging_count(d.once(_trending))


@query
def panel_multilingual(d: t.Tables) -> DataFrame:
    return reports.multilingual_count(d.once(_events))


@query
def panel_emerging_table(d: t.Tables) -> DataFrame:
    return reports.emerging_table(d.once(_trending))


@query
def trending_days(d: t.Tables) -> DataFrame:
    """The whole trending table of every day."""
    return d.once(_period)


@query
def events_days(d: t.Tables) -> DataFrame:
    return d.once(_period_events)


@query
def panel_emerging_per_day(d: t.Tables) -> DataFrame:
    return reports.emerging_per_day(d.once(_period), t.FIRST_DAY, t.LAST_DAY)


@query
def panel_search(d: t.Tables) -> DataFrame:
    return reports.multilingual_search(d.once(_events))


@query
def panel_first_languages(d: t.Tables) -> DataFrame:
    return reports.first_languages(d.once(_period_events))


@query
def rolling_articles(d: t.Tables) -> DataFrame:
    return reports.article_count(reports.rolling(d.once(_period), D, 14))


@query
def headline_totals(d: t.Tables) -> DataFrame:
    return reports.headline_totals(d.edits, d.once(_period), d.once(_period_events))


# ---- gates


@query
def quality_edits(d: t.Tables) -> DataFrame:
    return quality.edit_rules(d.edits, D, P)


@query
def quality_trending(d: t.Tables) -> DataFrame:
    return quality.trending_rules(d.once(_trending), P)


@query
def quality_ids(d: t.Tables) -> DataFrame:
    return quality.id_rules(d.ids, P)


@query
def view_match(d: t.Tables) -> DataFrame:
    return quality.view_match(d.once(_trending))


@query
def missing_projects(d: t.Tables) -> DataFrame:
    """Tracked languages in which no edit is larger than 400."""
    return quality.missing_projects(d.edits.filter("edit_size > 400"), P)


# ---- entities


@query
def request_batches(d: t.Tables) -> DataFrame:
    batches = entities.request_batches(d.order_titles, P)
    return batches.select("project", "batch", F.array_join("titles", "|").alias("titles"))


@query
def redirect_chains(d: t.Tables) -> DataFrame:
    return entities.resolve_chains(d.part_renames)


@query
def entity_ids(d: t.Tables) -> DataFrame:
    return landed.ids_from_responses(d.responses)


@query
def response_problems(d: t.Tables) -> DataFrame:
    """Every response given a status from its part's size: the unusable ones, counted."""
    size = F.col("titles")[0]
    status = (
        F.when(size.endswith("7"), 429).when(size.endswith("8"), 503).when(size.endswith("9"), 404).otherwise(200)
    )
    return landed.response_problems(d.responses.withColumn("status", status))


# ---- documents


@query
def documents_keyed(d: t.Tables) -> DataFrame:
    """Ids and a few values read back from the JSON of every published article and entity."""
    day = f"{D:%Y%m%d}"
    published = landed_once(d, d.once(_trending))
    both = documents.to_documents(published, "wikipedia-trending", day).unionByName(
        documents.to_documents(languages.cross_language_events(published), "wikipedia-crosslang", day)
    )
    value = lambda path: F.get_json_object("_source", f"$.{path}")
    return both.select(
        "_index",
        "_id",
        value("date").alias("date"),
        value("wikidata_id").alias("wikidata_id"),
        value("language_count").cast("bigint").alias("language_count"),
        value("is_emerging").alias("is_emerging"),
    )


def _multilingual_only(batch: list[documents.Document], attempt: int) -> list[tuple[str, str]]:
    """A target that is busy at first, and takes only what is edited in several languages."""
    if attempt == 0 and batch[0][1] < "8":
        raise documents.Busy("busy")
    return [(key, "one language") for _, key, source in batch if json.loads(source)["language_count"] < 2]


@query
def documents_rejected(d: t.Tables) -> DataFrame:
    """What a target refuses of the day's documents, as the table kept of it."""
    lake, day = Lake(scratch(d.spark)), f"{D:%Y%m%d}"
    lake.write_day(documents.to_documents(d.once(_trending), "wikipedia-trending", day), "documents", "wikipedia-trending", day)
    sent = lake.days(d.spark, "documents", "wikipedia-trending", [day], DOCUMENT).drop("day")
    lake.write_day(documents.delivered(sent, _multilingual_only, wait=0.01), "documents", "rejects", day)
    return lake.days(d.spark, "documents", "rejects", [day], documents.REJECTS).drop("day")


@query
def documents_in_parts(d: t.Tables) -> DataFrame:
    """A day's documents written by many tasks and read as one table, after a first run with others."""
    lake, day = Lake(scratch(d.spark)), f"{D:%Y%m%d}"
    every = aggregates.edit_volumes(d.edits).withColumnRenamed("project", "edit_project")
    for rows in (every.filter("edit_count > 1"), every):
        parts = documents.to_documents(rows, "wikipedia-trending", day).repartition(16, "_id")
        lake.write_day(parts, "documents", "wikipedia-trending", day)
    read = lake.days(d.spark, "documents", "wikipedia-trending", [day], DOCUMENT)
    return read.select("_index", "_id", F.get_json_object("_source", "$.edit_count").cast("bigint").alias("edit_count"))


@query
def documents_upserted(d: t.Tables) -> DataFrame:
    """The day's documents over those of all days: an article's newer document replaces the older."""
    columns = ["edit_project", "title", "edit_count"]
    every = aggregates.edit_volumes(d.edits).withColumnRenamed("project", "edit_project").select(columns)
    today = aggregates.edit_volumes(d.once(_today)).withColumnRenamed("project", "edit_project").select(columns)
    merged = documents.upserted(
        documents.to_documents(every, "wikipedia-trending", "20240130"),
        documents.to_documents(today, "wikipedia-trending", "20240130"),
    )
    return merged.select("_id", F.get_json_object("_source", "$.edit_count").cast("bigint").alias("edit_count"))
