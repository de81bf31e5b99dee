"""A third of all rows under one key: right results, and no task that gets the whole group."""

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, emergence, entities, languages, leadlag
from tidemark.sources import views

ROWS = 90_000
LANGUAGES = ("en", "fr", "de", "es", "ru")


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture
def no_broadcast(spark):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
    ):
        yield


def project(n):
    return F.concat(F.element_at(F.array(*map(F.lit, LANGUAGES)), (n % 5 + 1).cast("int")), F.lit(".wikipedia.org"))


@pytest.fixture(scope="module")
def edits(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(ROWS, numPartitions=16).select(
        F.when(hot, "en.wikipedia.org").otherwise(project(F.col("id"))).alias("project"),
        F.when(hot, "Hot").otherwise(F.concat(F.lit("T"), (F.col("id") % 7001).cast("string"))).alias("title"),
        (F.col("id") % 5003).cast("string").alias("user"),
        F.timestamp_seconds(F.lit(1790812800) + F.col("id") % 86400).alias("timestamp_utc"),
        F.lit(1).cast("bigint").alias("edit_size"),
    )


def test_hot_article(spark, edits, no_broadcast):
    hot = aggregates.edit_volumes(edits).filter("title = 'Hot'").first()
    assert (hot["edit_count"], hot["unique_editors"]) == (ROWS // 3, 5003)
    history = emergence.daily_history(edits.withColumn("day", F.lit("20261001"))).filter("title = 'Hot'").first()
    assert (history["edit_count"], history["unique_editors"]) == (ROWS // 3, 5003)


def test_hot_article_meets_its_editors_in_many_tasks(edits):
    """The distinct count first combines by article and editor, then by article."""
    plan = aggregates.edit_volumes(edits)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert "user" in shuffles[-1] and "partial_" in plan


def test_hot_article_in_lead_lag(spark, edits, no_broadcast):
    seen = edits.select(
        F.date_trunc("hour", "timestamp_utc").alias("hour_utc"),
        F.regexp_replace("project", r"\.org$", "").alias("project"),
        "title",
        F.col("edit_size").alias("views"),
    )
    hot = leadlag.day_patterns(edits, seen, date(2026, 10, 1)).filter("title = 'Hot'").first()
    assert (hot["event_edits"], hot["total_views"], hot["best_lag_hours"]) == (ROWS // 3, ROWS // 3, 0)


def test_hot_entity_is_split_by_the_join(spark, no_broadcast):
    articles = spark.range(ROWS, numPartitions=16).select(
        F.sha2(F.col("id").cast("string"), 256).alias("title"),
        project(F.col("id")).alias("edit_project"),
        F.when(F.col("id") % 3 == 0, "Qhot").otherwise(F.concat(F.lit("Q"), F.col("id").cast("string"))).alias("wikidata_id"),
        F.timestamp_seconds(F.lit(1790812800) + F.col("id") % 86400).alias("first_edit"),
    )
    signed = languages.add_language_signature(articles)
    counts = signed.groupBy("language_count").agg(F.count("*"), F.max("title"))
    assert sorted(tuple(r)[:2] for r in counts.collect()) == [(1, 2 * ROWS // 3), (5, ROWS // 3)]
    assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()


def test_hot_title_in_a_dump(spark, no_broadcast):
    lines = spark.range(ROWS, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "en Hot 1 0").otherwise(F.concat(F.lit("fr.m T"), F.col("id").cast("string"), F.lit(" 1 0"))).alias("value"),
        F.lit("pageviews-20261002-120000.gz").alias("file_name"),
    )
    followed = spark.createDataFrame([("en.wikipedia", "Hot"), ("fr.wikipedia", "T1")], "project STRING, title STRING")
    out = views.merge_hour(views.parse_dump_lines(lines), followed.distinct())
    assert sorted((r["project"], r["title"], r["views"]) for r in out.collect()) == [
        ("en.wikipedia", "-", ROWS // 3), ("en.wikipedia", "Hot", ROWS // 3), ("fr.wikipedia", "-", 2 * ROWS // 3),
        ("fr.wikipedia", "T1", 1),
    ]
    # the hot title is summed in each task before it travels, so there is nothing left to split
    lines = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[1].splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(below) == 4 and all("HashAggregate" in line for line in below)


def test_hot_redirect_target(spark, no_broadcast):
    """A third of all titles lead to one page; its id reaches them all, from many tasks."""
    titles = spark.range(ROWS // 3, numPartitions=16).select(F.lit("en").alias("project"), F.sha2(F.col("id").cast("string"), 256).alias("title"), "id")
    edges = titles.select("project", F.col("title").alias("from"), F.when(F.col("id") % 3 == 0, "Hub").otherwise(F.concat(F.lit("P"), F.col("id").cast("string"))).alias("to"))
    pages = spark.createDataFrame([("en", "Hub", "Q1"), ("en", "P1", "Q2")], "project STRING, title STRING, wikidata_id STRING")
    out = entities.resolve_ids(titles, edges, pages)
    counts = out.groupBy("wikidata_id").agg(F.count("*"), F.max("title"))
    assert sorted((tuple(r)[:2] for r in counts.collect()), key=repr) == [("Q1", ROWS // 9), ("Q2", 1), (None, 2 * ROWS // 9 - 1)]
    assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()
