"""A range of days at once has the rows each day has alone."""

from datetime import date, timedelta

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks.queries import QUERIES
from tidemark.operators import emergence
from tidemark.params import Params
from tidemark.plans.daily import trending_articles
from tidemark.plans.period import events_period, trending_period
from tidemark.sources.lake import Lake

FIRST = date(2026, 10, 1)
EDITS = "timestamp_utc TIMESTAMP, project STRING, title STRING, user STRING, edit_size BIGINT"
PARAMS = Params(history_days=4, min_history_days=2, z_threshold=2.0)


def some_edits():
    for n in range(12):
        if n == 5:
            continue  # a day nobody observed
        for k, project in enumerate(("en.wikipedia.org", "fr.wikipedia.org", "de.wikipedia.org")):
            for title in range(3):
                for user in range((n * (title + 1) + k) % 6):
                    yield at(f"2026-10-{n + 1:02d} 0{user}:{k}{title}"), project, f"T{title}", f"u{user % 4}", 10
    yield at("2026-10-12 09:00"), "en.wikipedia.org", "New", "u1", 1


@pytest.fixture(scope="module")
def inputs(spark):
    edits = spark.createDataFrame(list(some_edits()), EDITS)
    ids = spark.createDataFrame(
        [(p, f"T{t}", f"Q{t}" if t else None) for p in ("en.wikipedia.org", "fr.wikipedia.org") for t in range(3)], schemas.ENTITY_IDS
    )
    hourly = spark.createDataFrame(
        [(at(f"2026-10-{n + 1:02d} 0{h}:00"), "en.wikipedia", f"T{h % 3}", n + h) for n in range(12) for h in range(8)], schemas.HOURLY_VIEWS
    )
    top = spark.createDataFrame(
        [(at(f"2026-10-{n + 1:02d} 00:00"), "fr.wikipedia", n % 3 + 1, "T1", 9) for n in range(12)],
        "date_utc TIMESTAMP, project STRING, rank BIGINT, article STRING, views BIGINT",
    )
    return edits, ids, hourly, top


def alone(inputs, day):
    edits, ids, hourly, top = inputs
    past = emergence.past_edits(edits, day, PARAMS)
    of_day = lambda df, c: df.filter(F.to_date(c) == F.lit(day))
    return trending_articles(
        of_day(edits, "timestamp_utc"), emergence.daily_history(past), emergence.history_days(past), ids,
        of_day(hourly, "hour_utc"), of_day(top, "date_utc"), PARAMS,
    )


@pytest.fixture(scope="module")
def period(spark, inputs):
    return trending_period(*inputs, FIRST + timedelta(days=2), FIRST + timedelta(days=11), PARAMS).cache()


@pytest.mark.parametrize("n", [2, 3, 6, 9, 11])
def test_each_day_as_if_alone(inputs, period, n):
    day = FIRST + timedelta(days=n)
    assert rows(period.filter(F.col("day") == F.lit(day)).drop("day")) == rows(alone(inputs, day))


def test_only_the_days_asked_for(period):
    days = sorted(r["day"] for r in period.select("day").distinct().collect())
    assert days == [FIRST + timedelta(days=n) for n in range(2, 12) if n != 5]
    assert period.filter("is_emerging").count() > 0


def test_events_stay_within_their_day(period):
    events = events_period(period)
    per_day = period.filter("language_count >= 2 AND wikidata_id IS NOT NULL").select("day", "wikidata_id").distinct()
    assert rows(events, "day", "wikidata_id") == rows(per_day)


def test_edits_are_counted_once(inputs):
    """One aggregate of editors and one window over its days, however many days are asked for."""
    plan = trending_period(*inputs, FIRST, FIRST + timedelta(days=11), PARAMS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RangeFrame, -4, -1") >= 1 and "CollectList" not in plan


def test_nothing_after_the_counts_reads_the_edits(spark, inputs, tmp_path):
    edits, *others = inputs
    edits.write.parquet(str(tmp_path / "edits"))
    got = trending_period(spark.read.parquet(str(tmp_path / "edits")), *others, FIRST, FIRST + timedelta(days=11), PARAMS)
    assert got.inputFiles() and not [f for f in got.inputFiles() if str(tmp_path) in f]


def test_published_tables_start_from_written_rows(spark, monkeypatch):
    read, publish = [], Lake.publish

    def watched(self, layer, tables, days):
        read.extend(f for df in tables.values() for f in df.inputFiles())
        return publish(self, layer, tables, days)

    monkeypatch.setattr(Lake, "publish", watched)
    assert QUERIES["published_tables"](spark, "/root/testdata/sf0.001").count() > 0
    assert read and not [f for f in read if "events.parquet" in f]
