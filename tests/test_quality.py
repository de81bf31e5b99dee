from datetime import timedelta

import pytest
from conftest import at, rows

from tidemark.operators import quality
from tidemark.params import PROJECTS, Params

EDITS = "timestamp_utc TIMESTAMP, project STRING"
ALL = [f"{p}.org" for p in PROJECTS]


def edits(spark, per_project=200, projects=ALL, off_day=0):
    noon = at("2026-10-01 12:00")
    data = [(noon, p) for p in projects for _ in range(per_project)]
    data = [(noon + timedelta(days=1), p) for _, p in data[:off_day]] + data[off_day:]
    return spark.createDataFrame(data, EDITS)


def failed(rules):
    return {r["rule"] for r in rules.collect() if not r["ok"]}


def test_normal_day_passes(spark, day):
    quality.enforce(quality.edit_rules(edits(spark), day), "Edits")


def test_each_edit_rule(spark, day):
    assert failed(quality.edit_rules(edits(spark, 8), day)) == {"daily_edits"}
    assert failed(quality.edit_rules(edits(spark, 300, ALL[:4]), day)) == {"edits:ru.wikipedia.org"}
    assert failed(quality.edit_rules(edits(spark, off_day=400), day)) == {"in_day_share"}


def test_all_problems_are_reported_together(spark, day):
    with pytest.raises(quality.DataQualityError) as error:
        quality.enforce(quality.edit_rules(edits(spark, 3, ALL[:4], off_day=6), day), "Edits")
    assert all(x in str(error.value) for x in ("daily_edits", "edits:ru.wikipedia.org", "in_day_share"))


def test_empty_day_fails(spark, day):
    assert "daily_edits" in failed(quality.edit_rules(edits(spark, 0), day))


def test_share_dated_on_the_day(spark, day):
    df = spark.createDataFrame(
        [(at("2026-10-01 00:00"), "a"), (at("2026-10-01 23:59:59"), "a"), (at("2026-09-30 23:59:59"), "b"), (at("2026-10-02 00:00"), "b")],
        EDITS,
    )
    got = {r["rule"]: r["value"] for r in quality.edit_rules(df, day).collect()}
    assert (got["daily_edits"], got["in_day_share"]) == (4.0, 0.5)
    assert rows(quality.edit_metrics(df, day)) == [("a", 2, 2), ("b", 2, 0)]


def test_missing_projects(spark):
    df = spark.createDataFrame([(p,) for p in ALL[:3]], "project STRING")
    assert rows(quality.missing_projects(df)) == [("es.wikipedia.org",), ("ru.wikipedia.org",)]


TRENDING = "edit_project STRING, title STRING, pageviews BIGINT, is_emerging BOOLEAN"


def trending(spark, n=100, viewed=99, emerging=1, extra=()):
    data = [("fr.wikipedia.org", f"T{i}", int(i < viewed), i < emerging) for i in range(n)]
    return spark.createDataFrame([*data, *extra], TRENDING)


def test_normal_trending_passes(spark):
    quality.enforce(quality.trending_rules(trending(spark)), "Trending")
    quality.enforce(quality.trending_rules(trending(spark, 0)), "Trending")


def test_each_trending_rule(spark):
    assert failed(quality.trending_rules(trending(spark, viewed=2))) == {"view_match:fr.wikipedia.org"}
    again = [("fr.wikipedia.org", "T1", 1, False)]
    assert failed(quality.trending_rules(trending(spark, extra=again))) == {"duplicate_articles"}
    assert failed(quality.trending_rules(trending(spark, 10, 10, 1))) == {"emerging_share"}


def test_limits_themselves_pass(spark):
    assert failed(quality.trending_rules(trending(spark, 100, 80, 5))) == set()


def test_one_bad_language_is_enough(spark):
    extra = [("de.wikipedia.org", "X", 0, False)]
    assert failed(quality.trending_rules(trending(spark, extra=extra))) == {"view_match:de.wikipedia.org"}


IDS = "project STRING, title STRING, wikidata_id STRING"


def test_id_rate(spark):
    none = spark.createDataFrame([("fr", f"T{i}", None) for i in range(10)], IDS)
    half = spark.createDataFrame([("fr", f"T{i}", "Q1" if i < 5 else None) for i in range(10)], IDS)
    assert failed(quality.id_rules(none)) == {"id_rate"} and failed(quality.id_rules(half)) == set()
    assert failed(quality.id_rules(none.limit(0))) == {"id_rate"}
    assert failed(quality.id_rules(half, Params(min_id_rate=0.6))) == {"id_rate"}
