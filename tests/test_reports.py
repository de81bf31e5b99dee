from datetime import date, timedelta

import numpy as np
from conftest import rows

from tidemark.operators import reports

FIRST = date(2026, 10, 1)
EN, FR, DE = "en.wikipedia.org", "fr.wikipedia.org", "de.wikipedia.org"
TREND = (
    "day DATE, edit_project STRING, title STRING, is_emerging BOOLEAN, unique_editors BIGINT, "
    "baseline_editors DOUBLE, z_editors DOUBLE, pageviews BIGINT, language_count BIGINT"
)


def trend(offset, project, title, z, emerging=True):
    return (FIRST + timedelta(days=offset), project, title, emerging, int(z) + 3, 1.0, float(z), 100, 2)


def test_emerging_table_ranks_titles_then_languages(spark):
    data = [trend(0, EN, "A", 9), trend(0, FR, "A", 4), trend(1, FR, "A", 7), trend(0, DE, "B", 8), trend(0, EN, "C", 5), trend(0, EN, "D", 99, False)]
    out = reports.emerging_table(spark.createDataFrame(data, TREND), titles=2, languages=1)
    assert rows(out, "title", "title_z", "edit_project", "place", "z") == [("A", 9.0, EN, 1, 9.0), ("B", 8.0, DE, 1, 8.0)]
    both = reports.emerging_table(spark.createDataFrame(data, TREND), titles=1, languages=5)
    assert rows(both, "edit_project", "place", "z", "editors") == [(EN, 1, 9.0, 12), (FR, 2, 7.0, 10)]


def test_empty_days_are_shown(spark):
    data = [trend(0, EN, "A", 9), trend(0, EN, "B", 9), trend(2, FR, "A", 4), trend(1, DE, "X", 4, False)]
    out = reports.emerging_per_day(spark.createDataFrame(data, TREND), FIRST, FIRST + timedelta(days=2))
    assert [(r["day"].day, r["edit_project"], r["emerging"]) for r in out.orderBy("day", "edit_project").collect()] == [
        (1, EN, 2), (1, FR, 0), (2, EN, 0), (2, FR, 0), (3, EN, 0), (3, FR, 1),
    ]


def test_rolling_window_bounds(spark):
    df = spark.createDataFrame([trend(i, EN, "A", 1) for i in range(40)], TREND)
    assert reports.rolling(df, FIRST + timedelta(days=35)).count() == 31


LAGS = "pattern STRING, best_lag_hours INT"


def lags(spark):
    data = [("edit_led", 3)] * 3 + [("edit_led", 12)] + [("view_led", -4), ("view_led", -6)] + [("decorrelated", None)] * 2 + [("decorrelated", 5), ("simultaneous", 0)]
    return spark.createDataFrame(data, LAGS)


def test_pattern_reports(spark):
    assert rows(reports.pattern_counts(lags(spark))) == [("decorrelated", 3), ("edit_led", 4), ("simultaneous", 1), ("view_led", 2)]
    assert rows(reports.pattern_share(lags(spark), 2), "pattern", "percent") == [("decorrelated", 30.0), ("edit_led", 40.0)]
    assert rows(reports.lag_histogram(lags(spark))) == [(-4, "view_led", 1), (-6, "view_led", 1), (0, "simultaneous", 1), (12, "edit_led", 1), (3, "edit_led", 3)]
    assert reports.edit_led_count(lags(spark)).first()[0] == 4


def test_median_lag_is_read_off_the_counts(spark):
    got = {r["pattern"]: (r["articles"], r["share"], r["median_lag_hours"]) for r in reports.pattern_profile(lags(spark)).collect()}
    assert got == {"edit_led": (4, 0.4, 3.0), "view_led": (2, 0.2, -5.0), "decorrelated": (3, 0.3, 5.0), "simultaneous": (1, 0.1, 0.0)}
    rng = np.random.default_rng(3)
    many = [(f"p{i % 3}", int(rng.integers(-12, 25))) for i in range(500)]
    got = {r["pattern"]: r["median_lag_hours"] for r in reports.pattern_profile(spark.createDataFrame(many, LAGS)).collect()}
    assert got == {p: float(np.median([x for q, x in many if q == p])) for p in got}


def test_pattern_without_any_lag(spark):
    only = spark.createDataFrame([("decorrelated", None)], LAGS)
    assert reports.pattern_profile(only).first()["median_lag_hours"] is None


def test_totals(spark):
    one = spark.createDataFrame([trend(0, EN, "A", 9), trend(0, EN, "B", 9, False)], TREND)
    got = dict(rows(reports.headline_totals(one.union(one), one, one.limit(1))))
    assert got == {"edits": 4, "article_days": 2, "emerging": 1, "multilingual_subjects": 1}
