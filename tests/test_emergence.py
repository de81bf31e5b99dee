import numpy as np
from conftest import at, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import emergence
from tidemark.params import Params

TODAY = "project STRING, title STRING, edit_count BIGINT, unique_editors BIGINT"
HISTORY = "project STRING, title STRING, day STRING, edit_count BIGINT, unique_editors BIGINT"
FR = "fr.wikipedia.org"


def flagged(spark, today, history, days, params=Params()):
    df = emergence.flag_emerging(
        spark.createDataFrame([(FR, "Paris", *today)] if isinstance(today, tuple) else today, TODAY),
        spark.createDataFrame(history, HISTORY),
        days,
        params,
    )
    return df.first() if isinstance(today, tuple) else df


def week(counts):
    return [(FR, "Paris", f"2026092{i}", c, c) for i, c in enumerate(counts) if c]


def test_new_article(spark):
    r = flagged(spark, (8, 5), [], 5)
    assert (r["baseline_editors"], r["z_editors"], r["is_emerging"], r["history_days"]) == (0.0, 5.0, True, 5)
    assert (r["z_edits"], r["anomaly_score"]) == (8.0, 5.0)


def test_busy_article_at_its_usual_level(spark):
    r = flagged(spark, (6, 6), week([5, 6, 7, 6, 5]), 5)
    assert (r["baseline_editors"], r["z_editors"], r["is_emerging"]) == (6.0, 0.0, False)


def test_spike(spark):
    r = flagged(spark, (40, 30), week([5, 6, 7, 6, 5]), 5)
    assert r["z_editors"] >= 3.5 and r["is_emerging"]


def test_days_without_edits_count_as_zero(spark):
    r = flagged(spark, (4, 4), week([4, 0, 0, 0, 0]), 5)
    assert (r["baseline_editors"], r["z_editors"]) == (0.0, 4.0)


def test_few_editors_never_emerge(spark):
    assert not flagged(spark, (50, 2), [], 5)["is_emerging"]


def test_short_history(spark):
    r = flagged(spark, (9, 9), week([1, 1]), 2)
    assert (r["z_editors"], r["baseline_editors"], r["anomaly_score"], r["z_edits"]) == (None,) * 4
    assert r["is_emerging"] is False and r["history_days"] == 2


def test_languages_are_separate(spark):
    today = [(FR, "Paris", 6, 6), ("de.wikipedia.org", "Paris", 6, 6)]
    out = flagged(spark, today, week([6, 6, 6, 6, 6]), 5)
    assert rows(out, "project", "is_emerging") == [("de.wikipedia.org", True), (FR, False)]


def test_just_below_the_threshold(spark):
    r = flagged(spark, (4, 4), week([1, 1, 1, 0, 0]), 5)
    assert r["z_editors"] == 3.0 and not r["is_emerging"]


SOURCE = "timestamp_utc TIMESTAMP, project STRING, title STRING, user STRING"


def test_history_counts_and_window(spark, day):
    edits = spark.createDataFrame(
        [
            (at("2026-09-30 10:00"), FR, "Paris", "a"), (at("2026-09-30 11:00"), FR, "Paris", "a"),
            (at("2026-09-30 12:00"), FR, "Paris", "b"), (at("2026-09-29 23:59:59"), FR, "Paris", "a"),
            (at("2026-09-30 10:00"), FR, "Lyon", "a"), (at("2026-10-01 00:00"), FR, "Paris", "a"),
            (at("2026-09-03 00:00"), FR, "Paris", "z"), (at("2026-09-02 23:59:59"), FR, "Paris", "z"),
        ],
        SOURCE,
    )
    past = emergence.past_edits(edits, day)
    articles = spark.createDataFrame([(FR, "Paris")], "project STRING, title STRING")
    assert rows(emergence.daily_history(past, articles)) == [
        (FR, "Paris", "20260903", 1, 1), (FR, "Paris", "20260929", 1, 1), (FR, "Paris", "20260930", 3, 2),
    ]
    assert rows(emergence.observed_days(past)) == [("20260903",), ("20260929",), ("20260930",)]
    today = spark.createDataFrame([(FR, "New", 5, 5)], TODAY)
    r = emergence.flag_emerging(today, emergence.daily_history(past), emergence.history_days(past)).first()
    assert (r["history_days"], r["z_editors"]) == (3, 5.0)


def test_no_history_at_all(spark, day):
    past = emergence.past_edits(spark.createDataFrame([], SOURCE), day)
    today = spark.createDataFrame([(FR, "New", 5, 5)], TODAY)
    r = emergence.flag_emerging(today, emergence.daily_history(past), emergence.history_days(past)).first()
    assert (r["history_days"], r["z_editors"], r["is_emerging"]) == (0, None, False)


counts = st.lists(st.integers(0, 60), min_size=3, max_size=28)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 90), counts), min_size=1, max_size=12))
def test_scores_equal_the_dense_matrix(spark, articles):
    days = max(len(c) for _, c in articles)
    today, history, expected = [], [], {}
    for i, (x, past) in enumerate(articles):
        dense = np.array(past + [0] * (days - len(past)), dtype=float)
        center = np.median(dense)
        scale = max(1.4826 * np.median(np.abs(dense - center)), 1.0)
        today.append((FR, f"T{i}", x, x))
        history += [(FR, f"T{i}", f"d{j:02d}", c, c) for j, c in enumerate(past) if c]
        expected[f"T{i}"] = (center, round(float(np.round((x - center) / scale, 2)), 2))
    out = emergence.flag_emerging(
        spark.createDataFrame(today, TODAY), spark.createDataFrame(history, HISTORY), days
    )
    for r in out.collect():
        assert (r["baseline_editors"], r["z_editors"]) == expected[r["title"]]
