from datetime import timedelta

from conftest import at, rows
from pyspark.sql import functions as F

from tidemark.operators import languages

ROWS = (
    "title STRING, edit_project STRING, wikidata_id STRING, first_edit TIMESTAMP, edit_count BIGINT, "
    "unique_editors BIGINT, pageviews BIGINT, is_emerging BOOLEAN"
)
T0 = at("2026-10-01 10:00")
EN, FR, DE = "en.wikipedia.org", "fr.wikipedia.org", "de.wikipedia.org"


def row(title, project, qid, minutes=0.0, edits=4, editors=3, views=90, emerging=False):
    return (title, project, qid, T0 + timedelta(minutes=minutes), edits, editors, views, emerging)


def signed(spark, data):
    return languages.add_language_signature(spark.createDataFrame(data, ROWS))


def test_signature(spark):
    out = signed(spark, [row("Eiffel Tower", EN, "Q243", 30), row("Tour Eiffel", FR, "Q243"), row("Paris", EN, "Q90"), row("Paris", DE, None)])
    assert rows(out, "title", "edit_project", "language_count", "first_language", "languages_editing", "language_lag_minutes") == [
        ("Eiffel Tower", EN, 2, FR, f"{FR},{EN}", 30.0), ("Paris", DE, 1, DE, DE, 0.0),
        ("Paris", EN, 1, EN, EN, 0.0), ("Tour Eiffel", FR, 2, FR, f"{FR},{EN}", 0.0),
    ]
    assert {r["entity_key"] for r in out.collect()} == {"Q243", "Q90", f"{DE}|Paris"}


def test_two_titles_of_a_language_count_once(spark):
    out = signed(spark, [row("A", EN, "Q1", 5), row("B", EN, "Q1", 0), row("C", FR, "Q1", 2)])
    assert set(rows(out, "language_count", "languages_editing")) == {(2, f"{EN},{FR}")}


def test_same_minute_orders_by_project(spark):
    out = signed(spark, [row("A", FR, "Q1"), row("B", EN, "Q1")])
    assert set(rows(out, "languages_editing")) == {(f"{EN},{FR}",)}


def test_lag_rounds_half_to_even(spark):
    out = signed(spark, [row("A", EN, "Q1"), row("B", FR, "Q1", 3 / 60), row("C", DE, "Q1", 9 / 60)])
    assert rows(out, "title", "language_lag_minutes") == [("A", 0.0), ("B", 0.0), ("C", 0.2)]


def test_cross_language_event(spark):
    data = [row("Eiffel Tower", EN, "Q243", 45, emerging=True), row("Tour Eiffel", FR, "Q243"), row("Paris", EN, "Q90"), row("X", DE, None)]
    out = languages.cross_language_events(signed(spark, data)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["wikidata_id"], r["language_count"], r["first_language"], r["spread_minutes"]) == ("Q243", 2, FR, 45.0)
    assert r["titles"] == "fr:Tour Eiffel | en:Eiffel Tower"
    assert (r["total_edits"], r["sum_editors"], r["total_pageviews"]) == (8, 6, 180)
    assert (r["emerging_languages"], r["is_emerging"]) == (1, True)


def test_no_event_keeps_the_shape(spark):
    from tidemark import schemas

    out = languages.cross_language_events(signed(spark, [row("Paris", EN, "Q90")]))
    assert out.count() == 0 and out.columns == schemas.CROSS_LANGUAGE.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.CROSS_LANGUAGE]


def test_titles_of_a_hot_entity_stay_in_order(spark):
    data = [row(f"T{i:04d}", (EN, FR, DE)[i % 3], "Q1", (i * 7919 % 3000) / 10) for i in range(3000)]
    out = languages.cross_language_events(signed(spark, data)).first()
    ordered = sorted(data, key=lambda r: (r[3], r[1], r[0]))
    assert out["titles"] == " | ".join(f"{r[1].split('.')[0]}:{r[0]}" for r in ordered)
    assert out["sum_editors"] == 9000
    assert languages.cross_language_titles(signed(spark, data)).count() == 3000


def test_hot_entity_without_broadcast(spark):
    hot = [row(f"T{i}", (EN, FR)[i % 2], "Q1" if i % 3 == 0 else f"Q{i}", i % 50) for i in range(600)]
    small = rows(signed(spark, hot))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(signed(spark, hot)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reach_order(spark):
    df = spark.createDataFrame([("Q1", 2, 9), ("Q2", 3, 1), ("Q3", 2, 10)], "wikidata_id STRING, language_count BIGINT, sum_editors BIGINT")
    assert [r[0] for r in languages.by_reach(df).collect()] == ["Q2", "Q3", "Q1"]
    assert languages.by_reach(df.filter(F.lit(False))).count() == 0
