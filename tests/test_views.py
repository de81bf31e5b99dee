import gzip
import json

from conftest import at, rows

from tidemark.operators import aggregates
from tidemark.sources import views


def test_dump_is_named_after_the_end_of_its_hour(spark):
    df = spark.createDataFrame(
        [("pageviews-20261002-120000.gz",), ("pageviews-20261101-000000.gz",), ("other.gz",)], "n STRING"
    )
    got = [r[0] and r[0].isoformat() for r in df.select(views.hour_of_stamp(views.stamp_of_dump(df["n"]))).collect()]
    assert got == ["2026-10-02T11:00:00", "2026-10-31T23:00:00", None]


LINES = ["es.m Puente_viejo 41 7", "de Windrad 8 2", "wikidata Q77 6 0", "de Windrad 8x 0", "ru Мост", "es"]


def test_lines_of_dump_files(spark, tmp_path):
    with gzip.open(tmp_path / "pageviews-20261002-120000.gz", "wt") as out:
        out.write("\n".join(LINES))
    parsed = views.parse_dump_lines(views.read_dump_lines(spark, str(tmp_path)))
    assert rows(parsed, "project", "title", "views") == [
        ("de.wikipedia", "Windrad", 8), ("es.wikipedia", "Puente_viejo", 41),
    ]
    assert {r["stamp"] for r in parsed.collect()} == {"20261002-1200"}


def parsed(spark, lines):
    df = spark.createDataFrame([(x, "pageviews-20261002-120000.gz") for x in lines], "value STRING, file_name STRING")
    return views.parse_dump_lines(df)


def test_sites_merge_and_totals_cover_everything(spark):
    lines = ["ru Delta 31 0", "de Delta 640 0", "ru.m Echo 4 0", "ru.m Delta 13 0"]
    candidates = spark.createDataFrame([("ru.wikipedia", "Delta"), ("es.wikipedia", "Delta")], "project STRING, title STRING")
    out = views.merge_hour(parsed(spark, lines), candidates)
    assert rows(out, "project", "title", "views") == [
        ("de.wikipedia", "-", 640), ("ru.wikipedia", "-", 48), ("ru.wikipedia", "Delta", 44),
    ]


def test_no_broadcast_gives_the_same_merge(spark):
    lines = [f"fr T{i % 50} {i} 0" for i in range(500)] + ["fr T1 7 0"] * 500
    candidates = spark.createDataFrame([("fr.wikipedia", f"T{i}") for i in range(10)], "project STRING, title STRING")
    small = rows(views.merge_hour(parsed(spark, lines), candidates))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(views.merge_hour(parsed(spark, lines), candidates)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(small) == 11


def test_candidates_use_dump_spelling(spark):
    df = spark.createDataFrame([("es.wikipedia.org", "Puente de hierro")] * 2, "project STRING, title STRING")
    assert rows(views.candidate_articles(df)) == [("es.wikipedia", "Puente_de_hierro")]


def test_hourly_rows_are_normalized(spark):
    df = spark.createDataFrame([("2026-10-01 13:00:00", "fr.wikipedia", "Tour_Eiffel_2", 5)],
                               "hour_utc STRING, project STRING, title STRING, views BIGINT")
    out = views.normalize_hourly(df).first()
    assert out["hour_utc"].isoformat() == "2026-10-01T13:00:00" and out["title"] == "Tour Eiffel 2"


def test_tsv_titles_keep_their_quotes(spark, tmp_path):
    with gzip.open(tmp_path / "hourly.tsv.gz", "wt") as out:
        out.write('2026-10-01 13:00:00\tfr.wikipedia\t"Heroes"\t5\n2026-10-01 13:00:00\tfr.wikipedia\t"Open\t6\n')
    got = views.read_hourly_tsv(spark, str(tmp_path))
    assert rows(got, "title", "views") == [('"Heroes"', 5), ('"Open', 6)]


def test_daily_top_files(spark, tmp_path):
    body = {"items": [{"articles": [{"article": "Tour_Eiffel", "views": 9, "rank": 1}, {"article": "Paris", "views": 5, "rank": 2}]}]}
    (tmp_path / "pageviews_fr_wikipedia.json").write_text(json.dumps(body, indent=2))
    body["items"][0]["articles"] = [{"article": "London", "views": 7, "rank": 1}]
    (tmp_path / "pageviews_en_wikipedia.json").write_text(json.dumps(body, indent=2))
    out = views.read_daily_top(spark, str(tmp_path), "20261001")
    assert rows(out, "project", "article", "rank", "views") == [
        ("en.wikipedia", "London", 1, 7), ("fr.wikipedia", "Paris", 2, 5), ("fr.wikipedia", "Tour Eiffel", 1, 9),
    ]
    assert out.first()["date_utc"].isoformat() == "2026-10-01T00:00:00"


HOURLY = "project STRING, title STRING, views BIGINT"


TOP = "article STRING, project STRING, views BIGINT, rank BIGINT"
def test_views_of_a_day_leave_totals_out(spark):
    df = spark.createDataFrame([("de.wikipedia", "-", 8150), ("de.wikipedia", "Windrad", 26), ("de.wikipedia", "Windrad", 11)], HOURLY)
    none = spark.createDataFrame([], TOP)
    assert rows(aggregates.readership(df, none)) == [("de.wikipedia", "Windrad", 37, None)]


EDITED = "title STRING, project STRING, edit_count BIGINT"


def test_languages_never_meet(spark):
    edited = spark.createDataFrame([("Delta", "es.wikipedia.org", 6), ("Delta", "ru.wikipedia.org", 1)], EDITED)
    seen = spark.createDataFrame([("ru.wikipedia", "Delta", 73), ("de.wikipedia", "Delta", 5200)], HOURLY)
    top = spark.createDataFrame([("Delta", "ru.wikipedia", 73, 31), ("Delta", "ru.wikipedia", 73, 17)], TOP)
    out = aggregates.join_readership(edited, aggregates.readership(seen, top))
    assert rows(out, "edit_project", "pageview_project", "pageviews", "pageview_rank") == [
        ("es.wikipedia.org", "es.wikipedia", 0, 9999), ("ru.wikipedia.org", "ru.wikipedia", 73, 17),
    ]


def test_views_without_rank_and_underscored_top(spark):
    edited = spark.createDataFrame([("Lyon", "fr.wikipedia.org", 1), ("Tour Eiffel", "fr.wikipedia.org", 1)], EDITED)
    seen = spark.createDataFrame([("fr.wikipedia", "Lyon", 12)], HOURLY)
    top = spark.createDataFrame([("Tour_Eiffel", "fr.wikipedia", 5, 3)], TOP)
    out = aggregates.join_readership(edited, aggregates.readership(seen, top))
    assert rows(out, "title", "pageviews", "pageview_rank") == [("Lyon", 12, 9999), ("Tour Eiffel", 0, 3)]


def test_velocity(spark):
    df = spark.createDataFrame(
        [
            ("p", "A", 5, "u", at("2026-10-01 10:00")), ("p", "A", -7, "u", at("2026-10-01 10:06")),
            ("p", "A", None, None, at("2026-10-01 10:03")), ("p", "B", 1, "v", at("2026-10-01 10:00")),
        ],
        "project STRING, title STRING, edit_size BIGINT, user STRING, timestamp_utc TIMESTAMP",
    )
    out = aggregates.edit_volumes(df)
    assert rows(out, "title", "edit_count", "total_edit_size", "unique_editors", "edit_velocity") == [
        ("A", 3, 12, 1, 0.5), ("B", 1, 1, 1, 1.0),
    ]


def test_a_dump_is_read_once(spark, tmp_path):
    with gzip.open(tmp_path / "pageviews-20261002-120000.gz", "wt") as out:
        out.write("fr A 1 0\nfr.m A 2 0\nfr B 4 0\nfr - 8 0")
    candidates = spark.createDataFrame([("fr.wikipedia", "A"), ("fr.wikipedia", "A"), ("fr.wikipedia", "-")], "project STRING, title STRING")
    out = views.merge_hour(views.parse_dump_lines(views.read_dump_lines(spark, str(tmp_path))), candidates)
    assert rows(out, "title", "views") == [("-", 15), ("A", 3)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("text") == 1
