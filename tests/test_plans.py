"""A small lake from landed files to documents, through every job."""

import gzip
import json
from datetime import date, datetime, timedelta, timezone
from random import Random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import emergence
from tidemark.operators.quality import DataQualityError
from tidemark.params import PROJECTS, Params
from tidemark.plans import daily, history, ingest
from tidemark.sources import documents
from tidemark.sources.lake import Lake, MissingInput
from tidemark.streaming import drain as stream

D = date(2026, 10, 7)
PARAMS = Params(min_daily_edits=10, min_id_rate=0.4, min_view_match=0.1, max_emerging_share=0.5)
CODES = [p.split(".")[0] for p in PROJECTS]


def landed_edits():
    """Five quiet days, then a day on which one subject bursts in French and English."""
    rev = 0
    for back in range(6, -1, -1):
        day = D - timedelta(days=back)
        for code in CODES:
            for n in range(3):
                rev += 1
                yield edit(day, f"{9 + n}:00:00", code, f"Usual {n}", f"u{n}", rev)
        if back == 1:
            for n in range(6):
                rev += 1
                yield edit(day, f"10:0{n}:00", "fr", "Séisme", f"f{n}", rev)
        if back == 0:
            for n in range(8):
                rev += 1
                yield edit(day, f"10:0{n}:00", "fr", "Séisme", f"f{n}", rev)
            for n in range(6):
                rev += 1
                yield edit(day, f"10:3{n}:00", "en", "Earthquake", f"e{n}", rev)


def edit(day, time, code, title, user, rev):
    stamp = int(at(f"{day} {time.zfill(8)}").timestamp())
    return json.dumps({
        "timestamp": stamp, "project": f"{code}.wikipedia.org", "title": f" {title}", "user": user, "type": "edit",
        "minor": False, "length_old": 10, "length_new": 25, "comment": "", "rev_id": rev,
    })


def dump_hours(folder, day):
    folder.mkdir()
    for h in range(24):
        end = at(f"{day} 00:00") + timedelta(hours=h + 1)
        surge = 400 if h == 13 else 10
        lines = [f"{c} Usual_{n} {5 + n} 0" for c in CODES for n in range(3)] + [f"{c}.m Other 100 0" for c in CODES]
        lines += [f"fr Séisme {surge} 0", f"fr.m Séisme {surge} 0", f"en Earthquake {surge} 0", "bad line", "commons X 3 0"]
        with gzip.open(folder / f"pageviews-{end:%Y%m%d-%H}0000.gz", "wt") as out:
            out.write("\n".join(lines))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = Lake(str(root / "lake"))
    messages = list(landed_edits())
    (root / "topic").mkdir()
    (root / "topic" / "1.txt").write_text("\n".join(messages + messages[-20:] + ["junk"]))
    stream.drain(stream.file_messages(spark, str(root / "topic")), lake.path("raw", "Edits"), str(root / "state")).awaitTermination()
    for back in range(6, -1, -1):
        ingest.format_edits(spark, lake, D - timedelta(days=back), PARAMS)
    for back in (1, 0):
        day = D - timedelta(days=back)
        dump_hours(root / f"dumps{back}", day)
        ingest.format_hourly_views(spark, lake, str(root / f"dumps{back}"), day)
    (root / "top").mkdir()
    for code in CODES:
        articles = [{"article": "Usual_1", "views": 9, "rank": 4}, {"article": "Séisme", "views": 900, "rank": 1}]
        (root / "top" / f"pageviews_{code}_wikipedia.json").write_text(json.dumps({"items": [{"articles": articles}]}))
    ingest.format_daily_top(spark, lake, str(root / "top"), D)
    ingest.plan_entity_requests(spark, lake, D)
    requests = spark.read.parquet(lake.path("raw", "WikidataRequests", f"{D:%Y%m%d}")).collect()
    answers = []
    for r in requests:
        pages = [{"title": t, "pageprops": {"wikibase_item": "Q7944" if t in ("Séisme", "Earthquake") else f"Q{t[-1]}"}} for t in r["titles"] if t != "Usual 2"]
        answers.append(json.dumps({"project": r["project"], "status": 200, "titles": r["titles"], "body": {"query": {"pages": pages}}}))
    (root / "answers.ndjson").write_text("\n".join(answers))
    ingest.format_entities(spark, lake, str(root / "answers.ndjson"), D, PARAMS)
    daily.combine_day(spark, lake, D, PARAMS)
    daily.leadlag_day(spark, lake, D, PARAMS)
    daily.publish_day(spark, lake, D)
    daily.publish_leadlag(spark, lake, D)
    return lake


def usage(spark, lake, table, day=D):
    schema = {t.table: t.schema for t in documents.TABLES.values()}[table]
    return lake.published_day(spark, "usage", table, f"{day:%Y%m%d}", schema)


def test_formatted_edits_hold_no_copies(spark, lake):
    edits = lake.scan(spark, "formatted", "Edits", schemas.EDITS)
    assert edits.count() == len(list(landed_edits())) == edits.select("rev_id").distinct().count()


def test_hourly_views_follow_edited_articles_and_totals(spark, lake):
    hourly = lake.scan(spark, "formatted", "PageviewsHourly", schemas.HOURLY_VIEWS).filter("day = '20261007'")
    assert hourly.filter("title = 'Other'").count() == 0
    noon = hourly.filter("hour_utc = timestamp'2026-10-07 13:00:00'")
    assert rows(noon.filter("title in ('Séisme', 'Earthquake')"), "project", "title", "views") == [
        ("en.wikipedia", "Earthquake", 400), ("fr.wikipedia", "Séisme", 800),
    ]
    assert rows(noon.filter("project = 'de.wikipedia' and title = '-'"), "views") == [(118,)]


def test_trending(spark, lake):
    out = usage(spark, lake, "TrendingArticles")
    assert out.columns == schemas.TRENDING.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.TRENDING]
    assert rows(out.filter("is_emerging"), "title", "unique_editors", "history_days", "z_editors", "language_count") == [
        ("Earthquake", 6, 6, 6.0, 2), ("Séisme", 8, 6, 8.0, 2),
    ]
    r = out.filter("title = 'Séisme'").first()
    assert (r["pageviews"], r["pageview_rank"], r["first_language"], r["language_lag_minutes"]) == (800 + 23 * 20, 1, "fr.wikipedia.org", 0.0)
    assert out.count() == 17


def test_cross_language(spark, lake):
    out = usage(spark, lake, "CrossLanguageEvents")
    r = out.filter("wikidata_id = 'Q7944'").first()
    assert (r["titles"], r["spread_minutes"], r["emerging_languages"], r["total_edits"]) == ("fr:Séisme | en:Earthquake", 30.0, 2, 14)
    assert rows(out, "wikidata_id", "language_count") == [("Q0", 5), ("Q1", 5), ("Q7944", 2)]


def test_daily_ratio(spark, lake):
    assert rows(usage(spark, lake, "EditLeadLag"), "title", "edit_count") == [("Earthquake", 6), ("Séisme", 8)]


def test_hourly_leadlag(spark, lake):
    out = usage(spark, lake, "EditLeadLagHourly", D - timedelta(days=1))
    assert out.columns == schemas.LEADLAG_HOURLY.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.LEADLAG_HOURLY]
    assert rows(out, "project", "title", "event_edits", "best_lag_hours", "pattern") == [("fr.wikipedia", "Séisme", 6, 3, "edit_led")]


def test_documents(spark, lake):
    docs = spark.read.parquet(lake.path("documents", "wikipedia-trending", "20261007"))
    assert docs.count() == 17 and docs.select("_id").distinct().count() == 17
    hourly = spark.read.parquet(lake.path("documents", "wikipedia-leadlag-hourly", "20261006")).first()
    assert json.loads(hourly["_source"])["date"] == "20261006"


def test_rerun_changes_nothing(spark, lake):
    before = rows(usage(spark, lake, "TrendingArticles"))
    daily.combine_day(spark, lake, D, PARAMS)
    assert rows(usage(spark, lake, "TrendingArticles")) == before


def test_a_failed_gate_writes_nothing(spark, lake, tmp_path):
    with pytest.raises(DataQualityError, match="emerging_share"):
        daily.combine_day(spark, lake, D, Params(max_emerging_share=0.01))
    empty = Lake(str(tmp_path))
    with pytest.raises(MissingInput, match="Edits.*PageviewsHourly.*Pageviews/"):
        daily.combine_day(spark, empty, D)
    with pytest.raises(MissingInput, match="20261006.*20261007"):
        daily.leadlag_day(spark, empty, D)
    with pytest.raises(MissingInput):
        ingest.format_hourly_views(spark, empty, str(tmp_path), D)
    with pytest.raises(MissingInput):
        ingest.format_edits(spark, empty, D)


def test_missing_top_lists_are_named_but_the_others_written(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    (tmp_path / "pageviews_fr_wikipedia.json").write_text(json.dumps({"items": [{"articles": [{"article": "A", "views": 1, "rank": 1}]}]}))
    with pytest.raises(MissingInput, match="de.wikipedia, en.wikipedia, es.wikipedia, ru.wikipedia"):
        ingest.format_daily_top(spark, lake, str(tmp_path), D)
    assert lake.days(spark, "formatted", "Pageviews", ["20261007"], schemas.DAILY_TOP).count() == 1


def test_without_ids_articles_stand_alone(spark, lake, tmp_path):
    """Entity ids are an enrichment: a day without them is still combined."""
    edits = lake.days(spark, "formatted", "Edits", ["20261007"], schemas.EDITS).drop("day")
    hourly = lake.days(spark, "formatted", "PageviewsHourly", ["20261007"], schemas.HOURLY_VIEWS).drop("day")
    top = lake.days(spark, "formatted", "Pageviews", ["20261007"], schemas.DAILY_TOP).drop("day")
    ids = Lake(str(tmp_path)).optional_day(spark, "formatted", "Wikidata", "20261007", schemas.ENTITY_IDS)
    nothing = spark.createDataFrame([], schemas.EDIT_COUNTS)
    out = daily.trending_articles(edits, nothing, 0, ids, hourly, top)
    assert set(rows(out, "language_count", "is_emerging", "history_days")) == {(1, False, 0)}
    assert out.count() == 17


@pytest.mark.parametrize("change, named", [("drop", "no file: 2026-10-07 05:00"), ("rename", "unreadable name: hour-5.gz")])
def test_incomplete_dumps_fail_by_name(spark, lake, tmp_path, change, named):
    folder = tmp_path / "dumps"
    dump_hours(folder, D)
    hour = folder / "pageviews-20261007-060000.gz"
    hour.rename(folder / "hour-5.gz") if change == "rename" else hour.unlink()
    with pytest.raises(MissingInput, match=named):
        ingest.format_hourly_views(spark, lake, str(folder), D)


def test_hours_of_other_days_are_left_out(spark, lake, tmp_path):
    folder = tmp_path / "dumps"
    dump_hours(folder, D)
    with gzip.open(folder / "pageviews-20260901-050000.gz", "wt") as out:
        out.write("fr Séisme 77777 0")
    ingest.format_hourly_views(spark, lake, str(folder), D)
    hourly = lake.days(spark, "formatted", "PageviewsHourly", ["20261007"], schemas.HOURLY_VIEWS)
    assert hourly.filter("hour_utc IS NULL OR to_date(hour_utc) <> DATE'2026-10-07'").count() == 0
    assert hourly.select("hour_utc").distinct().count() == 24


def test_hourly_tsv_job(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    (tmp_path / "h.tsv").write_text("2026-10-07 01:00:00\tfr.wikipedia\tTour_Eiffel\t3\n")
    ingest.format_hourly_tsv(spark, lake, str(tmp_path / "h.tsv"), D)
    assert rows(lake.days(spark, "formatted", "PageviewsHourly", ["20261007"], schemas.HOURLY_VIEWS), "title", "views") == [("Tour Eiffel", 3)]


def test_history_counts_edits_on_observed_days_where_they_are_dated(spark, tmp_path):
    lake = Lake(str(tmp_path))
    first = D - timedelta(days=3)

    def edit(at, title, user="u"):
        return {"timestamp_utc": at, "project": "fr.wikipedia.org", "title": title, "user": user}

    def stamp(days, hour=12):
        day = first + timedelta(days=days)
        return datetime(day.year, day.month, day.day, hour, tzinfo=timezone.utc)

    # the first and the third day are observed; each folder holds one edit of the day after
    for day, title in ((0, "A"), (2, "B")):
        found = [edit(stamp(day), title), edit(stamp(day, 13), title, "v"), edit(stamp(day + 1, 0), f"late {title}")]
        df = spark.createDataFrame(found, "timestamp_utc timestamp, project string, title string, user string")
        lacking = [f for f in schemas.EDITS.fields if f.name not in df.columns]
        df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in lacking])
        lake.write_day(df, "formatted", "Edits", f"{first + timedelta(days=day):%Y%m%d}")
    counts, days = daily.past_counts(spark, lake, D)
    assert days == 2
    assert rows(counts, "title", "edit_count", "unique_editors") == [("A", 2, 2), ("B", 2, 2)]


def test_answers_without_the_days_requests_fail(spark, tmp_path):
    answer = {
        "project": "fr.wikipedia.org", "status": 200, "titles": ["Paris"],
        "body": {"query": {"pages": [{"title": "Paris", "pageprops": {"wikibase_item": "Q90"}}]}},
    }
    (tmp_path / "answers.ndjson").write_text(json.dumps(answer))
    with pytest.raises(FileNotFoundError, match="WikidataRequests"):
        ingest.format_entities(spark, Lake(str(tmp_path / "lake")), str(tmp_path / "answers.ndjson"), D, PARAMS)


def test_a_failed_combine_leaves_all_three_tables(spark, lake, monkeypatch):
    names = ("TrendingArticles", "EditLeadLag", "CrossLanguageEvents")
    before = [rows(usage(spark, lake, name)) for name in names]
    whole = daily.usage_tables

    def third_fails(trending, events):
        tables = whole(trending.withColumn("pageviews", F.lit(0).cast("bigint")), events)
        return tables | {"CrossLanguageEvents": events.withColumn("titles", F.expr("raise_error('lost')").cast("string"))}

    monkeypatch.setattr(daily, "usage_tables", third_fails)
    with pytest.raises(Exception, match="lost"):
        daily.combine_day(spark, lake, D, PARAMS)
    assert [rows(usage(spark, lake, name)) for name in names] == before


def test_a_range_publishes_what_its_days_do_alone(spark, lake, tmp_path_factory):
    names = ("TrendingArticles", "EditLeadLag", "CrossLanguageEvents")
    before = [rows(usage(spark, lake, name)) for name in names]
    daily.combine_period(spark, lake, D, D, PARAMS)
    assert [rows(usage(spark, lake, name)) for name in names] == before
    with pytest.raises(MissingInput, match="20261008"):
        daily.combine_period(spark, lake, D, D + timedelta(days=1), PARAMS)


def test_counts_kept_equal_counts_made_anew(spark, tmp_path):
    """Misfiled edits, shared editors, reruns in any order: the window's counts stay those of its folders."""
    lake, random = Lake(str(tmp_path)), Random(4)
    first = D - timedelta(days=6)
    schema = "timestamp_utc timestamp, project string, title string, user string"
    lacking = [f for f in schemas.EDITS.fields if f.name not in ("timestamp_utc", "project", "title", "user")]

    def write(n):
        found = []
        for _ in range(40):
            day = first + timedelta(days=n + random.choice([0, 0, 0, 0, -1, 1, 3, -40]))
            stamp = datetime(day.year, day.month, day.day, random.randrange(24), tzinfo=timezone.utc)
            found.append((stamp, "fr.wikipedia.org", f"T{random.randrange(3)}", random.choice(["a", "b", "c", "d", None])))
        df = spark.createDataFrame(found, schema).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in lacking])
        lake.write_day(df, "formatted", "Edits", f"{first + timedelta(days=n):%Y%m%d}")
        history.update_counts(spark, lake, [f"{first + timedelta(days=n):%Y%m%d}"])

    for n in (0, 2, 1, 4, 5, 1, 6, 4):
        write(n)
    for day, window in ((D, 4), (D, 2), (D - timedelta(days=2), 28)):
        params = Params(history_days=window)
        counts, days = history.past_counts(spark, lake, day, params)
        edits = lake.scan(spark, "formatted", "Edits", schemas.EDITS)
        start, end = (f"{d:%Y%m%d}" for d in emergence.history_window(day, params))
        observed = lake.observed_days(spark, "formatted", "Edits", schemas.EDITS, start, end)
        anew = emergence.daily_history(emergence.past_edits(edits, day, params).filter(F.col("day").isin(observed)))
        columns = ("title", "day", "edit_count", "unique_editors")
        assert days == len(observed) and rows(counts, *columns) == rows(anew, *columns)


def test_a_run_reads_counts_and_no_edits_of_the_past(spark, lake):
    counts, days = history.past_counts(spark, lake, D, PARAMS)
    assert days == 6 and not [f for f in counts.inputFiles() if "/formatted/Edits/" in f]
