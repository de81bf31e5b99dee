from datetime import date, datetime, timezone

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import columns
from tidemark.operators.joins import followed
from tidemark.session import checkpointed, shared_folder
from tidemark.sources.lake import Lake, MissingInput

IDS = schemas.ENTITY_IDS


def frame(spark, *titles):
    return spark.createDataFrame([("fr", t, None) for t in titles], IDS)


def test_rerun_replaces_only_its_day(spark, tmp_path):
    lake = Lake(str(tmp_path))
    lake.write_day(frame(spark, "A", "B"), "formatted", "Ids", "20261001")
    lake.write_day(frame(spark, "C"), "formatted", "Ids", "20261002")
    lake.write_day(frame(spark, "D"), "formatted", "Ids", "20261001")
    assert rows(lake.scan(spark, "formatted", "Ids", IDS), "day", "title") == [("20261001", "D"), ("20261002", "C")]
    lake.write_day(frame(spark), "formatted", "Ids", "20261001")
    assert rows(lake.scan(spark, "formatted", "Ids", IDS), "title") == [("C",)]


def test_several_days_in_one_job(spark, tmp_path):
    lake = Lake(str(tmp_path))
    data = spark.createDataFrame([("fr", f"T{i}", None, f"2026100{i % 3}") for i in range(9)],
                                 "project STRING, title STRING, wikidata_id STRING, day STRING")
    lake.write_days(data, "formatted", "Ids")
    lake.write_days(data.filter("day = '20261001'").limit(1), "formatted", "Ids")
    got = lake.scan(spark, "formatted", "Ids", IDS).groupBy("day").count()
    assert rows(got) == [("20261000", 3), ("20261001", 1), ("20261002", 3)]
    assert lake.observed_days(spark, "formatted", "Ids", IDS, "20261001", "20261009") == ["20261001", "20261002"]


def test_day_filters_prune_folders(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for d in ("20261001", "20261002", "20261003"):
        lake.write_day(frame(spark, d), "formatted", "Ids", d)
    two = lake.days(spark, "formatted", "Ids", ["20261001", "20261003"], IDS)
    assert "PartitionFilters: [isnotnull(day" in plan(two) or "PartitionFilters: [day" in plan(two)
    assert len({f for f in two.inputFiles()}) >= 2 and rows(two, "title") == [("20261001",), ("20261003",)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_missing_inputs_are_all_named(spark, tmp_path):
    lake = Lake(str(tmp_path))
    lake.write_day(frame(spark, "A"), "formatted", "Ids", "20261001")
    with pytest.raises(MissingInput) as error:
        lake.days(spark, "formatted", "Ids", ["20261001", "20261002", "20261003"], IDS)
    assert "20261002" in str(error.value) and "20261003" in str(error.value) and "20261001" not in str(error.value)
    empty = lake.optional_day(spark, "formatted", "Ids", "20261009", IDS)
    assert empty.count() == 0 and empty.schema == IDS
    assert lake.optional_day(spark, "formatted", "Ids", "20261001", IDS).count() == 1


def test_a_failing_rerun_keeps_the_old_day(spark, tmp_path):
    lake, broken = Lake(str(tmp_path)), "IF(id = 3, raise_error('lost'), CAST(id AS STRING)) AS a"
    lake.write_day(spark.range(5).selectExpr("CAST(id AS STRING) AS a"), "formatted", "Kept", "20261001")
    lake.write_day(spark.range(2).selectExpr("CAST(id AS STRING) AS a"), "formatted", "Kept", "20261002")
    with pytest.raises(Exception, match="lost"):
        lake.write_day(spark.range(0, 8, 1, 4).selectExpr(broken), "formatted", "Kept", "20261001")
    read = lambda: spark.read.parquet(lake.path("formatted", "Kept")).groupBy("day").count()
    assert sorted(r["count"] for r in read().collect()) == [2, 5]
    lake.write_day(spark.range(0).selectExpr("CAST(id AS STRING) AS a"), "formatted", "Kept", "20261001")
    assert rows(read(), "count") == [(2,)] and lake.has_day(spark, "formatted", "Kept", "20261001")


def test_run_days():
    start = datetime(2026, 10, 1, 13, 45, tzinfo=timezone.utc)
    assert columns.run_day(start) == date(2026, 10, 1) and columns.run_day(date(2026, 10, 1)) == date(2026, 10, 1)
    assert columns.event_day(date(2026, 10, 1)) == date(2026, 9, 30)
    with pytest.raises(ValueError):
        columns.run_day(None)


def test_names(spark):
    df = spark.createDataFrame([("fr.wikipedia.org", "Tour_Eiffel"), ("a.organ", "x")], "p STRING, t STRING")
    got = df.select(columns.align_project(df.p), columns.readable_title(df.t), columns.language_of(df.p))
    assert rows(got) == [("a.organ", "x", "a"), ("fr.wikipedia", "Tour Eiffel", "fr")]


def test_half_even(spark):
    df = spark.createDataFrame([(x,) for x in (0.05, 0.15, 0.25, -0.05, 2.5)], "x DOUBLE")
    assert [r[0] for r in df.select(columns.half_even(df.x, 1)).collect()] == [0.0, 0.2, 0.2, 0.0, 2.5]


def test_day_bounds_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(at("2026-10-01 00:00"),), (at("2026-10-01 23:59:59"),), (at("2026-10-02 00:00"),)], "t TIMESTAMP")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.filter(columns.between_days(df.t, date(2026, 10, 1), date(2026, 10, 1))).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_only_followed_articles_stay(spark):
    big = spark.createDataFrame([("p", f"T{i}", i) for i in range(100)], "project STRING, title STRING, n INT")
    few = spark.createDataFrame([("p", "T1"), ("p", "T2"), ("p", "T2")], "project STRING, title STRING")
    assert rows(followed(big, few), "n") == [(1,), (2,)]

def test_lineage_is_cut_on_shared_storage(spark):
    df = checkpointed(spark.range(10).selectExpr("id * 2 AS x"))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert "Scan ExistingRDD" in plan(df) and df.count() == 10


def test_tables_are_published_together_or_not_at_all(spark, tmp_path):
    lake = Lake(str(tmp_path))
    dated = lambda *titles: frame(spark, *titles).withColumn("day", F.lit("20261001"))
    read = lambda table: rows(lake.published(spark, "usage", table, IDS), "day", "title")
    lake.publish("usage", {"A": dated("a"), "B": dated("b"), "C": dated("c")}, ["20261001"])
    broken = dated("x").withColumn("title", F.expr("raise_error('lost')").cast("string"))
    with pytest.raises(Exception, match="lost"):
        lake.publish("usage", {"A": dated("new a"), "B": dated("new b"), "C": broken}, ["20261001"])
    assert [read(t) for t in "ABC"] == [[("20261001", t)] for t in "abc"]
    lake.publish("usage", {"A": dated("newest"), "B": dated()}, ["20261001"])
    assert (read("A"), read("B"), read("C")) == ([("20261001", "newest")], [], [("20261001", "c")])
    assert lake.published_day(spark, "usage", "B", "20261001", IDS).count() == 0
    with pytest.raises(MissingInput, match="20261002"):
        lake.published_day(spark, "usage", "A", "20261002", IDS)


def test_sweep_leaves_the_live_and_the_unfinished(spark, tmp_path):
    lake = Lake(str(tmp_path))
    days = spark.createDataFrame([("fr", f"T{d}", None, f"2026100{d}") for d in (1, 2)], "project STRING, title STRING, wikidata_id STRING, day STRING")
    first = lake.publish("usage", {"A": days}, ["20261001", "20261002"])
    lake.publish("usage", {"A": days.filter("day = '20261002'")}, ["20261002"])
    days.withColumn("run", F.lit("9" * 20)).write.mode("append").partitionBy("run", "day").parquet(lake.path("usage", "A"))
    assert lake.sweep(spark, "usage", "A") == [f"{lake.path('usage', 'A')}/run={first}/day=20261002"]
    assert rows(lake.published(spark, "usage", "A", IDS), "title") == [("T1",), ("T2",)]
    assert (tmp_path / "usage" / "A" / f"run={'9' * 20}").exists() and lake.sweep(spark, "usage", "A") == []
    assert lake.sweep(spark, "usage", "Nothing") == []


def test_only_live_folders_are_read(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for title in "ab":
        lake.publish("usage", {"A": frame(spark, title).withColumn("day", F.lit("20261001"))}, ["20261001"])
    read = lake.published(spark, "usage", "A", IDS)
    assert rows(read, "title") == [("b",)]
    scan = plan(read)
    assert "concat_ws(/, run" in scan[scan.index("PartitionFilters"):].split("\n")[0]
