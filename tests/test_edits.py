import json

from conftest import at, rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import edits

LEGACY = (
    "timestamp DOUBLE, project STRING, title STRING, user STRING, type STRING, minor BOOLEAN, "
    "length_old BIGINT, length_new BIGINT, comment STRING"
)
FR = "fr.wikipedia.org"


def legacy(user="Alice", title="Paris", length_new=150, comment="ok"):
    return (1790812800.0, FR, title, user, "edit", False, 100, length_new, comment)


def test_copies_share_the_natural_key(spark):
    df = spark.createDataFrame([legacy(), legacy(), legacy(user="Bob")], LEGACY)
    assert edits.normalize_edits(df).count() == 2


def test_revisions_identify_edits(spark):
    base = legacy()
    df = spark.createDataFrame([(*base, 1), (*base, 2), (*base, 2)], LEGACY + ", rev_id BIGINT")
    assert rows(edits.normalize_edits(df), "rev_id") == [(1,), (2,)]


def test_file_without_revisions(spark):
    out = edits.normalize_edits(spark.createDataFrame([legacy(), legacy()], LEGACY)).collect()
    assert len(out) == 1 and out[0]["rev_id"] is None


def test_names_sizes_and_comments_are_cleaned(spark):
    out = edits.normalize_edits(spark.createDataFrame([legacy(title=" Paris ", comment=None)], LEGACY)).first()
    assert (out["title"], out["edit_size"], out["comment"]) == ("Paris", 50, "")
    assert edits.normalize_edits(spark.createDataFrame([legacy()], LEGACY)).columns == schemas.EDITS.fieldNames()


def test_trimmed_titles_are_copies(spark):
    df = spark.createDataFrame([legacy(title=" Paris"), legacy(title="Paris ")], LEGACY)
    assert edits.normalize_edits(df).count() == 1


def test_nulls_do_not_merge_different_edits(spark):
    a = (1.0, FR, "A", None, "edit", False, 0, 7, "")
    b = (1.0, FR, None, "A", "edit", False, 0, 7, "")
    assert edits.normalize_edits(spark.createDataFrame([a, b], LEGACY)).count() == 2


def test_surviving_copy_is_stable(spark):
    copies = [(*legacy(comment=c), 9) for c in ("b", "a", "c")]
    df = spark.createDataFrame(copies, LEGACY + ", rev_id BIGINT").repartition(3)
    assert edits.normalize_edits(df).first()["comment"] == "a"


def test_one_edit_repeated_for_a_third_of_all_rows(spark):
    base = spark.range(30_000).select(
        F.lit(1790812800.0).alias("timestamp"), F.lit(FR).alias("project"), F.lit("Paris").alias("title"),
        F.lit("u").alias("user"), F.lit("edit").alias("type"), F.lit(False).alias("minor"),
        F.lit(0).cast("bigint").alias("length_old"), F.lit(1).cast("bigint").alias("length_new"),
        F.lit("").alias("comment"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("rev_id"),
    )
    assert edits.normalize_edits(base).count() == 20_001


def message(**fields):
    return (json.dumps(fields),)


def test_messages_without_a_numeric_timestamp_are_invalid(spark):
    df = spark.createDataFrame(
        [
            message(timestamp=1790812800, title="A"), message(timestamp=1.5, title="B"),
            message(timestamp="soon", title="C"), message(title="D"), ("[1, 2]",), ("not json",), (None,),
        ],
        "value STRING",
    )
    valid = edits.decode_messages(df).filter(edits.is_valid_message())
    assert rows(valid, "title") == [("A",), ("B",)]


def test_messages_arrive_as_bytes(spark):
    raw = json.dumps({"timestamp": 1, "title": "Zürich"}).encode()
    df = spark.createDataFrame([(bytearray(raw),), (bytearray(b"\xff\xfe"),)], "value BINARY")
    assert rows(edits.decode_messages(df).filter(edits.is_valid_message()), "title") == [("Zürich",)]


def test_edits_are_filed_under_their_own_day(spark):
    stamps = [(at("2026-10-01 23:59:59").timestamp(),), (at("2026-10-02 00:00").timestamp(),)]
    df = spark.createDataFrame(stamps, "timestamp DOUBLE")
    assert rows(edits.with_event_day(df), "day") == [("20261001",), ("20261002",)]


def change(**fields):
    event = {
        "server_name": FR, "bot": False, "namespace": 0, "type": "edit", "timestamp": 1790812800,
        "title": "Paris", "user": "Alice", "length": {"old": 1, "new": 3}, "revision": {"new": 42},
    }
    event.update(fields)
    return {k: v for k, v in event.items() if v != "absent"}


def test_only_human_article_edits_of_tracked_languages(spark):
    events = [
        change(), change(type="new", title="New"), change(bot=True), change(namespace=1), change(type="log"),
        change(server_name="it.wikipedia.org"), change(bot="absent", title="NoBot", length="absent", revision="absent"),
    ]
    lines = [(f"data: {json.dumps(e)}",) for e in events] + [("",), ("event: message",), ("data: {oops",), (": hi",)]
    out = edits.edits_from_change_events(
        edits.change_events_from_lines(spark.createDataFrame(lines, "value STRING"))
    )
    assert rows(out, "title", "length_old", "length_new", "rev_id", "minor", "comment") == [
        ("New", 1, 3, 42, False, ""), ("NoBot", 0, 0, None, False, ""), ("Paris", 1, 3, 42, False, ""),
    ]


def test_capture_files(spark, tmp_path):
    (tmp_path / "capture.txt").write_text(f"event: message\ndata: {json.dumps(change())}\n\n")
    assert edits.read_event_capture(spark, str(tmp_path)).first()["title"] == "Paris"
