import json

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from tidemark.sources.edits import read_raw_edits
from tidemark.sources.lake import Lake, MissingInput
from tidemark.streaming import drain as stream
from tidemark.streaming.live import live_edits, live_hourly_edits


def message(when, title="A", **more):
    return json.dumps({"timestamp": int(at(when).timestamp()), "project": "fr.wikipedia.org", "title": title, "user": "u", **more})


class Topic:
    def __init__(self, spark, root):
        self.spark, self.root, self.batch = spark, root, 0
        (root / "topic").mkdir()

    def send(self, *messages):
        self.batch += 1
        (self.root / "topic" / f"{self.batch:03d}.txt").write_text("\n".join(messages))

    def drain(self, files_per_trigger=None):
        messages = stream.file_messages(self.spark, str(self.root / "topic"), files_per_trigger)
        return stream.drained(self.spark, messages, str(self.root / "raw"), str(self.root / "state"))

    def days(self):
        return dict(rows(stream.edits_per_day(self.spark, str(self.root / "raw"))))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def test_drain_routes_counts_and_reruns(topic, spark):
    topic.send(message("2026-10-01 23:59:59"), message("2026-10-02 00:00"), "garbage", json.dumps({"title": "no time"}), message("2026-10-02 01:00"))
    assert topic.drain() == {"received": 5, "skipped": 2}
    assert topic.days() == {"20261001": 1, "20261002": 2}
    assert topic.drain() == {"received": 0, "skipped": 0}
    assert topic.days() == {"20261001": 1, "20261002": 2}
    topic.send(message("2026-10-02 02:00"))
    topic.drain()
    assert topic.days()["20261002"] == 3


def test_counts_cover_more_batches_than_are_remembered(topic, spark):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "8")
    try:
        for i in range(20):
            topic.send(message("2026-10-01 10:00", rev_id=i), *["junk"] * (i % 2))
        assert topic.drain(files_per_trigger=1) == {"received": 30, "skipped": 10}
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_many_fast_batches_are_all_counted(topic, spark):
    for i in range(120):
        topic.send(message("2026-10-01 10:00", rev_id=i), *["junk"] * (i % 2))
    assert topic.drain(files_per_trigger=1) == {"received": 180, "skipped": 60}
    assert rows(stream.message_counts(spark, str(topic.root / "raw"))) == [(180, 60)]


def test_skipped_messages_keep_their_text(topic, spark):
    topic.send("garbage", json.dumps({"title": "no time"}), message("2026-10-01 10:00"))
    topic.drain()
    kept = spark.read.schema("text STRING, day STRING").json(str(topic.root / "raw")).filter(f"day = '{stream.INVALID}'")
    assert rows(kept, "text") == [("garbage",), (json.dumps({"title": "no time"}),)]
    assert topic.days() == {"20261001": 1}


def test_only_committed_files_are_read(topic, spark):
    topic.send(message("2026-10-01 10:00", rev_id=1))
    topic.drain()
    raw = topic.root / "raw"
    (raw / "day=20261001" / "part-stray.json").write_text(message("2026-10-01 11:00", rev_id=2))
    (raw / "day=20261005").mkdir()
    (raw / "day=20261005" / "part-stray.json").write_text(message("2026-10-05 11:00", rev_id=3))
    assert rows(read_raw_edits(spark, str(raw), "20261001"), "rev_id") == [(1,)]
    (topic.root / "lake" / "raw").mkdir(parents=True)
    (topic.root / "lake" / "raw" / "Edits").symlink_to(raw)
    with pytest.raises(MissingInput, match="20261005"):
        stream.require_day(spark, Lake(str(topic.root / "lake")), "20261005")


def test_late_edits_are_kept(topic):
    topic.send(message("2026-10-05 00:00"))
    topic.drain()
    topic.send(message("2026-08-01 00:00"))
    topic.drain()
    assert topic.days() == {"20261005": 1, "20260801": 1}


def test_landed_fields_read_back(topic, spark):
    topic.send(message("2026-10-01 10:00", "Tour Eiffel", rev_id=7, minor=True, length_new=5))
    topic.drain()
    r = read_raw_edits(spark, str(topic.root / "raw"), "20261001").first()
    assert (r["title"], r["rev_id"], r["minor"], r["length_new"], r["length_old"]) == ("Tour Eiffel", 7, True, 5, None)


def test_a_day_without_edits_fails(spark, tmp_path):
    with pytest.raises(MissingInput, match="20261001"):
        stream.require_day(spark, Lake(str(tmp_path)), "20261001")


def test_live_hours_close_with_the_watermark(spark, tmp_path):
    (tmp_path / "in").mkdir()
    source = stream.file_messages(spark, str(tmp_path / "in"), files_per_trigger=1)
    live = live_hourly_edits(live_edits(stream.filed_edits(source), "1 hour"))
    batches = [
        [message("2026-10-01 10:05", "A", rev_id=1), message("2026-10-01 10:05", "A", rev_id=1), message("2026-10-01 10:40", " A", rev_id=2)],
        [message("2026-10-01 15:00", "B", rev_id=3)],
        [message("2026-10-01 20:00", "C", rev_id=4)],
    ]
    query = live.writeStream.format("memory").queryName("live_hours").outputMode("append").start()
    try:
        for i, batch in enumerate(batches):
            (tmp_path / "in" / f"{i}.txt").write_text("\n".join(batch))
            query.processAllAvailable()
    finally:
        query.stop()
    out = spark.table("live_hours").select(F.date_format("hour_utc", "HH").alias("h"), "project", "title", "edits", "editors")
    assert ("10", "fr.wikipedia", "A", 2, 1) in rows(out)
    assert "C" not in {r["title"] for r in out.collect()}
