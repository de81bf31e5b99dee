import hashlib
import json

import pytest
from conftest import at, rows

from tidemark.sources import documents
from tidemark.sources.lake import Lake


def sha(text):
    return hashlib.sha1(text.encode()).hexdigest()


def sources(df):
    return {r["_id"]: (r["_index"], json.loads(r["_source"])) for r in df.collect()}


def test_ids_separate_languages_and_days(spark):
    df = spark.createDataFrame([("fr.wikipedia.org", "Paris"), ("de.wikipedia.org", "Paris"), ("ru.wikipedia.org", "Москва")],
                               "edit_project STRING, title STRING")
    one = sources(documents.to_documents(df, "i", "20261001"))
    assert set(one) == {sha("20261001|fr.wikipedia.org|Paris"), sha("20261001|de.wikipedia.org|Paris"), sha("20261001|ru.wikipedia.org|Москва")}
    assert not set(one) & set(sources(documents.to_documents(df, "i", "20261002")))


def test_missing_values_are_null_and_the_day_is_stamped(spark):
    df = spark.createDataFrame([("fr", "A", float("nan"), None, 3, True, at("2026-10-01 10:00"))],
                               "edit_project STRING, title STRING, z DOUBLE, wikidata_id STRING, n BIGINT, ok BOOLEAN, first TIMESTAMP")
    ((index, body),) = sources(documents.to_documents(df, "trend", "20261001")).values()
    assert index == "trend"
    assert body == {"edit_project": "fr", "title": "A", "z": None, "wikidata_id": None, "n": 3, "ok": True,
                    "first": "2026-10-01T10:00:00.000000", "date": "20261001"}


def test_project_stands_in_for_a_missing_edit_project(spark):
    df = spark.createDataFrame([("fr.wikipedia", None, "A"), ("fr.wikipedia", "x", "B")], "project STRING, edit_project STRING, title STRING")
    assert set(sources(documents.to_documents(df, "i", "d"))) == {sha("d|fr.wikipedia|A"), sha("d|x|B")}
    hourly = spark.createDataFrame([("fr.wikipedia", "A")], "project STRING, title STRING")
    assert set(sources(documents.to_documents(hourly, "i", "d"))) == {sha("d|fr.wikipedia|A")}


def test_entity_events_are_keyed_by_entity(spark):
    df = spark.createDataFrame([("Q243", 2)], "wikidata_id STRING, language_count BIGINT")
    assert set(sources(documents.to_documents(df, "i", "20261001"))) == {sha("20261001|wikidata|Q243")}


def test_upsert_replaces_by_id(spark):
    schema = "_index STRING, _id STRING, _source STRING"
    old = spark.createDataFrame([("i", "1", "old"), ("i", "2", "old"), ("j", "1", "old")], schema)
    new = spark.createDataFrame([("i", "1", "new"), ("i", "3", "new")], schema)
    got = {(r["_index"], r["_id"]): r["_source"] for r in documents.upserted(old, new).collect()}
    assert got == {("i", "1"): "new", ("i", "2"): "old", ("j", "1"): "old", ("i", "3"): "new"}


def test_refused_documents_are_a_table(spark):
    def refuse_b(batch, attempt):
        if attempt == 0:
            raise documents.Busy("later")
        return [(key, "is b") for _, key, _ in batch if key.startswith("b")]

    df = spark.createDataFrame([("i", f"{x}{n}", "{}") for x in "abc" for n in range(40)], "_index STRING, _id STRING, _source STRING")
    out = documents.delivered(df, refuse_b, batch_size=7, wait=0.01)
    assert rows(out) == sorted((("i", f"b{n}", "is b") for n in range(40)), key=repr)
    assert rows(documents.delivered(df.limit(0), refuse_b, wait=0.01)) == []


def test_a_target_that_stays_busy_fails(spark):
    def never(batch, attempt):
        raise documents.Busy("never")

    df = spark.createDataFrame([("i", "a", "{}")], "_index STRING, _id STRING, _source STRING")
    with pytest.raises(Exception, match="never"):
        documents.delivered(df, never, attempts=2, wait=0.01).collect()


def test_sending_a_day_twice_replaces_it(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    df = spark.createDataFrame([("i", f"k{n}", json.dumps({"n": n})) for n in range(30)], "_index STRING, _id STRING, _source STRING")
    lake.write_day(df, "documents", "i", "20261001")
    for _ in range(2):
        assert documents.send_day(spark, lake, "i", "20261001", documents.FolderWriter(str(tmp_path / "out"))) == 30
    lines = [x for f in sorted((tmp_path / "out").iterdir()) for x in f.read_text().splitlines()]
    assert sorted(json.loads(x)["index"]["_id"] for x in lines[::2]) == sorted(f"k{n}" for n in range(30))
    with pytest.raises(documents.RejectedDocuments, match="30 documents rejected: no"):
        documents.send_day(spark, lake, "i", "20261001", lambda batch, attempt: [(key, "no") for _, key, _ in batch])
    assert lake.days(spark, "documents", "i-rejects", ["20261001"], documents.REJECTS).count() == 30
