"""Search documents: published rows as keyed JSON, ready for any store that upserts by id."""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sources.lake import Lake

DOCUMENT_COLUMNS = ("_index", "_id", "_source")


@dataclass(frozen=True)
class DocumentTable:
    """Which published table feeds an index, and whether its day is the event day."""

    table: str
    schema: T.StructType
    event_day: bool = False


# Index names and the tables behind them.
TABLES = {
    "wikipedia-trending": DocumentTable("TrendingArticles", schemas.TRENDING),
    "wikipedia-leadlag": DocumentTable("EditLeadLag", schemas.EDIT_TO_VIEW),
    "wikipedia-crosslang": DocumentTable("CrossLanguageEvents", schemas.CROSS_LANGUAGE),
    "wikipedia-leadlag-hourly": DocumentTable("EditLeadLagHourly", schemas.LEADLAG_HOURLY, event_day=True),
}


class RejectedDocuments(RuntimeError):
    """The target refused documents."""


def document_id(day: str, *key: Column) -> Column:
    """Stable id of a subject on a day, so a rerun replaces instead of repeating."""
    return F.sha1(F.concat_ws("|", F.lit(day), *key))


def _key_of(columns: list[str]) -> tuple[Column, Column]:
    if "wikidata_id" in columns and "title" not in columns:
        return F.lit("wikidata"), F.col("wikidata_id")
    if "edit_project" not in columns:
        return F.col("project"), F.col("title")
    fallback = [F.col("project")] if "project" in columns else []
    named = F.when(F.col("edit_project") != "", F.col("edit_project"))
    return F.coalesce(named, *fallback), F.col("title")


def to_documents(rows: DataFrame, index: str, day: str) -> DataFrame:
    """Each row as (_index, _id, _source); missing values stay as nulls, NaN becomes null."""
    columns = [c for c in rows.columns if c != "day"]
    kinds = dict(rows.dtypes)
    values = [
        F.when(~F.isnan(c), F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in columns
    ]
    body = F.to_json(
        F.struct(*values, F.lit(day).alias("date")),
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
    return rows.select(
        F.lit(index).alias("_index"), document_id(day, *_key_of(columns)).alias("_id"), body.alias("_source")
    )


def upserted(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing documents with the incoming ones put in their place."""
    kept = existing.join(incoming.select("_index", "_id"), ["_index", "_id"], "left_anti")
    return kept.select(*DOCUMENT_COLUMNS).unionByName(incoming.select(*DOCUMENT_COLUMNS))


class Busy(RuntimeError):
    """The target cannot take a batch now; asking again makes sense."""


# A writer stores a batch, given as (index, id, source) and the attempt from 0, and returns
# (id, reason) of the documents it will never take. It raises Busy to be asked again.
Document = tuple[str, str, str]
Writer = Callable[[list[Document], int], list[tuple[str, str]]]
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in ("_index", "_id", "reason")])


def _stored(batch: list[Document], writer: Writer, attempts: int, wait: float) -> list[tuple[str, str]]:
    for attempt in range(attempts):
        try:
            return writer(batch, attempt)
        except Busy:
            if attempt + 1 == attempts:
                raise
            time.sleep(wait * 2**attempt)
    return []


def delivered(
    documents: DataFrame, writer: Writer, batch_size: int = 500, attempts: int = 4, wait: float = 0.5
) -> DataFrame:
    """Store all documents; the result, once it is read or written, is the table of those refused.

    Batches are made by id, so a task or a job that is run again sends the same batches, and
    the same ids replace themselves. A batch is asked again while the target is busy, and
    fails its task when that does not end. One batch at a time is in memory.
    """
    batches = max(1, -(-documents.count() // batch_size))
    batch = F.pmod(F.xxhash64("_id"), F.lit(batches)).alias("batch")
    placed = documents.select(*DOCUMENT_COLUMNS, batch).repartition("batch").sortWithinPartitions("batch", "_index", "_id")

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def refused(held: list[Document]) -> pa.RecordBatch:
            reasons = dict(_stored(held, writer, attempts, wait)) if held else {}
            found = [(index, name, reasons[name]) for index, name, _ in held if name in reasons]
            columns = list(zip(*found)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=REJECTS.fieldNames())

        held, number = [], None
        for table in tables:
            for *document, of in zip(*[c.to_pylist() for c in table.columns]):
                if of != number:
                    yield refused(held)
                    held, number = [], of
                held.append(tuple(document))
        yield refused(held)

    return placed.mapInArrow(run, REJECTS)


@dataclass(frozen=True)
class FolderWriter:
    """Documents as files in a folder that all executors have mounted: one per batch, replaced when sent again."""

    folder: str

    def __call__(self, batch: list[Document], attempt: int) -> list[tuple[str, str]]:
        name = hashlib.sha256("|".join(i for _, i, _ in batch).encode()).hexdigest()[:32]
        os.makedirs(self.folder, exist_ok=True)
        unfinished = f"{self.folder}/.{name}-{uuid.uuid4().hex}"
        with open(unfinished, "w", encoding="utf-8") as out:
            for index, key, source in batch:
                out.write(json.dumps({"index": {"_index": index, "_id": key}}) + "\n" + source + "\n")
        os.replace(unfinished, f"{self.folder}/{name}.ndjson")
        return []


def send_day(spark: SparkSession, lake: Lake, index: str, day: str, writer: Writer) -> int:
    """Send a day's documents of an index. Refused ones are kept as a table, and then fail the job."""
    kept = T.StructType([T.StructField(c, T.StringType()) for c in DOCUMENT_COLUMNS])
    documents = lake.days(spark, "documents", index, [day], kept).drop("day")
    lake.write_day(delivered(documents, writer), "documents", f"{index}-rejects", day)
    rejects = lake.days(spark, "documents", f"{index}-rejects", [day], REJECTS).groupBy("reason").count()
    reasons = {r["reason"]: r["count"] for r in rejects.orderBy(F.desc("count"), "reason").limit(10).collect()}
    if reasons:
        raise RejectedDocuments("; ".join(f"{count} documents rejected: {reason}" for reason, count in reasons.items()))
    return documents.count()


def publish_table(spark: SparkSession, lake: Lake, index: str, day: str) -> str:
    """Write one day of a published table as documents; the day's folder is replaced."""
    rows = lake.published_day(spark, "usage", TABLES[index].table, day, TABLES[index].schema)
    return lake.write_day(to_documents(rows, index, day), "documents", index, day)
