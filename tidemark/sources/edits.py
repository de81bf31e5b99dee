"""Edits: from change events or messages to the clean, duplicate-free table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.columns import day_key
from tidemark.params import DEFAULTS, Params

# The change events that count as edits.
ARTICLE_NAMESPACE = 0
EDIT_TYPES = ("edit", "new")

NATURAL_KEY = ("timestamp", "project", "title", "user", "length_new")
MESSAGE_COLUMNS = tuple(schemas.EDIT_MESSAGE.fieldNames())


def change_events_from_lines(lines: DataFrame) -> DataFrame:
    """Event-stream text (column ``value``) to change events: only ``data:`` lines carry one."""
    payload = F.trim(F.substring(F.col("value"), 6, 2_000_000_000))
    return (
        lines.filter(F.col("value").startswith("data:"))
        .select(F.from_json(payload, schemas.CHANGE_EVENT).alias("event"))
        .filter(F.col("event").isNotNull())
        .select("event.*")
    )


def read_event_capture(spark: SparkSession, path: str) -> DataFrame:
    return change_events_from_lines(spark.read.text(path))


def is_tracked_edit(params: Params = DEFAULTS) -> Column:
    """Human edits and creations of articles in the tracked languages."""
    return (
        F.col("server_name").isin(*params.edit_projects)
        & ~F.coalesce(F.col("bot"), F.lit(False))
        & (F.col("namespace") == ARTICLE_NAMESPACE)
        & F.col("type").isin(*EDIT_TYPES)
    )


def edits_from_change_events(events: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Tracked edits as messages. An explicit JSON null and an absent field both get the default."""
    return events.filter(is_tracked_edit(params)).select(
        "timestamp",
        F.col("server_name").alias("project"),
        "title",
        "user",
        "type",
        F.coalesce("minor", F.lit(False)).alias("minor"),
        F.coalesce("length.old", F.lit(0).cast("bigint")).alias("length_old"),
        F.coalesce("length.new", F.lit(0).cast("bigint")).alias("length_new"),
        F.coalesce("comment", F.lit("")).alias("comment"),
        F.col("revision.new").alias("rev_id"),
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """Topic messages (column ``value``, bytes or text) to records; a bad one has no ``timestamp``.

    Works on batches and streams alike.
    """
    return messages.select(
        F.from_json(F.col("value").cast("string"), schemas.EDIT_MESSAGE).alias("edit")
    ).select("edit.*")


def is_valid_message() -> Column:
    """Only a record with a numeric timestamp can be filed under a day."""
    return F.col("timestamp").isNotNull()


def with_event_day(edits: DataFrame) -> DataFrame:
    """File each edit under the UTC day it happened, not the day it arrived."""
    return edits.withColumn("day", day_key(F.timestamp_seconds(F.col("timestamp"))))


def read_raw_edits(spark: SparkSession, root: str, day: str) -> DataFrame:
    """One day of landed messages from the drain's root folder; a missing root fails.

    The root has the sink's log, and only files that a finished batch has logged are read:
    what a failed attempt or anyone else left in the day's folder is not.
    """
    full = T.StructType(schemas.EDIT_MESSAGE.fields + [T.StructField("day", T.StringType())])
    return spark.read.schema(full).json(root).filter(F.col("day") == day).drop("day")


def deduplicated(edits: DataFrame) -> DataFrame:
    """One row per revision, or per natural key where the revision is unknown.

    Keys are compared column by column, so a null never makes two different keys look
    alike. Copies meet in the map-side combine first, so a heavily repeated edit costs
    one row per task. The copy that sorts first survives, on every run.
    """
    known = F.col("rev_id").isNotNull()
    rest = [c for c in edits.columns if c not in ("project", "rev_id")]
    keys = [F.col("project"), F.col("rev_id")] + [
        F.when(~known, F.col(c)).alias(f"key_{c}") for c in NATURAL_KEY if c != "project"
    ]
    return (
        edits.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("kept"))
        .select("project", "rev_id", "kept.*")
        .select(*edits.columns)
    )


def normalize_edits(raw: DataFrame) -> DataFrame:
    """Clean names, one row per edit, instants and sizes; files without ``rev_id`` are accepted."""
    if "rev_id" not in raw.columns:
        raw = raw.withColumn("rev_id", F.lit(None).cast("bigint"))
    trimmed = raw.select(*[c for c in MESSAGE_COLUMNS if c != "title"], F.trim("title").alias("title"))
    return deduplicated(trimmed).select(
        F.timestamp_seconds(F.floor("timestamp")).alias("timestamp_utc"),
        "project",
        "rev_id",
        "title",
        "user",
        "type",
        "minor",
        (F.col("length_new") - F.col("length_old")).alias("edit_size"),
        "length_old",
        "length_new",
        F.coalesce("comment", F.lit("")).alias("comment"),
    )
