"""Topic to lake: everything present now, filed under the day it happened.

Nothing is dropped for being late: there is no watermark on this path. The file sink and
the checkpoint make a rerun add only what is new.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions.columns import day_key
from tidemark.sources.edits import decode_messages, is_valid_message, read_raw_edits, with_event_day
from tidemark.sources.lake import Lake, MissingInput

TOPIC = "wikipedia-edits"
INVALID = "invalid"


def topic_messages(
    spark: SparkSession, servers: str, topic: str = TOPIC, max_per_batch: int | None = None
) -> DataFrame:
    """The topic from its earliest offset; needs Spark's Kafka connector on the class path.

    ``max_per_batch`` splits a long backlog into batches; all of it is read either way.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load().select("value")


def file_messages(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Landed message files, one JSON message per line."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder)


def filed_messages(messages: DataFrame) -> DataFrame:
    """Every message with the day it is filed under; invalid ones, with their text, under ``INVALID``."""
    text = F.col("value").cast("string")
    decoded = messages.select(F.from_json(text, schemas.EDIT_MESSAGE).alias("edit"), text.alias("text")).select("edit.*", "text")
    day = F.when(is_valid_message(), day_key(F.timestamp_seconds("timestamp"))).otherwise(INVALID)
    return decoded.withColumns({"text": F.when(~is_valid_message(), F.col("text")), "day": day})


def filed_edits(messages: DataFrame) -> DataFrame:
    """Valid records with their event day."""
    return with_event_day(decode_messages(messages).filter(is_valid_message()))


def drain(messages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append all messages present at launch under ``target/day=.../`` and stop.

    Skipped messages are kept under a day of their own, by the same exactly-once sink: so
    they are counted from what has landed, however many batches a run had.
    """
    return (
        filed_messages(messages)
        .writeStream.format("json")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("day")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def message_counts(spark: SparkSession, target: str) -> DataFrame:
    """received, skipped: all messages landed so far, from folder names and row counts."""
    landed = spark.read.schema("day STRING").json(target)
    return landed.agg(F.count("*").alias("received"), F.count_if(F.col("day") == INVALID).alias("skipped"))


def drained(spark: SparkSession, messages: DataFrame, target: str, checkpoint: str) -> dict[str, int]:
    """Drain to the end; messages received and skipped by this run."""

    def counted() -> dict[str, int]:
        try:
            return message_counts(spark, target).first().asDict()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {"received": 0, "skipped": 0}

    before = counted()
    drain(messages, target, checkpoint).awaitTermination()
    return {name: count - before[name] for name, count in counted().items()}


def edits_per_day(spark: SparkSession, target: str) -> DataFrame:
    """Landed edits per event day, from the folder names and row counts alone."""
    landed = spark.read.schema("day STRING").json(target)
    return landed.filter(F.col("day") != INVALID).groupBy("day").agg(F.count("*").alias("edits"))


def require_day(spark: SparkSession, lake: Lake, day: str) -> DataFrame:
    """The day's landed messages; fails when nothing happened on the day: the producer was probably down."""
    if lake.has_day(spark, "raw", "Edits", day):
        raw = read_raw_edits(spark, lake.path("raw", "Edits"), day)
        if not raw.isEmpty():
            return raw
    raise MissingInput(f"no edits for {day}: is the producer running?")
