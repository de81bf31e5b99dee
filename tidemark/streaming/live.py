"""Live hourly edit counts, an extension of the batch hourly table.

Unlike the raw path this one needs a watermark to close an hour, so edits later than the
delay are not counted here. The batch table stays the complete one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import align_project
from tidemark.streaming.drain import filed_edits


def live_edits(filed: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Filed messages as live edits; copies within the delay are suppressed by revision.

    Sets the watermark on ``timestamp_utc`` for whatever follows.
    """
    return (
        filed.withColumn("timestamp_utc", F.timestamp_seconds(F.floor("timestamp")))
        .withColumn("title", F.trim("title"))
        .withWatermark("timestamp_utc", delay)
        .dropDuplicatesWithinWatermark(["project", "rev_id"])
    )


def live_hourly_edits(edits: DataFrame) -> DataFrame:
    """Edits and approximate editors per article and hour, emitted when the hour closes.

    ``edits`` carries a watermark on ``timestamp_utc``. Exact distinct counts are not
    available on streams.
    """
    return (
        edits.groupBy(
            F.window("timestamp_utc", "1 hour"), align_project(F.col("project")).alias("project"), "title"
        )
        .agg(F.count("*").alias("edits"), F.approx_count_distinct("user").alias("editors"))
        .select(F.col("window.start").alias("hour_utc"), "project", "title", "edits", "editors")
    )


def land_live_hours(messages: DataFrame, target: str, checkpoint: str, delay: str = "2 hours") -> StreamingQuery:
    """Append the hours that have closed by the messages present now, and stop; the next run goes on from there."""
    hours = live_hourly_edits(live_edits(filed_edits(messages), delay))
    return (
        hours.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
