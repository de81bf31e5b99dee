"""Joins that hold up under size and skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed

ARTICLE = ["project", "title"]
ROW_BITS = 33  # monotonically_increasing_id keeps the partition above the lower 33 bits


def followed(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Only the rows of the given articles; Spark picks the join by the sizes it sees."""
    return rows.join(articles.select(*ARTICLE).distinct(), ARTICLE, "left_semi")


def join_under_skew(rows: DataFrame, looked_up: DataFrame, on: list[str]) -> DataFrame:
    """Left join of rows that may share one hot key with a side that has one row per key.

    AQE splits a hot partition only where both sides were shuffled for the join itself. A
    side that was just aggregated on the key is not, and its join would run the whole hot
    key in one task. Joining on a digest of the key as well makes Spark shuffle that small
    side again, and the hot rows are then split. Where the side is small enough, Spark
    broadcasts it as usual.
    """
    digest = F.pmod(F.xxhash64(*on), F.lit(1 << 20)).alias("key_digest")
    return rows.select("*", digest).join(looked_up.select("*", digest), [*on, "key_digest"], "left").drop("key_digest")


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with their zero-based ``position`` in the order within their group.

    A window would sort a whole group in one task. Here the rows are range-sorted over all
    tasks, and each row's position is its place in its partition plus the sizes of the
    group's earlier partitions. The sorted rows are checkpointed, so both uses see the same
    partitions even if an executor is lost; the sizes are one row per group and partition,
    few enough to broadcast when Spark measures them.
    """
    ordered = checkpointed(rows.orderBy(group, *order).withColumn("place", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("part", F.shiftright("place", ROW_BITS))
    sizes = ordered.groupBy(group, "part").agg(F.count("*").alias("rows"), F.min("place").alias("first_place"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "part", "first_place", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    return ordered.join(offsets, [group, "part"]).select(
        *rows.columns, (F.col("offset") + F.col("place") - F.col("first_place")).alias("position")
    )
