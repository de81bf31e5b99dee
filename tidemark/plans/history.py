"""Daily counts kept beside the edits, so that a run reads counts instead of 28 days of edits.

A day's folder may hold edits dated on another day. Distinct editors cannot be added up over
folders, so three tables are kept, each replaced with its day:

* ``EditCounts``: per article, of the edits in the folder of their own day;
* ``MisfiledEditors``: per article, editor and dated day, of the other edits in a folder;
* ``SharedEditors``: per article and editor, of the edits in the folder of their own day, for
  the articles and days of which another folder holds edits too.

Nearly all articles need the first table only; for the others the editors are united.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import day_key, day_text
from tidemark.operators import emergence
from tidemark.params import DEFAULTS, Params
from tidemark.sources.lake import Lake

LAYER = "formatted"
COUNTED = ["project", "title", "day"]


def _dated_edits(spark: SparkSession, lake: Lake, days: list[str]) -> DataFrame:
    edits = lake.scan(spark, LAYER, "Edits", schemas.EDITS).filter(F.col("day").isin(days))
    return edits.select("day", "project", "title", "user", day_key(F.col("timestamp_utc")).alias("dated"))


def update_counts(spark: SparkSession, lake: Lake, days: list[str]) -> None:
    """Bring the three tables up to date after the folders of ``days`` were written."""
    rows = _dated_edits(spark, lake, days)
    own = rows.filter(F.col("day") == F.col("dated"))
    counts = own.groupBy(*COUNTED).agg(
        F.count("*").alias("edit_count"), F.count_distinct("user").alias("unique_editors")
    )
    lake.replace_days(counts, LAYER, "EditCounts", days)
    misfiled = rows.filter(F.col("day") != F.col("dated")).groupBy("day", "dated", "project", "title", "user")
    lake.replace_days(misfiled.agg(F.count("*").alias("edit_count")), LAYER, "MisfiledEditors", days)
    # the days that these folders' edits are dated on have new articles in common with them
    all_misfiled = lake.scan(spark, LAYER, "MisfiledEditors", schemas.MISFILED_EDITORS)
    reached = all_misfiled.filter(F.col("day").isin(days)).select(F.col("dated").alias("day")).distinct()
    filed = lake.scan(spark, LAYER, "Edits", schemas.EDITS).select("day").distinct()
    touched = sorted({r["day"] for r in reached.join(filed, "day", "left_semi").collect()} | set(days))
    common = all_misfiled.filter(F.col("dated").isin(touched)).select("project", "title", F.col("dated").alias("day")).distinct()
    own = _dated_edits(spark, lake, touched).filter(F.col("day") == F.col("dated"))
    editors = own.groupBy(*COUNTED, "user").agg(F.count("*").alias("edit_count"))
    lake.replace_days(editors.join(common, COUNTED, "left_semi"), LAYER, "SharedEditors", touched)


def past_counts(spark: SparkSession, lake: Lake, day: date, params: Params = DEFAULTS) -> tuple[DataFrame, int]:
    """Daily counts of the history window and the number of observed days.

    A day is observed if its folder has data, and edits count on the day they are dated, whichever
    folder of the window they lie in. Edits dated on a day nobody observed are left out, so an
    article never has more counts than there are days. Folders written before counts were
    kept are counted now.
    """
    first, last = (day_text(d) for d in emergence.history_window(day, params))
    observed = lake.observed_days(spark, LAYER, "Edits", schemas.EDITS, first, last)
    if not observed:
        return spark.createDataFrame([], "project STRING, title STRING, day STRING, edit_count BIGINT, unique_editors BIGINT"), 0
    uncounted = [d for d in observed if not lake.has_day(spark, LAYER, "EditCounts", d)]
    if uncounted:
        update_counts(spark, lake, uncounted)
    counts = lake.scan(spark, LAYER, "EditCounts", schemas.EDIT_COUNTS).filter(F.col("day").isin(observed))
    late = lake.scan(spark, LAYER, "MisfiledEditors", schemas.MISFILED_EDITORS).filter(
        F.col("day").isin(observed) & F.col("dated").isin(observed)
    )
    shared = lake.scan(spark, LAYER, "SharedEditors", schemas.SHARED_EDITORS).filter(F.col("day").isin(observed))
    editors = late.select("project", "title", F.col("dated").alias("day"), "user", "edit_count").unionByName(
        shared.select(*COUNTED, "user", "edit_count")
    )
    united = editors.groupBy(*COUNTED).agg(
        F.sum("edit_count").alias("edit_count"), F.count_distinct("user").alias("unique_editors")
    )
    measured = F.struct("edit_count", "unique_editors")
    both = counts.select(*COUNTED, measured.alias("found"), F.lit(0).alias("rank")).unionByName(
        united.select(*COUNTED, measured.alias("found"), F.lit(1).alias("rank"))
    )
    return both.groupBy(*COUNTED).agg(F.max_by("found", "rank").alias("found")).select(*COUNTED, "found.*"), len(observed)
