"""Views: hourly dumps of every page and the daily top list."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import align_project, day_text, dump_title, readable_title
from tidemark.params import DEFAULTS, Params

# Where a dump's name carries its stamp, and the stamp's format.
STAMP_PATTERN = r"pageviews-(\d{8}-\d{4})\d{2}"
STAMP_FORMAT = "yyyyMMdd-HHmm"


def stamp_of_dump(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, STAMP_PATTERN, 1), F.lit(""))


def hour_of_stamp(stamp: Column) -> Column:
    """A dump is named after the end of its hour; the hour it describes starts one earlier."""
    return F.to_timestamp(stamp, STAMP_FORMAT) - F.expr("INTERVAL 1 HOUR")


def dump_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of the dump files in a folder; no content is read."""
    return spark.read.format("binaryFile").load(path).select(F.substring_index("path", "/", -1).alias("file_name"))


def dump_problems(files: DataFrame, day: date) -> DataFrame:
    """problem, name: hours of the day without a file or with several, and names that tell no hour."""
    found = files.select("file_name", hour_of_stamp(stamp_of_dump(F.col("file_name"))).alias("hour_utc"))
    hours = files.sparkSession.range(24).select(
        (F.to_timestamp(F.lit(day_text(day)), "yyyyMMdd") + F.make_interval(hours=F.col("id").cast("int"))).alias("hour_utc")
    )
    stamp = F.date_format("hour_utc", "yyyy-MM-dd HH:mm").alias("name")
    per_hour = hours.join(found, "hour_utc", "left").groupBy("hour_utc").agg(F.count("file_name").alias("files"))
    return (
        per_hour.filter("files = 0").select(F.lit("no file").alias("problem"), stamp)
        .unionByName(per_hour.filter("files > 1").select(F.lit("several files").alias("problem"), stamp))
        .unionByName(found.filter("hour_utc IS NULL").select(F.lit("unreadable name").alias("problem"), F.col("file_name").alias("name")))
    )


def read_dump_lines(spark: SparkSession, path: str) -> DataFrame:
    """Dump files as lines with their file name. Gzip does not split: one task per file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file_name"))


def parse_dump_lines(lines: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """``domain title count bytes`` to (stamp, project, title, views).

    Desktop ``fr`` and mobile ``fr.m`` are both ``fr.wikipedia``. Lines of other sites,
    with fewer than three fields or with a count that is no whole number are left out;
    most of a dump goes by the first test, on the plain line. Titles keep the dump's
    spelling. The fields leave through ``inline``, so a line is split once however the
    columns are used later.
    """
    codes = "|".join(p.split(".")[0] for p in params.projects)
    fields = F.split("value", " ")
    parsed = F.struct(
        F.try_element_at(fields, F.lit(1)).alias("domain"),
        F.try_element_at(fields, F.lit(2)).alias("title"),
        F.try_element_at(fields, F.lit(3)).try_cast("bigint").alias("views"),
    )
    return (
        lines.filter(F.col("value").rlike(rf"^({codes})(\.m)? "))
        .select(stamp_of_dump(F.col("file_name")).alias("stamp"), F.inline(F.array(parsed)))
        .filter(F.col("views").isNotNull())
        .select(
            "stamp",
            F.concat(F.substring_index("domain", ".", 1), F.lit(".wikipedia")).alias("project"),
            "title",
            "views",
        )
    )


def candidate_articles(edits: DataFrame) -> DataFrame:
    """Distinct edited articles in the dump's spelling."""
    return edits.select(
        align_project(F.col("project")).alias("project"), dump_title(F.col("title")).alias("title")
    ).distinct()


def merge_hour(views: DataFrame, candidates: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Hourly views of candidate articles, desktop plus mobile, and each language's total.

    The dump is read once. Titles are summed in each task before anything travels, followed
    ones are marked, and each sum then counts for its language's total and, where marked, for
    its title; totals are combined in each task again. Hours are read off the stamps at the
    end, once per result row.
    """
    per_title = views.groupBy("stamp", "project", "title").agg(F.sum("views").alias("views"))
    followed = candidates.select("project", "title").distinct().withColumn("followed", F.col("title") != params.total_title)
    marked = per_title.join(followed, ["project", "title"], "left")
    whole = F.struct(F.lit(params.total_title).alias("title"))
    rows = F.when(F.col("followed"), F.array(whole, F.struct("title"))).otherwise(F.array(whole))
    counted = marked.select("stamp", "project", "views", F.inline(rows)).groupBy("stamp", "project", "title").agg(
        F.sum("views").alias("views")
    )
    return counted.select(hour_of_stamp(F.col("stamp")).alias("hour_utc"), "project", "title", "views")


def normalize_hourly(raw: DataFrame) -> DataFrame:
    """Landed rows with text hours and dump titles to the hourly table."""
    return raw.select(
        F.to_timestamp("hour_utc", "yyyy-MM-dd HH:mm:ss").alias("hour_utc"),
        "project",
        readable_title(F.col("title")).alias("title"),
        "views",
    )


def read_hourly_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated hourly rows. No quote character: a title may start with one."""
    return spark.read.csv(path, sep="\t", quote="", schema=schemas.HOURLY_TSV)


def explode_top(raw: DataFrame) -> DataFrame:
    """Nested top lists (``items``, ``project``, ``date_utc``) to one row per article."""
    return (
        raw.select("date_utc", "project", F.inline(F.try_element_at("items", F.lit(1))["articles"]))
        .select("date_utc", "project", "rank", readable_title(F.col("article")).alias("article"), "views")
    )


def read_daily_top(spark: SparkSession, folder: str, day: str) -> DataFrame:
    """All languages' top lists of a day: project from the file name, one task per file."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^pageviews_(.+)\.json$", 1)
    raw = (
        spark.read.option("multiLine", True)
        .schema(schemas.DAILY_TOP_JSON)
        .json(f"{folder}/pageviews_*.json")
        .select(
            "items",
            F.translate(name, "_", ".").alias("project"),
            F.to_timestamp(F.lit(day), "yyyyMMdd").alias("date_utc"),
        )
    )
    return explode_top(raw)
