"""The test tables seen as edits, views, top lists, entity ids and their raw forms.

``events`` gives the languages (user_id), articles (three hot ones per language by the key in
``props``, thousands of others by event), edits (click,
purchase and error rows) and views (view rows); view and signup rows make up a
language's total traffic. All rows of a table are used.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.columns import between_days
from tidemark.params import Params

RUN_DAY = date(2024, 1, 30)
EVENT_DAY = date(2024, 1, 25)
FIRST_DAY, LAST_DAY = date(2024, 1, 1), date(2024, 1, 30)

# The tables are thinner than a day of real edits, so thresholds are lower.
PARAMS = Params(z_threshold=2.0, min_editors=3, min_event_edits=3, min_corr=0.2)

LANGUAGES = ("en", "fr", "de", "es", "ru")
EDIT_EVENTS = ("click", "purchase", "error")


def _edit_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("event_type").isin(*EDIT_EVENTS))


def _edit_project() -> Column:
    return F.concat("project", F.lit(".org"))


def on_day(rows: DataFrame, day: date, column: str = "timestamp_utc") -> DataFrame:
    return rows.filter(between_days(F.col(column), day, day))


class Tables:
    """One folder of test tables in a session; every view of them is built once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.built: dict[Callable, DataFrame] = {}

    def once(self, build: Callable[[Tables], DataFrame]) -> DataFrame:
        """What ``build`` makes of these tables, built on first use."""
        if build not in self.built:
            self.built[build] = build(self)
        return self.built[build]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        rows = self.table("events")
        key = F.get_json_object("props", "$.k").cast("int")
        language = F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), (F.col("user_id") % 5 + 1).cast("int"))
        page = F.concat(language, F.lit(".wikipedia"))
        spread = 3 + (F.col("event_id") * 7 + key) % 4000
        title = F.concat(F.lit("T"), F.when(key < 30, F.floor(key / 10)).otherwise(spread).cast("string"))
        return rows.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("user_id").cast("string").alias("user"),
            "event_type",
            F.col("value").cast("bigint").alias("amount"),
            # inline: names are built once per row, while filters on the other columns still reach the scan
            F.inline(F.array(F.struct(page.alias("project"), title.alias("title")))),
        )

    @cached_property
    def edits(self) -> DataFrame:
        return _edit_rows(self.events).select(
            F.col("ts").alias("timestamp_utc"),
            _edit_project().alias("project"),
            F.col("event_id").alias("rev_id"),
            "title",
            "user",
            F.col("amount").alias("edit_size"),
        )

    @cached_property
    def raw_edits(self) -> DataFrame:
        """Messages as landed: padded titles, clicks delivered twice, errors without a revision."""
        copies = F.when(F.col("event_type") == "click", 2).otherwise(1)
        return _edit_rows(self.events).select(
            F.unix_seconds("ts").cast("double").alias("timestamp"),
            _edit_project().alias("project"),
            F.concat(F.lit(" "), F.col("title"), F.lit(" ")).alias("title"),
            "user",
            F.when(F.col("event_type") == "purchase", "new").otherwise("edit").alias("type"),
            (F.col("event_type") == "click").alias("minor"),
            F.lit(100).cast("bigint").alias("length_old"),
            (F.col("amount") + 100).alias("length_new"),
            F.when(F.col("event_type") != "error", F.concat(F.lit("c"), F.col("user"))).alias("comment"),
            F.when(F.col("event_type") != "error", F.col("event_id")).alias("rev_id"),
            F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
        ).drop("copy")

    @cached_property
    def messages(self) -> DataFrame:
        """Topic messages: one JSON edit per edit event, garbage per signup, no timestamp per view."""
        fields = F.struct(
            F.unix_seconds("ts").alias("timestamp"),
            _edit_project().alias("project"),
            "title",
            "user",
            F.lit("edit").alias("type"),
            F.col("event_id").alias("rev_id"),
        )
        untimed = F.struct(_edit_project().alias("project"), "title")
        return self.events.select(
            F.when(F.col("event_type") == "signup", F.concat(F.lit("{broken "), F.col("title")))
            .when(F.col("event_type") == "view", F.to_json(untimed))
            .otherwise(F.to_json(fields))
            .alias("value")
        )

    @cached_property
    def capture_lines(self) -> DataFrame:
        """Event-stream text: bots are errors, talk pages are signups, categorising is a view; blanks between."""
        event = F.struct(
            _edit_project().alias("server_name"),
            (F.col("event_type") == "error").alias("bot"),
            F.when(F.col("event_type") == "signup", 1).otherwise(0).alias("namespace"),
            F.when(F.col("event_type") == "view", "categorize").otherwise("edit").alias("type"),
            F.unix_seconds("ts").alias("timestamp"),
            "title",
            "user",
            F.struct(F.col("amount").alias("new")).alias("length"),
            F.struct(F.col("event_id").alias("new")).alias("revision"),
        )
        lines = F.array(F.lit("event: message"), F.concat(F.lit("data: "), F.to_json(event)), F.lit(""))
        return self.events.select(F.explode(lines).alias("value"))

    @cached_property
    def hourly(self) -> DataFrame:
        """Hourly views of articles, and of whole languages under the total title."""
        page = F.struct("title")
        whole = F.struct(F.lit(PARAMS.total_title).alias("title"))
        return (
            self.events
            .filter(F.col("event_type").isin("view", "signup"))
            .select(
                F.date_trunc("hour", "ts").alias("hour_utc"),
                "project",
                F.inline(F.when(F.col("event_type") == "view", F.array(page, whole)).otherwise(F.array(whole))),
                F.col("amount").alias("views"),
            )
            .select("hour_utc", "project", "title", "views")
        )

    @cached_property
    def dump_lines(self) -> DataFrame:
        """Dump text: views and clicks on the desktop or mobile site, purchases with a bad count,
        signups on another site, errors cut short."""
        code = F.substring_index("project", ".", 1)
        site = F.when(F.col("event_id") % 2 == 0, code).otherwise(F.concat(code, F.lit(".m")))
        line = (
            F.when(F.col("event_type") == "signup", F.concat_ws(" ", F.lit("commons.m"), "title", "amount", F.lit("0")))
            .when(F.col("event_type") == "purchase", F.concat_ws(" ", site, "title", F.lit("many"), F.lit("0")))
            .when(F.col("event_type") == "error", site)
            .otherwise(F.concat_ws(" ", site, "title", "amount", F.lit("0")))
        )
        end = F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR")
        name = F.concat(F.lit("pageviews-"), F.date_format(end, "yyyyMMdd-HHmm"), F.lit("00.gz"))
        return self.events.select(line.alias("value"), name.alias("file_name"))

    @cached_property
    def top(self) -> DataFrame:
        """Five most viewed articles per language and day."""
        viewed = (
            self.hourly
            .filter(F.col("title") != PARAMS.total_title)
            .groupBy(F.date_trunc("day", "hour_utc").alias("date_utc"), "project", "title")
            .agg(F.sum("views").alias("views"))
        )
        order = Window.partitionBy("date_utc", "project").orderBy(F.desc("views"), "title")
        return (
            viewed.withColumn("rank", F.row_number().over(order).cast("bigint"))
            .filter(F.col("rank") <= 5)
            .select("date_utc", "project", "rank", F.col("title").alias("article"), "views")
        )

    @cached_property
    def ids(self) -> DataFrame:
        """Entity ids: the same number in every language, unknown for T9."""
        return (
            self.edits
            .select("project", "title")
            .distinct()
            .withColumn(
                "wikidata_id",
                F.when(F.col("title") != "T9", F.concat(F.lit("Q"), F.expr("substring(title, 2)"))),
            )
        )

    @cached_property
    def order_titles(self) -> DataFrame:
        """One title per order, spread over the languages by customer."""
        language = F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), (F.col("o_custkey") % 5 + 1).cast("int"))
        return self.table("orders").select(
            F.concat(language, F.lit(".wikipedia.org")).alias("project"),
            F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("title"),
        )

    @cached_property
    def part_renames(self) -> DataFrame:
        """Long chains in one language (each part leads to half its number) and loops with
        tails in another (the tenth of each ten leads back to the seventh)."""
        parts = self.table("part").select(F.col("p_partkey").alias("k"))
        halves = parts.filter("k >= 1").select(
            F.lit("en.wikipedia.org").alias("project"),
            F.concat(F.lit("P"), F.col("k").cast("string")).alias("from"),
            F.concat(F.lit("P"), F.floor(F.col("k") / 2).cast("string")).alias("to"),
        )
        step = F.when(F.col("k") % 10 == 9, F.col("k") - 3).otherwise(F.col("k") + 1)
        loops = parts.select(
            F.lit("fr.wikipedia.org").alias("project"),
            F.concat(F.lit("L"), F.col("k").cast("string")).alias("from"),
            F.concat(F.lit("L"), step.cast("string")).alias("to"),
        )
        return halves.unionByName(loops)

    @cached_property
    def responses(self) -> DataFrame:
        """Lookup responses, one per part: ``part_n`` is normalised to ``part n``, which redirects to
        ``Brand``; brands ending in 5 have no id."""
        parts = self.table("part")
        asked = F.concat(F.lit("part_"), F.col("p_partkey").cast("string"))
        clean = F.concat(F.lit("part "), F.col("p_partkey").cast("string"))
        item = F.when(~F.col("p_brand").endswith("5"), F.concat(F.lit("Q"), F.col("p_brand")))
        body = F.struct(
            F.struct(
                F.array(F.struct(asked.alias("from"), clean.alias("to"))).alias("normalized"),
                F.array(F.struct(clean.alias("from"), F.col("p_brand").alias("to"))).alias("redirects"),
                F.array(
                    F.struct(F.col("p_brand").alias("title"), F.struct(item.alias("wikibase_item")).alias("pageprops"))
                ).alias("pages"),
            ).alias("query")
        )
        line = F.to_json(
            F.struct(
                F.lit("en.wikipedia.org").alias("project"),
                F.lit(200).alias("status"),
                F.array(asked).alias("titles"),
                body.alias("body"),
            )
        )
        return parts.select(F.from_json(line, schemas.ENTITY_RESPONSE).alias("r")).select("r.*")
