"""The lake: dated tables, one folder per UTC day."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import delete_folder

MANIFEST = "run STRING, days ARRAY<STRING>, tables ARRAY<STRING>"


class MissingInput(FileNotFoundError):
    """A required day of a required table is absent."""


@dataclass(frozen=True)
class Lake:
    """Tables under ``root/layer/group/Table/day=yyyyMMdd``."""

    root: str

    def path(self, layer: str, table: str, day: str | None = None) -> str:
        base = f"{self.root}/{layer}/{table}"
        return f"{base}/day={day}" if day else base

    def scan(self, spark: SparkSession, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """Every day of a table with its ``day`` column; filters on it prune folders."""
        full = T.StructType(schema.fields + [T.StructField("day", T.StringType())])
        return spark.read.schema(full).parquet(self.path(layer, table))

    def scan_if_present(
        self, spark: SparkSession, layer: str, table: str, schema: T.StructType
    ) -> DataFrame | None:
        """``scan``, or None while the table has never been written."""
        return self.scan(spark, layer, table, schema) if self._exists(spark, self.path(layer, table)) else None

    def days(
        self, spark: SparkSession, layer: str, table: str, days: list[str], schema: T.StructType
    ) -> DataFrame:
        """Required days of a table; names every missing one."""
        self.require(spark, [(layer, table, d) for d in days])
        return self.scan(spark, layer, table, schema).filter(F.col("day").isin(*days))

    def absent(self, spark: SparkSession, needed: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
        """Those (layer, table, day) that have no folder."""
        return [day for day in needed if not self.has_day(spark, *day)]

    def require(self, spark: SparkSession, needed: list[tuple[str, str, str]]) -> None:
        """Fail unless every (layer, table, day) is there; all missing ones are named at once."""
        missing = [self.path(*day) for day in self.absent(spark, needed)]
        if missing:
            raise MissingInput(f"missing inputs: {missing}")

    def optional_day(
        self, spark: SparkSession, layer: str, table: str, day: str, schema: T.StructType
    ) -> DataFrame:
        """A day that may be absent: then an empty frame of the same shape."""
        if self.has_day(spark, layer, table, day):
            return self.days(spark, layer, table, [day], schema).drop("day")
        return spark.createDataFrame([], schema)

    def has_day(self, spark: SparkSession, layer: str, table: str, day: str) -> bool:
        """Whether the day's folder exists."""
        return self._exists(spark, self.path(layer, table, day))

    @staticmethod
    def _exists(spark: SparkSession, path: str) -> bool:
        """Looks at names only, no data."""
        try:
            spark.read.schema("probe STRING").parquet(path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def observed_days(
        self, spark: SparkSession, layer: str, table: str, schema: T.StructType, first: str, last: str
    ) -> list[str]:
        """Days of [first, last] that have data. Reads no column but the folder name."""
        rows = (
            self.scan(spark, layer, table, schema)
            .filter(F.col("day").between(first, last))
            .select("day")
            .distinct()
            .collect()
        )
        return sorted(r["day"] for r in rows)

    def write_day(self, df: DataFrame, layer: str, table: str, day: str) -> str:
        """Replace one day. A rerun leaves the same content; an empty result replaces too.

        The day's old files go when the new ones are complete, so a run that fails in its
        tasks leaves the old rows readable.
        """
        self.replace_days(df.drop("day").withColumn("day", F.lit(day)), layer, table, [day])
        return self.path(layer, table, day)

    def replace_days(self, df: DataFrame, layer: str, table: str, days: list[str]) -> str:
        """Replace the days listed by the rows of ``df`` (column ``day``) in one job.

        Rows are counted as they are written: a listed day without any was not replaced yet,
        and an empty one is put in its place.
        """
        target, written = self.path(layer, table), Observation()
        (
            df.observe(written, *[F.count_if(F.col("day") == d).alias(f"day_{d}") for d in days])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day")
            .parquet(target)
        )
        counts = written.get
        for day in days:
            if not counts.get(f"day_{day}"):
                empty = df.sparkSession.createDataFrame([], df.drop("day").schema)
                empty.write.mode("overwrite").parquet(self.path(layer, table, day))
        return target

    def write_days(self, df: DataFrame, layer: str, table: str) -> str:
        """Replace exactly the days present in ``df`` (column ``day``) in one job.

        Rows are rebalanced by day first: few files per day, and a heavy day still many tasks.
        """
        target = self.path(layer, table)
        (
            df.hint("rebalance", F.col("day"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day")
            .parquet(target)
        )
        return target

    # ---- tables published together

    def _manifest(self, layer: str) -> str:
        return f"{self.root}/{layer}/_published"

    def publish(self, layer: str, tables: dict[str, DataFrame], days: list[str]) -> str:
        """Replace the days of several tables at once, or of none of them.

        The rows (column ``day``) go to folders of a new run, which nobody reads yet. The
        manifest then gets one more file, whose rename makes all tables' days the new ones
        together. A run that fails before it leaves every table as it was.
        """
        run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        for name, df in tables.items():
            df.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run", "day").parquet(self.path(layer, name))
        spark = next(iter(tables.values())).sparkSession
        entry = spark.createDataFrame([(run, days, sorted(tables))], MANIFEST).coalesce(1)
        entry.write.mode("append").json(self._manifest(layer))
        return run

    def published_runs(self, spark: SparkSession, layer: str, table: str) -> dict[str, str]:
        """The run that holds each published day of a table: one short entry per day."""
        if not self._exists(spark, self._manifest(layer)):
            return {}
        entries = spark.read.schema(MANIFEST).json(self._manifest(layer)).filter(F.array_contains("tables", table))
        latest = entries.select("run", F.explode("days").alias("day")).groupBy("day").agg(F.max("run").alias("run"))
        return {r["day"]: r["run"] for r in latest.collect()}

    def published(self, spark: SparkSession, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """Every published day of a table with its ``day``; only the folders of the live runs are read."""
        full = T.StructType(schema.fields + [T.StructField("run", T.StringType()), T.StructField("day", T.StringType())])
        live = [f"{run}/{day}" for day, run in self.published_runs(spark, layer, table).items()]
        if not live or not self._exists(spark, self.path(layer, table)):
            return spark.createDataFrame([], full).drop("run")
        rows = spark.read.schema(full).parquet(self.path(layer, table))
        return rows.filter(F.concat_ws("/", "run", "day").isin(live)).drop("run")

    def published_day(self, spark: SparkSession, layer: str, table: str, day: str, schema: T.StructType) -> DataFrame:
        """One published day; a day nobody published is a missing input, an empty one is not."""
        if day not in self.published_runs(spark, layer, table):
            raise MissingInput(f"not published: {self.path(layer, table)} of {day}")
        return self.published(spark, layer, table, schema).filter(F.col("day") == day).drop("day")

    def sweep(self, spark: SparkSession, layer: str, table: str) -> list[str]:
        """Delete the folders that a later published run has replaced, failed runs' included.

        A run that is still writing is younger than what is published, and stays.
        """
        if not self._exists(spark, self.path(layer, table)):
            return []
        live = self.published_runs(spark, layer, table)
        kept = spark.read.schema("run STRING, day STRING").parquet(self.path(layer, table)).select("run", "day").distinct().collect()
        old = [f"{self.path(layer, table)}/run={r['run']}/day={r['day']}" for r in kept if r["run"] < live.get(r["day"], "")]
        for folder in old:
            delete_folder(spark, folder)
        return old
