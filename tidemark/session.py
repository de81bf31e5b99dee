"""Session settings and reliable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the analysis relies on; sizes are left to the cluster and AQE."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # recording the Python line of every column expression slows building a plan severalfold
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` where the cluster sets it.

    Only a local session without the setting falls back to a temporary folder; a
    cluster without it is an error, because executors could not read it back.
    """
    current = spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise on reliable storage and cut the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever storage it lies."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class WorkTables:
    """Tables that steps of one computation hand on, under the shared folder.

    A written table cuts the lineage as a checkpoint does, and can be removed as soon as the
    next step's table is complete.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.rows: list[int] = []

    def write(self, df: DataFrame, part: str, by: str | None = None, **metrics: Column) -> dict[str, int]:
        """Write a table, with a folder for each value of ``by``; rows and metrics are counted on the way."""
        seen = Observation()
        writer = df.observe(seen, F.count("*").alias("rows"), *[m.alias(n) for n, m in metrics.items()]).write
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/{part}")
        found = {name: seen.get.get(name) or 0 for name in ("rows", *metrics)}
        self.rows.append(found["rows"])
        return found

    def read(self, part: str, schema: StructType) -> DataFrame:
        """A table, or none of its rows where the part was never written."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{part}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def remove(self, part: str) -> None:
        delete_folder(self.spark, f"{self.root}/{part}")
