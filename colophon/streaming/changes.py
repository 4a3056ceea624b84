"""The change log as a stream: changes counted once although they are sent twice and late, folders of records re-read as they grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colophon.sources.yaml_records import PARSED, file_parser


def read_changes(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def distinct_changes(stream: DataFrame, lateness: str = "30 days") -> DataFrame:
    """Each change once: state holds the ids seen within the watermark on the arrival time."""
    timed = stream.withColumn("arrived_at", F.col("arrived_at").cast("timestamp"))
    return timed.withWatermark("arrived_at", lateness).dropDuplicatesWithinWatermark(["change_id"])


def new_changes(stream: DataFrame, history: DataFrame, lateness: str = "30 days") -> DataFrame:
    """distinct_changes without those that ``history``, a table of what was taken before, holds already: state stays as large as
    the watermark is long, and repeats that come later than that are told by the table."""
    return distinct_changes(stream.join(history.select("change_id").distinct(), "change_id", "left_anti"), lateness)


def daily_counts(stream: DataFrame, lateness: str = "30 days", window: str = "1 day") -> DataFrame:
    """``(day, kind, n)`` by the time of the change; days close when the watermark has passed them."""
    timed = stream.withColumn("changed_at", F.col("changed_at").cast("timestamp"))
    counted = timed.withWatermark("changed_at", lateness).groupBy(F.window("changed_at", window).alias("w"), "kind").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("day"), "kind", "n")


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed record files of a folder as they appear."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.schema(schema).format("binaryFile").option("pathGlobFilter", "*.yaml").load(folder)
    return files.select("path", "content").mapInPandas(file_parser(), PARSED)
