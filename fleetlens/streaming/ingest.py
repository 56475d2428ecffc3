"""Arrival of new drives: folders that hold a READY marker and a list of scenes.

Markers are read as a file stream to its end and each batch is merged into the
scene table once, whatever happens: its rows are keyed by drive, and a drive's
partition is replaced as a whole.  Spark archives the markers it has processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arrivals(spark: SparkSession, landing: str, archive: str | None = None) -> DataFrame:
    """A row for each scene that a READY marker lists: drive and scene_name.

    Without state: a scene listed twice is two rows until ``merge_arrivals``
    makes each batch distinct.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "READY")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = reader.text(landing).select(F.trim("value").alias("scene_name"), F.col("_metadata.file_path").alias("path"))
    return lines.where("scene_name <> ''").select(F.element_at(F.split("path", "/"), -2).alias("drive"), "scene_name")


def merge_arrivals(spark: SparkSession, landing: str, scenes: str, state: str, archive: str | None = None) -> None:
    """Adds what has arrived to the scene table at ``scenes``."""

    def merge(batch: DataFrame, _: int) -> None:
        batch.distinct().write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("drive").parquet(scenes)

    arrivals(spark, landing, archive).writeStream.outputMode("append").foreachBatch(merge).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def current_scenes(spark: SparkSession, scenes: str) -> DataFrame:
    return spark.read.schema("scene_name string, drive string").parquet(scenes).select("scene_name").distinct()
