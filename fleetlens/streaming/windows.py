"""Windowed, sessionised and deduplicated streams.

The stream is a file source over a table's Parquet files, read to its end and
then stopped (``availableNow``).  Timestamps without zone are taken as UTC.

Aggregates are appended: a window or session comes out once, when the watermark
has passed its end, and its state is dropped.  Rows behind the watermark are
dropped too; ``late`` counts them by batch.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = spark.readStream.schema(EVENTS).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 64).parquet(f"{sf_dir}/events*.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only on a local master that names none."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fleetlens-"))
        found = sc.getCheckpointDir()
    return found


def run_to_end(stream: DataFrame) -> DataFrame:
    """All rows that the stream appends until its end, as a table of a file sink."""
    spark = stream.sparkSession
    root = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{root}/state").trigger(availableNow=True)
    query = writer.format("parquet").option("path", f"{root}/out").start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def late(query) -> int:
    """Rows that a finished query dropped because they came behind the watermark."""
    return sum(op.numRowsDroppedByWatermark for batch in query.recentProgress for op in batch.stateOperators)


def counts(stream: DataFrame, window: Callable, watermark: str = "10 minutes", *keys: str) -> DataFrame:
    """Counts and sums per window and keys."""
    rows = stream.withWatermark("ts", watermark).groupBy(window, *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return rows.select(F.unix_micros("window.start").alias("window_start"), *keys, "n", "total")


def tumbling(spark: SparkSession, sf_dir: str, width: str = "1 hour") -> DataFrame:
    return run_to_end(counts(read_events(spark, sf_dir), F.window("ts", width), "10 minutes", "event_type"))


def sliding(spark: SparkSession, sf_dir: str, width: str = "6 hours", step: str = "2 hours") -> DataFrame:
    return run_to_end(counts(read_events(spark, sf_dir), F.window("ts", width, step), "10 minutes", "event_type"))


def sessions(spark: SparkSession, sf_dir: str, gap: str = "12 hours") -> DataFrame:
    rows = read_events(spark, sf_dir).withWatermark("ts", "10 minutes").groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return run_to_end(rows.select(F.unix_micros("s.start").alias("session_start"), F.unix_micros("s.end").alias("session_end"), "user_id", "n"))


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events once, though each arrives twice; state lasts as long as the watermark."""
    once = read_events(spark, sf_dir).select("event_id", "ts", "value")
    twice = once.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    kept = twice.withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["event_id"])
    return run_to_end(kept.select("event_id", "value"))


def late_rows(table: DataFrame, delay: str, *order: str) -> DataFrame:
    """Rows that a stream in the given order would drop as late: more than the delay behind the latest time before them."""
    from pyspark.sql import Window

    seen = F.max("ts").over(Window.partitionBy("user_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return table.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("_seen", seen).where(F.col("ts") < F.col("_seen") - F.expr(f"INTERVAL {delay}")).drop("_seen")
