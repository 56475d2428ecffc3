"""Generic tables under the names of the recordings' tables, in Spark and in SQL.

The operators read frames, samples and annotations; these views give the
business tables those columns, so that every operator can be run and checked
on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import lookup, speed_bin
from ..operators.curate import scene_splits

FLAG_TO_CLASS = {"A": "car", "N": "pedestrian"}
SPEED_CUTS = (100000.0, 300000.0)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def frames(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select(
        F.col("event_id").alias("frame_token"),
        F.col("user_id").alias("scene_name"),
        F.col("event_type").alias("channel"),
        micros("ts").alias("timestamp"),
        (F.col("event_id") % 10 == 0).alias("is_key_frame"),
        F.when(F.col("value") < 1, F.lit(-1).cast("long")).otherwise(F.floor(F.col("value") * 1000)).alias("file_size_bytes"),
        (F.col("value") >= 1).alias("file_exists"),
        F.col("value").alias("ego_x"),
        (F.col("event_id") % 97).cast("double").alias("ego_y"),
    )


FRAMES = """frames AS (
  SELECT event_id AS frame_token, user_id AS scene_name, event_type AS channel, epoch_us(ts) AS timestamp, event_id % 10 = 0 AS is_key_frame,
         CASE WHEN value < 1 THEN -1 ELSE floor(value * 1000)::BIGINT END AS file_size_bytes, value >= 1 AS file_exists, value AS ego_x, (event_id % 97)::DOUBLE AS ego_y
  FROM events)"""


def bare_samples(spark: SparkSession, d: str) -> DataFrame:
    o, c, n, r = (read(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("o_orderkey").alias("sample_token"),
        F.col("o_custkey").alias("scene_name"),
        F.col("r_name").alias("location"),
        F.when(F.col("o_orderstatus") == "F", "night").otherwise("day").alias("time_of_day"),
        F.when(F.col("o_orderpriority").startswith("1"), "rain").otherwise("clear").alias("weather"),
        speed_bin(F.col("o_totalprice"), SPEED_CUTS).alias("speed_bin"),
        (F.col("o_totalprice") > 50000).alias("ml_ready"),
        micros("o_orderdate").alias("sample_timestamp"),
        F.col("o_totalprice").alias("price"),
    )


def samples(spark: SparkSession, d: str) -> DataFrame:
    base = bare_samples(spark, d)
    splits = scene_splits(base, 42, 0.2, 0.2)
    tags = F.array("time_of_day", "weather", "speed_bin", "location")
    return base.join(splits.select("scene_name", "split"), "scene_name").withColumn("tags", tags).withColumn("in_regression_set", (F.col("split") == "test") & F.arrays_overlap("tags", F.array(F.lit("night"), F.lit("rain"))))


BARE_SAMPLES = """bare AS (
  SELECT o_orderkey AS sample_token, o_custkey AS scene_name, r_name AS location, CASE WHEN o_orderstatus = 'F' THEN 'night' ELSE 'day' END AS time_of_day,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'rain' ELSE 'clear' END AS weather,
         CASE WHEN o_totalprice IS NULL THEN 'unknown' WHEN o_totalprice < 100000 THEN 'stopped' WHEN o_totalprice < 300000 THEN 'slow' ELSE 'moving' END AS speed_bin,
         o_totalprice > 50000 AS ml_ready, epoch_us(o_orderdate) AS sample_timestamp, o_totalprice AS price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
SPLITS = """votes AS (SELECT scene_name, time_of_day, count(*) AS n FROM bare GROUP BY ALL),
strata AS (SELECT scene_name, time_of_day FROM (SELECT *, row_number() OVER (PARTITION BY scene_name ORDER BY n DESC, time_of_day) AS k FROM votes) WHERE k = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY time_of_day ORDER BY sha256('42' || scene_name::VARCHAR), scene_name) AS r, count(*) OVER (PARTITION BY time_of_day) AS size, count(*) OVER () AS total FROM strata),
placed AS (SELECT *, row_number() OVER (ORDER BY r, size DESC, time_of_day) - 1 AS position FROM ranked),
cuts AS (SELECT *, CASE WHEN total >= 3 THEN greatest(1, round_even(total * 0.2::DOUBLE, 0)) ELSE 0 END::BIGINT AS part FROM placed),
splits AS (SELECT scene_name, time_of_day, position, CASE WHEN position < part THEN 'test' WHEN position < 2 * part THEN 'val' ELSE 'train' END AS split FROM cuts)"""
SAMPLES = (
    BARE_SAMPLES
    + ",\n"
    + SPLITS
    + """,
samples AS (
  SELECT bare.*, split, [bare.time_of_day, weather, speed_bin, location] AS tags, split = 'test' AND list_has_any([bare.time_of_day, weather, speed_bin, location], ['night', 'rain']) AS in_regression_set
  FROM bare JOIN splits ON bare.scene_name = splits.scene_name)"""
)


def annotations(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return read(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.floor(c("l_extendedprice") * 100 + 0.5).cast("long")).alias("annotation_token"),
        c("l_orderkey").alias("sample_token"),
        lookup(c("l_returnflag"), FLAG_TO_CLASS).alias("det_class"),
        (F.floor("l_quantity") - 1).cast("int").alias("num_lidar_pts"),
        (c("l_linenumber") % 4 + 1).cast("int").alias("visibility"),
        F.array("l_quantity", c("l_extendedprice") / 1000, c("l_tax") * 10 + 1).alias("size"),
        F.array(c("l_extendedprice") / 1000 - 30, c("l_discount") * 100 - 5, c("l_tax") * 10 + 0.0).alias("translation"),
        F.array(F.cos(c("l_quantity") / 20), F.lit(0.0), F.lit(0.0), F.sin(c("l_quantity") / 20)).alias("rotation"),
        c("l_quantity").alias("quantity"),
        c("l_discount").alias("discount"),
        c("l_extendedprice").alias("price"),
    )


ANNOTATIONS = """annotations AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, floor(l_extendedprice * 100 + 0.5)::BIGINT) AS annotation_token, l_orderkey AS sample_token,
         CASE l_returnflag WHEN 'A' THEN 'car' WHEN 'N' THEN 'pedestrian' END AS det_class, (floor(l_quantity) - 1)::INTEGER AS num_lidar_pts, (l_linenumber % 4 + 1)::INTEGER AS visibility,
         [l_quantity, l_extendedprice / 1000, l_tax * 10 + 1] AS size, [l_extendedprice / 1000 - 30, l_discount * 100 - 5, l_tax * 10 + 0.0] AS translation,
         [cos(l_quantity / 20), 0.0, 0.0, sin(l_quantity / 20)]::DOUBLE[] AS rotation, l_quantity AS quantity, l_discount AS discount, l_extendedprice AS price
  FROM lineitem)"""
LABELS_QC = """labels_qc AS (
  SELECT *, CASE WHEN det_class IS NOT NULL AND num_lidar_pts < 10 THEN 'weak' WHEN visibility < 2 THEN 'low_visibility' ELSE 'ok' END AS label_quality FROM annotations)"""


def points(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as 16 points of four values each."""
    at = F.sequence(F.lit(0), F.lit(15))
    value = lambda i, k: F.get("embedding", i * 4 + k).cast("double") * 20
    rows = read(spark, d, "embeddings").select("vec_id", "label", F.explode(F.transform(at, lambda i: F.struct(i.alias("i"), value(i, 0).alias("x"), value(i, 1).alias("y"), value(i, 2).alias("z"), value(i, 3).alias("intensity")))).alias("p"))
    return rows.select(F.col("vec_id").alias("frame"), F.col("label").alias("cls"), F.col("p.i").cast("int").alias("point"), "p.x", "p.y", "p.z", "p.intensity")


POINTS = """points AS (
  SELECT vec_id AS frame, label AS cls, i::INTEGER AS point, embedding[i * 4 + 1]::DOUBLE * 20 AS x, embedding[i * 4 + 2]::DOUBLE * 20 AS y, embedding[i * 4 + 3]::DOUBLE * 20 AS z, embedding[i * 4 + 4]::DOUBLE * 20 AS intensity
  FROM embeddings, range(0, 16) r(i))"""
