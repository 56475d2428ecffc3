"""Queries for scans, projections, filters, joins and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import curate, kpi, timing
from .adapters import ANNOTATIONS, BARE_SAMPLES, FRAMES, POINTS, SAMPLES, annotations, bare_samples, frames, points, read, samples
from .registry import query

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHANNELS = ["click", "view", "purchase"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def scan_manifest_counts(spark, d):
    return reduce(DataFrame.unionByName, [read(spark, d, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in TABLES])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def scan_pk_guard(spark, d):
    return read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def scan_json_props(spark, d):
    return read(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("WITH " + FRAMES + " SELECT frame_token, file_size_bytes, file_exists FROM frames")
def scan_file_status(spark, d):
    return frames(spark, d).select("frame_token", "file_size_bytes", "file_exists")


@query("SELECT o_orderkey, CASE WHEN o_totalprice / 5000 < 20 THEN 'near' WHEN o_totalprice / 5000 < 40 THEN 'mid' WHEN o_totalprice IS NOT NULL THEN 'far' END AS distance_bin FROM orders")
def proj_distance_bin(spark, d):
    return read(spark, d, "orders").select("o_orderkey", S.distance_bin(F.col("o_totalprice") / 5000).alias("distance_bin"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice IS NULL THEN 'unknown' WHEN o_totalprice < 100000 THEN 'stopped' WHEN o_totalprice < 300000 THEN 'slow' ELSE 'moving' END AS speed_bin FROM orders")
def proj_speed_bin(spark, d):
    return read(spark, d, "orders").select("o_orderkey", S.speed_bin(F.col("o_totalprice"), (100000.0, 300000.0)).alias("speed_bin"))


@query("SELECT doc_id, CASE WHEN contains(lower(text), 'license') THEN 'licensed' ELSE 'plain' END AS rights, CASE WHEN contains(lower(text), 'the') THEN 'the' ELSE 'other' END AS wording FROM documents")
def proj_keyword_tags(spark, d):
    return read(spark, d, "documents").select("doc_id", S.keyword_tag(F.col("text"), "license", "licensed", "plain").alias("rights"), S.keyword_tag(F.col("text"), "the", "the", "other").alias("wording"))


@query("SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'car' WHEN 'STANDARD' THEN 'truck' WHEN 'SMALL' THEN 'bicycle' WHEN 'LARGE' THEN 'bus' WHEN 'MEDIUM' THEN 'trailer' END AS det_class FROM part")
def proj_class_map(spark, d):
    return read(spark, d, "part").select("p_partkey", S.lookup(F.col("p_type"), {"ECONOMY": "car", "STANDARD": "truck", "SMALL": "bicycle", "LARGE": "bus", "MEDIUM": "trailer"}).alias("det_class"))


@query("SELECT l_orderkey, l_partkey, l_linenumber, [CASE l_returnflag WHEN 'A' THEN 'moving' ELSE l_returnflag END, CASE l_linestatus WHEN 'O' THEN 'parked' ELSE l_linestatus END] AS attributes FROM lineitem")
def proj_array_map_fallback(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", S.lookup_each(F.array("l_returnflag", "l_linestatus"), {"A": "moving", "O": "parked"}).alias("attributes"))


_HAS = "count_if(det_class = 'car') AS n_car, count_if(det_class = 'pedestrian') AS n_pedestrian"


@query(
    "WITH " + BARE_SAMPLES + ", " + ANNOTATIONS + f", c AS (SELECT sample_token, {_HAS} FROM annotations GROUP BY 1) "
    "SELECT bare.sample_token, list_filter([time_of_day, weather, speed_bin, location, CASE WHEN coalesce(n_car, 0) > 0 THEN 'has_car' END, CASE WHEN coalesce(n_pedestrian, 0) > 0 THEN 'has_pedestrian' END, "
    "CASE WHEN coalesce(n_pedestrian, 0) >= 3 THEN 'crowded' END], lambda t: t IS NOT NULL) AS tags FROM bare LEFT JOIN c ON bare.sample_token = c.sample_token"
)
def proj_tag_list(spark, d):
    counted = curate.class_counts(bare_samples(spark, d), annotations(spark, d), ["car", "pedestrian"]).withColumn("crowded", F.col("n_pedestrian") >= 3)
    return counted.select("sample_token", curate.tag_list(["car", "pedestrian"]).alias("tags"))


@query("WITH " + ANNOTATIONS + " SELECT annotation_token, CASE WHEN det_class IS NOT NULL AND num_lidar_pts < 10 THEN 'weak' WHEN visibility < 2 THEN 'low_visibility' ELSE 'ok' END AS label_quality FROM annotations")
def proj_label_quality(spark, d):
    return annotations(spark, d).select("annotation_token", S.label_quality(F.col("num_lidar_pts"), F.col("visibility"), 10, 2, F.col("det_class")).alias("label_quality"))


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'calibration_suspect' WHEN o_orderkey % 5 = 0 THEN 'out_of_sync' WHEN o_orderkey % 3 = 0 THEN 'camera_qc_error' WHEN o_orderkey % 2 = 0 THEN 'no_camera_keyframe' END AS not_ready_reason FROM orders"
)
def proj_not_ready_reason(spark, d):
    k = F.col("o_orderkey")
    return read(spark, d, "orders").select("o_orderkey", S.not_ready_reason(k % 2 != 0, k % 3 == 0, k % 5 != 0, k % 7 != 0).alias("not_ready_reason"))


@query("WITH " + SAMPLES + " SELECT sample_token, split = 'test' AND list_has_any(tags, ['night', 'rain']) AS in_regression_set FROM samples")
def proj_regression_overlap(spark, d):
    return samples(spark, d).select("sample_token", "in_regression_set")


@query(
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, printf('%d %.6f %.6f %.6f %.6f', l_linenumber, ((l_quantity * 8) + (l_quantity * 16)) / 2 / 1590, ((l_linenumber * 32) + (l_linenumber * 96)) / 2 / 930, "
    "((l_quantity * 16) - (l_quantity * 8)) / 1590, ((l_linenumber * 96) - (l_linenumber * 32)) / 930) AS line FROM lineitem"
)
def proj_yolo_line(spark, d):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", S.yolo_line(n, q * 8, n * 32, q * 16, n * 96, F.lit(1590), F.lit(930)).alias("line"))


@query("SELECT DISTINCT event_type || '.' || (user_id % 3) || '.ERROR' AS metric, event_type || '.' || (user_id % 3) AS check_name, 'ERROR' AS severity FROM events")
def proj_metric_name_split(spark, d):
    name = F.concat_ws(".", "event_type", F.col("user_id") % 3, F.lit("ERROR"))
    head, tail = S.split_last(F.col("metric"))
    return read(spark, d, "events").select(name.alias("metric")).distinct().select("metric", head.alias("check_name"), tail.alias("severity"))


@query("WITH " + FRAMES + " SELECT frame_token, printf('%+.1f ms', (timestamp % 1000000) / 1000.0::DOUBLE - 500.0003) AS message FROM frames")
def proj_messages(spark, d):
    return frames(spark, d).select("frame_token", F.format_string("%+.1f ms", F.col("timestamp") % 1000000 / 1000.0 - 500.0003).alias("message"))


@query("WITH " + FRAMES + " SELECT frame_token, round((timestamp - min(timestamp) OVER (PARTITION BY scene_name)) / 1e6, 1) AS seconds FROM frames")
def proj_since_start(spark, d):
    w = Window.partitionBy("scene_name")
    return frames(spark, d).select("frame_token", F.round((F.col("timestamp") - F.min("timestamp").over(w)) / 1e6, 1).alias("seconds"))


@query("WITH " + FRAMES + " SELECT * FROM frames WHERE channel IN ('click', 'view', 'purchase')")
def filter_enabled_channels(spark, d):
    return frames(spark, d).where(F.col("channel").isin(CHANNELS))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)")
def filter_scene_list(spark, d):
    return read(spark, d, "orders").where(F.col("o_custkey").isin([1, 2, 3, 5, 8, 13, 21, 34, 55, 89])).select("o_orderkey", "o_custkey")


@query("WITH " + FRAMES + " SELECT * FROM frames WHERE is_key_frame")
def filter_keyframes(spark, d):
    return frames(spark, d).where("is_key_frame")


@query(
    "SELECT r_name, n_name, count(*) AS n, round(sum(l_quantity), 4) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"
)
def join_star_frames(spark, d):
    l, o, c, n, r = (read(spark, d, t) for t in ("lineitem", "orders", "customer", "nation", "region"))  # noqa: E741
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity"))


def grid_frames(spark, d):
    """Frames with samples: the scene's day."""
    return frames(spark, d).withColumn("sample_token", F.concat_ws(":", "scene_name", F.floor(F.col("timestamp") / 86400000000)))


GRID_FRAMES = FRAMES + ", gf AS (SELECT *, scene_name::VARCHAR || ':' || (timestamp // 86400000000)::VARCHAR AS sample_token FROM frames)"
GRID = (
    GRID_FRAMES
    + """,
keyed AS (SELECT sample_token, scene_name, channel, min(timestamp) AS timestamp FROM gf WHERE is_key_frame GROUP BY ALL),
grid AS (SELECT DISTINCT sample_token, scene_name, c.channel FROM gf, (VALUES ('click'), ('view'), ('purchase')) c(channel)),
sync AS (
  SELECT grid.sample_token, grid.scene_name, grid.channel, k.timestamp, r.timestamp AS ref_timestamp, k.timestamp IS NOT NULL AS has_keyframe, (k.timestamp - r.timestamp) / 1000.0::DOUBLE AS offset_ms
  FROM grid LEFT JOIN keyed k ON grid.sample_token = k.sample_token AND grid.channel = k.channel
  LEFT JOIN keyed r ON grid.sample_token = r.sample_token AND r.channel = 'view')"""
)


@query("WITH " + GRID + " SELECT * FROM sync")
def join_sync_grid(spark, d):
    return timing.sync_grid(grid_frames(spark, d), CHANNELS, "view")


@query("WITH " + FRAMES + " SELECT frame_token, channel, value AS brightness, f.event_id IS NOT NULL AS decode_ok FROM frames LEFT JOIN (SELECT event_id, value FROM events WHERE value >= 5) f ON frame_token = f.event_id")
def join_left_features(spark, d):
    features = read(spark, d, "events").where("value >= 5").select(F.col("event_id").alias("frame_token"), F.col("value").alias("brightness"), F.lit(True).alias("decode_ok"))
    return frames(spark, d).join(features, "frame_token", "left").select("frame_token", "channel", "brightness", F.coalesce("decode_ok", F.lit(False)).alias("decode_ok"))


@query("WITH " + GRID_FRAMES + " SELECT a.frame_token, b.frame_token AS frame_token_lidar, a.sample_token FROM gf a JOIN gf b ON a.sample_token = b.sample_token WHERE a.channel = 'click' AND b.channel = 'view'")
def join_self_pairs(spark, d):
    f = grid_frames(spark, d)
    cam, lidar = f.where("channel = 'click'").select("sample_token", "frame_token"), f.where("channel = 'view'").select("sample_token", F.col("frame_token").alias("frame_token_lidar"))
    return cam.join(lidar, "sample_token")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def join_semi_ingested(spark, d):
    o = read(spark, d, "orders").where("o_orderstatus = 'F'")
    return read(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@query("SELECT unnest(['car', 'truck', 'pedestrian', 'bus']) AS det_class EXCEPT SELECT CASE l_returnflag WHEN 'A' THEN 'car' WHEN 'N' THEN 'pedestrian' END FROM lineitem")
def join_anti_missing_classes(spark, d):
    return kpi.missing_classes(spark, annotations(spark, d), ["car", "truck", "pedestrian", "bus"])


@query("WITH " + GRID + " SELECT frame_token, NOT is_key_frame OR b.sample_token IS NULL AS sync_ok FROM gf LEFT JOIN (SELECT DISTINCT sample_token, channel FROM sync WHERE NOT has_keyframe OR abs(offset_ms) > 3600000) b ON gf.sample_token = b.sample_token AND gf.channel = b.channel")
def join_sync_bad_pairs(spark, d):
    f = grid_frames(spark, d)
    bad = timing.sync_grid(f, CHANNELS, "view").where("NOT has_keyframe OR abs(offset_ms) > 3600000").select("sample_token", "channel").distinct().withColumn("bad", F.lit(True))
    return f.join(bad, ["sample_token", "channel"], "left").select("frame_token", (~F.col("is_key_frame") | F.col("bad").isNull()).alias("sync_ok"))


@query(
    "WITH " + BARE_SAMPLES + ", part AS (SELECT DISTINCT location, time_of_day, weather, speed_bin FROM bare WHERE price < 60000 OR location <> 'ASIA'), "
    "grid AS (SELECT * FROM (SELECT DISTINCT location FROM part) CROSS JOIN (SELECT DISTINCT time_of_day FROM part) CROSS JOIN (SELECT DISTINCT speed_bin FROM part)) "
    "SELECT * FROM grid EXCEPT SELECT location, time_of_day, speed_bin FROM part"
)
def join_cross_coverage_gaps(spark, d):
    return kpi.coverage_gaps(bare_samples(spark, d).where("price < 60000 OR location <> 'ASIA'"), ["location", "time_of_day", "speed_bin"])


@query("WITH " + POINTS + ", boxes AS (SELECT DISTINCT frame, b::INTEGER AS box, -4.0 + 2 * b AS x1, 1.0 + 2 * b AS x2, -3.0 AS y1, 3.0 AS y2 FROM points, range(0, 3) r(b)) "
       "SELECT points.frame, box, point FROM points JOIN boxes ON points.frame = boxes.frame WHERE x BETWEEN x1 + (x2 - x1) * 0.05::DOUBLE AND x2 - (x2 - x1) * 0.05::DOUBLE AND y BETWEEN y1 + (y2 - y1) * 0.05::DOUBLE AND y2 - (y2 - y1) * 0.05::DOUBLE")  # fmt: skip
def join_range_frustum(spark, d):
    from ..operators.fusion import in_frustum

    p = points(spark, d)
    b = F.col("box")
    boxes = p.select("frame").distinct().withColumn("box", F.explode(F.sequence(F.lit(0), F.lit(2)))).select("frame", "box", (b * 2 - 4.0).alias("x1"), (b * 2 + 1.0).alias("x2"), F.lit(-3.0).alias("y1"), F.lit(3.0).alias("y2"))
    return in_frustum(p.select("frame", "point", F.col("x").alias("u"), F.col("y").alias("v")), boxes, "frame", 0.1).select("frame", "box", "point")


@query(
    "WITH " + FRAMES + ", k AS (SELECT scene_name, timestamp AS t, frame_token AS token FROM frames WHERE is_key_frame) "
    "SELECT frame_token, nearest_token, nearest_gap FROM (SELECT f.frame_token, k.token AS nearest_token, abs(f.timestamp - k.t) AS nearest_gap, row_number() OVER (PARTITION BY f.frame_token ORDER BY abs(f.timestamp - k.t) NULLS LAST, k.token) AS r "
    "FROM frames f LEFT JOIN k ON f.scene_name = k.scene_name) WHERE r = 1"
)
def join_nearest_sample(spark, d):
    f = frames(spark, d).select("frame_token", "scene_name", "timestamp")
    k = frames(spark, d).where("is_key_frame").select("scene_name", F.col("timestamp").alias("t"), F.col("frame_token").alias("token"))
    return timing.nearest(f, k, "scene_name", "timestamp", "t", "token").select("frame_token", "nearest_token", "nearest_gap")


@query("SELECT s_nationkey AS nationkey FROM supplier WHERE s_acctbal > 0 UNION SELECT c_nationkey FROM customer WHERE c_acctbal > 9000")
def set_union_scenes(spark, d):
    return read(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("nationkey")).union(read(spark, d, "customer").where("c_acctbal > 9000").select("c_nationkey")).distinct()


@query("SELECT n_nationkey FROM nation EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9900")
def set_except_required(spark, d):
    return read(spark, d, "nation").select("n_nationkey").exceptAll(read(spark, d, "customer").where("c_acctbal > 9900").select("c_nationkey").distinct())


@query("WITH " + BARE_SAMPLES + " SELECT sample_token, scene_name, location FROM (SELECT *, row_number() OVER (PARTITION BY sample_token, scene_name ORDER BY location) AS r FROM (SELECT * FROM bare UNION ALL SELECT * FROM bare)) WHERE r = 1")
def set_drop_duplicates(spark, d):
    b = bare_samples(spark, d).select("sample_token", "scene_name", "location")
    return b.unionByName(b).groupBy("sample_token", "scene_name").agg(F.min("location").alias("location"))


@query("WITH " + BARE_SAMPLES + " SELECT scene_name, count(*) AS missed FROM bare WHERE NOT ml_ready GROUP BY 1 ORDER BY missed DESC, scene_name DESC LIMIT 10")
def sort_topk_failures(spark, d):
    return bare_samples(spark, d).where("NOT ml_ready").groupBy("scene_name").agg(F.count(F.lit(1)).alias("missed")).orderBy(F.desc("missed"), F.desc("scene_name")).limit(10)


@query("SELECT l_returnflag, l_linestatus, l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice DESC, l_orderkey) AS r FROM lineitem) WHERE r = 1")
def sort_best_of_group(spark, d):
    best = F.max(F.struct("l_extendedprice", (-F.col("l_orderkey")).alias("neg"))).alias("b")
    return read(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(best).select("l_returnflag", "l_linestatus", (-F.col("b.neg")).alias("l_orderkey"), F.col("b.l_extendedprice").alias("l_extendedprice"))


@query(
    "WITH " + FRAMES + ", n AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY timestamp, frame_token) - 1 AS pos, count(*) OVER (PARTITION BY channel) AS total FROM frames) "
    "SELECT channel, frame_token FROM n WHERE pos IN (SELECT round_even(i * (total - 1) / 7::DOUBLE, 0)::BIGINT FROM range(0, 8) r(i))"
)
def sort_even_pick(spark, d):
    w = Window.partitionBy("channel")
    f = frames(spark, d).select("channel", "frame_token", F.row_number().over(w.orderBy("timestamp", "frame_token")).alias("pos"), F.count(F.lit(1)).over(w).alias("total"))
    return f.where(F.array_contains(S.even_positions(F.col("total"), 8), F.col("pos").cast("long") - 1)).select("channel", "frame_token")
