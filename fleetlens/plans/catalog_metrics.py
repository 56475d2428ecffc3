"""Queries for aggregations, window operators and the quality rules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import curate, fusion, kpi, quality, timing
from ..params import Params
from .adapters import ANNOTATIONS, BARE_SAMPLES, FRAMES, LABELS_QC, POINTS, SAMPLES, SPLITS, annotations, bare_samples, frames, points, read, samples
from .catalog_tables import CHANNELS, GRID, grid_frames
from .registry import query

PERIOD_MS, FACTOR = 48 * 3600 * 1000.0, 2.5
MOTION = FRAMES + """,
motion AS (
  SELECT *, (timestamp - lag(timestamp) OVER w) / 1000.0::DOUBLE AS dt_prev_ms,
         sqrt(pow(ego_x - lag(ego_x) OVER w, 2) + pow(ego_y - lag(ego_y) OVER w, 2)) / nullif((timestamp - lag(timestamp) OVER w) / 1000.0::DOUBLE / 1000, 0) AS ego_speed_mps
  FROM frames WINDOW w AS (PARTITION BY scene_name, channel ORDER BY timestamp, frame_token))"""


def params() -> Params:
    p = Params()
    p.quality.min_box_lidar_points = 10
    return p


def labels_qc(spark, d):
    return quality.label_status(annotations(spark, d), params())


@query("WITH " + FRAMES + " SELECT channel, count(*) AS frames, sum(is_key_frame::INT)::BIGINT AS keyframes, sum(greatest(file_size_bytes, 0))::BIGINT AS bytes FROM frames GROUP BY 1")
def agg_volume(spark, d):
    return kpi.volume(frames(spark, d))


@query("WITH " + FRAMES + " SELECT sum(s) / 1e6::DOUBLE AS recording_seconds FROM (SELECT max(timestamp) - min(timestamp) AS s FROM frames GROUP BY scene_name)")
def agg_duration(spark, d):
    return kpi.duration(frames(spark, d))


@query("WITH " + FRAMES + ", h AS (SELECT channel, count(*) / nullif((max(timestamp) - min(timestamp)) / 1e6::DOUBLE, 0) AS hz FROM frames GROUP BY scene_name, channel) SELECT channel, round(median(hz) * 1e6, 6) AS measured_uhz FROM h GROUP BY 1")
def agg_rate_median(spark, d):
    return kpi.rate(frames(spark, d)).select("channel", F.round(F.col("measured_hz") * 1e6, 6).alias("measured_uhz"))


@query("WITH " + FRAMES + " SELECT channel, round(avg((file_exists AND ego_y < 90)::INT::DOUBLE), 6) AS pass_rate FROM frames GROUP BY 1")
def agg_pass_rate(spark, d):
    return kpi.pass_rate(frames(spark, d).withColumn("qc_pass", F.col("file_exists") & (F.col("ego_y") < 90))).select("channel", F.round("pass_rate", 6).alias("pass_rate"))


@query("WITH " + GRID + " SELECT channel, quantile_disc(abs(offset_ms), 0.5) AS p50_ms, quantile_disc(abs(offset_ms), 0.95) AS p95_ms, max(abs(offset_ms)) AS max_ms FROM sync WHERE has_keyframe GROUP BY 1")
def agg_sync_percentiles(spark, d):
    return kpi.sync_percentiles(timing.sync_grid(grid_frames(spark, d), CHANNELS, "view"))


@query("WITH " + ANNOTATIONS + ", " + LABELS_QC + """ SELECT count(*) AS boxes, round(count_if(label_quality = 'ok') / count(*)::DOUBLE, 4) AS ok_rate, round(count_if(label_quality = 'weak') / count(*)::DOUBLE, 4) AS weak_rate,
  round(count_if(label_quality = 'low_visibility') / count(*)::DOUBLE, 4) AS low_visibility_rate FROM labels_qc WHERE det_class IS NOT NULL""")  # fmt: skip
def agg_label_quality(spark, d):
    return kpi.label_rates(labels_qc(spark, d))


_BOXES = ANNOTATIONS + ", boxes AS (SELECT det_class, CASE WHEN price / 1000 < 20 THEN 'near' WHEN price / 1000 < 40 THEN 'mid' ELSE 'far' END AS distance_bin, sample_token FROM annotations WHERE det_class IS NOT NULL)"


def boxes(spark, d):
    return annotations(spark, d).where("det_class IS NOT NULL").select("det_class", S.distance_bin(F.col("price") / 1000).alias("distance_bin"), "sample_token")


@query("WITH " + _BOXES + " SELECT det_class, distance_bin, count(*) AS n FROM boxes GROUP BY GROUPING SETS ((det_class), (distance_bin))")
def agg_boxes_grouping_sets(spark, d):
    return kpi.boxes_by(boxes(spark, d), "det_class", "distance_bin")


@query("WITH " + SAMPLES + " SELECT split, count(*) AS samples, sum(ml_ready::INT)::BIGINT AS ml_ready, sum((in_regression_set AND ml_ready)::INT)::BIGINT AS regression_set FROM samples GROUP BY 1")
def agg_readiness(spark, d):
    return kpi.readiness(samples(spark, d))


@query("WITH " + SAMPLES + ", " + _BOXES + " SELECT det_class, count(*) AS boxes FROM boxes JOIN samples ON boxes.sample_token = samples.sample_token WHERE split = 'train' GROUP BY 1")
def agg_train_balance(spark, d):
    return kpi.train_balance(boxes(spark, d), samples(spark, d))


@query("WITH " + SAMPLES + " SELECT location, time_of_day, weather, speed_bin, split, count(*) AS samples, sum(ml_ready::INT)::BIGINT AS ml_ready FROM samples GROUP BY ALL")
def agg_coverage(spark, d):
    return kpi.coverage(samples(spark, d))


@query("WITH " + BARE_SAMPLES + ", c AS (SELECT DISTINCT location, time_of_day, weather FROM bare) SELECT count(*) AS observed, count(DISTINCT location) * count(DISTINCT time_of_day) * count(DISTINCT weather) AS possible, count(DISTINCT location) * count(DISTINCT time_of_day) * count(DISTINCT weather) - count(*) AS empty FROM c")
def agg_coverage_summary(spark, d):
    return kpi.coverage_summary(bare_samples(spark, d))


@query("WITH " + BARE_SAMPLES + ", " + ANNOTATIONS + """, c AS (SELECT sample_token, count_if(det_class = 'car') AS n_car, count_if(det_class = 'pedestrian') AS n_pedestrian FROM annotations GROUP BY 1)
SELECT bare.sample_token, coalesce(n_car, 0)::INTEGER AS n_car, coalesce(n_pedestrian, 0)::INTEGER AS n_pedestrian, coalesce(n_car, 0) > 0 AS has_car, coalesce(n_pedestrian, 0) > 0 AS has_pedestrian FROM bare LEFT JOIN c ON bare.sample_token = c.sample_token""")
def agg_pivot_counts(spark, d):
    return curate.class_counts(bare_samples(spark, d).select("sample_token"), annotations(spark, d), ["car", "pedestrian"])


@query("WITH " + BARE_SAMPLES + " SELECT location, count_if(time_of_day = 'day') AS day, count_if(time_of_day = 'night') AS night, count_if(weather = 'clear') AS clear, count_if(weather = 'rain') AS rain FROM bare GROUP BY 1")
def agg_pivot_condition(spark, d):
    n = lambda c, v: F.count_if(F.col(c) == v).alias(v)
    return bare_samples(spark, d).groupBy("location").agg(n("time_of_day", "day"), n("time_of_day", "night"), n("weather", "clear"), n("weather", "rain"))


@query("WITH " + BARE_SAMPLES + ", " + SPLITS + " SELECT scene_name, time_of_day FROM splits")
def agg_mode_stratum(spark, d):
    return curate.mode_by(bare_samples(spark, d), "scene_name", "time_of_day")


@query("WITH " + SAMPLES + " SELECT scene_name, count(DISTINCT CASE WHEN price > 400000 THEN 'x' ELSE split END) AS n_splits FROM samples GROUP BY 1 HAVING count(DISTINCT CASE WHEN price > 400000 THEN 'x' ELSE split END) > 1")
def agg_leakage(spark, d):
    return curate.leaking_scenes(samples(spark, d).withColumn("split", F.when(F.col("price") > 400000, "x").otherwise(F.col("split"))))


@query("WITH " + ANNOTATIONS + ", s AS (SELECT det_class, median(size[1]) AS w, median(size[2]) AS l, median(size[3]) AS h FROM annotations WHERE det_class IS NOT NULL GROUP BY 1 HAVING count(*) >= 5) SELECT * FROM (SELECT det_class, round(w, 6) AS w, round(l, 6) AS l, round(h, 6) AS h, 'data' AS source FROM s UNION ALL SELECT 'bus', 2.94, 11.19, 3.47, 'default')")
def agg_size_priors(spark, d):
    r = fusion.size_priors(annotations(spark, d), 5).where("det_class IN ('car', 'pedestrian', 'bus')")
    return r.select("det_class", *[F.round(c, 6).alias(c) for c in "wlh"], "source")


@query("SELECT event_type, b AS le, count_if(value <= b) AS n FROM events, (VALUES (5.0::DOUBLE), (25.0), (100.0), (400.0), ('inf'::DOUBLE)) t(b) GROUP BY ALL")
def agg_histogram(spark, d):
    return kpi.histogram(read(spark, d, "events"), "value", [5.0, 25.0, 100.0, 400.0], "event_type")


@query("SELECT event_type, round(quantile_cont(value, 0.05), 6) AS p5, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1")
def agg_percentiles_linear(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(*[F.round(F.percentile("value", q), 6).alias(n) for q, n in ((0.05, "p5"), (0.5, "p50"), (0.99, "p99"))])


@query("WITH " + POINTS + " SELECT frame, count(*) AS n_points, round(avg(sqrt(x * x + y * y + z * z)), 6) AS mean_range, round(max(sqrt(x * x + y * y + z * z)), 6) AS max_range, round(avg(intensity), 6) AS mean_intensity FROM points GROUP BY 1")
def agg_points_stats(spark, d):
    r = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    return points(spark, d).groupBy("frame").agg(F.count(F.lit(1)).alias("n_points"), F.round(F.avg(r), 6).alias("mean_range"), F.round(F.max(r), 6).alias("max_range"), F.round(F.avg("intensity"), 6).alias("mean_intensity"))


@query("SELECT event_type, round(stddev_pop(value), 6) AS contrast, round(var_pop(value), 4) AS sharpness, round(avg(value), 6) AS brightness FROM events GROUP BY 1")
def agg_population_std(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(F.round(F.stddev_pop("value"), 6).alias("contrast"), F.round(F.var_pop("value"), 4).alias("sharpness"), F.round(F.avg("value"), 6).alias("brightness"))


@query("WITH " + BARE_SAMPLES + " SELECT count(DISTINCT scene_name) AS scenes, count(DISTINCT sample_token) AS samples FROM bare")
def agg_distinct_counts(spark, d):
    return bare_samples(spark, d).agg(F.count_distinct("scene_name").alias("scenes"), F.count_distinct("sample_token").alias("samples"))


@query("WITH " + ANNOTATIONS + " SELECT det_class, count(*) AS n FROM annotations WHERE det_class IS NOT NULL GROUP BY 1")
def agg_value_counts(spark, d):
    return annotations(spark, d).where("det_class IS NOT NULL").groupBy("det_class").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + MOTION + " SELECT frame_token, dt_prev_ms FROM motion")
def win_dt_prev(spark, d):
    return timing.with_motion(frames(spark, d)).select("frame_token", "dt_prev_ms")


@query("WITH " + MOTION + " SELECT frame_token, round(ego_speed_mps, 9) AS ego_speed_mps FROM motion")
def win_speed(spark, d):
    return timing.with_motion(frames(spark, d)).select("frame_token", F.round("ego_speed_mps", 9).alias("ego_speed_mps"))


@query("WITH " + FRAMES + ", n AS (SELECT *, CASE WHEN is_key_frame THEN ego_x END AS v FROM frames) SELECT frame_token, first_value(v IGNORE NULLS) OVER (PARTITION BY scene_name ORDER BY timestamp, frame_token ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled FROM n")
def win_bfill(spark, d):
    return frames(spark, d).select("frame_token", timing.backfilled(F.when(F.col("is_key_frame"), F.col("ego_x")), "scene_name", order=["timestamp", "frame_token"]).alias("filled"))


@query("WITH " + FRAMES + " SELECT frame_token FROM (SELECT *, row_number() OVER (PARTITION BY scene_name, channel, timestamp // 86400000000 ORDER BY frame_token) AS r FROM frames) WHERE r > 1")
def win_duplicates(spark, d):
    f = frames(spark, d).withColumn("day", F.floor(F.col("timestamp") / 86400000000))
    return timing.duplicates(f, "scene_name", "channel", "day").select("frame_token")


@query("WITH " + MOTION + f" SELECT frame_token, round(dt_prev_ms, 3) AS dt_prev_ms, (round_even(dt_prev_ms / {PERIOD_MS}::DOUBLE, 0) - 1)::BIGINT AS dropped FROM motion WHERE dt_prev_ms > {PERIOD_MS}::DOUBLE * {FACTOR}")
def win_gaps(spark, d):
    return timing.gaps(timing.with_motion(frames(spark, d)), F.lit(PERIOD_MS), FACTOR).select("frame_token", F.round("dt_prev_ms", 3).alias("dt_prev_ms"), "dropped")


@query("WITH " + POINTS + ", j AS (SELECT *, CASE WHEN x - lag(x) OVER (PARTITION BY frame ORDER BY x, point) > 0.8 THEN 1 ELSE 0 END AS jump FROM points) SELECT frame, point, sum(jump) OVER (PARTITION BY frame ORDER BY x, point ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM j")
def win_islands(spark, d):
    return fusion.with_islands(points(spark, d), "frame", "x", 0.8, "point").select("frame", "point", "island")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) OVER w::BIGINT AS tp, sum(CASE WHEN l_quantity > 25 THEN 0 ELSE 1 END) OVER w::BIGINT AS fp FROM lineitem WINDOW w AS (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_suppkey, l_linenumber ROWS UNBOUNDED PRECEDING)")
def win_running_tp(spark, d):
    w = Window.partitionBy("l_partkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_suppkey", "l_linenumber").rowsBetween(Window.unboundedPreceding, 0)
    hit = F.col("l_quantity") > 25
    return read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.sum(hit.cast("long")).over(w).alias("tp"), F.sum((~hit).cast("long")).over(w).alias("fp"))


@query("SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS envelope FROM events")
def win_reverse_max(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(0, Window.unboundedFollowing)
    return read(spark, d, "events").select("event_id", F.max("value").over(w).alias("envelope"))


@query("WITH " + BARE_SAMPLES + ", " + SPLITS + " SELECT scene_name, position, split FROM splits")
def win_round_robin_split(spark, d):
    return curate.scene_splits(bare_samples(spark, d), 42, 0.2, 0.2).select("scene_name", "position", "split")


def checked_frames(spark, d):
    """Frames with what the rules read: modality by channel, features from the event's value."""
    f = timing.with_motion(frames(spark, d))
    return f.withColumns({"modality": F.when(F.col("channel") == "click", "camera").when(F.col("channel") == "view", "lidar").otherwise("radar"), "n_points": F.col("ego_x") * 60, "brightness": F.col("ego_x") * 2, "decode_ok": F.col("frame_token") % 50 != 0})


def event_rules():
    c, t = F.col, F.col("frame_token")
    return [
        quality.Rule("missing_file", "ERROR", "frame", t, ~c("file_exists")),
        quality.Rule("corrupt_file", "ERROR", "frame", t, c("file_exists") & ~c("decode_ok")),
        quality.Rule("frame_gap", "WARN", "frame", t, c("dt_prev_ms") > PERIOD_MS * FACTOR, F.round(c("dt_prev_ms"), 3)),
        quality.Rule("low_lidar_points", "WARN", "frame", t, (c("modality") == "lidar") & c("decode_ok") & (c("n_points") < 600), F.round("n_points", 6)),
        quality.Rule("night_metadata_mismatch", "WARN", "frame", t, (c("modality") == "camera") & c("is_key_frame") & (c("brightness") > 90), F.round("brightness", 6)),
    ]


def event_issues(spark, d):
    rows = checked_frames(spark, d)
    sync = timing.sync_grid(grid_frames(spark, d), CHANNELS, "view")
    late = Params()
    late.quality.sync_tolerance_ms = 3600000.0
    return quality.union_issues(
        [
            quality.issues_of(rows, event_rules(), F.col("scene_name"), F.col("channel")),
            quality.issues_of(sync, [quality.Rule(r.check, r.severity, r.entity_type, r.entity_id, r.when, r.value) for r in quality.sync_rules(late)], F.col("scene_name"), F.col("channel")),
        ]
    ).drop("message")


ISSUES = MOTION + GRID.removeprefix(FRAMES) + f""",
checked AS (SELECT *, CASE channel WHEN 'click' THEN 'camera' WHEN 'view' THEN 'lidar' ELSE 'radar' END AS modality, ego_x * 60 AS n_points, ego_x * 2 AS brightness, frame_token % 50 <> 0 AS decode_ok FROM motion),
issues AS (
  SELECT 'missing_file' AS "check", 'ERROR' AS severity, 'frame' AS entity_type, frame_token::VARCHAR AS entity_id, scene_name::VARCHAR AS scene_name, channel, NULL::DOUBLE AS value FROM checked WHERE NOT file_exists
  UNION ALL SELECT 'corrupt_file', 'ERROR', 'frame', frame_token::VARCHAR, scene_name::VARCHAR, channel, NULL FROM checked WHERE file_exists AND NOT decode_ok
  UNION ALL SELECT 'frame_gap', 'WARN', 'frame', frame_token::VARCHAR, scene_name::VARCHAR, channel, round(dt_prev_ms, 3) FROM checked WHERE dt_prev_ms > {PERIOD_MS}::DOUBLE * {FACTOR}
  UNION ALL SELECT 'low_lidar_points', 'WARN', 'frame', frame_token::VARCHAR, scene_name::VARCHAR, channel, round(n_points, 6) FROM checked WHERE modality = 'lidar' AND decode_ok AND n_points < 600
  UNION ALL SELECT 'night_metadata_mismatch', 'WARN', 'frame', frame_token::VARCHAR, scene_name::VARCHAR, channel, round(brightness, 6) FROM checked WHERE modality = 'camera' AND is_key_frame AND brightness > 90
  UNION ALL SELECT 'missing_keyframe', 'WARN', 'sample', sample_token, scene_name::VARCHAR, channel, NULL FROM sync WHERE NOT has_keyframe
  UNION ALL SELECT 'sync_offset', 'WARN', 'sample', sample_token, scene_name::VARCHAR, channel, offset_ms FROM sync WHERE has_keyframe AND abs(offset_ms) > 3600000)"""


@query("WITH " + ISSUES + " SELECT * FROM issues")
def quality_issues(spark, d):
    return event_issues(spark, d)


@query("WITH " + ISSUES + ' SELECT "check", severity, count(*) AS n FROM issues GROUP BY ALL')
def agg_issue_counts(spark, d):
    return kpi.issue_counts(event_issues(spark, d))


STATUS = ISSUES + """,
own AS (SELECT entity_id, bool_or(severity = 'ERROR') AS bad, list_sort(list(DISTINCT "check") FILTER (WHERE severity = 'WARN')) AS warnings FROM issues WHERE entity_type = 'frame' GROUP BY 1),
late AS (SELECT DISTINCT entity_id, channel FROM issues WHERE entity_type = 'sample'),
status AS (
  SELECT gf.frame_token::VARCHAR AS frame_token, gf.channel, coalesce(bad, false) AS qc_error, coalesce(warnings, []) AS qc_warnings, NOT is_key_frame OR late.entity_id IS NULL AS sync_ok, true AS calib_ok
  FROM gf LEFT JOIN own ON gf.frame_token::VARCHAR = own.entity_id LEFT JOIN late ON gf.sample_token = late.entity_id AND gf.channel = late.channel)"""


def event_status(spark, d):
    return quality.frame_status(grid_frames(spark, d), event_issues(spark, d))


@query("WITH " + STATUS + " SELECT *, NOT qc_error AND sync_ok AND calib_ok AS qc_pass FROM status")
def quality_frame_status(spark, d):
    return event_status(spark, d).select("frame_token", "channel", "qc_error", "qc_warnings", "sync_ok", "calib_ok", "qc_pass")


@query("WITH " + STATUS + " SELECT frame_token, array_to_string(qc_warnings, ',') AS codes FROM status WHERE len(qc_warnings) > 0")
def agg_collect_warn_codes(spark, d):
    return event_status(spark, d).where("size(qc_warnings) > 0").select("frame_token", F.concat_ws(",", "qc_warnings").alias("codes"))


@query("WITH " + STATUS + " SELECT channel, round(avg((NOT qc_error AND sync_ok)::INT::DOUBLE), 4) AS pass_rate, count_if(qc_error) AS errors FROM status GROUP BY 1")
def quality_summary(spark, d):
    return event_status(spark, d).groupBy("channel").agg(F.round(F.avg(F.col("qc_pass").cast("double")), 4).alias("pass_rate"), F.count_if("qc_error").alias("errors"))


@query("WITH " + ANNOTATIONS + """ SELECT entity_id, count(*) AS n FROM (
  SELECT 'visibility in 1..4' AS entity_id FROM annotations WHERE NOT (visibility BETWEEN 1 AND 4) UNION ALL SELECT 'num_lidar_pts >= 5' FROM annotations WHERE num_lidar_pts < 5
  UNION ALL SELECT 'size has three positive sides' FROM annotations WHERE NOT list_min(size) > 0 UNION ALL SELECT 'sample_token unique' FROM annotations GROUP BY sample_token HAVING count(*) > 1) GROUP BY 1""")
def quality_schema_constraints(spark, d):
    rows = annotations(spark, d)
    rules = [("visibility in 1..4", F.col("visibility").between(1, 4)), ("num_lidar_pts >= 5", F.col("num_lidar_pts") >= 5), ("size has three positive sides", (F.size("size") == 3) & (F.array_min("size") > 0))]
    return quality.schema_issues(rows, "silver.annotations", rules, ["sample_token"]).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + POINTS + ", s AS (SELECT frame, cls, avg((x > 0)::INT::DOUBLE) AS share FROM points GROUP BY ALL), m AS (SELECT median(share) AS mid, count(*) AS n FROM s) SELECT frame::VARCHAR AS entity_id, round(share, 6) AS value FROM s, m WHERE n >= 3 AND (share / nullif(mid, 0) > 1.3 OR share / nullif(mid, 0) < 1 / 1.3::DOUBLE)")
def quality_calibration(spark, d):
    shares = points(spark, d).groupBy("frame", "cls").agg(F.avg((F.col("x") > 0).cast("double")).alias("share")).select(F.col("frame").alias("frame_token"), F.col("cls").alias("scene_name"), "share")
    return quality.calibration_issues(shares, "CAM", 1.3).select("entity_id", F.round("value", 6).alias("value"))


@query("WITH " + SAMPLES + " SELECT time_of_day, count(*) AS scenes FROM (SELECT DISTINCT scene_name, time_of_day FROM splits) GROUP BY 1")
def curate_strata(spark, d):
    return curate.mode_by(bare_samples(spark, d), "scene_name", "time_of_day").groupBy("time_of_day").agg(F.count(F.lit(1)).alias("scenes"))


@query("WITH " + GRID + ', late AS (SELECT sample_token, channel FROM sync WHERE NOT has_keyframe) SELECT channel, count(*) AS n FROM late GROUP BY 1')
def quality_missing_keyframes(spark, d):
    return timing.sync_grid(grid_frames(spark, d), CHANNELS, "view").where("NOT has_keyframe").groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, count(value) AS runs, round(avg(value), 6) AS mean_ms, round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms, round(quantile_cont(value, 0.99), 6) AS p99_ms, round(1000 / avg(value), 6) AS fps FROM events GROUP BY 1")
def agg_latency_report(spark, d):
    r = kpi.latency_report(read(spark, d, "events"), "value", "event_type")
    return r.select("event_type", "runs", *[F.round(c, 6).alias(c) for c in ("mean_ms", "p50_ms", "p95_ms", "p99_ms", "fps")])
