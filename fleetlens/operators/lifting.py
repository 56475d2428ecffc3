"""3D boxes for 2D boxes: the composition of the fusion operators over camera and LiDAR pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import into, let, out_of, pixel, quat_of_yaw, rotation, vec, wrap, yaw_of
from ..params import Fusion
from . import fusion


def place_points(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """LiDAR points of each pair: in the camera's ego frame (x, y, z), and in the image (u, v, depth) where they are in front."""
    j = points.withColumn("point", F.monotonically_increasing_id()).join(pairs, "lidar_frame")
    at = lambda n: vec(F.col(n))

    def placed(rl, rle, re, rs):
        ego = out_of((F.col("x"), F.col("y"), F.col("z")), at("lidar_translation"), rl)
        cam_ego = into(out_of(ego, at("lidar_ego_translation"), rle), at("ego_translation"), re)
        return let(F.struct(*[c.alias(n) for c, n in zip(cam_ego, "xyz", strict=True)]), lambda e: seen(e, rs))

    def seen(e, rs):
        cam = into((e["x"], e["y"], e["z"]), at("sensor_translation"), rs)
        u, v = pixel(F.col("camera_intrinsic"), cam)
        return F.struct(e["x"].alias("px"), e["y"].alias("py"), e["z"].alias("pz"), u.alias("u"), v.alias("v"), cam[2].alias("depth"))

    q = lambda n: rotation(F.col(n))
    row = let(q("lidar_rotation"), lambda rl: let(q("lidar_ego_rotation"), lambda rle: let(q("ego_rotation"), lambda re: let(q("sensor_rotation"), lambda rs: placed(rl, rle, re, rs)))))
    return j.select("frame_token", "point", "width", "height", F.inline(F.array(row))).toDF("frame_token", "point", "width", "height", "x", "y", "z", "u", "v", "depth")


def lift(pairs: DataFrame, points: DataFrame, boxes: DataFrame, priors: DataFrame, p: Fusion, keep: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> DataFrame:
    """A 3D box in the global frame for each 2D box (box_id, frame_token, cls, score, x1, y1, x2, y2).

    Boxes with enough points in their frustum stand where the points are
    (``lidar``); the others where their height says (``mono``, at a lower score).
    ``keep`` writes a table that several branches read, and returns it.
    """
    sized = boxes.join(priors.select(F.col("det_class").alias("cls"), "w", "l", "h"), "cls")
    cams = pairs.select("frame_token", "sample_token", "camera_intrinsic", "sensor_translation", "sensor_rotation", "ego_translation", "ego_rotation")
    sized = sized.join(cams, "frame_token").withColumn("expected", fusion.expected_depth(F.get(F.get("camera_intrinsic", F.lit(1)), F.lit(1)), F.col("h"), F.col("y1"), F.col("y2")))
    placed = keep(place_points(pairs, points), "placed_points")
    ground = fusion.ground_height(placed, "frame_token")
    inside = (F.col("depth") > 0.5) & (F.col("u") >= 0) & (F.col("u") < F.col("width")) & (F.col("v") >= 0) & (F.col("v") < F.col("height"))
    candidates = placed.where(inside).join(ground, "frame_token").where(F.col("z") > F.col("ground") + p.ground_clearance).select("frame_token", "point", "x", "y", "u", "v", "depth")
    narrow = sized.select("frame_token", "box_id", "x1", "y1", "x2", "y2", "expected", "w", "l")
    hit = keep(fusion.in_frustum(candidates, narrow, "frame_token", p.box_shrink).select("box_id", "point", "x", "y", "depth", "expected", "w", "l"), "frustum_points")
    best = fusion.dominant_cluster(hit, "box_id", "depth", "expected", p, "point").select("box_id", F.col("island").alias("best"))
    cluster = fusion.with_islands(hit, "box_id", "depth", p.cluster_gap, "point").join(best, "box_id").where("island = best")
    cluster = keep(cluster, "cluster_points")
    yaw = fusion.yaw_by_pca(cluster, "box_id", "w", "l").select("box_id", "yaw")
    cam_xy = sized.select("box_id", F.get("sensor_translation", F.lit(0)).alias("cam_x"), F.get("sensor_translation", F.lit(1)).alias("cam_y"))
    by_points = fusion.place_by_points(cluster.join(yaw, "box_id").join(cam_xy, "box_id"), "box_id", p)
    frustum = hit.groupBy("box_id").agg(F.count(F.lit(1)).alias("n_frustum"))
    k = lambda i, j: F.get(F.get("camera_intrinsic", F.lit(i)), F.lit(j))
    j = (
        sized.join(ground, "frame_token", "left").join(by_points, "box_id", "left").join(yaw.withColumnRenamed("yaw", "point_yaw"), "box_id", "left").join(frustum, "box_id", "left")
        .withColumn("by_points", F.col("cx").isNotNull())
        .withColumns({"u": (F.col("x1") + F.col("x2")) / 2, "v": (F.col("y1") + F.col("y2")) / 2})
    )
    ray = fusion.camera_ray(F.col("u"), F.col("v"), F.col("expected"), k(0, 0), k(1, 1), k(0, 2), k(1, 2))
    mono = let(rotation(F.col("sensor_rotation")), lambda r: F.struct(*[c.alias(n) for c, n in zip(out_of(ray, vec(F.col("sensor_translation")), r), "xyz", strict=True)]))
    j = j.select("*", F.inline(F.array(mono))).withColumnsRenamed({"x": "mx", "y": "my", "z": "mz"})
    away = F.hypot(F.col("mx") - F.get("sensor_translation", F.lit(0)), F.col("my") - F.get("sensor_translation", F.lit(1)))
    stretch = 1 + F.try_divide((F.col("l") + F.col("w")) / 4, away)
    shift = lambda m, i: F.get("sensor_translation", F.lit(i)) + (F.col(m) - F.get("sensor_translation", F.lit(i))) * stretch
    ex, ey = F.when(F.col("by_points"), F.col("cx")).otherwise(shift("mx", 0)), F.when(F.col("by_points"), F.col("cy")).otherwise(shift("my", 1))
    local = (ex, ey, F.coalesce("ground", F.lit(0.0)) + F.col("h") / 2)
    heading = F.when(F.col("by_points"), F.coalesce("point_yaw", F.lit(0.0))).otherwise(0.0)
    center = let(rotation(F.col("ego_rotation")), lambda r: F.array(*[F.round(c, 3) for c in out_of(local, vec(F.col("ego_translation")), r)]))
    return j.select(
        "box_id", "sample_token", "frame_token", "cls", F.round(F.col("score") * F.when(F.col("by_points"), 1.0).otherwise(p.mono_factor), 4).alias("score"), center.alias("center"), F.array("w", "l", "h").alias("size"),
        F.round(wrap(heading + yaw_of(F.col("ego_rotation"))), 4).alias("yaw"), F.coalesce("n", "n_frustum", F.lit(0)).cast("long").alias("n_points"), F.when(F.col("by_points"), "lidar").otherwise("mono").alias("source"), F.round(F.hypot(ex, ey), 1).alias("distance"),
    )


def ground_truth(annotations: DataFrame, pairs: DataFrame, p: Fusion) -> DataFrame:
    """Boxes to score against: of a class, with a LiDAR point, within the class's range, centre in the image."""
    from ..functions.geometry import global_to_sensor, in_image
    from ..functions.scalars import distance_bin, lookup

    j = annotations.where("det_class IS NOT NULL AND num_lidar_pts >= 1").join(pairs, "sample_token")
    c, e = vec(F.col("translation")), vec(F.col("ego_translation"))
    seen = let(rotation(F.col("ego_rotation")), lambda re: let(rotation(F.col("sensor_rotation")), lambda rs: F.struct(*[x.alias(n) for x, n in zip(global_to_sensor(c, e, re, vec(F.col("sensor_translation")), rs), "xyz", strict=True)])))
    j = j.withColumn("distance", F.hypot(c[0] - e[0], c[1] - e[1])).select("*", F.inline(F.array(seen)))
    j = j.where(in_image((F.col("x"), F.col("y"), F.col("z")), F.col("camera_intrinsic"), F.col("width"), F.col("height")) & (F.col("distance") <= F.coalesce(lookup(F.col("det_class"), p.class_range), F.lit(50.0))))
    return j.select(F.col("sample_token").alias("sample"), F.col("det_class").alias("cls"), "annotation_token", c[0].alias("x"), c[1].alias("y"), "size", yaw_of(F.col("rotation")).alias("yaw"), "distance", distance_bin(F.col("distance")).alias("distance_bin"), "num_lidar_pts")


def quaternion(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("rotation", quat_of_yaw(F.col("yaw")))
