"""Silver tables from the raw ones: frames, annotations, and the grid of keyframes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lookup
from ..params import Params
from ..sources.raw import SourceError
from . import timing

Tables = Callable[[str], DataFrame]


def scene_context(raw: Tables, p: Params) -> DataFrame:
    """The scenes to ingest with their logs; a scene asked for by name must exist."""
    scenes = raw("scene")
    if p.etl.scenes != "all":
        wanted = list(p.etl.scenes)
        have = {r["name"] for r in scenes.where(F.col("name").isin(wanted)).select("name").distinct().collect()}  # no more than were asked for
        if unknown := set(wanted) - have:
            raise SourceError(f"unknown scenes: {sorted(unknown)}")
        scenes = scenes.where(F.col("name").isin(wanted))
    log = raw("log").select(F.col("token").alias("log_token"), "location", "vehicle", "date_captured")
    return scenes.join(log, "log_token").select(F.col("token").alias("scene_token"), F.col("name").alias("scene_name"), F.col("description").alias("scene_description"), "location", "vehicle", "date_captured")


def build_frames(raw: Tables, file_sizes: DataFrame, p: Params) -> DataFrame:
    """One row a sensor frame of the enabled channels: context, pose, calibration, file state, motion.

    Filters stand before the joins; the small tables are left to Spark to
    broadcast by their size.
    """
    sensor = raw("sensor").where(F.col("channel").isin(p.sensors.enabled)).select(F.col("token").alias("sensor_token"), "channel", "modality")
    cal = raw("calibrated_sensor").select(F.col("token").alias("calibrated_sensor_token"), "sensor_token", F.col("translation").alias("sensor_translation"), F.col("rotation").alias("sensor_rotation"), "camera_intrinsic")
    ego = raw("ego_pose").select(F.col("token").alias("ego_pose_token"), F.col("translation").alias("ego_translation"), F.col("rotation").alias("ego_rotation"))
    sample = raw("sample").select(F.col("token").alias("sample_token"), F.col("timestamp").alias("sample_timestamp"), "scene_token")
    data = raw("sample_data").select(F.col("token").alias("frame_token"), "sample_token", "ego_pose_token", "calibrated_sensor_token", "timestamp", "is_key_frame", "filename", "width", "height")
    if not p.etl.include_sweeps:
        data = data.where("is_key_frame")
    j = data.join(cal.join(sensor, "sensor_token"), "calibrated_sensor_token").join(sample.join(scene_context(raw, p), "scene_token"), "sample_token").join(ego, "ego_pose_token")
    j = j.join(file_sizes, "filename", "left").withColumn("file_size_bytes", F.coalesce("file_size_bytes", F.lit(-1).cast("long")))
    j = j.withColumns({"file_exists": F.col("file_size_bytes") >= 0, **{f"ego_{a}": F.get("ego_translation", F.lit(i)) for i, a in enumerate("xyz")}})
    return timing.with_motion(j).select(
        "frame_token", "sample_token", "scene_token", "scene_name", "scene_description", "location", "vehicle", "date_captured", "channel", "modality", "timestamp", "sample_timestamp", "is_key_frame", "filename",
        "file_exists", "file_size_bytes", "width", "height", "dt_prev_ms", "ego_x", "ego_y", "ego_z", "ego_speed_mps", "ego_translation", "ego_rotation", "sensor_translation", "sensor_rotation", "camera_intrinsic",
    )


def check_channels(frames: DataFrame, p: Params) -> None:
    """Every enabled channel must have frames."""
    have = {r["channel"] for r in frames.select("channel").distinct().collect()}  # no more than are enabled
    if missing := set(p.sensors.enabled) - have:
        raise SourceError(f"no frames on enabled channels: {sorted(missing)}")


def build_annotations(raw: Tables, frames: DataFrame, p: Params) -> DataFrame:
    """One row a 3D box of an ingested scene, with category, class and attribute names."""
    inst = raw("instance").select(F.col("token").alias("instance_token"), "category_token")
    cat = raw("category").select(F.col("token").alias("category_token"), F.col("name").alias("category"))
    ann = raw("sample_annotation").withColumnRenamed("token", "annotation_token")
    scenes = frames.select("sample_token", "scene_name").distinct()
    # The attribute vocabulary as one map: no larger than the attribute table.
    names = raw("attribute").agg(F.map_from_entries(F.collect_set(F.struct("token", "name"))).alias("_names"))
    j = ann.join(inst.join(cat, "category_token"), "instance_token").join(scenes, "sample_token").crossJoin(F.broadcast(names))
    return j.select(
        "annotation_token", "sample_token", "scene_name", "instance_token", "category", lookup(F.col("category"), p.curation.categories).alias("det_class"), F.col("visibility_token").cast("int").alias("visibility"),
        F.transform("attribute_tokens", lambda t: F.coalesce(F.try_element_at("_names", t), t)).alias("attributes"), "translation", "size", "rotation", "num_lidar_pts", "num_radar_pts",
    )


def build_sync(frames: DataFrame, p: Params) -> DataFrame:
    return timing.sync_grid(frames, p.sensors.enabled, p.sensors.reference_channel)


def camera_lidar_pairs(frames: DataFrame, camera: str, lidar: str = "LIDAR_TOP") -> DataFrame:
    """Keyframes of a camera with the LiDAR keyframe of their sample, poses of both."""
    key = frames.where("is_key_frame")
    low = key.where(F.col("channel") == lidar).select("sample_token", F.col("frame_token").alias("lidar_frame"), F.col("sensor_translation").alias("lidar_translation"), F.col("sensor_rotation").alias("lidar_rotation"), F.col("ego_translation").alias("lidar_ego_translation"), F.col("ego_rotation").alias("lidar_ego_rotation"))
    return key.where(F.col("channel") == camera).join(low, "sample_token")
