"""Schemas of the raw tables, the layers and the reports."""

from __future__ import annotations

from pyspark.sql import types as T

_ARR, _MAT = "array<double>", "array<array<double>>"

#: Raw tables and the columns that they must have.
RAW: dict[str, str] = {
    "scene": "token string, log_token string, name string, description string, first_sample_token string",
    "sample": "token string, timestamp bigint, scene_token string",
    "sample_data": "token string, sample_token string, ego_pose_token string, calibrated_sensor_token string, timestamp bigint, is_key_frame boolean, filename string, width int, height int",
    "sensor": "token string, channel string, modality string",
    "calibrated_sensor": f"token string, sensor_token string, translation {_ARR}, rotation {_ARR}, camera_intrinsic {_MAT}",
    "ego_pose": f"token string, timestamp bigint, translation {_ARR}, rotation {_ARR}",
    "log": "token string, location string, vehicle string, date_captured string",
    "sample_annotation": f"token string, sample_token string, instance_token string, visibility_token string, attribute_tokens array<string>, translation {_ARR}, size {_ARR}, rotation {_ARR}, num_lidar_pts int, num_radar_pts int",
    "instance": "token string, category_token string",
    "category": "token string, name string",
    "visibility": "token string, level string",
    "attribute": "token string, name string",
}
FEATURES = T.StructType(
    [T.StructField("frame_token", T.StringType()), T.StructField("decode_ok", T.BooleanType()), T.StructField("decode_error", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("brightness", "contrast", "sharpness", "n_points", "mean_range", "max_range", "mean_intensity")]
)
POINTS = T.StructType([T.StructField("lidar_frame", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in ("x", "y", "z", "intensity")])


def raw_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(RAW[name])
