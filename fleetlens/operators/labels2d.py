"""3D boxes as 2D labels in the camera image."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import CORNER_SIGNS, let, minus, rotation, unrotate, vec
from ..functions.scalars import distance_bin
from ..params import Curation
from ..session import ship

#: Depth beyond which a corner is in front of the camera.
MIN_DEPTH = 0.1


def camera_matrices(camera_frames: DataFrame) -> DataFrame:
    """``camera_frames`` with ``_cam``: sixteen numbers that take a global point to homogeneous pixels and to its depth.

    Rows of four: u, v and w by the intrinsic, and the depth z; three factors
    and an offset each.  Ego pose and mounting are multiplied out here, once a
    frame and not once a box.  Frames that have it already stay as they are.
    """
    if "_cam" in camera_frames.columns:
        return camera_frames
    ego, sensor, k = vec(F.col("ego_translation")), vec(F.col("sensor_translation")), F.col("camera_intrinsic")

    def composed(re: Column, rs: Column) -> Column:
        e, s = ([F.get(r, F.lit(i)) for i in range(9)] for r in (re, rs))
        turn = [[sum((e[3 * c + j] * s[3 * j + i] for j in range(1, 3)), e[3 * c] * s[i]) for c in range(3)] for i in range(3)]  # sensor row i, global column c
        off = minus((F.lit(0.0),) * 3, unrotate(rs, tuple(a + b for a, b in zip(unrotate(re, ego), sensor, strict=True))))
        rows = [[*turn[i], off[i]] for i in range(3)]
        pixel = [[sum((F.get(F.get(k, F.lit(i)), F.lit(j)) * rows[j][c] for j in range(1, 3)), F.get(F.get(k, F.lit(i)), F.lit(0)) * rows[0][c]) for c in range(4)] for i in range(3)]
        return F.array(*[x for row in [*pixel, rows[2]] for x in row])

    return camera_frames.withColumn("_cam", let(rotation(F.col("ego_rotation")), lambda re: let(rotation(F.col("sensor_rotation")), lambda rs: composed(re, rs))))


def image_boxes(center: pa.Array, size: pa.Array, quaternion: pa.Array, cam: pa.Array, width: pa.Array, height: pa.Array) -> pa.Array:
    """Clipped image boxes (x1, y1, x2, y2) of 3D boxes; NULL if no corner is in front of the camera, or all is outside.

    A corner is the centre plus or minus three half axes, and projection is
    linear before the division: centre and axes are projected, and corners are
    sums of four numbers.  A null anywhere gives NULL.
    """
    list_of = lambda a, n: np.stack([pc.cast(pc.list_element(a, i), pa.float64()).to_numpy(zero_copy_only=False) for i in range(n)], 1)
    c, s, q, m = list_of(center, 3), list_of(size, 3), list_of(quaternion, 4), list_of(cam, 16).reshape(-1, 4, 4)
    right, bottom = (pc.cast(x, pa.float64()).to_numpy(zero_copy_only=False) for x in (width, height))
    with np.errstate(all="ignore"):
        w, x, y, z = (q / np.sqrt((q * q).sum(1, keepdims=True))).T
        turn = np.stack(
            [
                1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
                2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
                2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
            ], 1,
        ).reshape(-1, 3, 3)
        axes = m[:, :, :3] @ (turn * (s[:, None, [1, 0, 2]] / 2))
        at = (m[:, :, :3] @ c[:, :, None]) + m[:, :, 3:] + axes @ np.array(CORNER_SIGNS, float).T
        front = (at[:, 3] > MIN_DEPTH) & (at[:, 2] != 0)
        u, v = at[:, 0] / at[:, 2], at[:, 1] / at[:, 2]
        low, high = (lambda a: np.where(front, a, np.inf).min(1)), (lambda a: np.where(front, a, -np.inf).max(1))
        x1, y1, x2, y2 = low(u), low(v), high(u), high(v)
        inside = (x2 > 0) & (y2 > 0) & (x1 < right) & (y1 < bottom)  # false where no corner is in front, or a value is null
        ends = [np.maximum(x1, 0.0), np.maximum(y1, 0.0), np.minimum(x2, right), np.minimum(y2, bottom)]
    return pa.StructArray.from_arrays([pa.array(e) for e in ends], ["x1", "y1", "x2", "y2"], mask=pa.array(~inside))


def project_boxes(camera_frames: DataFrame, annotations: DataFrame, p: Curation, only_ok: bool = False) -> DataFrame:
    """A row for each box of a camera frame's sample, with its 2D box or the first reason to drop it.

    Reasons are tried in this order: weak, low_visibility, outside (behind the
    camera or out of the image), too_small.  With ``only_ok``, boxes that the
    first two drop are not projected and have no 2D box.
    """
    ship(annotations.sparkSession)
    j = annotations.join(camera_matrices(camera_frames), "sample_token")
    center = F.col("translation")
    if only_ok:
        center = F.when(~F.coalesce(F.col("label_quality").isin("weak", "low_visibility"), F.lit(False)), center)
    boxes = F.arrow_udf(image_boxes, "x1 double, y1 double, x2 double, y2 double").asNondeterministic()  # so that it runs once, however often its fields are read
    j = j.withColumn("box", boxes(center, "size", "rotation", "_cam", "width", "height")).drop("_cam")
    own, ego = vec(F.col("translation")), vec(F.col("ego_translation"))
    side = F.least(F.col("box.x2") - F.col("box.x1"), F.col("box.y2") - F.col("box.y1"))
    return j.withColumns(
        {
            "drop_reason": F.when(F.col("label_quality") == "weak", "weak")
            .when(F.col("label_quality") == "low_visibility", "low_visibility")
            .when(F.col("box").isNull(), "outside")
            .when(side < p.min_box_px, "too_small"),
            "distance_m": F.hypot(own[0] - ego[0], own[1] - ego[1]),
        }
    )


def labels_2d(camera_frames: DataFrame, annotations: DataFrame, p: Curation) -> DataFrame:
    """The kept 2D labels of boxes of a class."""
    rows = project_boxes(camera_frames, annotations.where("det_class IS NOT NULL"), p, only_ok=True).where("drop_reason IS NULL")
    names = F.array(*map(F.lit, p.class_names))
    return rows.select(
        "sample_token", "frame_token", "annotation_token", "det_class", (F.array_position(names, F.col("det_class")) - 1).cast("int").alias("class_id"),
        *[F.col(f"box.{c}").alias(c) for c in ("x1", "y1", "x2", "y2")], F.col("width").alias("img_w"), F.col("height").alias("img_h"),
        "distance_m", distance_bin(F.col("distance_m")).alias("distance_bin"), "visibility", "num_lidar_pts",
    )


def drop_counts(projected: DataFrame) -> DataFrame:
    return projected.where("drop_reason IS NOT NULL").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))
