"""3D boxes from 2D detections and point clouds, as joins, windows and aggregations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import wrap
from ..params import SIZE_PRIORS, Fusion


def size_priors(annotations: DataFrame, min_count: int = 5, defaults: Mapping[str, tuple[float, float, float]] = SIZE_PRIORS) -> DataFrame:
    """Median size by class where enough boxes have one, else the default; with ``source``."""
    size = lambda i: F.percentile(F.get(F.col("size"), F.lit(i)), 0.5)
    own = annotations.where("det_class IS NOT NULL").groupBy("det_class").agg(size(0).alias("ow"), size(1).alias("ol"), size(2).alias("oh"), F.count(F.lit(1)).alias("n"))
    table = F.array(*[F.struct(F.lit(k).alias("det_class"), F.lit(w).alias("dw"), F.lit(l).alias("dl"), F.lit(h).alias("dh")) for k, (w, l, h) in defaults.items()])  # noqa: E741
    base = annotations.sparkSession.range(1).select(F.inline(table))
    enough = F.coalesce(F.col("n") >= min_count, F.lit(False))
    pick = lambda o, d: F.when(enough, F.col(o)).otherwise(F.col(d))
    return base.join(own, "det_class", "left").select("det_class", pick("ow", "dw").alias("w"), pick("ol", "dl").alias("l"), pick("oh", "dh").alias("h"), F.when(enough, "data").otherwise("default").alias("source"))


def ground_height(points: DataFrame, key: str, x: str = "x", y: str = "y", z: str = "z", radius: float = 40.0) -> DataFrame:
    """The 5th percentile of height near the vehicle; of all points where none is near."""
    near = F.hypot(F.col(x), F.col(y)) <= radius
    return points.groupBy(key).agg(F.coalesce(F.percentile(F.when(near, F.col(z)), 0.05), F.percentile(F.col(z), 0.05), F.lit(0.0)).alias("ground"))


def shrunk(box: tuple[Column, Column, Column, Column], shrink: float) -> tuple[Column, Column, Column, Column]:
    x1, y1, x2, y2 = box
    return x1 + (x2 - x1) * shrink / 2, y1 + (y2 - y1) * shrink / 2, x2 - (x2 - x1) * shrink / 2, y2 - (y2 - y1) * shrink / 2


def in_frustum(points: DataFrame, boxes: DataFrame, key: str, shrink: float) -> DataFrame:
    """Points (u, v) within the shrunk 2D boxes of their frame, bounds included: a hash join with a range filter."""
    x1, y1, x2, y2 = shrunk((F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")), shrink)
    return points.join(boxes, key).where(F.col("u").between(x1, x2) & F.col("v").between(y1, y2))


def expected_depth(focal: Column, height_prior: Column, y1: Column, y2: Column) -> Column:
    return focal * height_prior / F.greatest(y2 - y1, F.lit(1.0))


def with_islands(points: DataFrame, key: str, depth: str, gap: float, tie: str) -> DataFrame:
    """Numbers the runs of depths without a jump larger than ``gap``."""
    w = Window.partitionBy(key).orderBy(depth, tie)
    jump = (F.col(depth) - F.lag(depth).over(w) > gap).cast("int")
    return points.withColumn("_jump", F.coalesce(jump, F.lit(0))).withColumn("island", F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_jump")


def dominant_cluster(points: DataFrame, key: str, depth: str, expected: str, p: Fusion, tie: str) -> DataFrame:
    """Per key the island that best fits the expected depth: its size weighed by a Gaussian of its near surface; the nearest on ties."""
    islands = with_islands(points, key, depth, p.cluster_gap, tie)
    near = F.percentile(depth, p.near_percentile / 100)
    groups = islands.groupBy(key, "island").agg(F.count(F.lit(1)).alias("n"), near.alias("near"), F.min(depth).alias("first"), F.first(expected).alias("_z"))
    off = F.try_divide(F.col("near") - F.col("_z"), p.depth_sigma * F.col("_z"))
    score = F.col("n") * F.exp(-0.5 * off * off)
    best = groups.withColumn("score", score).groupBy(key).agg(F.max(F.struct("score", (-F.col("first")).alias("neg"), "island", "n", "near")).alias("b"))
    return best.select(key, F.col("b.island").alias("island"), F.col("b.n").alias("n"), F.col("b.near").alias("near"), F.col("b.score").alias("score"))


def yaw_by_pca(points: DataFrame, key: str, width: str, length: str, x: str = "x", y: str = "y") -> DataFrame:
    """Heading along the points' main axis, folded to half a turn; 0 where they say too little.

    The axis is turned by a right angle where its extent fits the width better
    than the length.
    """
    spread = points.groupBy(key).agg(
        F.var_samp(x).alias("a"), F.var_samp(y).alias("b"), F.covar_samp(x, y).alias("c"), F.count(F.lit(1)).alias("n"), F.first(width).alias("w"), F.first(length).alias("l"), F.avg(x).alias("mx"), F.avg(y).alias("my")
    )
    spread = spread.withColumns({"theta": 0.5 * F.atan2(2 * F.col("c"), F.col("a") - F.col("b")), "mid": (F.col("a") + F.col("b")) / 2, "half": F.hypot((F.col("a") - F.col("b")) / 2, "c")})
    along = (F.col(x) - F.col("mx")) * F.cos("theta") + (F.col(y) - F.col("my")) * F.sin("theta")
    extent = points.select(key, x, y).join(spread.select(key, "theta", "mx", "my"), key).groupBy(key).agg((F.percentile(along, 0.95) - F.percentile(along, 0.05)).alias("extent"))
    small, large = F.least("w", "l"), F.greatest("w", "l")
    vague = (F.col("n") < 10) | (large < 1.3 * small) | (F.col("mid") + F.col("half") < 2 * (F.col("mid") - F.col("half")))
    turned = F.col("theta") + F.when(F.abs(F.col("extent") - F.col("w")) < F.abs(F.col("extent") - F.col("l")), F.pi() / 2).otherwise(0.0)
    folded = wrap(turned)
    folded = F.when(folded > F.pi() / 2, folded - F.pi()).when(folded <= -F.pi() / 2, folded + F.pi()).otherwise(folded)
    return spread.join(extent, key).select(key, F.when(vague, F.lit(0.0)).otherwise(folded).alias("yaw"), "n")


def place_by_points(points: DataFrame, key: str, p: Fusion, yaw: str = "yaw") -> DataFrame:
    """Box centres from cluster points in the ego plane.

    ``points`` has x, y, the camera's cam_x, cam_y, the size w, l, and a yaw.
    The centre lies on the ray through the mean point, half the box's extent
    behind the near surface, shifted by the median lateral offset.
    """
    mean = points.groupBy(key).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), *[F.first(c).alias(c) for c in ("cam_x", "cam_y", "w", "l", yaw)], F.count(F.lit(1)).alias("n"))
    dx, dy = F.col("mx") - F.col("cam_x"), F.col("my") - F.col("cam_y")
    mean = mean.withColumns({"rx": F.try_divide(dx, F.hypot(dx, dy)), "ry": F.try_divide(dy, F.hypot(dx, dy))})
    j = points.select(key, "x", "y").join(mean, key)
    px, py = F.col("x") - F.col("cam_x"), F.col("y") - F.col("cam_y")
    along, lateral = px * F.col("rx") + py * F.col("ry"), py * F.col("rx") - px * F.col("ry")
    stats = j.groupBy(key).agg(F.percentile(along, p.near_percentile / 100).alias("near"), F.median(lateral).alias("lateral"))
    turn = F.col(yaw) - F.atan2("ry", "rx")
    extent = F.abs(F.cos(turn)) * F.col("l") / 2 + F.abs(F.sin(turn)) * F.col("w") / 2
    reach = F.col("near") + extent
    return mean.join(stats, key).where(F.col("n") >= p.min_points).select(
        key, (F.col("cam_x") + F.col("rx") * reach - F.col("ry") * F.col("lateral")).alias("cx"), (F.col("cam_y") + F.col("ry") * reach + F.col("rx") * F.col("lateral")).alias("cy"), "n"
    )


def camera_ray(u: Column, v: Column, depth: Column, fx: Column, fy: Column, px: Column, py: Column) -> tuple[Column, Column, Column]:
    """The point at a depth behind a pixel, in the camera's frame."""
    return (u - px) * depth / fx, (v - py) * depth / fy, depth


def place_by_camera(boxes: DataFrame, p: Fusion) -> DataFrame:
    """Boxes without enough points: the 2D centre's ray at the expected depth, at a lower score.

    ``boxes`` has u, v of the centre, depth, fx, fy, px, py, w, l, score.
    """
    extent = (F.col("l") + F.col("w")) / 4
    z = F.col("depth")
    point = camera_ray(*map(F.col, ("u", "v", "depth", "fx", "fy", "px", "py")))
    return boxes.withColumns(
        {"cam_point": F.array(*point), "reach": z + extent, "yaw": F.lit(0.0), "score": F.col("score") * p.mono_factor, "source": F.lit("mono")}
    )


def in_range(boxes: DataFrame, ranges: Mapping[str, float], default: float = 50.0, cls: str = "cls", distance: str = "distance") -> DataFrame:
    from ..functions.scalars import lookup

    return boxes.where(F.col(distance) <= F.coalesce(lookup(F.col(cls), ranges), F.lit(default)))


MODES = ("oracle_2d", "detector")


def boxes_of_modes(labels: DataFrame, detections: DataFrame | None, min_score: float) -> DataFrame:
    """2D boxes to lift, with their ``mode``: labels at a score of 1, and a detector's boxes that score enough.

    Both tables have frame_token, cls, x1, y1, x2, y2; labels an
    annotation_token, detections a score.  A ``box_id`` names one box of one
    mode; detections are numbered within their frame by score.
    """
    shape = ("box_id", "mode", "frame_token", "cls", "score", "x1", "y1", "x2", "y2")
    oracle, detector = MODES
    boxes = labels.withColumns({"mode": F.lit(oracle), "box_id": F.concat_ws("/", F.lit(oracle), "annotation_token"), "score": F.lit(1.0)}).select(*shape)
    if detections is None:
        return boxes
    nth = F.row_number().over(Window.partitionBy("frame_token").orderBy(F.col("score").desc(), "cls", "x1", "y1", "x2", "y2"))
    found = detections.where(F.col("score") >= min_score).withColumn("score", F.col("score").cast("double"))
    found = found.withColumns({"mode": F.lit(detector), "box_id": F.concat_ws("/", F.lit(detector), "frame_token", nth.cast("string"))})
    return boxes.unionByName(found.select(*shape))


def mode_of(box_id: Column) -> Column:
    return F.split(box_id, "/")[0]
