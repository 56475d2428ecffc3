"""The rule-based quality gate: findings are rows.

Row rules of one table are compiled into a single projection that emits each
finding, so a table is scanned once however many rules it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import in_image, into, out_of, vec
from ..functions.scalars import label_quality, ratio
from ..params import Params
from .timing import expected_ms

ERROR, WARN = "ERROR", "WARN"
ISSUE = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("check", "severity", "entity_type", "entity_id", "scene_name", "channel")] + [T.StructField("value", T.DoubleType()), T.StructField("message", T.StringType())]
)


@dataclass(frozen=True)
class Rule:
    """A finding about the rows for which ``when`` holds."""

    check: str
    severity: str
    entity_type: str
    entity_id: Column
    when: Column
    value: Column | None = None
    message: Column | None = None


def issues_of(rows: DataFrame, rules: Sequence[Rule], scene: Column | None = None, channel: Column | None = None) -> DataFrame:
    """The findings of all rules on a table, in one pass."""
    cell = lambda c, kind: (F.lit(None) if c is None else c).cast(kind)
    found = [
        F.when(
            r.when,
            F.struct(
                F.lit(r.check).alias("check"),
                F.lit(r.severity).alias("severity"),
                F.lit(r.entity_type).alias("entity_type"),
                r.entity_id.cast("string").alias("entity_id"),
                cell(scene, "string").alias("scene_name"),
                cell(channel, "string").alias("channel"),
                cell(r.value, "double").alias("value"),
                cell(r.message, "string").alias("message"),
            ),
        )
        for r in rules
    ]
    return rows.select(F.inline(F.filter(F.array(*found), lambda i: i.isNotNull())))


def union_issues(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def schema_issues(rows: DataFrame, name: str, constraints: Sequence[tuple[str, Column]], unique: Sequence[str] = ()) -> DataFrame:
    """ERROR findings for rows that break a constraint, and for repeated values of ``unique`` columns.

    A constraint that is NULL is not broken.  The entity is the table, not a
    frame, so such findings stop the gate and mark no frame.
    """
    broken = issues_of(rows, [Rule("schema", ERROR, name, F.lit(label), ~F.coalesce(ok, F.lit(True)), message=F.lit(f"{label} does not hold")) for label, ok in constraints]) if constraints else None
    parts = [broken] if broken is not None else []
    for c in unique:
        again = rows.groupBy(c).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(issues_of(again, [Rule("schema", ERROR, name, F.lit(f"{c} unique"), F.lit(True), F.col("n"), F.concat(F.lit(f"{c} repeats: "), F.col(c).cast("string")))]))
    return union_issues(parts)


def frame_constraints() -> list[tuple[str, Column]]:
    c = F.col
    return [
        *[(f"{x} not null", c(x).isNotNull()) for x in ("frame_token", "sample_token", "scene_name", "channel", "modality", "filename")],
        ("modality known", c("modality").isin("camera", "lidar", "radar")),
        ("timestamp > 0", c("timestamp") > 0),
        ("width >= 0", c("width") >= 0),
        ("height >= 0", c("height") >= 0),
        ("ego_speed_mps in [0, 70]", c("ego_speed_mps").between(0, 70)),
        ("cameras have a size", (c("modality") != "camera") | ((c("width") > 0) & (c("height") > 0))),
    ]


def annotation_constraints() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("visibility in 1..4", c("visibility").between(1, 4)),
        ("num_lidar_pts >= 0", c("num_lidar_pts") >= 0),
        ("num_radar_pts >= 0", c("num_radar_pts") >= 0),
        ("size has three positive sides", (F.size("size") == 3) & (F.array_min("size") > 0)),
        ("rotation has four parts", F.size("rotation") == 4),
    ]


def feature_constraints() -> list[tuple[str, Column]]:
    return [("brightness in [0, 255]", F.col("brightness").between(0, 255)), ("n_points >= 0", F.col("n_points") >= 0)]


def frame_rules(p: Params) -> list[Rule]:
    """Rules on frames with their features left-joined and ``_nth`` among equal timestamps."""
    c, q = F.col, p.quality
    expected = expected_ms(c("modality"), p.sensors.nominal_hz)
    dropped = (F.bround(c("dt_prev_ms") / expected) - 1).cast("long")
    decoded = F.coalesce(c("decode_ok"), F.lit(False))
    token = c("frame_token")
    return [
        Rule("missing_file", ERROR, "frame", token, ~c("file_exists"), message=F.concat(F.lit("file not found: "), c("filename"))),
        Rule("corrupt_file", ERROR, "frame", token, c("file_exists") & ~decoded, message=F.coalesce("decode_error", F.lit("not decoded"))),
        Rule("duplicate_frame", ERROR, "frame", token, c("_nth") > 1, message=F.lit("timestamp repeats within its channel")),
        Rule("frame_gap", WARN, "frame", token, c("dt_prev_ms") > expected * q.gap_factor, c("dt_prev_ms"), F.format_string("gap of %.0f ms, ~%d frames dropped", c("dt_prev_ms"), dropped)),
        Rule("low_lidar_points", WARN, "frame", token, (c("modality") == "lidar") & decoded & (c("n_points") < q.min_lidar_points), c("n_points"), F.format_string("%.0f points", c("n_points"))),
        Rule(
            "night_metadata_mismatch", WARN, "frame", token,
            (c("modality") == "camera") & c("is_key_frame") & F.lower("scene_description").contains("night") & (c("brightness") > q.night_max_brightness),
            c("brightness"), F.format_string("described as night, brightness %.0f", c("brightness")),
        ),
    ]


def sync_rules(p: Params) -> list[Rule]:
    c = F.col
    return [
        Rule("missing_keyframe", WARN, "sample", c("sample_token"), ~c("has_keyframe"), message=F.concat(F.lit("no keyframe on "), c("channel"))),
        Rule("sync_offset", WARN, "sample", c("sample_token"), c("has_keyframe") & (F.abs("offset_ms") > p.quality.sync_tolerance_ms), c("offset_ms"), F.format_string("%+.1f ms from the reference", c("offset_ms"))),
    ]


def calibration_issues(projection: DataFrame, camera: str, tolerance: float) -> DataFrame:
    """Camera frames whose share of ground points in the image strays from the median of all, if there are three at least."""
    middle = projection.agg(F.median("share").alias("_median"), F.count(F.lit(1)).alias("_n"))
    rate = F.try_divide("share", "_median")
    off = (F.col("_n") >= 3) & ((rate > tolerance) | (rate < 1 / tolerance))
    rows = projection.crossJoin(F.broadcast(middle))  # one row
    return issues_of(rows, [Rule("calibration_suspect", WARN, "frame", F.col("frame_token"), off, F.col("share"), F.format_string("%.1f%% of ground points in the image, median %.1f%%", F.col("share") * 100, F.col("_median") * 100))], F.col("scene_name"), F.lit(camera))


def weak_label_rules(p: Params) -> list[Rule]:
    c = F.col
    return [Rule("weak_label", WARN, "annotation", c("annotation_token"), c("det_class").isNotNull() & (c("num_lidar_pts") < p.quality.min_box_lidar_points), c("num_lidar_pts"), F.concat(c("det_class"), F.lit(" without enough LiDAR points")))]


def projection_shares(pairs: DataFrame, points: DataFrame, ground_band: float = 0.2) -> DataFrame:
    """For each camera and LiDAR pair, the share of ground points that fall into the image.

    ``pairs`` has poses as arrays; ``points`` has ``lidar_frame`` and ``x y z``.
    Ground is what lies below the 5th percentile of height near the vehicle
    plus ``ground_band``.
    """
    j = points.join(pairs, "lidar_frame")
    from ..functions.geometry import rotation

    j = j.withColumns({f"_r_{n}": rotation(F.col(n)) for n in ("lidar_rotation", "lidar_ego_rotation", "ego_rotation", "sensor_rotation")})
    at = lambda n: vec(F.col(n))
    p = (F.col("x"), F.col("y"), F.col("z"))
    ego = out_of(p, at("lidar_translation"), F.col("_r_lidar_rotation"))
    world = out_of(ego, at("lidar_ego_translation"), F.col("_r_lidar_ego_rotation"))
    cam_ego = into(world, at("ego_translation"), F.col("_r_ego_rotation"))
    cam = into(cam_ego, at("sensor_translation"), F.col("_r_sensor_rotation"))
    placed = j.select("frame_token", "sample_token", "scene_name", *[v.alias(n) for n, v in zip(("ex", "ey", "ez"), cam_ego, strict=True)], in_image(cam, F.col("camera_intrinsic"), F.col("width"), F.col("height")).alias("inside"))
    keys = ["frame_token", "sample_token", "scene_name"]
    near = F.hypot("ex", "ey") <= 40
    ground = placed.groupBy(*keys).agg(F.coalesce(F.percentile(F.when(near, F.col("ez")), 0.05), F.percentile("ez", 0.05), F.lit(0.0)).alias("ground"))
    low = placed.join(ground, keys).where(F.col("ez") < F.col("ground") + ground_band)
    return low.groupBy("sample_token", "frame_token", "scene_name").agg(F.avg(F.col("inside").cast("double")).alias("share"), F.count(F.lit(1)).alias("n_points"))


def frame_status(frames: DataFrame, issues: DataFrame) -> DataFrame:
    """Verdicts of frames from the findings: errors, warnings, timing, calibration, and the pass over all three."""
    own = issues.where("entity_type = 'frame'").groupBy(F.col("entity_id").alias("frame_token")).agg(
        F.max(F.col("severity") == ERROR).alias("_error"),
        F.sort_array(F.collect_set(F.when(F.col("severity") == WARN, F.col("check")))).alias("_warnings"),
        F.max(F.col("check") == "calibration_suspect").alias("_calib"),
    )
    samples = issues.where("entity_type = 'sample'").select(F.col("entity_id").alias("sample_token"), "channel").distinct().withColumn("_late", F.lit(True))
    no = F.lit(False)
    return (
        frames.withColumn("frame_token", F.col("frame_token").cast("string"))
        .withColumn("sample_token", F.col("sample_token").cast("string"))
        .join(own, "frame_token", "left")
        .join(samples, ["sample_token", "channel"], "left")
        .withColumns(
            {
                "qc_error": F.coalesce("_error", no),
                "qc_warnings": F.coalesce("_warnings", F.array().cast("array<string>")),
                "sync_ok": ~F.col("is_key_frame") | ~F.coalesce("_late", no),
                "calib_ok": ~F.coalesce("_calib", no),
            }
        )
        .withColumn("qc_pass", ~F.col("qc_error") & F.col("sync_ok") & F.col("calib_ok"))
        .drop("_error", "_warnings", "_calib", "_late")
    )


def label_status(annotations: DataFrame, p: Params) -> DataFrame:
    """Boxes that are weak, barely visible or fine; only boxes of a class can be weak."""
    return annotations.withColumn("label_quality", label_quality(F.col("num_lidar_pts"), F.col("visibility"), p.quality.min_box_lidar_points, p.curation.min_visibility, F.col("det_class")))


def summary(issues: DataFrame, frames_qc: DataFrame, labels_qc: DataFrame) -> dict:
    """Issue counts, pass rates per channel and overall, and the share of fine boxes among all."""
    counts = {f"{r['check']}.{r['severity']}": r["n"] for r in issues.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.round(F.avg(F.col("qc_pass").cast("double")), 4)
    by_channel = {r["channel"]: r["rate"] for r in frames_qc.groupBy("channel").agg(rate.alias("rate")).collect()}
    overall = frames_qc.agg(rate).first()[0]
    fine = labels_qc.agg(ratio(F.count_if(F.col("label_quality") == "ok"), F.count(F.lit(1)), 4)).first()[0]
    return {"issues": counts, "pass_rate_by_channel": by_channel, "pass_rate": overall, "label_ok_rate": fine}


class QualityGateError(Exception):
    """More errors than allowed; raised after the findings were written."""


def gate(issues: DataFrame, max_errors: int) -> int:
    """The number of errors; raises when there are more than allowed, naming the first ten."""
    errors = issues.where(F.col("severity") == ERROR)
    n = errors.count()
    if n > max_errors:
        first = errors.orderBy("check", F.col("entity_id").asc_nulls_last()).limit(10).collect()
        raise QualityGateError(f"{n} errors, {max_errors} allowed: " + "; ".join(f"{r['check']} {r['entity_id']}: {r['message']}" for r in first))
    return n


def with_nth(frames: DataFrame) -> DataFrame:
    return frames.withColumn("_nth", F.row_number().over(Window.partitionBy("scene_name", "channel", "timestamp").orderBy("frame_token")))


def evaluate(frames: DataFrame, features: DataFrame, annotations: DataFrame, sync: DataFrame, projection: DataFrame | None, p: Params) -> DataFrame:
    """All findings, in the order severity, check, entity."""
    rows = with_nth(frames).join(features, "frame_token", "left")
    parts = [
        schema_issues(frames, "silver.frames", frame_constraints(), ["frame_token", "filename"]),
        schema_issues(annotations, "silver.annotations", annotation_constraints(), ["annotation_token"]),
        schema_issues(features, "silver.frame_features", feature_constraints(), ["frame_token"]),
        issues_of(rows, frame_rules(p), F.col("scene_name"), F.col("channel")),
        issues_of(sync, sync_rules(p), F.col("scene_name"), F.col("channel")),
        issues_of(annotations, weak_label_rules(p), F.col("scene_name")),
    ]
    if projection is not None:
        parts.append(calibration_issues(projection, p.curation.camera_channel, p.quality.projection_tolerance))
    return union_issues(parts)
