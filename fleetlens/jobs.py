"""The stages as jobs, and their command line.

Every stage reads what earlier ones wrote below ``out_dir``, writes its tables
and returns a small summary.  The quality stage ends with exit code 2 when its
gate does not hold, the model gate with 3.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import curate, kpi, labels2d, lifting, matching, quality, silver, store
from .operators import fusion as fuse
from .operators import gate as model_gate
from .params import Params, load_params
from .session import get_spark
from .sinks import export_yolo, html_report, submission, write_json, write_parquet, write_text, yolo_labels
from .sources import decode
from .sources.lineage import fingerprint, git_commit
from .sources.raw import check_key, file_sizes, manifest, read_parquet, read_table
from .schemas import RAW


#: A camera detector's boxes, if there are any.
DETECTIONS = "predictions/detections2d"
#: The names under which 3D scores are published.
SCORE_NAMES = {"map": "mAP", "nds": "NDS_lite", "mate": "mATE", "mase": "mASE", "maoe": "mAOE"}


class Stage:
    """Where the layers of one run lie."""

    def __init__(self, spark: SparkSession, p: Params):
        self.spark, self.p = spark, p

    def path(self, name: str) -> str:
        return f"{self.p.out_dir}/{name}"

    def table(self, name: str, made_by: str) -> DataFrame:
        return read_parquet(self.spark, self.path(name), made_by)

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """A table between the steps of a stage, written once."""
        write_parquet(df, self.path(f"work/{name}"))
        return self.table(f"work/{name}", name)

    def bronze(self, name: str) -> DataFrame:
        return self.table(f"bronze/{name}", "extract")


def extract(spark: SparkSession, p: Params) -> dict:
    s, raw = Stage(spark, p), f"{p.raw_dir}/{p.version}"
    for name in RAW:
        t = read_table(spark, raw, name)
        check_key(t, name)
        write_parquet(t, s.path(f"bronze/{name}"))
    rows = {r["table"]: {"rows": r["rows"], "sha256": r["sha256"]} for r in manifest(spark, raw).collect()}  # one row a table
    write_json(spark, rows, s.path("bronze/_manifest.json"))
    return {k: v["rows"] for k, v in rows.items()}


def transform(spark: SparkSession, p: Params) -> dict:
    s = Stage(spark, p)
    frames = silver.build_frames(s.bronze, file_sizes(spark, p.raw_dir), p)
    write_parquet(frames, s.path("silver/frames"), "scene_name")
    frames = s.table("silver/frames", "transform")
    silver.check_channels(frames, p)
    write_parquet(silver.build_annotations(s.bronze, frames, p), s.path("silver/annotations"))
    write_parquet(silver.build_sync(frames, p), s.path("silver/sync"))
    return {"scenes": frames.select("scene_name").distinct().count(), "frames": {r["channel"]: r["count"] for r in frames.groupBy("channel").count().collect()}}


def features(spark: SparkSession, p: Params) -> dict:
    s = Stage(spark, p)
    write_parquet(decode.frame_features(spark, s.table("silver/frames", "transform"), p.raw_dir, p.etl.feature_width), s.path("silver/frame_features"))
    f = s.table("silver/frame_features", "features")
    return dict(zip(("frames", "failed"), f.agg(F.count(F.lit(1)), F.count_if(~F.col("decode_ok"))).first(), strict=True))


def quality_stage(spark: SparkSession, p: Params) -> dict:
    s = Stage(spark, p)
    frames, feats = s.table("silver/frames", "transform"), s.table("silver/frame_features", "features")
    ann, sync = s.table("silver/annotations", "transform"), s.table("silver/sync", "transform")
    projection = None
    if {p.curation.camera_channel, p.sensors.reference_channel} <= set(p.sensors.enabled):
        decoded = frames.join(feats.where("decode_ok").select("frame_token"), "frame_token", "left_semi")
        pairs = silver.camera_lidar_pairs(decoded, p.curation.camera_channel, p.sensors.reference_channel)
        points = decode.read_points(spark, decoded.where(F.col("is_key_frame") & (F.col("channel") == p.sensors.reference_channel)), p.raw_dir)
        write_parquet(quality.projection_shares(pairs, points), s.path("reports/projection"))
        projection = s.table("reports/projection", "quality")
    write_parquet(quality.evaluate(frames, feats, ann, sync, projection, p).orderBy("severity", "check", F.col("entity_id").asc_nulls_last()), s.path("reports/issues"))
    issues = s.table("reports/issues", "quality")
    status = quality.frame_status(frames.select("frame_token", "sample_token", "scene_name", "channel", "modality", "is_key_frame"), issues)
    write_parquet(status, s.path("silver/frames_qc"))
    write_parquet(quality.label_status(ann, p), s.path("silver/annotations_qc"))
    summary = quality.summary(issues, s.table("silver/frames_qc", "quality"), s.table("silver/annotations_qc", "quality"))
    write_json(spark, summary, s.path("reports/quality.json"))
    quality.gate(issues, p.quality.max_error_issues)
    return summary


def curate_stage(spark: SparkSession, p: Params) -> dict:
    s, c = Stage(spark, p), p.curation
    frames, qc = s.table("silver/frames", "transform"), s.table("silver/frames_qc", "quality")
    ref = frames.where(F.col("is_key_frame") & (F.col("channel") == p.sensors.reference_channel))
    speed = ref.select("sample_token", curate_speed().alias("ego_speed_mps"))
    samples = frames.groupBy("sample_token").agg(*[F.first(x).alias(x) for x in ("scene_name", "scene_description", "location", "sample_timestamp")]).join(speed, "sample_token", "left")
    tagged = curate.tag_samples(samples, s.table("silver/annotations", "transform"), c)
    tagged = tagged.join(curate.scene_splits(tagged, c.seed, c.val_fraction, c.test_fraction, c.stratify_by).select("scene_name", "split"), "scene_name")
    cam = frames.where(F.col("is_key_frame") & (F.col("channel") == c.camera_channel))
    cam_qc = cam.join(qc.select("frame_token", "qc_error", "sync_ok", "calib_ok"), "frame_token")
    write_parquet(curate.with_readiness(tagged, cam_qc, c), s.path("gold/samples"))
    done = s.table("gold/samples", "curate")
    curate.check_no_leakage(done)
    ready = cam.join(done.where("ml_ready").select("sample_token"), "sample_token", "left_semi").select("frame_token", "sample_token", "ego_translation", "ego_rotation", "sensor_translation", "sensor_rotation", "camera_intrinsic", "width", "height")
    write_parquet(labels2d.labels_2d(ready, s.table("silver/annotations_qc", "quality"), c), s.path("gold/labels_2d"))
    n = done.groupBy("split").agg(F.count(F.lit(1)).alias("samples"), F.count_if("ml_ready").alias("ready")).collect()
    report = {r["split"]: {"samples": r["samples"], "ready": r["ready"]} for r in n}
    write_json(spark, report, s.path("reports/curation.json"))
    return report


def curate_speed():
    """A keyframe's speed, or the next one's of its scene."""
    from .operators.timing import backfilled

    return backfilled(F.col("ego_speed_mps"), "scene_name", order=["timestamp", "frame_token"])


def export_stage(spark: SparkSession, p: Params) -> dict:
    s = Stage(spark, p)
    labels = yolo_labels(s.table("gold/labels_2d", "curate"), s.table("gold/samples", "curate"))
    export_yolo(spark, labels, p.curation.class_names, p.raw_dir, s.path("ml_ready/yolo"))
    return {"images": labels.count()}


def kpis(spark: SparkSession, p: Params) -> dict:
    s = Stage(spark, p)
    frames, qc, sync = s.table("silver/frames", "transform"), s.table("silver/frames_qc", "quality"), s.table("silver/sync", "transform")
    issues, labels_qc = s.table("reports/issues", "quality"), s.table("silver/annotations_qc", "quality")
    samples, boxes = s.table("gold/samples", "curate"), s.table("gold/labels_2d", "curate")
    keyed = lambda df, k: {str(r[k]): {c: r[c] for c in df.columns if c != k} for r in df.collect()}  # noqa: E731  a row a channel, class or split
    balance = kpi.train_balance(boxes, samples)
    report = {
        "volume": keyed(kpi.volume(frames), "channel"),
        "recording_seconds": kpi.duration(frames).first()[0],
        "measured_hz": keyed(kpi.rate(frames), "channel"),
        "pass_rate": keyed(kpi.pass_rate(qc), "channel"),
        "sync": keyed(kpi.sync_percentiles(sync), "channel"),
        "issues": {f"{r['check']}.{r['severity']}": r["n"] for r in kpi.issue_counts(issues).collect()},
        "labels": kpi.label_rates(labels_qc).first().asDict(),
        "boxes": {str(r["det_class"] or r["distance_bin"]): r["n"] for r in kpi.boxes_by(boxes, "det_class", "distance_bin").collect()},
        "readiness": keyed(kpi.readiness(samples), "split"),
        "train_balance": keyed(balance, "det_class"),
        "coverage": kpi.coverage_summary(samples).first().asDict(),
        "missing_train_classes": sorted(r[0] for r in kpi.missing_classes(spark, balance, p.curation.class_names).collect()),
        "ml_ready_rate": samples.agg(F.round(F.avg(F.col("ml_ready").cast("double")), 4)).first()[0],
    }
    write_parquet(kpi.coverage(samples), s.path("reports/coverage"))
    write_json(spark, report, s.path("reports/kpis.json"))
    rows = [r.asDict() for r in s.table("reports/coverage", "kpis").groupBy("location", "time_of_day", "weather").agg(F.sum("samples").alias("samples")).collect()]
    write_text(spark, html_report(report, rows), s.path("reports/coverage.html"))
    return report


def publish(spark: SparkSession, p: Params, run_id: str, published_at: str) -> dict:
    s = Stage(spark, p)
    text = spark.read.text(s.path("reports/kpis.json"), wholetext=True).first()[0]
    version = fingerprint(spark, s.path("reports/kpis.json"))
    rows = store.metric_rows(spark, json.loads(text)).withColumns({"git_commit": F.lit(git_commit()), "dataset_version": F.lit(version)})
    store.publish(rows, s.path("store/kpi_history"), run_id, published_at)
    store.publish(s.table("reports/issues", "quality").select("check", "severity", "scene_name", "channel", "message"), s.path("store/quality_issues"), run_id, published_at)
    store.publish(s.table("reports/coverage", "kpis"), s.path("store/coverage"), run_id, published_at)
    return {"run_id": run_id, "dataset_version": version, "metrics": rows.count()}


def publish_model(spark: SparkSession, p: Params, slices: DataFrame, model_version: str, run_id: str, published_at: str) -> None:
    """Appends a model's metrics: 2D scores by slice (slice, metric, value), and 3D ones if fusion has run."""
    s = Stage(spark, p)
    rows = slices.select("slice", "metric", F.col("value").cast("double").alias("value"))
    path = s.path("predictions/eval3d.json")
    if exists(spark, path):
        report = json.loads(spark.read.text(path, wholetext=True).first()[0])
        rows = rows.unionByName(spark.createDataFrame(scores_3d(report), rows.schema))
    store.publish(rows.withColumn("model_version", F.lit(model_version)), s.path("store/model_metrics"), run_id, published_at)


def scores_3d(report: dict) -> list[tuple[str, str, float]]:
    """Rows (slice, metric, value) of the 3D scores: a slice a mode, and one a mode and class."""
    out = []
    for mode, scores in report.items():
        out += [(f"3d_{mode}", name, float(scores[key])) for key, name in SCORE_NAMES.items() if scores[key] is not None]
        out += [(f"3d_{mode}:{cls}", "ap", float(of["ap"])) for cls, of in scores["per_class"].items()]
    return out


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def fuse3d(spark: SparkSession, p: Params) -> dict:
    """3D boxes of the test split, scored against its 3D labels, for each mode of 2D boxes.

    ``oracle_2d`` lifts the 2D labels; ``detector`` the boxes of the table
    predictions/detections2d (frame_token, cls, score, x1, y1, x2, y2), where
    there is one.
    """
    s, f = Stage(spark, p), p.fusion
    samples = s.table("gold/samples", "curate")
    frames, qc = s.table("silver/frames", "transform"), s.table("silver/frames_qc", "quality")
    sound = frames.join(qc.where("NOT qc_error").select("frame_token"), "frame_token", "left_semi")
    test = samples.where("split = 'test' AND ml_ready").select("sample_token")
    pairs = silver.camera_lidar_pairs(sound, p.curation.camera_channel, p.sensors.reference_channel).join(test, "sample_token", "left_semi")
    lidar = sound.join(pairs.select(F.col("lidar_frame").alias("frame_token")), "frame_token", "left_semi")
    ann = s.table("silver/annotations", "transform")
    train = ann.join(samples.where("split = 'train'").select("sample_token"), "sample_token", "left_semi")
    priors = fuse.size_priors(train)
    labels = s.table("gold/labels_2d", "curate").withColumnRenamed("det_class", "cls")
    detections = spark.read.parquet(s.path(DETECTIONS)) if exists(spark, s.path(DETECTIONS)) else None
    modes = fuse.MODES if detections is not None else fuse.MODES[:1]
    flat = fuse.boxes_of_modes(labels, detections, f.min_score).join(pairs.select("frame_token"), "frame_token", "left_semi")
    boxes = lifting.lift(pairs, decode.read_points(spark, lidar, p.raw_dir), flat.drop("mode"), priors, f, s.kept)
    write_parquet(fuse.in_range(boxes.withColumn("mode", fuse.mode_of(F.col("box_id"))), f.class_range), s.path("predictions/boxes3d"))
    write_parquet(lifting.ground_truth(ann, pairs, f), s.path("predictions/gt3d"))
    preds, gts = s.table("predictions/boxes3d", "fuse3d"), s.table("predictions/gt3d", "fuse3d")
    of = {m: preds.where(F.col("mode") == m) for m in modes}
    write_parquet(submission(next((of[m] for m in reversed(modes) if not of[m].isEmpty()), preds)), s.path("predictions/submission"))
    report = {m: evaluate_boxes(of[m], gts, p) for m in modes}
    write_json(spark, report, s.path("predictions/eval3d.json"))
    return report


def evaluate_boxes(preds: DataFrame, gts: DataFrame, p: Params) -> dict:
    """Scores of one mode's boxes: in all, by class, and recall by distance."""
    f = p.fusion
    pr = preds.select(F.col("sample_token").alias("sample"), "cls", F.xxhash64("box_id").alias("p"), "score", F.get("center", F.lit(0)).alias("x"), F.get("center", F.lit(1)).alias("y"), "size", "yaw")
    gt = gts.withColumn("g", F.xxhash64("annotation_token"))
    m = matching.match(pr, gt, f.eval_thresholds)
    n = gt.groupBy("cls").agg(F.count(F.lit(1)).alias("n_gt")).withColumn("thr", F.explode(F.array(*map(F.lit, f.eval_thresholds))))
    ap = matching.average_precision(m.withColumn("tp", F.col("g").isNotNull()), n)
    pairs = m.where((F.col("thr") == f.tp_threshold) & F.col("g").isNotNull()).join(pr.select("p", *sizes("pred")), "p").join(gt.select("g", *sizes("gt")), "g")
    report = matching.nds_lite(ap.select("cls", "thr", "ap"), matching.tp_errors(pairs)).first().asDict()
    by_class = ap.where("ap IS NOT NULL").groupBy("cls").agg(F.avg("ap").alias("ap")).collect()  # a row a class
    by_distance = matching.recall_by(pr, gt, "distance_bin", f.tp_threshold).collect()  # a row a bin
    report["per_class"] = {r["cls"]: {"ap": r["ap"]} for r in by_class}
    report["by_distance"] = {r["distance_bin"]: {"n_gt": r["n_gt"], "recall": r["recall"], "ate": r["ate"]} for r in by_distance}
    report["lidar_share"] = preds.agg(F.avg((F.col("source") == "lidar").cast("double"))).first()[0]
    return report


def sizes(prefix: str) -> list:
    return [*[F.get("size", F.lit(i)).alias(f"{prefix}_{c}") for i, c in enumerate("wlh")], F.col("yaw").alias(f"{prefix}_yaw")]


def gate(spark: SparkSession, p: Params, new: str, old: str, watched: list[str]) -> bool:
    """Whether the model whose slice scores are at ``new`` may replace the one at ``old``."""
    checks = model_gate.gate_checks(spark.read.parquet(new), spark.read.parquet(old), watched, p.gate.min_map50, p.gate.max_slice_drop)
    return bool(model_gate.passed(checks).first()["passed"])


STAGES: dict[str, Callable[[SparkSession, Params], dict]] = {"extract": extract, "transform": transform, "features": features, "quality": quality_stage, "curate": curate_stage, "export-yolo": export_stage, "kpis": kpis, "fuse3d": fuse3d}


def run_all(spark: SparkSession, p: Params, upto: str = "fuse3d") -> dict[str, dict]:
    out = {}
    for name, stage in STAGES.items():
        out[name] = stage(spark, p)
        if name == upto:
            break
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="fleetlens", description=__doc__.split("\n")[0])
    parser.add_argument("command", choices=[*STAGES, "all", "publish-kpis", "gate", "fixture"])
    parser.add_argument("--params")
    parser.add_argument("--run-id", default="run")
    parser.add_argument("--published-at", default="1970-01-01 00:00:00")
    parser.add_argument("--new")
    parser.add_argument("--old")
    parser.add_argument("--watched", nargs="*", default=["night", "rain"])
    parser.add_argument("--faults", action="store_true")
    a = parser.parse_args(argv)
    p, spark = load_params(a.params), get_spark()
    try:
        if a.command == "fixture":
            from .sources.fixture import make_fixture

            out: object = make_fixture(spark, p.raw_dir, p.version, faults=a.faults)
        elif a.command == "all":
            out = run_all(spark, p)
        elif a.command == "publish-kpis":
            out = publish(spark, p, a.run_id, a.published_at)
        elif a.command == "gate":
            if not gate(spark, p, a.new, a.old, a.watched):
                print("the gate does not hold", file=sys.stderr)
                return 3
            out = {"passed": True}
        else:
            out = STAGES[a.command](spark, p)
    except quality.QualityGateError as e:
        print(e, file=sys.stderr)
        return 2
    print(json.dumps(out, indent=2, sort_keys=True, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
