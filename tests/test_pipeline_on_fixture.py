"""The stages end to end on the synthetic recording: clean, and with faults."""

import json
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlens import jobs
from fleetlens.operators import curate, quality
from fleetlens.params import Params, load_params, params_from
from fleetlens.sources import decode
from fleetlens.sources.fixture import make_fixture
from fleetlens.sources.raw import SourceError, read_table


def params(root, **kw) -> Params:
    p = Params(raw_dir=f"{root}/raw", out_dir=f"{root}/out")
    for section, values in kw.items():
        for k, v in values.items():
            setattr(getattr(p, section), k, v)
    return p


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("clean"))
    make_fixture(spark, f"{root}/raw")
    p = params(root)
    return p, jobs.run_all(spark, p)


@pytest.fixture(scope="module")
def faulty(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("faulty"))
    make_fixture(spark, f"{root}/raw", faults=True)
    p = params(root)
    for stage in ("extract", "transform", "features"):
        jobs.STAGES[stage](spark, p)
    with pytest.raises(quality.QualityGateError, match="2 errors"):
        jobs.quality_stage(spark, p)
    return p


def out(spark, p, name):
    return spark.read.parquet(f"{p.out_dir}/{name}")


def test_extract_keeps_rows_and_digests(spark, clean):
    p, done = clean
    assert done["extract"]["sample"] == 15 and done["extract"]["sample_annotation"] == 90
    report = json.loads(open(f"{p.out_dir}/bronze/_manifest.json").read())
    assert len(report) == 12 and all(len(v["sha256"]) == 64 for v in report.values())


def test_frames_and_sync(spark, clean):
    p, done = clean
    assert done["transform"] == {"scenes": 3, "frames": {"CAM_FRONT": 75, "LIDAR_TOP": 123}}
    frames, sync = out(spark, p, "silver/frames"), out(spark, p, "silver/sync")
    step = frames.where("channel = 'LIDAR_TOP'").agg(F.median("dt_prev_ms")).first()[0]
    assert abs(step - 50) < 1
    assert sync.count() == 30 and sync.where("NOT has_keyframe").count() == 0
    offsets = Counter(round(r.offset_ms * 1000) for r in sync.where("channel = 'CAM_FRONT'").collect())
    assert offsets == {0: 3, -2: 3, -4: 3, -6: 3, -8: 3}
    assert out(spark, p, "silver/annotations").where("det_class IS NULL").count() == 5


def test_clean_recording_passes(spark, clean):
    p, done = clean
    assert done["quality"]["pass_rate"] == 1.0 and done["quality"]["issues"] == {}
    assert done["features"] == {"frames": 198, "failed": 0}
    f = out(spark, p, "silver/frame_features").join(out(spark, p, "silver/frames"), "frame_token")
    day = f.where("modality = 'camera' AND scene_name = 'drive-a'").agg(F.avg("brightness")).first()[0]
    night = f.where("modality = 'camera' AND scene_name = 'drive-b'").agg(F.avg("brightness")).first()[0]
    assert abs(day - 129) < 3 and abs(night - 32) < 3


def test_faults_are_found(spark, faulty):
    issues = out(spark, faulty, "reports/issues")
    n = {(r["check"], r["severity"]): r["n"] for r in issues.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n == {("corrupt_file", "ERROR"): 1, ("missing_file", "ERROR"): 1, ("sync_offset", "WARN"): 1, ("frame_gap", "WARN"): 1, ("weak_label", "WARN"): 3, ("calibration_suspect", "WARN"): 5}
    one = {r["check"]: r for r in issues.collect()}
    assert one["sync_offset"]["value"] == pytest.approx(119.996) and one["sync_offset"]["scene_name"] == "drive-a"
    assert one["frame_gap"]["value"] == pytest.approx(250.0) and "~4 frames" in one["frame_gap"]["message"]
    assert {r["scene_name"] for r in issues.where("`check` = 'calibration_suspect'").collect()} == {"drive-c"}
    status = out(spark, faulty, "silver/frames_qc")
    assert status.count() == 194 and status.where("qc_error").count() == 2 and status.where("NOT calib_ok").count() == 5


def test_tags_and_splits(spark, clean):
    p, _ = clean
    tags = {r["scene_name"]: set(r["tags"]) for r in out(spark, p, "gold/samples").collect()}
    assert {"night", "crowded", "slow"} <= tags["drive-b"] and {"rain", "stopped"} <= tags["drive-c"] and {"has_bicycle", "moving", "day"} <= tags["drive-a"]
    splits = {(r["scene_name"], r["split"]) for r in out(spark, p, "gold/samples").collect()}
    assert len(splits) == 3 and {s for _, s in splits} == {"train", "val", "test"}


def test_leakage_is_an_error(spark):
    with pytest.raises(curate.LeakageError):
        curate.check_no_leakage(spark.createDataFrame([("a", "train"), ("a", "test")], "scene_name string, split string"))


def test_labels_lie_in_the_image(spark, clean):
    p, done = clean
    boxes = out(spark, p, "gold/labels_2d")
    assert boxes.where("x1 < 0 OR y1 < 0 OR x2 > 1600 OR y2 > 900 OR x2 <= x1 OR y2 <= y1").count() == 0
    assert boxes.where("det_class IS NULL OR class_id < 0").count() == 0 and boxes.count() > 60
    assert done["export-yolo"] == {"images": 15}
    index = out(spark, p, "ml_ready/yolo/index.parquet").collect()
    for r in index:
        text = open(f"{p.out_dir}/ml_ready/yolo/labels/{r.split}/{r.image[:-4]}.txt").read()
        assert all(len(line.split()) == 5 and all(0 <= float(x) <= 1 for x in line.split()[1:]) for line in text.splitlines())
        assert open(f"{p.out_dir}/ml_ready/yolo/images/{r.split}/{r.image}", "rb").read(2) == b"\xff\xd8"


def test_kpis(spark, clean):
    p, done = clean
    k = done["kpis"]
    assert k["recording_seconds"] == 6.0 and k["ml_ready_rate"] == 1.0
    assert round(k["measured_hz"]["LIDAR_TOP"]["measured_hz"], 2) == 20.5 and round(k["measured_hz"]["CAM_FRONT"]["measured_hz"], 2) == 12.5
    assert k["coverage"] == {"observed": 3, "possible": 12, "empty": 9}
    assert "truck" in k["missing_train_classes"] and "car" not in k["missing_train_classes"]


def test_publishing_twice_makes_two_runs(spark, clean):
    p, _ = clean
    for i in (1, 2, 2):
        jobs.publish(spark, p, f"run-{i}", f"2024-01-0{i} 00:00:00")
    history = out(spark, p, "store/kpi_history")
    n = history.count()
    assert {"git_commit", "dataset_version", "published_at"} <= set(history.columns) and history.select("dataset_version").distinct().count() == 1
    jobs.publish_model(spark, p, spark.createDataFrame([("night", "map50", 0.5)], "slice string, metric string, value double"), "m1", "run-1", "2024-01-01 00:00:00")
    assert {r["metric"] for r in out(spark, p, "store/model_metrics").collect()} >= {"map50", "mAP", "NDS_lite", "ap"}
    assert history.select("run_id").distinct().count() == 2 and n == 2 * history.where("run_id = 'run-1'").count()


def test_fusion_scores(spark, clean):
    _, done = clean
    assert set(done["fuse3d"]) == {"oracle_2d"}
    f = done["fuse3d"]["oracle_2d"]
    assert f["map"] > 0.8 and f["mate"] < 0.5 and f["lidar_share"] > 0.5
    assert f["per_class"] and all(0 <= v["recall"] <= 1 and v["n_gt"] > 0 for v in f["by_distance"].values())


def test_detector_boxes_are_a_mode_of_their_own(spark, clean):
    p, done = clean
    labels = out(spark, p, "gold/labels_2d")
    seen = labels.selectExpr("frame_token", "det_class AS cls", "CAST(0.9 AS FLOAT) AS score", "x1", "y1", "x2", "y2")
    weak = seen.selectExpr("frame_token", "cls", "CAST(0.1 AS FLOAT) AS score", "x1 + 5 AS x1", "y1", "x2 + 5 AS x2", "y2")
    seen.union(weak).write.parquet(f"{p.out_dir}/{jobs.DETECTIONS}")
    try:
        report = jobs.fuse3d(spark, p)
        boxes = out(spark, p, "predictions/boxes3d")
        n = {r["mode"]: r["count"] for r in boxes.groupBy("mode").count().collect()}
    finally:
        shutil.rmtree(f"{p.out_dir}/{jobs.DETECTIONS}")
    assert set(report) == {"oracle_2d", "detector"} and n["oracle_2d"] == n["detector"]  # the weak boxes are left out
    assert abs(report["detector"]["map"] - report["oracle_2d"]["map"]) < 0.05
    assert {s for s, _, _ in jobs.scores_3d(report)} >= {"3d_detector", "3d_oracle_2d"}
    assert out(spark, p, "predictions/submission").count() == boxes.where("mode = 'detector'").select("sample_token").distinct().count()
    jobs.fuse3d(spark, p)


def test_report_has_its_panels(spark, clean):
    from fleetlens.sinks import html_report

    page = html_report({"volume": {"CAM_FRONT": {"frames": 7}}, "issues": {"gap.WARN": 2, "missing_file.ERROR": 1}, "train_balance": {"car": {"boxes": 9}}}, [{"location": "a<b", "time_of_day": "day", "weather": "rain", "samples": 3}])
    assert all(t in page for t in ("Coverage", "a&lt;b", "Frames by channel", "Issues: ERROR", "Issues: WARN", "Training boxes by class"))
    assert "Coverage" in html_report({}, [])


def test_radar_and_scene_filter(spark, clean, tmp_path):
    p, _ = clean
    q = params(tmp_path, sensors={"enabled": ["CAM_FRONT", "LIDAR_TOP", "RADAR_FRONT"]}, etl={"scenes": ["drive-a", "drive-b"]})
    q.raw_dir = p.raw_dir
    jobs.extract(spark, q)
    done = jobs.transform(spark, q)
    assert done == {"scenes": 2, "frames": {"CAM_FRONT": 50, "LIDAR_TOP": 82, "RADAR_FRONT": 54}}
    jobs.features(spark, q)
    radar = out(spark, q, "silver/frame_features").join(out(spark, q, "silver/frames").where("modality = 'radar'"), "frame_token", "left_semi")
    assert {r["n_points"] for r in radar.collect()} == {12.0}
    q.etl.scenes = ["scene-1"]
    with pytest.raises(SourceError, match="unknown scenes"):
        jobs.transform(spark, q)


def test_sources_name_what_is_missing(spark, tmp_path):
    with pytest.raises(SourceError, match="not found"):
        read_table(spark, str(tmp_path), "scene")
    (tmp_path / "log.json").write_text('[{"token": "a", "location": "x"}]')
    with pytest.raises(SourceError, match="vehicle"):
        read_table(spark, str(tmp_path), "log")


def test_decoders():
    with pytest.raises(decode.DecodeError):
        decode.lidar_points(b"\0" * 1001)
    with pytest.raises(decode.DecodeError):
        decode.lidar_points(b"")
    with pytest.raises(decode.DecodeError):
        decode.pcd_header(b"VERSION 0.7\n" * 1000)
    with pytest.raises(KeyError, match="known"):
        decode.modality("sonar")
    grey = decode.image_features(bytes([100] * 300 * 640 * 3), 300, 640, 3)
    assert abs(grey["brightness"] - 100) < 1e-6 and grey["sharpness"] < 1e-9


def test_params():
    p = params_from({"quality": {"sync_tolerance_ms": 20.0}, "curation": {"speed_bins": [1.0, 2.0]}})
    assert p.quality.sync_tolerance_ms == 20.0 and p.curation.speed_bins == (1.0, 2.0) and load_params().curation.class_names[0] == "car"
    with pytest.raises(ValueError, match="unknown parameter"):
        params_from({"quality": {"nothing": 1}})
    with pytest.raises(ValueError, match="tp_threshold"):
        params_from({"fusion": {"tp_threshold": 3.0}})
