"""Scenario tags, splits without leakage, and readiness of samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import keyword_tag, not_ready_reason, present, speed_bin
from ..params import Curation


def class_counts(samples: DataFrame, annotations: DataFrame, classes: Sequence[str], key: str = "sample_token") -> DataFrame:
    """Samples with ``n_<class>`` and ``has_<class>`` of every class; absent classes count 0."""
    wide = annotations.where(F.col("det_class").isin(list(classes))).groupBy(key).pivot("det_class", list(classes)).count()
    return samples.join(wide, key, "left").select(
        samples["*"], *[F.coalesce(wide[c], F.lit(0)).cast("int").alias(f"n_{c}") for c in classes], *[(F.coalesce(wide[c], F.lit(0)) > 0).alias(f"has_{c}") for c in classes]
    )


def tag_samples(samples: DataFrame, annotations: DataFrame, p: Curation, crowd_class: str = "pedestrian") -> DataFrame:
    """Samples (scene_description, location, ego_speed_mps) with conditions, class counts, crowds and the tag list."""
    classes = p.class_names
    base = samples.withColumns(
        {"time_of_day": keyword_tag(F.col("scene_description"), "night", "night", "day"), "weather": keyword_tag(F.col("scene_description"), "rain", "rain", "clear"), "speed_bin": speed_bin(F.col("ego_speed_mps"), p.speed_bins)}
    )
    counted = class_counts(base, annotations, classes).withColumn("crowded", F.col(f"n_{crowd_class}") >= p.crowded_min)
    return counted.withColumn("tags", tag_list(classes))


def tag_list(classes: Sequence[str]):
    return present(F.col("time_of_day"), F.col("weather"), F.col("speed_bin"), F.col("location"), *[F.when(F.col(f"has_{c}"), f"has_{c}") for c in classes], F.when(F.col("crowded"), "crowded"))


def mode_by(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value of each key, the least on ties."""
    n = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy(key).agg(F.min(F.struct(-F.col("_n"), F.col(value).alias("v")))["v"].alias(value))


def scene_splits(samples: DataFrame, seed: int, val_fraction: float, test_fraction: float, stratum: str = "time_of_day") -> DataFrame:
    """Every scene with its split, strata dealt in turn.

    A scene's stratum is the mode of its samples; scenes of a stratum are
    ordered by a digest of seed and name, and dealt one per stratum at a time,
    larger strata first.  A scene's position follows from its rank and the
    strata's sizes, so scenes are never sorted as a whole.  The first
    positions are the test split, the next validation, the rest training.
    """
    scenes = mode_by(samples, "scene_name", stratum)
    ranked = scenes.withColumn("_rank", F.row_number().over(Window.partitionBy(stratum).orderBy(F.sha2(F.concat(F.lit(str(seed)), F.col("scene_name").cast("string")), 256), "scene_name")))
    sizes = scenes.groupBy(stratum).agg(F.count(F.lit(1)).alias("_size"))
    # one row: the strata and their sizes, largest first
    strata = sizes.agg(F.sort_array(F.collect_list(F.struct((-F.col("_size")).alias("neg"), F.col(stratum).alias("name")))).alias("_strata"))
    own = ranked.join(sizes, ranked[stratum].eqNullSafe(sizes[stratum])).select(ranked["*"], "_size").crossJoin(F.broadcast(strata))
    before = F.aggregate("_strata", F.lit(0).cast("long"), lambda n, s: n + F.least(-s["neg"], F.col("_rank") - 1))
    ahead = F.size(F.filter("_strata", lambda s: (-s["neg"] >= F.col("_rank")) & (F.struct(s["neg"], s["name"]) < F.struct((-F.col("_size")).alias("neg"), F.col(stratum).alias("name")))))
    total = F.aggregate("_strata", F.lit(0).cast("long"), lambda n, s: n - s["neg"])
    share = lambda f: F.when((total >= 3) & (F.lit(f) > 0), F.greatest(F.lit(1), F.bround(total * F.lit(f)))).otherwise(F.lit(0)).cast("long")
    position = (before + ahead).alias("position")
    placed = own.select("scene_name", stratum, position, share(test_fraction).alias("_test"), share(val_fraction).alias("_val"))
    return placed.select("scene_name", stratum, "position", F.when(F.col("position") < F.col("_test"), "test").when(F.col("position") < F.col("_test") + F.col("_val"), "val").otherwise("train").alias("split"))


class LeakageError(Exception):
    """A scene is in more than one split."""


def leaking_scenes(samples: DataFrame) -> DataFrame:
    return samples.groupBy("scene_name").agg(F.count_distinct("split").alias("n_splits")).where("n_splits > 1")


def check_no_leakage(samples: DataFrame) -> None:
    found = leaking_scenes(samples).limit(10).collect()
    if found:
        raise LeakageError(f"scenes in more than one split: {[r['scene_name'] for r in found]}")


def with_readiness(samples: DataFrame, camera_frames: DataFrame, p: Curation) -> DataFrame:
    """Samples with their camera keyframe's verdict: the reason why one is not ready, and the regression flag."""
    cam = camera_frames.select("sample_token", "frame_token", "filename", "qc_error", "sync_ok", "calib_ok")
    reason = not_ready_reason(F.col("frame_token").isNotNull(), F.col("qc_error"), F.col("sync_ok"), F.col("calib_ok"))
    flag = (F.col("split") == "test") & F.arrays_overlap("tags", F.array(*map(F.lit, p.regression_tags)))
    return samples.join(cam, "sample_token", "left").withColumn("not_ready_reason", reason).withColumns({"ml_ready": F.col("not_ready_reason").isNull(), "in_regression_set": flag}).drop("qc_error", "sync_ok", "calib_ok")
