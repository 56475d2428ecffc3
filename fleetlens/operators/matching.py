"""Scoring of detections: greedy matching by centre distance, AP, errors, NDS, recall by group.

Matching is a fold over the detections of one (class, threshold, sample), so it
runs in parallel over these groups and inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import yaw_gap

_TAKEN = "array<struct<p:bigint,g:bigint,d:double>>"


def greedy(preds: Column, gts: Column, threshold: Column) -> Column:
    """Pairs (p, g, d) of a group: detections by score, each takes the nearest free truth closer than the threshold.

    ``preds`` are structs (score, p, x, y) and ``gts`` structs (g, x, y); equal
    scores go by ``p``, equal distances by ``g``.
    """
    ordered = F.array_sort(F.transform(preds, lambda a: F.struct((-a["score"]).alias("neg"), a["p"].alias("p"), a["x"].alias("x"), a["y"].alias("y"))))

    def step(taken: Column, a: Column) -> Column:
        away = lambda g: F.hypot(g["x"] - a["x"], g["y"] - a["y"])
        free = F.filter(gts, lambda g: (away(g) < threshold) & ~F.exists(taken, lambda t: t["g"] == g["g"]))
        best = F.array_min(F.transform(free, lambda g: F.struct(away(g).alias("d"), g["g"].alias("g"))))
        hit = F.filter(F.array(best), lambda b: b.isNotNull())
        return F.concat(taken, F.transform(hit, lambda b: F.struct(a["p"].alias("p"), b["g"].alias("g"), b["d"].alias("d"))))

    return F.aggregate(ordered, F.array().cast(_TAKEN), step)


def match(preds: DataFrame, gts: DataFrame, thresholds: Sequence[float], keys: Sequence[str] = ("cls", "sample")) -> DataFrame:
    """Every detection at every threshold, with the truth it takes and the distance, or NULL.

    Both tables have the keys, an id (``p`` or ``g``), ``x``, ``y``; detections a ``score``.
    """
    keys = list(keys)
    p = preds.groupBy(*keys).agg(F.collect_list(F.struct("score", "p", "x", "y")).alias("ps"))
    g = gts.groupBy(*keys).agg(F.collect_list(F.struct("g", "x", "y")).alias("gs"))
    none = F.array().cast("array<struct<g:bigint,x:double,y:double>>")
    j = p.join(g, keys, "left").withColumn("thr", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    j = j.withColumn("taken", greedy(F.col("ps"), F.coalesce("gs", none), F.col("thr")))
    hit = F.get(F.filter("taken", lambda t: t["p"] == F.col("a.p")), F.lit(0))
    return j.select(*keys, "thr", "taken", F.explode("ps").alias("a")).select(*keys, "thr", F.col("a.p").alias("p"), F.col("a.score").alias("score"), hit["g"].alias("g"), hit["d"].alias("d"))


#: Bins of the score range of a group whose detections are ranked apart from each other.
SCORE_BINS = 1024


def ranked(matched: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``matched`` with ``_n``, the place by score, and ``_tp``, the hits up to there.

    The score range of a group is cut into bins; a bin is ranked by itself and
    starts at the totals of the bins above, of which there are SCORE_BINS a
    group at most.  So no task sees a whole group.
    """
    keys = list(keys)
    ends = matched.groupBy(*keys).agg(F.min("score").alias("_low"), F.max("score").alias("_high"))
    share = F.coalesce(F.try_divide(F.col("_high") - F.col("score"), F.col("_high") - F.col("_low")), F.lit(0.0))
    binned = matched.join(ends, keys).withColumn("_bin", F.floor(share * (SCORE_BINS - 1)).cast("int")).drop("_low", "_high")
    totals = binned.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.col("tp").cast("long")).alias("_hits"))
    above = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*keys, "_bin", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("_rows", "_hits")])
    w = Window.partitionBy(*keys, "_bin").orderBy(F.col("score").desc(), order)
    local = binned.withColumns({"_n": F.row_number().over(w), "_tp": F.sum(F.col("tp").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))})
    return local.join(bases, [*keys, "_bin"]).withColumns({"_n": F.col("_n") + F.col("_rows_above"), "_tp": F.col("_tp") + F.col("_hits_above")}).drop("_bin", "_rows_above", "_hits_above")


def average_precision(matched: DataFrame, n_gt: DataFrame, keys: Sequence[str] = ("cls", "thr"), order: str = "p") -> DataFrame:
    """AP of each group over 101 recall points: interpolated, enveloped, without the first 11 points, less 0.1 precision.

    ``matched`` has ``tp`` (boolean) and ``score``; ``n_gt`` the number of
    truths of a group.  A group of truths without detections has AP 0, one
    without truths NULL.  Recall rises by one hit at a time, so each of the 101
    points lies between two known numbers of hits, and only the precisions at
    these, at most 202 a group, are looked up.
    """
    keys = list(keys)
    steps = (
        ranked(matched, keys, order).groupBy(*keys, "_tp").agg(F.min("_n").alias("first_n"), F.max("_n").alias("last_n"))
        .join(n_gt.where("n_gt > 0"), keys)
        .withColumns({"rec": F.col("_tp") / F.col("n_gt"), "first": F.col("_tp") / F.col("first_n"), "last": F.col("_tp") / F.col("last_n")})
    )
    ends = steps.groupBy(*keys).agg(F.max("rec").alias("top"), F.max_by("last", "_tp").alias("top_prec"), F.min_by("first", "_tp").alias("first_prec"), F.first("n_gt").alias("n_gt"))
    x = F.col("k") / F.lit(100.0)
    guess = F.floor(x * F.col("n_gt"))  # hits at the point, but for rounding
    below = F.when((guess + 1) / F.col("n_gt") <= x, guess + 1).when(guess / F.col("n_gt") > x, guess - 1).otherwise(guess)
    grid = ends.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(100)))).withColumns({"x": x, "below": below})
    points = grid.join(steps.select(*keys, F.col("_tp").alias("below"), F.col("rec").alias("low_rec"), F.col("last").alias("low_prec")), [*keys, "below"], "left")
    points = points.withColumn("next", F.col("below") + 1).join(steps.select(*keys, F.col("_tp").alias("next"), F.col("rec").alias("high_rec"), F.col("first").alias("high_prec")), [*keys, "next"], "left")
    # beyond the last hit the lower end is the top itself
    past = F.col("x") >= F.col("top")
    between = F.col("low_prec") + (F.col("high_prec") - F.col("low_prec")) * F.try_divide(F.col("x") - F.col("low_rec"), F.col("high_rec") - F.col("low_rec"))
    value = F.when(past, F.when(F.col("x") == F.col("top"), F.col("top_prec")).otherwise(0.0)).when(F.col("low_rec").isNull(), F.col("first_prec")).otherwise(between)
    points = points.withColumn("v", value)
    env = F.max("v").over(Window.partitionBy(*keys).orderBy("k").rowsBetween(0, Window.unboundedFollowing))  # 101 rows a group
    points = points.withColumn("env", F.when(F.col("x") > F.col("top") + 1e-9, F.lit(0.0)).otherwise(env))
    ap = points.where("k > 10").groupBy(*keys).agg((F.avg(F.greatest(F.col("env") - 0.1, F.lit(0.0))) / 0.9).alias("ap"))
    return n_gt.join(ap, keys, "left").select(*keys, "n_gt", F.when(F.col("n_gt") > 0, F.coalesce("ap", F.lit(0.0))).alias("ap"))


def aligned_iou(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    """IoU of two sizes with centres and headings aligned."""
    common = F.least(a[0], b[0]) * F.least(a[1], b[1]) * F.least(a[2], b[2])
    return F.try_divide(common, a[0] * a[1] * a[2] + b[0] * b[1] * b[2] - common)


def tp_errors(pairs: DataFrame) -> DataFrame:
    """Per class: mean distance, scale and heading errors of matched pairs (d, pred and gt sizes and yaws)."""
    s = tuple(F.col(f"pred_{c}") for c in "wlh"), tuple(F.col(f"gt_{c}") for c in "wlh")
    return pairs.groupBy("cls").agg(F.avg("d").alias("ate"), F.avg(1 - aligned_iou(*s)).alias("ase"), F.avg(yaw_gap(F.col("pred_yaw"), F.col("gt_yaw"))).alias("aoe"))


def nds_lite(ap: DataFrame, errors: DataFrame) -> DataFrame:
    """mAP over classes with truths, mean errors, and (5 mAP + sum of 1 - min(1, error)) / 8; a missing error counts 1."""
    per = ap.where("ap IS NOT NULL").groupBy("cls").agg(F.avg("ap").alias("ap"))
    m = per.join(errors, "cls", "left").agg(F.avg("ap").alias("map"), *[F.avg(c).alias(f"m{c}") for c in ("ate", "ase", "aoe")])
    gain = lambda c: 1 - F.least(F.lit(1.0), F.coalesce(F.col(c), F.lit(1.0)))
    return m.withColumn("nds", (5 * F.coalesce("map", F.lit(0.0)) + gain("mate") + gain("mase") + gain("maoe")) / 8)


def recall_by(preds: DataFrame, gts: DataFrame, group: str, threshold: float) -> DataFrame:
    """Recall and mean distance by a group of the truths; matching starts anew in each group."""
    groups = gts.select(group).distinct()
    spread = preds.join(gts.select("cls", "sample", group).distinct(), ["cls", "sample"])
    m = match(spread, gts, [threshold], ("cls", "sample", group))
    found = m.where("g IS NOT NULL").groupBy(group).agg(F.count(F.lit(1)).alias("n_found"), F.avg("d").alias("ate"))
    total = gts.groupBy(group).agg(F.count(F.lit(1)).alias("n_gt"))
    return groups.join(total, group).join(found, group, "left").select(group, "n_gt", (F.coalesce("n_found", F.lit(0)) / F.col("n_gt")).alias("recall"), "ate")


def missed(matched: DataFrame, gts: DataFrame) -> DataFrame:
    """Truths that nothing took, per sample."""
    taken = matched.where("g IS NOT NULL").select("sample", "cls", "g").distinct()
    return gts.join(taken, ["sample", "cls", "g"], "left_anti").groupBy("sample").agg(F.count(F.lit(1)).alias("missed"))
