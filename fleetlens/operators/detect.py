"""Post-processing of detector output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BOX = "array<struct<neg:double,p:bigint,x1:double,y1:double,x2:double,y2:double>>"


def iou(a: Column, b: Column) -> Column:
    w = F.greatest(F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]), F.lit(0.0))
    h = F.greatest(F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]), F.lit(0.0))
    area = lambda q: (q["x2"] - q["x1"]) * (q["y2"] - q["y1"])
    return w * h / (area(a) + area(b) - w * h + F.lit(1e-9))


def nms(boxes: DataFrame, threshold: float, keys: Sequence[str] = ("frame", "cls")) -> DataFrame:
    """Boxes left when, by score, each drops those of its frame and class that overlap it by more than the threshold; equal scores go by ``p``."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), F.col("p").cast("long").alias("p"), "x1", "y1", "x2", "y2")))
    keep = F.aggregate("_all", F.array().cast(_BOX), lambda kept, b: F.when(F.exists(kept, lambda k: iou(k, b) > threshold), kept).otherwise(F.concat(kept, F.array(b))))
    return boxes.groupBy(*keys).agg(ranked.alias("_all")).select(*keys, F.inline(keep)).select(*keys, "p", (-F.col("neg")).alias("score"), "x1", "y1", "x2", "y2")


def decode(rows: DataFrame, classes: Sequence[str], min_score: float) -> DataFrame:
    """Boxes from raw output rows (cx, cy, w, h and an array ``scores``): best class, if it scores enough, and corners."""
    best = F.array_max("scores")
    cls = F.get(F.array(*map(F.lit, classes)), (F.array_position("scores", best) - 1).cast("int"))
    half_w, half_h = F.col("w") / 2, F.col("h") / 2
    return rows.withColumns({"score": best, "cls": cls, "x1": F.col("cx") - half_w, "y1": F.col("cy") - half_h, "x2": F.col("cx") + half_w, "y2": F.col("cy") + half_h}).where(F.col("score") >= min_score).drop("scores")
