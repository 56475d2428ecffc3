"""Model evaluation by slice, and the gate between an old and a new model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_slice(samples: DataFrame, *metrics: Column) -> DataFrame:
    """Metrics for each tag and for the regression set."""
    names = F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.when(F.col("in_regression_set"), F.array(F.lit("regression_set"))).otherwise(F.array().cast("array<string>")))
    return samples.withColumn("slice", F.explode(F.array_distinct(names))).groupBy("slice").agg(*metrics)


def gate_checks(new: DataFrame, old: DataFrame, watched: Sequence[str], min_score: float, max_drop: float, total: str = "all") -> DataFrame:
    """A row for each check (slice, old, new, passed): the floor on the total, and the drop of each watched slice that both models have."""
    floor = new.where(F.col("slice") == total).select("slice", F.lit(None).cast("double").alias("old"), F.col("score").alias("new"), (F.col("score") >= min_score).alias("passed"))
    both = new.alias("n").join(old.alias("o"), "slice").where(F.col("slice").isin(list(watched)))
    drops = both.select("slice", F.col("o.score").alias("old"), F.col("n.score").alias("new"), (F.col("o.score") - F.col("n.score") <= max_drop).alias("passed"))
    return floor.unionByName(drops)


def passed(checks: DataFrame) -> DataFrame:
    return checks.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def may_promote(models: DataFrame, report: DataFrame) -> DataFrame:
    """``model_version`` and ``allowed``: a model may be promoted if the gate's report is on this very version, and passed."""
    gated = report.select(F.col("model_version").alias("_gated"), "passed")
    j = models.join(F.broadcast(gated), F.col("model_version") == F.col("_gated"), "left")  # a row a report
    return j.select("model_version", F.coalesce("passed", F.lit(False)).alias("allowed"))
