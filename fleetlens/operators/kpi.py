"""KPIs over frames, sync, issues, labels and samples.  Each is one distributed aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ratio


def volume(frames: DataFrame) -> DataFrame:
    return frames.groupBy("channel").agg(F.count(F.lit(1)).alias("frames"), F.sum(F.col("is_key_frame").cast("long")).alias("keyframes"), F.sum(F.greatest(F.col("file_size_bytes"), F.lit(0))).alias("bytes"))


def duration(frames: DataFrame) -> DataFrame:
    """Recorded seconds, summed over scenes."""
    return frames.groupBy("scene_name").agg((F.max("timestamp") - F.min("timestamp")).alias("span")).agg((F.sum("span") / F.lit(1e6)).alias("recording_seconds"))


def rate(frames: DataFrame) -> DataFrame:
    """Median over scenes of frames per second of span; scenes of no span have none."""
    per = frames.groupBy("scene_name", "channel").agg(ratio(F.count(F.lit(1)), (F.max("timestamp") - F.min("timestamp")) / F.lit(1e6)).alias("hz"))
    return per.groupBy("channel").agg(F.median("hz").alias("measured_hz"))


def pass_rate(frames_qc: DataFrame) -> DataFrame:
    return frames_qc.groupBy("channel").agg(F.avg(F.col("qc_pass").cast("double")).alias("pass_rate"))


def sync_percentiles(sync: DataFrame) -> DataFrame:
    off = F.abs("offset_ms")
    return sync.where("has_keyframe").groupBy("channel").agg(F.percentile_approx(off, 0.5).alias("p50_ms"), F.percentile_approx(off, 0.95).alias("p95_ms"), F.max(off).alias("max_ms"))


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n"))


def label_rates(labels_qc: DataFrame) -> DataFrame:
    """Shares of fine, weak and barely visible boxes among boxes of a class."""
    n = F.count(F.lit(1))
    share = lambda q: ratio(F.count_if(F.col("label_quality") == q), n, 4)
    return labels_qc.where("det_class IS NOT NULL").agg(n.alias("boxes"), share("ok").alias("ok_rate"), share("weak").alias("weak_rate"), share("low_visibility").alias("low_visibility_rate"))


def boxes_by(labels_2d: DataFrame, *dims: str) -> DataFrame:
    """Counts by each dimension alone, in one pass: a row has one dimension set and the others NULL."""
    sets = [[F.col(d)] for d in dims]
    return labels_2d.groupingSets(sets, *[F.col(d) for d in dims]).agg(F.count(F.lit(1)).alias("n"))


def readiness(samples: DataFrame) -> DataFrame:
    """Per split; the regression count needs a ready sample, the flag itself does not."""
    one = lambda c: F.sum(c.cast("long"))
    return samples.groupBy("split").agg(F.count(F.lit(1)).alias("samples"), one(F.col("ml_ready")).alias("ml_ready"), one(F.col("in_regression_set") & F.col("ml_ready")).alias("regression_set"))


def train_balance(labels_2d: DataFrame, samples: DataFrame) -> DataFrame:
    train = samples.where("split = 'train'").select("sample_token")
    return labels_2d.join(train, "sample_token").groupBy("det_class").agg(F.count(F.lit(1)).alias("boxes"))


def missing_classes(spark: SparkSession, present: DataFrame, classes: Sequence[str], column: str = "det_class") -> DataFrame:
    """Configured classes without any row."""
    wanted = spark.range(1).select(F.explode(F.array(*map(F.lit, classes))).alias(column))
    return wanted.join(present.select(column).distinct(), column, "left_anti")


COVERAGE = ("location", "time_of_day", "weather", "speed_bin", "split")


def coverage(samples: DataFrame, dims: Sequence[str] = COVERAGE) -> DataFrame:
    return samples.groupBy(*dims).agg(F.count(F.lit(1)).alias("samples"), F.sum(F.col("ml_ready").cast("long")).alias("ml_ready"))


def coverage_gaps(samples: DataFrame, dims: Sequence[str] = COVERAGE[:3]) -> DataFrame:
    """Combinations of the dimensions' levels that no sample has.

    The levels of all dimensions are gathered in one aggregation; their product
    is that of the vocabularies, not of rows.
    """
    seen = samples.select(*dims).distinct()
    levels = seen.agg(*[F.array_sort(F.collect_set(d)).alias(d) for d in dims])
    grid = levels
    for d in dims:
        grid = grid.withColumn(d, F.explode(d))
    return grid.join(seen, list(dims), "left_anti")


def coverage_summary(samples: DataFrame, dims: Sequence[str] = COVERAGE[:3]) -> DataFrame:
    """Observed, possible and empty cells."""
    seen = samples.select(*dims).distinct()
    possible: Column = F.lit(1).cast("long")
    for d in dims:
        possible = possible * F.count_distinct(d)
    n = F.count(F.lit(1))
    return seen.agg(n.alias("observed"), possible.alias("possible"), (possible - n).alias("empty"))


def histogram(values: DataFrame, column: str, bounds: Sequence[float], *keys: str) -> DataFrame:
    """Cumulative counts of values up to each bound, and of all."""
    tops = F.array(*[F.lit(float(b)) for b in bounds], F.lit(float("inf")))
    per = values.groupBy(*keys).agg(*[F.count_if(F.col(column) <= F.lit(float(b))).alias(f"_le_{i}") for i, b in enumerate(bounds)], F.count(column).alias(f"_le_{len(bounds)}"))
    cells = F.arrays_zip(tops.alias("le"), F.array(*[F.col(f"_le_{i}") for i in range(len(bounds) + 1)]).alias("n"))
    return per.select(*keys, F.inline(cells)).toDF(*keys, "le", "n")


def sliding(rows: DataFrame, time: str, seconds: int, step: int) -> DataFrame:
    """Each row once for every multiple ``at`` of ``step`` seconds whose last ``seconds`` hold it: from ``at - seconds`` on, before ``at``."""
    return rows.withColumn("_w", F.window(F.col(time), f"{seconds} seconds", f"{step} seconds")).withColumn("at", F.col("_w.end")).drop("_w")


def sliding_rate(rows: DataFrame, time: str, seconds: int, step: int, *keys: str) -> DataFrame:
    """Rows a second over the last ``seconds`` before each ``at``, where there are any."""
    return sliding(rows, time, seconds, step).groupBy("at", *keys).agg((F.count(F.lit(1)) / F.lit(float(seconds))).alias("rate"))


def exposition(name: str, rows: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """Lines of the text format for metrics: one a row, labelled by its other columns, and one that names the kind.

    A histogram's rows are cumulative counts ``n`` by ``le``.
    """
    labels = [c for c in rows.columns if c not in (value, "n")]
    text = lambda c: F.when(F.col(c).cast("string") == "Infinity", "+Inf").otherwise(F.col(c).cast("string"))
    pairs = F.concat_ws(",", *[F.concat(F.lit(f'{c}="'), F.replace(F.replace(text(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')) for c in labels])
    series, number = (f"{name}_bucket", "n") if kind == "histogram" else (name, value)
    lines = rows.select(F.concat(F.lit(series), F.when(pairs != "", F.concat(F.lit("{"), pairs, F.lit("}"))).otherwise(F.lit("")), F.lit(" "), F.col(number).cast("string")).alias("line"))
    return rows.sparkSession.range(1).select(F.lit(f"# TYPE {name} {kind}").alias("line")).unionByName(lines)


def latency_report(runs: DataFrame, column: str, *keys: str) -> DataFrame:
    """Mean and percentiles of run times in ms, and runs per second at the mean."""
    q = lambda p: F.percentile(column, p)
    mean = F.avg(column)
    return runs.groupBy(*keys).agg(F.count(column).alias("runs"), mean.alias("mean_ms"), q(0.5).alias("p50_ms"), q(0.95).alias("p95_ms"), q(0.99).alias("p99_ms"), F.try_divide(F.lit(1000.0), mean).alias("fps"))


def histogram_quantile(buckets: DataFrame, q: float, *keys: str) -> DataFrame:
    """The quantile by linear interpolation within cumulative buckets; the last finite bound beyond it; NULL without values."""
    row = buckets.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("le", "n"))).alias("b"))
    rank = F.lit(q) * F.element_at("b", -1)["n"]
    at = F.size(F.filter("b", lambda x: x["n"] < rank))
    here, low = F.get("b", at), F.get("b", at - 1)
    from_le, from_n = F.coalesce(low["le"], F.lit(0.0)), F.coalesce(low["n"], F.lit(0))
    inside = from_le + (here["le"] - from_le) * F.try_divide((rank - from_n).cast("double"), (here["n"] - from_n).cast("double"))
    value = F.when(F.element_at("b", -1)["n"] == 0, F.lit(None)).when(here["le"] == F.lit(float("inf")), from_le).otherwise(inside)
    return row.select(*keys, value.alias("quantile"))
