"""Timing of frames: steps, speeds, gaps, duplicates, and the grid of expected keyframes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import lookup


def stream_window(*order: str):
    """Frames of one channel of one scene in time order; the token settles ties."""
    return Window.partitionBy("scene_name", "channel").orderBy("timestamp", *(order or ("frame_token",)))


def with_motion(frames: DataFrame) -> DataFrame:
    """Adds the step from the frame before in ms and the ego speed over it; NULL for a first frame, and speed for a step of 0."""
    w = stream_window()
    step = (F.col("timestamp") - F.lag("timestamp").over(w)) / F.lit(1000.0)
    moved = F.hypot(F.col("ego_x") - F.lag("ego_x").over(w), F.col("ego_y") - F.lag("ego_y").over(w))
    return frames.withColumns({"dt_prev_ms": step, "_moved_m": moved}).withColumn("ego_speed_mps", F.try_divide("_moved_m", F.col("dt_prev_ms") / 1000)).drop("_moved_m")


def backfilled(value: Column, *keys: str, order: Sequence[str]) -> Column:
    """The value, or the next one in order that is not NULL."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return F.first(value, ignorenulls=True).over(w)


def duplicates(frames: DataFrame, *keys: str, keep_by: str = "frame_token") -> DataFrame:
    """Every row after the first of its keys."""
    return frames.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(keep_by))).where("_nth > 1").drop("_nth")


def expected_ms(key: Column, nominal_hz: Mapping[str, float]) -> Column:
    return F.lit(1000.0) / lookup(key, nominal_hz)


def gaps(frames: DataFrame, expected: Column, factor: float) -> DataFrame:
    """Frames whose step exceeds ``factor`` expected steps, with about how many frames are missing."""
    return frames.withColumn("expected_ms", expected).where(F.col("dt_prev_ms") > F.col("expected_ms") * factor).withColumn("dropped", (F.bround(F.col("dt_prev_ms") / F.col("expected_ms")) - 1).cast("long"))


def sync_grid(frames: DataFrame, channels: Sequence[str], reference: str) -> DataFrame:
    """Every sample by every enabled channel, with the offset of its keyframe from the reference channel's.

    One aggregation gathers a sample's keyframes of all channels; no join is
    needed to find the missing ones.  The reference may be missing too: then
    the offset is NULL.  Of several keyframes the earliest counts.
    """
    key = F.col("is_key_frame") & F.col("channel").isin(list(channels) + [reference])
    at = lambda c: F.min(F.when(key & (F.col("channel") == c), F.col("timestamp")))
    wide = frames.groupBy("sample_token", "scene_name").agg(at(reference).alias("ref_timestamp"), *[at(c).alias(f"_at_{i}") for i, c in enumerate(channels)])
    cells = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"_at_{i}").alias("timestamp")) for i, c in enumerate(channels)])
    return wide.select("sample_token", "scene_name", "ref_timestamp", F.inline(cells)).select(
        "sample_token",
        "scene_name",
        "channel",
        "timestamp",
        "ref_timestamp",
        F.col("timestamp").isNotNull().alias("has_keyframe"),
        ((F.col("timestamp") - F.col("ref_timestamp")) / F.lit(1000.0)).alias("offset_ms"),
    )


def nearest(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, right_token: str) -> DataFrame:
    """Each left row with the right row of its key that is nearest in time, the least token on ties; NULL where the key has none.

    Both sides stand in one line by time, and a row looks back and ahead for
    the next right row: no pairs are made, and equal left rows stay apart.
    """
    of = lambda c: F.col(f"row.{c}")
    none = F.lit(None).cast(right.schema[right_token].dataType)
    token = right.groupBy(F.col(key).alias("key"), F.col(right_time).alias("time")).agg(F.min(right_token).alias("token")).where("time IS NOT NULL")
    line = left.select(F.struct(*left.columns).alias("row")).select(of(key).alias("key"), of(left_time).alias("time"), none.alias("token"), "row")
    line = line.unionByName(token.select("key", "time", "token", F.lit(None).cast(line.schema["row"].dataType).alias("row")))
    mark, w = F.when(F.col("row").isNull(), F.struct("time", "token")), Window.partitionBy("key").orderBy("time")
    before = F.last(mark, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first(mark, ignorenulls=True).over(w.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    near = line.withColumns({"before": before, "after": after}).where("row IS NOT NULL")
    rank = lambda c: F.when(F.col(c).isNotNull() & F.col("time").isNotNull(), F.struct(F.abs(F.col("time") - F.col(f"{c}.time")).alias("gap"), F.col(f"{c}.token").alias("token")))
    return near.withColumn("best", F.least(rank("before"), rank("after"))).select(*[of(c).alias(c) for c in left.columns], F.col("best.token").alias("nearest_token"), F.col("best.gap").alias("nearest_gap"))
