"""Scalar rules as Column expressions: bins, tags, lookups and texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyword_tag(text: Column, keyword: str, hit: str, miss: str) -> Column:
    """``hit`` where the lower-cased text contains the keyword anywhere; a null text misses."""
    return F.when(F.coalesce(F.lower(text).contains(keyword.lower()), F.lit(False)), F.lit(hit)).otherwise(F.lit(miss))


def speed_bin(speed: Column, bins: Sequence[float]) -> Column:
    return F.when(speed.isNull(), "unknown").when(speed < bins[0], "stopped").when(speed < bins[1], "slow").otherwise("moving")


def distance_bin(distance: Column, near: float = 20.0, far: float = 40.0) -> Column:
    return F.when(distance < near, "near").when(distance < far, "mid").when(distance.isNotNull(), "far")


def lookup(key: Column, values: Mapping[str, object]) -> Column:
    """The mapped value; NULL where the key is not mapped."""
    if not values:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())]), key)


def lookup_each(keys: Column, values: Mapping[str, str]) -> Column:
    """Each element's mapped value, or the element itself."""
    return F.transform(keys, lambda k: F.coalesce(lookup(k, values), k))


def present(*parts: Column) -> Column:
    """The parts that are not NULL, as an array in their order."""
    return F.filter(F.array(*parts), lambda p: p.isNotNull())


def label_quality(points: Column, visibility: Column, min_points: int, min_visibility: int, det_class: Column | None = None) -> Column:
    """weak beats low_visibility beats ok; only boxes with a class can be weak."""
    weak = points < min_points if det_class is None else det_class.isNotNull() & (points < min_points)
    return F.when(weak, "weak").when(visibility < min_visibility, "low_visibility").otherwise("ok")


def not_ready_reason(has_frame: Column, qc_error: Column, sync_ok: Column, calib_ok: Column) -> Column:
    """The last rule that applies wins: calibration, then timing, then errors, then a missing frame."""
    return (
        F.when(~F.coalesce(calib_ok, F.lit(True)), "calibration_suspect")
        .when(~F.coalesce(sync_ok, F.lit(True)), "out_of_sync")
        .when(F.coalesce(qc_error, F.lit(False)), "camera_qc_error")
        .when(~F.coalesce(has_frame, F.lit(False)), "no_camera_keyframe")
    )


def yolo_line(class_id: Column, x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id, (x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height)


def split_last(name: Column, sep: str = ".") -> tuple[Column, Column]:
    """What stands before and after the last separator."""
    tail = F.substring_index(name, sep, -1)
    return F.substring(name, F.lit(1), F.length(name) - F.length(tail) - len(sep)), tail


def ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    """NULL where the denominator is 0."""
    r = F.try_divide(a.cast("double"), b.cast("double"))
    return r if digits is None else F.round(r, digits)


def letterbox(width: Column, height: Column, side: int) -> dict[str, Column]:
    """Scale and paddings that fit an image into a square of ``side``."""
    scale = F.least(F.lit(float(side)) / height, F.lit(float(side)) / width)
    pad = lambda dim: F.floor((F.lit(side) - F.bround(dim * scale)) / 2).cast("int")
    return {"scale": scale, "pad_x": pad(width), "pad_y": pad(height)}


def unletterbox(x: Column, pad: Column, scale: Column, top: Column) -> Column:
    return F.least(F.greatest((x - pad) / scale, F.lit(0.0)), top.cast("double"))


def even_positions(n: Column, k: int) -> Column:
    """``k`` evenly spaced positions from 0 to ``n - 1``, rounded half to even, without repeats."""
    if k == 1:
        return F.array(F.lit(0).cast("long"))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (n - 1) / F.lit(k - 1)).cast("long")))


def nearest_level(value: Column, levels: Sequence[float]) -> Column:
    """The place, from 0, of the level nearest to a value; the first of two as near; NULL for NULL."""
    away = F.array(*[F.abs(value - F.lit(float(x))) for x in levels])
    return F.when(value.isNotNull(), (F.array_position(away, F.array_min(away)) - 1).cast("int"))
