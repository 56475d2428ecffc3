"""Rigid-body and camera geometry as Column expressions.

Vectors are triples of Columns and quaternions arrays ``[w, x, y, z]``, so the
optimizer sees plain arithmetic and compiles it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]

#: Corners of a box as signs along length, width, height: front face, then back.
CORNER_SIGNS = [(1, 1, 1), (1, -1, 1), (1, -1, -1), (1, 1, -1), (-1, 1, 1), (-1, -1, 1), (-1, -1, -1), (-1, 1, -1)]


def vec(array: Column) -> Vec:
    return F.get(array, F.lit(0)), F.get(array, F.lit(1)), F.get(array, F.lit(2))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rotation(q: Column) -> Column:
    """The 3x3 rotation of a quaternion, normalised first, as an array of nine by rows."""

    def unit(n: Column) -> Column:
        w, x, y, z = (F.get(q, F.lit(i)) / n for i in range(4))
        return F.array(
            1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
            2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
            2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
        )

    norm = F.sqrt(sum((F.get(q, F.lit(i)) * F.get(q, F.lit(i)) for i in range(1, 4)), F.get(q, F.lit(0)) * F.get(q, F.lit(0))))
    return let(norm, unit)


def rotate(r: Column, v: Vec) -> Vec:
    m = [F.get(r, F.lit(i)) for i in range(9)]
    return tuple(m[3 * i] * v[0] + m[3 * i + 1] * v[1] + m[3 * i + 2] * v[2] for i in range(3))  # type: ignore[return-value]


def unrotate(r: Column, v: Vec) -> Vec:
    m = [F.get(r, F.lit(i)) for i in range(9)]
    return tuple(m[i] * v[0] + m[3 + i] * v[1] + m[6 + i] * v[2] for i in range(3))  # type: ignore[return-value]


def minus(a: Vec, b: Vec) -> Vec:
    return a[0] - b[0], a[1] - b[1], a[2] - b[2]


def plus(a: Vec, b: Vec) -> Vec:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def into(p: Vec, t: Vec, r: Column) -> Vec:
    """A point given in the outer frame, in the frame at ``t`` with rotation ``r``."""
    return unrotate(r, minus(p, t))


def out_of(p: Vec, t: Vec, r: Column) -> Vec:
    return plus(rotate(r, p), t)


def global_to_sensor(p: Vec, ego_t: Vec, ego_r: Column, sensor_t: Vec, sensor_r: Column) -> Vec:
    return into(into(p, ego_t, ego_r), sensor_t, sensor_r)


def sensor_to_global(p: Vec, ego_t: Vec, ego_r: Column, sensor_t: Vec, sensor_r: Column) -> Vec:
    return out_of(out_of(p, sensor_t, sensor_r), ego_t, ego_r)


def pixel(k: Column, p: Vec) -> tuple[Column, Column]:
    """Pinhole projection with a 3x3 intrinsic given as nested arrays; NULL at depth 0."""
    row = [[F.get(F.get(k, F.lit(i)), F.lit(j)) for j in range(3)] for i in range(3)]
    u, v, w = (row[i][0] * p[0] + row[i][1] * p[1] + row[i][2] * p[2] for i in range(3))
    return F.try_divide(u, w), F.try_divide(v, w)


def box_corners(center: Vec, size: Vec, r: Column) -> Column:
    """The eight corners of a box of ``size`` (width, length, height) as structs x, y, z."""
    w, l, h = size  # noqa: E741
    signs = F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b"), F.lit(float(c)).alias("c")) for a, b, c in CORNER_SIGNS])

    def corner(s: Column) -> Column:
        x, y, z = plus(rotate(r, (s["a"] * l / 2, s["b"] * w / 2, s["c"] * h / 2)), center)
        return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))

    return F.transform(signs, corner)


def map_points(points: Column, to: Callable[[Vec], Vec]) -> Column:
    def one(p: Column) -> Column:
        x, y, z = to((p["x"], p["y"], p["z"]))
        return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))

    return F.transform(points, one)


def box_to_2d(corners: Column, k: Column, width: Column, height: Column, min_depth: float = 0.1) -> Column:
    """The clipped image box of the corners in front of the camera, as a struct; NULL if none is, or all is outside."""

    def projected(front: Column) -> Column:
        def uv(p: Column) -> Column:
            u, v = pixel(k, (p["x"], p["y"], p["z"]))
            return F.struct(u.alias("u"), v.alias("v"))

        return let(F.transform(front, uv), boxed)

    def boxed(uv: Column) -> Column:
        us, vs = F.transform(uv, lambda p: p["u"]), F.transform(uv, lambda p: p["v"])
        x1, x2, y1, y2 = F.array_min(us), F.array_max(us), F.array_min(vs), F.array_max(vs)
        clip = lambda a, top: F.least(F.greatest(a, F.lit(0.0)), top)
        inside = (x2 > 0) & (y2 > 0) & (x1 < width) & (y1 < height)
        return F.when(inside, F.struct(clip(x1, width).alias("x1"), clip(y1, height).alias("y1"), clip(x2, width).alias("x2"), clip(y2, height).alias("y2")))

    return let(F.filter(corners, lambda p: p["z"] > min_depth), projected)


def in_image(p: Vec, k: Column, width: Column, height: Column, min_depth: float = 0.5) -> Column:
    u, v = pixel(k, p)
    return F.coalesce((p[2] > min_depth) & (u >= 0) & (u < width) & (v >= 0) & (v < height), F.lit(False))


def yaw_of(q: Column) -> Column:
    w, x, y, z = (F.get(q, F.lit(i)) for i in range(4))
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def quat_of_yaw(yaw: Column) -> Column:
    return F.array(F.cos(yaw / 2), F.lit(0.0), F.lit(0.0), F.sin(yaw / 2))


def wrap(angle: Column) -> Column:
    """Into [-pi, pi)."""
    return F.pmod(angle + F.pi(), 2 * F.pi()) - F.pi()


def yaw_gap(a: Column, b: Column) -> Column:
    """The angle between two headings whose direction does not matter."""
    d = F.pmod(a - b, F.pi())
    return F.least(d, F.pi() - d)
