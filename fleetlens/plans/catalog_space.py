"""Queries for geometry, fusion, detection post-processing and evaluation."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from ..operators import detect, fusion, labels2d, lifting, matching
from ..params import Curation, Fusion
from ..sources import decode
from .adapters import ANNOTATIONS, LABELS_QC, POINTS, annotations, points, read
from .catalog_metrics import labels_qc
from .registry import query

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _r(c, n=6):
    """Rounded; -0.0 becomes 0.0."""
    return F.round(c, n) + F.lit(0.0)


# A yaw rotation by l_quantity / 10 about z, as the quaternion [cos(q/20), 0, 0, sin(q/20)].
@query(
    "WITH " + ANNOTATIONS + ", r AS (SELECT annotation_token, quantity / 10 AS a, size[1] AS x, size[2] AS y, size[3] AS z FROM annotations) "
    "SELECT annotation_token, round(cos(a) * x - sin(a) * y, 6) + 0.0 AS x, round(sin(a) * x + cos(a) * y, 6) + 0.0 AS y, round(z, 6) AS z FROM r"
)
def geo_quat_rotate(spark, d):
    a = annotations(spark, d).withColumn("r", G.rotation(F.col("rotation")))
    x, y, z = G.rotate(F.col("r"), G.vec(F.col("size")))
    return a.select("annotation_token", _r(x).alias("x"), _r(y).alias("y"), F.round(z, 6).alias("z"))


_CORNERS = ANNOTATIONS + """,
signs AS (SELECT * FROM (VALUES (0, 1, 1, 1), (1, 1, -1, 1), (2, 1, -1, -1), (3, 1, 1, -1), (4, -1, 1, 1), (5, -1, -1, 1), (6, -1, -1, -1), (7, -1, 1, -1)) s(k, sa, sb, sc)),
corners AS (
  SELECT annotation_token, k, cos(quantity / 10) * (sa * size[2] / 2) - sin(quantity / 10) * (sb * size[1] / 2) + translation[1] AS x,
         sin(quantity / 10) * (sa * size[2] / 2) + cos(quantity / 10) * (sb * size[1] / 2) + translation[2] AS y, sc * size[3] / 2 + translation[3] AS z
  FROM annotations, signs)"""


@query("WITH " + _CORNERS + " SELECT annotation_token, " + ", ".join(f"round({f}({c}), 5) + 0.0 AS {f}_{c}" for c in "xyz" for f in ("min", "max")) + " FROM corners GROUP BY 1")
def geo_box_corners(spark, d):
    """The extent of each box over its eight corners."""
    a = annotations(spark, d)
    corners = G.let(G.rotation(F.col("rotation")), lambda r: G.box_corners(G.vec(F.col("translation")), G.vec(F.col("size")), r))
    c = a.select("annotation_token", F.inline(corners))
    return c.groupBy("annotation_token").agg(*[_r(getattr(F, f)(n), 5).alias(f"{f}_{n}") for n in "xyz" for f in ("min", "max")])


# A camera at the origin that looks along x: sensor x = -y, sensor y = -z, depth = x.
CAM_Q, K = [0.5, -0.5, 0.5, -0.5], [[1266.4, 0.0, 816.3], [0.0, 1266.4, 491.5], [0.0, 0.0, 1.0]]
_CAMERA = _CORNERS + """,
seen AS (SELECT annotation_token, (1266.4 * (-y) + 816.3 * x) / x AS u, (1266.4 * (-z) + 491.5 * x) / x AS v FROM corners WHERE x > 0.1),
ext AS (SELECT annotation_token, min(u) AS x1, max(u) AS x2, min(v) AS y1, max(v) AS y2 FROM seen GROUP BY 1),
boxes AS (
  SELECT annotation_token, greatest(x1, 0) AS x1, greatest(y1, 0) AS y1, least(x2, 1600) AS x2, least(y2, 900) AS y2 FROM ext WHERE x2 > 0 AND y2 > 0 AND x1 < 1600 AND y1 < 900)"""


def camera(spark):
    arr = lambda v: F.array(*map(F.lit, v))
    return spark.range(1).select(
        F.lit("cam").alias("frame_token"), arr([0.0, 0.0, 0.0]).alias("ego_translation"), arr([1.0, 0.0, 0.0, 0.0]).alias("ego_rotation"), arr([0.0, 0.0, 0.0]).alias("sensor_translation"),
        arr(CAM_Q).alias("sensor_rotation"), F.array(*map(arr, K)).alias("camera_intrinsic"), F.lit(1600).alias("width"), F.lit(900).alias("height"),
    )


def projected(spark, d):
    """Every annotation before the same camera."""
    boxes = labels_qc(spark, d)
    cams = boxes.select("sample_token").distinct().crossJoin(F.broadcast(labels2d.camera_matrices(camera(spark))))  # one row
    return cams, boxes


@query("WITH " + _CAMERA + " SELECT annotation_token, round(x1, 3) AS x1, round(y1, 3) AS y1, round(x2, 3) AS x2, round(y2, 3) AS y2 FROM boxes")
def geo_project_2d(spark, d):
    cams, boxes = projected(spark, d)
    rows = labels2d.project_boxes(cams, boxes, Curation()).where("box IS NOT NULL")
    return rows.select("annotation_token", *[F.round(F.col(f"box.{c}"), 3).alias(c) for c in ("x1", "y1", "x2", "y2")])


_DROPS = _CAMERA + ", " + LABELS_QC + """,
labelled AS (
  SELECT q.*, b.x1, b.y1, b.x2, b.y2, CASE WHEN label_quality = 'weak' THEN 'weak' WHEN label_quality = 'low_visibility' THEN 'low_visibility' WHEN b.x1 IS NULL THEN 'outside' WHEN least(b.x2 - b.x1, b.y2 - b.y1) < 6 THEN 'too_small' END AS drop_reason
  FROM labels_qc q LEFT JOIN boxes b ON q.annotation_token = b.annotation_token)"""


@query("WITH " + _DROPS + " SELECT annotation_token, det_class, (CASE det_class WHEN 'car' THEN 0 WHEN 'pedestrian' THEN 7 END)::INTEGER AS class_id, round(x1, 3) AS x1, round(y2, 3) AS y2, "
       "round(sqrt(translation[1] ** 2 + translation[2] ** 2), 6) AS distance_m, CASE WHEN sqrt(translation[1] ** 2 + translation[2] ** 2) < 20 THEN 'near' WHEN sqrt(translation[1] ** 2 + translation[2] ** 2) < 40 THEN 'mid' ELSE 'far' END AS distance_bin "
       "FROM labelled WHERE drop_reason IS NULL AND det_class IS NOT NULL")  # fmt: skip
def geo_labels2d(spark, d):
    cams, boxes = projected(spark, d)
    return labels2d.labels_2d(cams, boxes, Curation()).select("annotation_token", "det_class", "class_id", F.round("x1", 3).alias("x1"), F.round("y2", 3).alias("y2"), F.round("distance_m", 6).alias("distance_m"), "distance_bin")


@query("WITH " + _DROPS + " SELECT drop_reason, count(*) AS n FROM labelled WHERE drop_reason IS NOT NULL GROUP BY 1")
def agg_drop_reasons(spark, d):
    cams, boxes = projected(spark, d)
    return labels2d.drop_counts(labels2d.project_boxes(cams, boxes, Curation(), only_ok=True))


@query("WITH " + ANNOTATIONS + ", y AS (SELECT annotation_token, quantity / 10 AS a FROM annotations) SELECT annotation_token, round(cos(a), 6) + 0.0 AS cosine, round(sin(a), 6) + 0.0 AS sine, round(least((a - 1) - pi() * floor((a - 1) / pi()), pi() - ((a - 1) - pi() * floor((a - 1) / pi()))), 6) AS gap FROM y")
def geo_yaw_roundtrip(spark, d):
    yaw = G.yaw_of(F.col("rotation"))
    a = annotations(spark, d).select("annotation_token", G.wrap(yaw).alias("yaw"))
    back = G.yaw_of(G.quat_of_yaw(F.col("yaw")))
    return a.select("annotation_token", _r(F.cos(back)).alias("cosine"), _r(F.sin(back)).alias("sine"), F.round(G.yaw_gap(F.col("yaw"), F.lit(1.0)), 6).alias("gap"))


@query("SELECT o_orderkey, round(least(640.0::DOUBLE / h, 640.0::DOUBLE / w), 9) AS scale, floor((640 - round_even(w * least(640.0::DOUBLE / h, 640.0::DOUBLE / w), 0)) / 2)::INTEGER AS pad_x, floor((640 - round_even(h * least(640.0::DOUBLE / h, 640.0::DOUBLE / w), 0)) / 2)::INTEGER AS pad_y "
       "FROM (SELECT o_orderkey, (o_orderkey % 1500 + 100)::DOUBLE AS w, (o_custkey % 900 + 100)::DOUBLE AS h FROM orders)")  # fmt: skip
def det_letterbox(spark, d):
    w, h = (F.col("o_orderkey") % 1500 + 100).cast("double"), (F.col("o_custkey") % 900 + 100).cast("double")
    b = S.letterbox(w, h, 640)
    return read(spark, d, "orders").select("o_orderkey", F.round(b["scale"], 9).alias("scale"), b["pad_x"].alias("pad_x"), b["pad_y"].alias("pad_y"))


@query("WITH e AS (SELECT vec_id, list_transform(embedding[5:14], lambda v: v::DOUBLE) AS scores, embedding[1]::DOUBLE AS cx, embedding[2]::DOUBLE AS cy, abs(embedding[3])::DOUBLE AS w FROM embeddings) "
       "SELECT vec_id, 'c' || (list_position(scores, list_max(scores)) - 1) AS cls, round(list_max(scores), 6) AS score, round(cx - w / 2, 6) + 0.0 AS x1, round(cy + w / 2, 6) + 0.0 AS y2 FROM e WHERE list_max(scores) >= 0.15")  # fmt: skip
def det_decode(spark, d):
    v = lambda i: F.get("embedding", F.lit(i)).cast("double")
    rows = read(spark, d, "embeddings").select("vec_id", v(0).alias("cx"), v(1).alias("cy"), F.abs(v(2)).alias("w"), F.abs(v(2)).alias("h"), F.transform(F.slice("embedding", 5, 10), lambda x: x.cast("double")).alias("scores"))
    return detect.decode(rows, [f"c{i}" for i in range(10)], 0.15).select("vec_id", "cls", F.round("score", 6).alias("score"), _r(F.col("x1")).alias("x1"), _r(F.col("y2")).alias("y2"))


_NMS_BOXES = POINTS + ", b AS (SELECT frame, (point % 2)::INTEGER AS cls, point AS p, round(intensity, 1) AS score, x - 4 AS x1, y - 3 AS y1, x + 4 AS x2, y + 3 AS y2 FROM points)"


@query("WITH RECURSIVE " + _NMS_BOXES + """,
k AS (SELECT *, row_number() OVER (PARTITION BY frame, cls ORDER BY score DESC, p) AS r FROM b),
f AS (
  SELECT frame, cls, r, [struct_pack(p := p, x1 := x1, y1 := y1, x2 := x2, y2 := y2)] AS kept FROM k WHERE r = 1
  UNION ALL
  SELECT k.frame, k.cls, k.r, CASE WHEN len(list_filter(f.kept, lambda o:
      greatest(least(o.x2, k.x2) - greatest(o.x1, k.x1), 0) * greatest(least(o.y2, k.y2) - greatest(o.y1, k.y1), 0)
      / ((o.x2 - o.x1) * (o.y2 - o.y1) + (k.x2 - k.x1) * (k.y2 - k.y1) - greatest(least(o.x2, k.x2) - greatest(o.x1, k.x1), 0) * greatest(least(o.y2, k.y2) - greatest(o.y1, k.y1), 0) + 1e-9) > 0.3)) > 0
    THEN f.kept ELSE list_append(f.kept, struct_pack(p := k.p, x1 := k.x1, y1 := k.y1, x2 := k.x2, y2 := k.y2)) END
  FROM f JOIN k ON f.frame = k.frame AND f.cls = k.cls AND k.r = f.r + 1)
SELECT frame, cls, unnest(list_transform(kept, lambda o: o.p))::BIGINT AS p FROM f WHERE r = 8""")  # fmt: skip
def det_nms(spark, d):
    b = points(spark, d).select("frame", (F.col("point") % 2).cast("int").alias("cls"), F.col("point").alias("p"), F.round("intensity", 1).alias("score"), (F.col("x") - 4).alias("x1"), (F.col("y") - 3).alias("y1"), (F.col("x") + 4).alias("x2"), (F.col("y") + 3).alias("y2"))
    return detect.nms(b, 0.3).select("frame", "cls", "p")


@query("WITH " + POINTS + " SELECT frame, round(coalesce(quantile_cont(z, 0.05) FILTER (WHERE sqrt(x * x + y * y) <= 2), quantile_cont(z, 0.05), 0), 6) + 0.0 AS ground FROM points GROUP BY 1")
def fuse_ground(spark, d):
    return fusion.ground_height(points(spark, d), "frame", radius=2.0).select("frame", _r(F.col("ground")).alias("ground"))


_DEPTHS = POINTS + """, dp AS (SELECT frame, cls, point, sqrt(x * x + y * y) AS depth, 1.0 + cls AS expected FROM points),
dj AS (SELECT *, CASE WHEN depth - lag(depth) OVER (PARTITION BY frame ORDER BY depth, point) > 0.8 THEN 1 ELSE 0 END AS jump FROM dp),
di AS (SELECT *, sum(jump) OVER (PARTITION BY frame ORDER BY depth, point ROWS UNBOUNDED PRECEDING) AS island FROM dj),
dg AS (SELECT frame, island, count(*) AS n, quantile_cont(depth, 0.1) AS near, min(depth) AS first, any_value(expected) AS z FROM di GROUP BY ALL),
ds AS (SELECT *, n * exp(-0.5 * pow((near - z) / (0.2 * z), 2)) AS score FROM dg),
best AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY score DESC, first, island) AS r FROM ds)"""


def depths(spark, d):
    return points(spark, d).select("frame", "cls", "point", "x", "y", F.hypot("x", "y").alias("depth"), (F.col("cls") + 1.0).alias("expected"))


@query("WITH " + _DEPTHS + " SELECT frame, island::BIGINT AS island, n, round(near, 6) AS near, round(score, 6) AS score FROM best WHERE r = 1")
def fuse_cluster(spark, d):
    c = fusion.dominant_cluster(depths(spark, d), "frame", "depth", "expected", Fusion(), "point")
    return c.select("frame", "island", "n", F.round("near", 6).alias("near"), F.round("score", 6).alias("score"))


@query("WITH " + POINTS + """, s AS (SELECT frame, var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS c, avg(x) AS mx, avg(y) AS my, count(*) AS n FROM points GROUP BY 1),
t AS (SELECT *, 0.5 * atan2(2 * c, a - b) AS theta, (a + b) / 2 AS mid, sqrt(pow((a - b) / 2, 2) + c * c) AS half FROM s),
e AS (SELECT p.frame, quantile_cont((x - mx) * cos(theta) + (y - my) * sin(theta), 0.95) - quantile_cont((x - mx) * cos(theta) + (y - my) * sin(theta), 0.05) AS extent FROM points p JOIN t ON p.frame = t.frame GROUP BY 1),
f AS (SELECT t.*, theta + CASE WHEN abs(extent - 2) < abs(extent - 5) THEN pi() / 2 ELSE 0 END AS turned FROM t JOIN e ON t.frame = e.frame),
w AS (SELECT *, (turned + pi()) - 2 * pi() * floor((turned + pi()) / (2 * pi())) - pi() AS wrapped FROM f)
SELECT frame, round(CASE WHEN n < 10 OR mid + half < 2 * (mid - half) THEN 0.0 WHEN wrapped > pi() / 2 THEN wrapped - pi() WHEN wrapped <= -pi() / 2 THEN wrapped + pi() ELSE wrapped END, 5) + 0.0 AS yaw FROM w""")  # fmt: skip
def fuse_yaw_pca(spark, d):
    p = points(spark, d).withColumns({"w": F.lit(2.0), "l": F.lit(5.0)})
    return fusion.yaw_by_pca(p, "frame", "w", "l").select("frame", _r(F.col("yaw"), 5).alias("yaw"))


@query("WITH " + POINTS + """, m AS (SELECT frame, avg(x) AS mx, avg(y) AS my FROM points GROUP BY 1),
r AS (SELECT frame, (mx + 1.5) / sqrt(pow(mx + 1.5, 2) + pow(my - 0.5, 2)) AS rx, (my - 0.5) / sqrt(pow(mx + 1.5, 2) + pow(my - 0.5, 2)) AS ry FROM m),
s AS (SELECT p.frame, any_value(rx) AS rx, any_value(ry) AS ry, quantile_cont((x + 1.5) * rx + (y - 0.5) * ry, 0.1) AS near, median((y - 0.5) * rx - (x + 1.5) * ry) AS side FROM points p JOIN r ON p.frame = r.frame GROUP BY 1),
e AS (SELECT *, near + abs(cos(0.3 - atan2(ry, rx))) * 4.5 / 2 + abs(sin(0.3 - atan2(ry, rx))) * 1.9 / 2 AS reach FROM s)
SELECT frame, round(-1.5 + rx * reach - ry * side, 5) + 0.0 AS cx, round(0.5 + ry * reach + rx * side, 5) + 0.0 AS cy, 16::BIGINT AS n FROM e""")  # fmt: skip
def fuse_lift(spark, d):
    p = points(spark, d).withColumns({"cam_x": F.lit(-1.5), "cam_y": F.lit(0.5), "w": F.lit(1.9), "l": F.lit(4.5), "yaw": F.lit(0.3)})
    return fusion.place_by_points(p, "frame", Fusion()).select("frame", _r(F.col("cx"), 5).alias("cx"), _r(F.col("cy"), 5).alias("cy"), "n")


@query("SELECT vec_id, round(embedding[1]::DOUBLE * (5.0 + label) / 2, 6) + 0.0 AS x, round(5.0 + label + (4.5 + 1.9) / 4, 6) AS reach, round(abs(embedding[2]::DOUBLE) * 0.5, 6) AS score FROM embeddings")
def fuse_mono(spark, d):
    v = lambda i: F.get("embedding", F.lit(i)).cast("double")
    one = {"v": F.lit(0.0), "fx": F.lit(2.0), "fy": F.lit(2.0), "px": F.lit(0.0), "py": F.lit(0.0), "w": F.lit(1.9), "l": F.lit(4.5)}
    b = read(spark, d, "embeddings").select("vec_id", v(0).alias("u"), (F.col("label") + 5.0).alias("depth"), F.abs(v(1)).alias("score")).withColumns(one)
    return fusion.place_by_camera(b, Fusion()).select("vec_id", _r(F.get("cam_point", F.lit(0))).alias("x"), F.round("reach", 6).alias("reach"), F.round("score", 6).alias("score"))


@query("SELECT vec_id, label FROM embeddings WHERE abs(embedding[1]::DOUBLE) * 100 <= CASE label WHEN 0 THEN 20.0 WHEN 1 THEN 5.0 ELSE 10.0 END")
def fuse_range_filter(spark, d):
    e = read(spark, d, "embeddings").select("vec_id", "label", F.col("label").cast("string").alias("cls"), (F.abs(F.get("embedding", F.lit(0)).cast("double")) * 100).alias("distance"))
    return fusion.in_range(e, {"0": 20.0, "1": 5.0}, 10.0).select("vec_id", "label")


THRESHOLDS = (0.5, 1.0, 2.0, 4.0)
#: The first eight points of a frame are detections, the others truths; class by parity.
_MATCH = POINTS + """,
pr AS (SELECT frame AS sample, point % 2 AS cls, point::BIGINT AS p, round(intensity, 0) AS score, x, y FROM points WHERE point < 8),
gt AS (SELECT frame AS sample, point % 2 AS cls, point::BIGINT AS g, x, y FROM points WHERE point >= 8),
rk AS (SELECT *, row_number() OVER (PARTITION BY sample, cls ORDER BY score DESC, p) AS r FROM pr),
th AS (SELECT unnest([0.5, 1.0, 2.0, 4.0])::DOUBLE AS thr),
gl AS (SELECT sample, cls, list(struct_pack(g := g, x := x, y := y)) AS gs FROM gt GROUP BY ALL),
fold AS (
  SELECT rk.sample, rk.cls, thr, 0::BIGINT AS r, []::STRUCT(p BIGINT, g BIGINT, d DOUBLE)[] AS taken FROM rk, th WHERE r = 1
  UNION ALL
  SELECT f.sample, f.cls, f.thr, rk.r, list_concat(f.taken, list_transform(
      list_sort(list_transform(list_filter(gl.gs, lambda q: sqrt(pow(q.x - rk.x, 2) + pow(q.y - rk.y, 2)) < f.thr AND NOT list_contains(list_transform(f.taken, lambda t: t.g), q.g)),
        lambda q: struct_pack(d := sqrt(pow(q.x - rk.x, 2) + pow(q.y - rk.y, 2)), g := q.g)))[1:1],
      lambda b: struct_pack(p := rk.p, g := b.g, d := b.d)))
  FROM fold f JOIN rk ON f.sample = rk.sample AND f.cls = rk.cls AND rk.r = f.r + 1 JOIN gl ON gl.sample = f.sample AND gl.cls = f.cls),
done AS (SELECT sample, cls, thr, unnest(taken) AS t FROM fold WHERE r = 4),
matched AS (SELECT pr.sample, pr.cls, th.thr, pr.p, pr.score, (t).g AS g, (t).d AS d FROM pr CROSS JOIN th LEFT JOIN done ON done.sample = pr.sample AND done.cls = pr.cls AND done.thr = th.thr AND (t).p = pr.p)"""


def detections(spark, d):
    p = points(spark, d).select(F.col("frame").alias("sample"), (F.col("point") % 2).alias("cls"), "point", F.round("intensity", 0).alias("score"), "x", "y")
    return p.where("point < 8").withColumn("p", F.col("point").cast("long")), p.where("point >= 8").withColumn("g", F.col("point").cast("long"))


def matched(spark, d):
    return matching.match(*detections(spark, d), THRESHOLDS)


@query("WITH RECURSIVE " + _MATCH + " SELECT sample, cls::INTEGER AS cls, thr, p, g, round(d, 6) AS d FROM matched")
def eval_match(spark, d):
    return matched(spark, d).select("sample", "cls", "thr", "p", "g", F.round("d", 6).alias("d"))


_AP = _MATCH + """,
ngt AS (SELECT cls, count(*) AS n_gt FROM gt GROUP BY 1),
c0 AS (SELECT m.cls, thr, n_gt, score, sample * 100 + p AS ord, (g IS NOT NULL)::INT AS tp FROM matched m JOIN ngt ON m.cls = ngt.cls),
c1 AS (SELECT *, sum(tp) OVER (PARTITION BY cls, thr ORDER BY score DESC, ord ROWS UNBOUNDED PRECEDING) / n_gt::DOUBLE AS rec,
              sum(tp) OVER (PARTITION BY cls, thr ORDER BY score DESC, ord ROWS UNBOUNDED PRECEDING) / (row_number() OVER (PARTITION BY cls, thr ORDER BY score DESC, ord))::DOUBLE AS prec,
              row_number() OVER (PARTITION BY cls, thr ORDER BY score DESC, ord) AS n FROM c0),
grid AS (SELECT DISTINCT cls, thr, i, i / 100.0::DOUBLE AS x FROM c0, range(0, 101) r(i)),
lo AS (SELECT g.cls, g.thr, i, arg_max(rec, n) AS r0, arg_max(prec, n) AS p0 FROM grid g JOIN c1 ON g.cls = c1.cls AND g.thr = c1.thr AND rec <= x GROUP BY ALL),
hi AS (SELECT g.cls, g.thr, i, arg_min(rec, n) AS r1, arg_min(prec, n) AS p1 FROM grid g JOIN c1 ON g.cls = c1.cls AND g.thr = c1.thr AND rec > x GROUP BY ALL),
ends AS (SELECT cls, thr, max(rec) AS top, arg_min(prec, n) AS pf, arg_max(prec, n) AS pl FROM c1 GROUP BY ALL),
v AS (SELECT g.*, top, CASE WHEN p0 IS NULL THEN pf WHEN p1 IS NULL THEN CASE WHEN x = top THEN pl ELSE 0 END ELSE p0 + (p1 - p0) * (x - r0) / (r1 - r0) END AS val
      FROM grid g JOIN ends e ON g.cls = e.cls AND g.thr = e.thr LEFT JOIN lo ON lo.cls = g.cls AND lo.thr = g.thr AND lo.i = g.i LEFT JOIN hi ON hi.cls = g.cls AND hi.thr = g.thr AND hi.i = g.i),
env AS (SELECT *, CASE WHEN x > top + 1e-9 THEN 0 ELSE max(val) OVER (PARTITION BY cls, thr ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS e FROM v),
ap AS (SELECT cls, thr, avg(greatest(e - 0.1::DOUBLE, 0)) / 0.9::DOUBLE AS ap FROM env WHERE i > 10 GROUP BY ALL)"""


def ap_table(spark, d):
    m = matched(spark, d).withColumns({"tp": F.col("g").isNotNull(), "ord": F.col("sample") * 100 + F.col("p")})
    thr = F.explode(F.array(*[F.lit(t) for t in THRESHOLDS]))
    n = detections(spark, d)[1].groupBy("cls").agg(F.count(F.lit(1)).alias("n_gt")).withColumn("thr", thr)
    return matching.average_precision(m, n, order="ord")


@query("WITH RECURSIVE " + _AP + " SELECT ap.cls::INTEGER AS cls, thr, n_gt, round(ap, 8) AS ap FROM ap JOIN ngt ON ap.cls = ngt.cls")
def eval_ap(spark, d):
    return ap_table(spark, d).select("cls", "thr", "n_gt", F.round("ap", 8).alias("ap"))


_ERRORS = _AP + """,
err AS (SELECT cls, avg(d) AS ate, avg(1 - 1.0 / (1 + 0.1 * (p % 4)) ) AS ase, avg(least((p * 0.2 - g * 0.1) - pi() * floor((p * 0.2 - g * 0.1) / pi()), pi() - ((p * 0.2 - g * 0.1) - pi() * floor((p * 0.2 - g * 0.1) / pi())))) AS aoe
  FROM matched WHERE thr = 2.0 AND g IS NOT NULL GROUP BY 1),
per AS (SELECT cls, avg(ap) AS ap FROM ap GROUP BY 1),
m AS (SELECT avg(ap) AS map, avg(ate) AS mate, avg(ase) AS mase, avg(aoe) AS maoe FROM per LEFT JOIN err ON per.cls = err.cls)"""


@query("WITH RECURSIVE " + _ERRORS + " SELECT round(map, 6) AS map, round(mate, 6) AS mate, round(mase, 6) AS mase, round(maoe, 6) AS maoe, round((5 * map + (1 - least(1, mate)) + (1 - least(1, mase)) + (1 - least(1, maoe))) / 8, 6) AS nds FROM m")
def eval_nds(spark, d):
    """A detection's size is 1 by 1 by (1 + a tenth per p mod 4), a truth's is 1; yaws follow from the ids."""
    pairs = matched(spark, d).where("thr = 2.0 AND g IS NOT NULL").select(
        "cls", "d", *[F.lit(1.0).alias(c) for c in ("pred_w", "pred_l", "gt_w", "gt_l", "gt_h")], (1 + 0.1 * (F.col("p") % 4)).alias("pred_h"), (F.col("p") * 0.2).alias("pred_yaw"), (F.col("g") * 0.1).alias("gt_yaw")
    )
    r = matching.nds_lite(ap_table(spark, d).select("cls", "thr", "ap"), matching.tp_errors(pairs))
    return r.select(*[F.round(c, 6).alias(c) for c in ("map", "mate", "mase", "maoe", "nds")])


#: The truths of a frame in two halves; every detection is matched in each half anew.
_HALVES = _MATCH.replace("SELECT frame AS sample, point % 2 AS cls, point::BIGINT AS p", "SELECT frame * 2 + h AS sample, point % 2 AS cls, point::BIGINT AS p").replace("FROM points WHERE point < 8", "FROM points, range(0, 2) q(h) WHERE point < 8").replace(
    "SELECT frame AS sample, point % 2 AS cls, point::BIGINT AS g", "SELECT frame * 2 + (point >= 12)::INT AS sample, point % 2 AS cls, point::BIGINT AS g"
)


@query("WITH RECURSIVE " + _HALVES + """, n AS (SELECT sample % 2 AS half, count(*) AS n_gt FROM gt GROUP BY 1), f AS (SELECT sample % 2 AS half, count(*) AS found, avg(d) AS ate FROM matched WHERE thr = 2.0 AND g IS NOT NULL GROUP BY 1)
SELECT CASE n.half WHEN 0 THEN 'first' ELSE 'second' END AS half, n_gt, round(coalesce(found, 0) / n_gt::DOUBLE, 6) AS recall, round(ate, 6) AS ate FROM n LEFT JOIN f ON n.half = f.half""")  # fmt: skip
def eval_recall_by(spark, d):
    p, g = detections(spark, d)
    g = g.withColumn("half", F.when(F.col("g") < 12, "first").otherwise("second"))
    return matching.recall_by(p, g, "half", 2.0).select("half", "n_gt", F.round("recall", 6).alias("recall"), F.round("ate", 6).alias("ate"))


@query("WITH RECURSIVE " + _MATCH + " SELECT gt.sample, count(*) AS missed FROM gt WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.thr = 2.0 AND m.sample = gt.sample AND m.cls = gt.cls AND m.g = gt.g) GROUP BY 1")
def eval_missed(spark, d):
    return matching.missed(matched(spark, d).where("thr = 2.0"), detections(spark, d)[1])


@query("WITH " + POINTS + " SELECT cls, round(avg((intensity > 0)::INT::DOUBLE), 6) AS lidar_share, round(avg(abs(z)), 6) AS mean_ms FROM points GROUP BY 1")
def eval_source_share(spark, d):
    return points(spark, d).groupBy("cls").agg(F.round(F.avg((F.col("intensity") > 0).cast("double")), 6).alias("lidar_share"), F.round(F.avg(F.abs("z")), 6).alias("mean_ms"))


@query("WITH " + POINTS + ", l AS (SELECT 'oracle_2d' AS mode, 'oracle_2d/' || frame || '-' || point AS box_id, frame, 1.0::DOUBLE AS score, x, y FROM points WHERE point < 8), "
       "d AS (SELECT 'detector' AS mode, 'detector/' || frame || '/' || row_number() OVER (PARTITION BY frame ORDER BY score DESC, x, y) AS box_id, frame, score, x, y FROM (SELECT *, round(intensity, 0) + 0.0 AS score FROM points) WHERE point >= 8 AND score >= 0) "
       "SELECT mode, box_id, frame::VARCHAR AS frame_token, score, round(x, 6) AS x1, round(y, 6) AS y1 FROM (FROM l UNION ALL FROM d)")  # fmt: skip
def fuse_modes(spark, d):
    """2D boxes of both modes: labels at a score of 1, and a detector's that score enough."""
    box = points(spark, d).select(F.col("frame").cast("string").alias("frame_token"), "point", F.lit("car").alias("cls"), (F.round("intensity", 0) + 0.0).alias("score"), F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + 1).alias("x2"), (F.col("y") + 1).alias("y2"))
    labels = box.where("point < 8").withColumn("annotation_token", F.concat_ws("-", "frame_token", F.col("point").cast("string")))
    both = fusion.boxes_of_modes(labels, box.where("point >= 8"), 0.0)
    return both.select("mode", "box_id", "frame_token", F.col("score"), F.round("x1", 6).alias("x1"), F.round("y1", 6).alias("y1"))


_LEVELS = [round(-30 + i * 40 / 31, 6) for i in range(32)]


@query("WITH " + POINTS + f", l AS (SELECT unnest({_LEVELS}::DOUBLE[]) AS e, unnest(range(0, 32))::INTEGER AS ring), a AS (SELECT frame, point, degrees(atan2(z, sqrt(x * x + y * y))) AS up FROM points) "
       "SELECT frame, point, arg_min(ring, (round(abs(up - e), 9), ring)) AS ring FROM a, l GROUP BY ALL")  # fmt: skip
def proj_nearest_ring(spark, d):
    """The laser ring that a point's elevation is nearest to."""
    up = F.degrees(F.atan2("z", F.hypot("x", "y")))
    return points(spark, d).withColumn("up", up).select("frame", "point", S.nearest_level(F.col("up"), _LEVELS).alias("ring"))


@query("WITH " + POINTS + " SELECT frame, count(*)::DOUBLE AS n_points, round(avg(sqrt(x * x + y * y + z * z)), 3) AS mean_range, round(max(sqrt(x * x + y * y + z * z)), 3) AS max_range, round(avg(intensity), 3) AS mean_intensity, "
       "frame % 5 <> 0 AS decode_ok FROM points WHERE frame % 5 <> 0 GROUP BY frame UNION ALL SELECT vec_id, NULL, NULL, NULL, NULL, false FROM embeddings WHERE vec_id % 5 = 0")  # fmt: skip
def decode_lidar(spark, d):
    """Points packed as files of the sensor, every fifth cut short, and decoded."""
    cells = points(spark, d).groupBy("frame").agg(F.sort_array(F.collect_list(F.struct("point", "x", "y", "z", "intensity"))).alias("p"))
    files = cells.select(F.col("frame").cast("string").alias("frame_token"), F.transform("p", lambda q: F.array(q["x"], q["y"], q["z"], q["intensity"], F.lit(0.0))).alias("rows"), (F.col("frame") % 5 == 0).alias("cut"))
    packed = files.select("frame_token", F.arrow_udf(pack, "binary")("rows", "cut").alias("content"), F.lit(0).alias("width"), F.lit(0).alias("height"))
    f = decode.binary_features(packed, "lidar")
    return f.select(F.col("frame_token").cast("long").alias("frame"), "n_points", *[F.round(c, 3).alias(c) for c in ("mean_range", "max_range", "mean_intensity")], "decode_ok")


def pack(rows: pa.Array, cut: pa.Array) -> pa.Array:
    """Nested rows of numbers as little-endian float32, without the last byte where ``cut``."""
    import numpy as np

    return pa.array([np.array(r, "<f4").tobytes()[: -1 if c else None] for r, c in zip(rows.to_pylist(), cut.to_pylist(), strict=True)], pa.binary())


# A vehicle at (-10, -2, 0) that is turned by 0.3 for each of seven kinds of frames, and a camera 1.5 m ahead and 1.6 m up that looks along its x.
_TURNED = POINTS + """, turned AS (
  SELECT *, (frame % 7) * 0.3::DOUBLE AS a, x + 10 AS dx, y + 2 AS dy FROM points), seen AS (
  SELECT frame, point, x, y, z, -(-sin(a) * dx + cos(a) * dy) AS cx, -(z - 1.6::DOUBLE) AS cy, cos(a) * dx + sin(a) * dy - 1.5::DOUBLE AS cz FROM turned)"""


def _poses(p):
    arr = lambda *v: F.array(*map(F.lit, v))
    half = (F.col("frame") % 7) * 0.15
    return p.withColumns(
        {"ego_translation": arr(-10.0, -2.0, 0.0), "ego_rotation": F.array(F.cos(half), F.lit(0.0), F.lit(0.0), F.sin(half)), "sensor_translation": arr(1.5, 0.0, 1.6), "sensor_rotation": arr(*CAM_Q), "camera_intrinsic": F.array(*[arr(*row) for row in K]), "width": F.lit(1600), "height": F.lit(900)}
    )


def _turned(spark, d):
    """Points with their place in the turned vehicle's camera."""
    p = _poses(points(spark, d))
    at = lambda c: G.vec(F.col(c))
    cam = G.let(G.rotation(F.col("ego_rotation")), lambda re: G.let(G.rotation(F.col("sensor_rotation")), lambda rs: F.struct(*[c.alias(n) for c, n in zip(G.global_to_sensor((F.col("x"), F.col("y"), F.col("z")), at("ego_translation"), re, at("sensor_translation"), rs), ("cx", "cy", "cz"), strict=True)])))
    return p.select("*", F.inline(F.array(cam)))


@query("WITH " + _TURNED + " SELECT frame, point, round(cx, 6) + 0.0 AS cx, round(cy, 6) + 0.0 AS cy, round(cz, 6) + 0.0 AS cz, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z FROM seen")
def geo_turned_ego(spark, d):
    """From the world to a turned vehicle's camera, and back again."""
    at = lambda c: G.vec(F.col(c))
    back = G.let(G.rotation(F.col("ego_rotation")), lambda re: G.let(G.rotation(F.col("sensor_rotation")), lambda rs: F.struct(*[c.alias(n) for c, n in zip(G.sensor_to_global((F.col("cx"), F.col("cy"), F.col("cz")), at("ego_translation"), re, at("sensor_translation"), rs), ("bx", "by", "bz"), strict=True)])))
    rows = _turned(spark, d).select("frame", "point", "cx", "cy", "cz", F.inline(F.array(back)))
    return rows.select("frame", "point", *[_r(F.col(c)).alias(c) for c in ("cx", "cy", "cz")], *[_r(F.col(f"b{c}")).alias(c) for c in "xyz"])


@query("WITH " + _TURNED + " SELECT frame, point FROM seen WHERE cz > 0.5 AND 1266.4 * cx / cz + 816.3 >= 0 AND 1266.4 * cx / cz + 816.3 < 1600 AND 1266.4 * cy / cz + 491.5 >= 0 AND 1266.4 * cy / cz + 491.5 < 900")
def geo_in_image(spark, d):
    seen = G.in_image((F.col("cx"), F.col("cy"), F.col("cz")), F.col("camera_intrinsic"), F.col("width"), F.col("height"))
    return _turned(spark, d).where(seen).select("frame", "point")


# A LiDAR 0.8 m ahead and 1.9 m up, turned by a quarter to the right, whose vehicle stands 0.5 m behind the camera's.
_LIDAR = POINTS + """, e AS (
  SELECT frame, (frame % 7) * 0.3::DOUBLE AS a, y + 0.8::DOUBLE AS lx, -x AS ly, z + 1.9::DOUBLE AS lz FROM points), g AS (
  SELECT frame, a, cos(a) * lx - sin(a) * ly - 10 - 0.5 * cos(a) AS gx, sin(a) * lx + cos(a) * ly - 2 - 0.5 * sin(a) AS gy, lz AS gz FROM e), c AS (
  SELECT frame, cos(a) * (gx + 10) + sin(a) * (gy + 2) AS px, -sin(a) * (gx + 10) + cos(a) * (gy + 2) AS py, gz AS pz FROM g)"""


def _placed(spark, d):
    p = points(spark, d)
    poses = _poses(p.select("frame").distinct())
    r, half = 0.7071067811865476, F.col("frame") % 7 * 0.3
    pairs = poses.withColumns(
        {"lidar_frame": F.col("frame"), "frame_token": F.col("frame"), "lidar_translation": F.array(*map(F.lit, (0.8, 0.0, 1.9))), "lidar_rotation": F.array(*map(F.lit, (r, 0.0, 0.0, -r))),
         "lidar_ego_translation": F.array(-10 - 0.5 * F.cos(half), -2 - 0.5 * F.sin(half), F.lit(0.0)), "lidar_ego_rotation": F.col("ego_rotation")}
    )
    return lifting.place_points(pairs.drop("frame"), p.select(F.col("frame").alias("lidar_frame"), "x", "y", "z"))


@query("WITH " + _LIDAR + " SELECT frame AS frame_token, round(px, 5) + 0.0 AS x, round(py, 5) + 0.0 AS y, round(pz, 5) + 0.0 AS z, round(px - 1.5, 5) + 0.0 AS depth, round((1266.4 * (-py) + 816.3 * (px - 1.5)) / (px - 1.5), 2) AS u FROM c WHERE abs(px - 1.5) > 1")
def fuse_place_points(spark, d):
    """LiDAR points of turned vehicles in the camera's vehicle frame and in its image."""
    return _placed(spark, d).where("abs(depth) > 1").select("frame_token", *[_r(F.col(c), 5).alias(c) for c in ("x", "y", "z", "depth")], F.round("u", 2).alias("u"))


@query("WITH " + _LIDAR + " SELECT frame AS frame_token, round(coalesce(quantile_cont(pz, 0.05) FILTER (WHERE sqrt(px * px + py * py) <= 40), quantile_cont(pz, 0.05)), 6) AS ground FROM c GROUP BY 1")
def fuse_ground_turned(spark, d):
    """The ground's height under each frame."""
    return fusion.ground_height(_placed(spark, d), "frame_token").select("frame_token", F.round("ground", 6).alias("ground"))
