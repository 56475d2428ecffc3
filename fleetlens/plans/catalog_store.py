"""Queries for the KPI history, dashboards, model gate, service metrics and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gate, kpi, store
from ..sources import views
from ..streaming import windows
from .adapters import SAMPLES, read, samples
from .registry import query

#: The history that a run a day over the events would publish.
HISTORY = """day AS (SELECT ts::DATE AS d, event_type, count(*) AS frames, sum(value) AS value_sum FROM events GROUP BY ALL),
history AS (
  SELECT strftime(d, '%Y%m%d') AS run_id, d::TIMESTAMP AS published_at, 'volume.' || event_type || '.frames' AS metric, frames::DOUBLE AS value FROM day
  UNION ALL SELECT strftime(d, '%Y%m%d'), d::TIMESTAMP, 'volume.' || event_type || '.value_sum', round(value_sum, 4) FROM day)"""


def history(spark, d):
    day = F.to_date("ts")
    per = read(spark, d, "events").groupBy(day.alias("d"), "event_type").agg(F.count(F.lit(1)).alias("frames"), F.round(F.sum("value"), 4).alias("value_sum"))
    cells = F.array(*[F.struct(F.concat(F.lit("volume."), "event_type", F.lit(f".{c}")).alias("metric"), F.col(c).cast("double").alias("value")) for c in ("frames", "value_sum")])
    return per.select(F.date_format("d", "yyyyMMdd").alias("run_id"), F.col("d").cast("timestamp_ntz").alias("published_at"), F.inline(cells))


@query("WITH " + HISTORY + " SELECT 'volume.' || event_type || '.frames' AS metric, frames::DOUBLE AS value FROM (SELECT event_type, count(*) AS frames FROM events GROUP BY 1) UNION ALL SELECT 'volume.' || event_type || '.total', round(sum(value), 4) FROM events GROUP BY event_type")
def store_flatten(spark, d):
    wide = read(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("frames"), F.round(F.sum("value"), 4).alias("total"))
    return store.melt(wide, "event_type", "volume")


@query("WITH " + HISTORY + ", renamed AS (SELECT md5(run_id) AS run_id, published_at FROM history) SELECT run_id FROM renamed ORDER BY published_at DESC, run_id DESC LIMIT 1")
def win_latest_run(spark, d):
    """Run ids that do not follow time: the time of publishing counts."""
    renamed = history(spark, d).withColumn("run_id", F.md5("run_id"))
    return store.latest_run(renamed).withColumnRenamed("_latest", "run_id")


@query("WITH " + HISTORY + " SELECT value FROM history WHERE metric = 'volume.view.frames' ORDER BY published_at DESC LIMIT 1")
def dash_latest(spark, d):
    return store.latest_value(history(spark, d), "volume.view.frames")


@query("WITH " + HISTORY + " SELECT published_at, substr(metric, 8) AS series, value FROM history WHERE metric LIKE 'volume.%'")
def dash_series(spark, d):
    return store.series(history(spark, d), "volume.")


@query("WITH " + HISTORY + " SELECT substr(metric, 13) AS label, value FROM history WHERE metric LIKE 'volume.view.%' AND run_id = (SELECT run_id FROM history ORDER BY published_at DESC LIMIT 1)")
def dash_latest_group(spark, d):
    return store.latest_group(history(spark, d), "volume.view.")


@query("WITH " + HISTORY + " SELECT metric, value FROM history WHERE metric LIKE '%.frames' AND run_id = (SELECT run_id FROM history WHERE metric LIKE 'volume.signup.%' ORDER BY published_at DESC LIMIT 1)")
def dash_3d_ap(spark, d):
    return store.of_latest(history(spark, d), "metric LIKE 'volume.signup.%'").where("metric LIKE '%.frames'").select("metric", "value")


@query("WITH " + HISTORY + " SELECT published_at, replace(replace(metric, 'volume.', ''), '.', ' / ') || ' daily' AS label, value FROM history WHERE metric IN ('volume.view.frames', 'volume.click.frames')")
def dash_labelled_series(spark, d):
    h = history(spark, d).where(F.col("metric").isin("volume.view.frames", "volume.click.frames"))
    return h.select("published_at", F.concat(F.replace(F.replace("metric", F.lit("volume."), F.lit("")), F.lit("."), F.lit(" / ")), F.lit(" daily")).alias("label"), "value")


#: The coverage that a run a year over the samples would publish.
COVERAGE = SAMPLES + """, coverage AS (
  SELECT md5(year(make_timestamp(sample_timestamp))::VARCHAR) AS run_id, make_timestamp(year(make_timestamp(sample_timestamp)), 12, 31, 0, 0, 0) AS published_at, location, weather, count(*) AS samples FROM samples GROUP BY ALL)"""


@query("WITH " + COVERAGE + " SELECT location, weather, sum(samples)::BIGINT AS samples FROM coverage WHERE run_id = (SELECT run_id FROM coverage ORDER BY published_at DESC LIMIT 1) GROUP BY 1, 2")
def dash_coverage(spark, d):
    """The cells of the run published last."""
    year = F.year(F.timestamp_micros("sample_timestamp"))
    runs = samples(spark, d).groupBy(F.md5(year.cast("string")).alias("run_id"), F.make_timestamp_ntz(year, F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias("published_at"), "location", "weather").agg(F.count(F.lit(1)).alias("samples"))
    return store.of_latest(runs).groupBy("location", "weather").agg(F.sum("samples").alias("samples"))


@query("SELECT epoch_us(t) AS at, event_type, n / 300.0::DOUBLE AS rate FROM (SELECT t, event_type, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 MINUTE, ts) + to_minutes(k + 1) AS t, ts, event_type FROM events, range(0, 5) r(k)) GROUP BY ALL)")
def prom_rate_5m(spark, d):
    """The rate over the five minutes before each full minute that has any event in them."""
    return kpi.sliding_rate(read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", 300, 60, "event_type").select(F.unix_micros("at").alias("at"), "event_type", "rate")


@query("""WITH t AS (SELECT date_trunc('day', ts) + to_days(k + 1) AS t, event_type, value FROM events, range(0, 2) r(k)),
b AS (SELECT t, event_type, b AS le, count_if(value <= b) AS n FROM t, (VALUES (5.0::DOUBLE), (10.0), (25.0), (50.0), (100.0), (250.0), ('inf'::DOUBLE)) x(b) GROUP BY ALL),
p AS (SELECT *, lag(le, 1, 0.0::DOUBLE) OVER w AS low, lag(n, 1, 0) OVER w AS below, max(n) OVER (PARTITION BY t, event_type) * 0.95::DOUBLE AS rank FROM b WINDOW w AS (PARTITION BY t, event_type ORDER BY le)),
f AS (SELECT *, row_number() OVER (PARTITION BY t, event_type ORDER BY le) AS r FROM p WHERE n >= rank)
SELECT epoch_us(t) AS at, event_type, round(CASE WHEN le = 'inf'::DOUBLE THEN low ELSE low + (le - low) * (rank - below) / (n - below) END, 6) AS quantile FROM f WHERE r = 1""")  # fmt: skip
def prom_quantile_sliding(spark, d):
    """The 0.95 quantile of the two days before each midnight, from buckets."""
    e = kpi.sliding(read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", 2 * 86400, 86400)
    return kpi.histogram_quantile(kpi.histogram(e, "value", _BOUNDS, "at", "event_type"), 0.95, "at", "event_type").select(F.unix_micros("at").alias("at"), "event_type", F.round("quantile", 6).alias("quantile"))


_BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0]


@query("""WITH b AS (SELECT event_type, b AS le, count_if(value <= b) AS n FROM events, (VALUES (5.0::DOUBLE), (10.0), (25.0), (50.0), (100.0), (250.0), ('inf'::DOUBLE)) t(b) GROUP BY ALL),
p AS (SELECT *, lag(le, 1, 0.0::DOUBLE) OVER w AS low, lag(n, 1, 0) OVER w AS below, max(n) OVER (PARTITION BY event_type) * 0.95::DOUBLE AS rank FROM b WINDOW w AS (PARTITION BY event_type ORDER BY le)),
f AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS r FROM p WHERE n >= rank)
SELECT event_type, round(CASE WHEN le = 'inf'::DOUBLE THEN low ELSE low + (le - low) * (rank - below) / (n - below) END, 6) AS quantile FROM f WHERE r = 1""")  # fmt: skip
def prom_histogram_quantile(spark, d):
    h = kpi.histogram(read(spark, d, "events"), "value", _BOUNDS, "event_type")
    return kpi.histogram_quantile(h, 0.95, "event_type").select("event_type", F.round("quantile", 6).alias("quantile"))


_SLICES = SAMPLES + """, s AS (SELECT unnest(list_distinct(list_concat(tags, CASE WHEN in_regression_set THEN ['regression_set'] ELSE [] END))) AS slice, price, ml_ready FROM samples)"""


@query("WITH " + _SLICES + " SELECT slice, count(*) AS n, round(avg(ml_ready::INT::DOUBLE), 6) AS score FROM s GROUP BY 1")
def slice_explode_metrics(spark, d):
    return gate.by_slice(samples(spark, d), F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("ml_ready").cast("double")), 6).alias("score"))


_GATE = _SLICES + """, n AS (SELECT slice, avg(ml_ready::INT::DOUBLE) AS score FROM s GROUP BY 1 UNION ALL SELECT 'all', avg(ml_ready::INT::DOUBLE) FROM samples),
o AS (SELECT slice, avg((price > 20000)::INT::DOUBLE) AS score FROM s WHERE slice <> 'ASIA' GROUP BY 1),
checks AS (SELECT slice, NULL::DOUBLE AS old, score AS new, score >= 0.25 AS passed FROM n WHERE slice = 'all'
  UNION ALL SELECT n.slice, o.score, n.score, o.score - n.score <= 0.1 FROM n JOIN o ON n.slice = o.slice WHERE n.slice IN ('night', 'rain', 'stopped', 'ASIA'))"""


def gate_rows(spark, d):
    s = samples(spark, d)
    score = lambda c: F.avg(c.cast("double")).alias("score")
    new = gate.by_slice(s, score(F.col("ml_ready"))).unionByName(s.agg(score(F.col("ml_ready"))).select(F.lit("all").alias("slice"), "score"))
    old = gate.by_slice(s, score(F.col("price") > 20000)).where("slice <> 'ASIA'")
    return gate.gate_checks(new, old, ["night", "rain", "stopped", "ASIA"], 0.25, 0.10)


@query("WITH " + _GATE + " SELECT slice, round(old, 6) AS old, round(new, 6) AS new, passed FROM checks")
def gate_slice_drop(spark, d):
    return gate_rows(spark, d).select("slice", F.round("old", 6).alias("old"), F.round("new", 6).alias("new"), "passed")


@query("WITH " + _GATE + " SELECT bool_and(passed) AS passed, count_if(NOT passed) AS failed FROM checks")
def gate_verdict(spark, d):
    return gate.passed(gate_rows(spark, d))


#: Where the watermark stands at the end of the events.
_MARK = "(SELECT epoch_us(max(ts)) - 600000000 FROM events)"


@query(f"SELECT * FROM (SELECT epoch_us(date_trunc('hour', ts)) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL) WHERE window_start + 3600000000 <= {_MARK}")
def stream_tumbling(spark, d):
    return windows.tumbling(spark, d)


@query(f"SELECT * FROM (SELECT epoch_us(time_bucket(INTERVAL 2 HOUR, ts)) - k * 7200000000 AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, range(0, 3) r(k) GROUP BY ALL) WHERE window_start + 21600000000 <= {_MARK}")
def stream_sliding(spark, d):
    return windows.sliding(spark, d)


@query("""WITH g AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w >= 43200000000 THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT min(t) AS session_start, max(t) + 43200000000 AS session_end, user_id, count(*) AS n FROM s GROUP BY user_id, k HAVING max(t) + 43200000000 <= """ + _MARK)  # fmt: skip
def stream_session(spark, d):
    return windows.sessions(spark, d)


@query("SELECT event_id, value FROM events")
def stream_dedup(spark, d):
    return windows.deduplicated(spark, d)


@query("WITH e AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY value, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM events) SELECT event_id FROM e WHERE ts < seen - INTERVAL 10 DAY")
def stream_late_rows(spark, d):
    return windows.late_rows(read(spark, d, "events"), "10 DAYS", "value", "event_id").select("event_id")


@query("WITH " + _GATE + ", verdict AS (SELECT bool_and(passed) AS passed FROM checks) SELECT v AS model_version, passed AND v = 'm2' AS allowed FROM verdict, (VALUES ('m1'), ('m2')) t(v)")
def gate_promotion(spark, d):
    """Whether each of two models may be promoted by a gate report on the second."""
    report = gate.passed(gate_rows(spark, d)).withColumn("model_version", F.lit("m2"))
    models = spark.range(1).select(F.explode(F.array(F.lit("m1"), F.lit("m2"))).alias("model_version"))
    return gate.may_promote(models, report)


@query("SELECT event_type AS channel, count(*) AS frames, round(sum(value), 4) AS total FROM events WHERE event_id % 10 = 0 GROUP BY 1 HAVING count(*) > 3")
def sql_views(spark, d):
    """SQL text over tables that were registered as views."""
    with views.registered(spark, {"silver_frames": f"{d}/events.parquet"}):
        return spark.sql("SELECT event_type AS channel, count(*) AS frames, round(sum(value), 4) AS total FROM silver_frames WHERE event_id % 10 = 0 GROUP BY 1 HAVING count(*) > 3")
