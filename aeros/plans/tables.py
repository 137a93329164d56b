"""Queries of joins, aggregates, windows, de-duplication, top lists, contract and monitor."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as G
from ..operators import contract as C
from ..operators import joins as Jn
from ..operators import monitor as M
from ..operators import projections as J
from ..operators import windows as W
from ..operators.filters import of_topic, split_label, trailing
from ..operators.sketches import ERROR, SketchTable, quantiles, sketched_drift
from ..sources import sinks
from ..sources.versions import VersionedTable
from .base import AIR_TOPIC, AS_OF, BUCKET, TRAIN_END, VAL_END, WEATHER_TOPIC, features, halves, over, register, scratch, sensor, station_hours, table

_ALL = "temp_c humidity pressure wind_speed wind_dir precipitation cloud_cover shortwave_radiation soil_temperature pm2_5 us_aqi"
_ALL_SQL = ", ".join(_ALL.split())


def _as_of():
    return F.to_timestamp(F.lit(AS_OF))


_WINDOW = "OVER (PARTITION BY station_id ORDER BY timestamp"

# ---- joins ----


@register("jon1", over("j", f"SELECT station_id, hour_ts, timestamp, {_ALL_SQL} FROM j"), _ALL)
def jon1(spark, d):
    return station_hours(sensor(spark, d)).select("station_id", "hour_ts", "timestamp", *_ALL.split())


@register("jon2", over("a", "SELECT station_id, hour_ts, temp_c, pm2_5 FROM w JOIN a USING (station_id, hour_ts)"), "temp_c pm2_5")
def jon2(spark, d):
    w, a = halves(sensor(spark, d))
    return Jn.merge_exact(w, a.select("station_id", "hour_ts", "pm2_5", "us_aqi"), ("station_id", "hour_ts")).select("station_id", "hour_ts", "temp_c", "pm2_5")


_LATEST = "QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY event_time DESC, event_id DESC) = 1"


@register("jon3", over("s", f"SELECT station_id, greatest(x.event_time, y.event_time) AS event_time, temperature_c, pm25 FROM (SELECT station_id, event_time, temperature_c FROM s WHERE kafka_topic = '{WEATHER_TOPIC}' {_LATEST}) x JOIN (SELECT station_id, event_time, pm25 FROM s WHERE kafka_topic = '{AIR_TOPIC}' {_LATEST}) y USING (station_id)"), "temperature_c pm25")
def jon3(spark, d):
    s = sensor(spark, d)
    w = of_topic(s, WEATHER_TOPIC).select("station_id", "event_time", "event_id", "temperature_c")
    a = of_topic(s, AIR_TOPIC).select("station_id", "event_time", F.col("event_id").alias("air_id"), "pm25")
    latest = Jn.latest_per_key(a, ["station_id"], "event_time", "air_id")
    return Jn.merge_latest(w, latest, "station_id").select("station_id", "event_time", "temperature_c", "pm25")


@register("jon6", over("s", "SELECT station_id, hour_ts, source, event_id FROM (SELECT *, date_trunc('hour', event_time) AS hour_ts, list_position(['view', 'click', 'signup'], source) AS r FROM s) WHERE r IS NOT NULL AND temperature_c IS NOT NULL QUALIFY row_number() OVER (PARTITION BY station_id, hour_ts ORDER BY r, event_id) = 1"))
def jon6(spark, d):
    s = sensor(spark, d).withColumn("hour_ts", F.date_trunc("hour", "event_time"))
    out = Jn.first_valid_source(s, ["station_id", "hour_ts"], ["view", "click", "signup"], F.col("temperature_c").isNotNull())
    return out.select("station_id", "hour_ts", "source", "event_id")


# ---- aggregates ----

_MISSING = ["temperature_c", "pm25", "soil_temperature_0_to_7cm_c", "humidity"]
_MISSING_SQL = " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS missing_rate FROM s" for c in _MISSING)


@register("agg1", over("s", _MISSING_SQL), "missing_rate")
def agg1(spark, d):
    return G.missing_rate(sensor(spark, d), _MISSING)


_DUP = "SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, sum(n - 1) / sum(n) AS duplicate_rate FROM (SELECT count(*) AS n FROM s GROUP BY station_id, date_trunc('hour', event_time))"


@register("agg2", over("s", _DUP), "duplicate_rate")
def agg2(spark, d):
    return G.duplicate_rate(sensor(spark, d).withColumn("hour_ts", F.date_trunc("hour", "event_time")), ["station_id", "hour_ts"])


_DELAY = "SELECT avg(x) AS avg_delay_seconds, quantile_cont(x, 0.95) AS p95_delay_seconds, max(x) AS max_delay_seconds FROM (SELECT CAST(epoch(date_trunc('second', ingestion_time)) - epoch(date_trunc('second', event_time)) AS BIGINT) AS x FROM s)"


@register("agg3", over("s", _DELAY), "avg_delay_seconds p95_delay_seconds")
def agg3(spark, d):
    return G.delay_stats(sensor(spark, d), exact=True)


_DRIFT_COLUMNS = ["pm25", "humidity", "temperature_c"]
_DELAYED = "delay_seconds"


def _sketched(spark, d):
    """The view with its delays, and a table of its daily sketches, written day by day as a job would."""
    s = sensor(spark, d).withColumn(_DELAYED, F.unix_timestamp("ingestion_time") - F.unix_timestamp("event_time"))
    kept = SketchTable(spark, scratch(spark, "sketches"))
    for part, rows in (("first", s.filter("event_time < '2024-01-15'")), ("second", s.filter("event_time >= '2024-01-15'"))):
        kept.add(rows, [_DELAYED, *_DRIFT_COLUMNS, *_MISSING], batch=part)
    return s, kept


@register("agg3_sketch", over("s", f"SELECT avg_delay_seconds, max_delay_seconds, TRUE AS p95_within FROM ({_DELAY})"), "avg_delay_seconds")
def agg3_sketch(spark, d):
    """From merged daily sketches; the rank of the percentile is within the sketches' error."""
    s, kept = _sketched(spark, d)
    q = quantiles(kept.between(), {"p95": 0.95}).filter(F.col("column_name") == _DELAYED)
    x = F.col(_DELAYED)
    return s.crossJoin(F.broadcast(q)).agg(F.first("mean").alias("avg_delay_seconds"), F.first("most").cast("long").alias("max_delay_seconds"), ((F.avg((x < F.col("p95")).cast("int")) - ERROR <= 0.95) & (F.avg((x <= F.col("p95")).cast("int")) + ERROR >= 0.95)).alias("p95_within"))


_SILENCE = f"SELECT station_id, max(event_time) AS last_event_time, (epoch(TIMESTAMP '{AS_OF}') - epoch(date_trunc('second', max(event_time)))) / 60.0 AS silence_minutes FROM s GROUP BY station_id"


@register("agg4", over("s", _SILENCE), "silence_minutes")
def agg4(spark, d):
    return G.station_silence(sensor(spark, d), _as_of())


@register("agg5", over("s", f"SELECT max(silence_minutes) AS max_silence_minutes FROM ({_SILENCE})"), "max_silence_minutes")
def agg5(spark, d):
    return G.max_silence(sensor(spark, d), _as_of())


@register("agg6", over("s", f"SELECT * FROM ({_MISSING_SQL}) WHERE missing_rate > 0"), "missing_rate")
def agg6(spark, d):
    return G.null_violations(sensor(spark, d), _MISSING)


_RATES = {"pm25": "pm25_missing_rate", "temperature_c": "temp_missing_rate", "humidity": "humidity_missing_rate", "wind_speed_mps": "wind_missing_rate"}


@register("agg8", over("s", f"SELECT station_id, region, city, count(*) AS total_rows, {', '.join(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {n}' for c, n in _RATES.items())} FROM s WHERE event_time >= (SELECT max(event_time) FROM s) - INTERVAL 7 DAY GROUP BY ALL"), " ".join(_RATES.values()))
def agg8(spark, d):
    return G.quality_by_station(trailing(sensor(spark, d), "7 DAYS"), _RATES)


@register("agg9", over("s", "SELECT station_id, region, city, avg(pm25) AS avg_pm25_24h, max(pm25) AS max_pm25_24h, avg(aqi) AS avg_aqi_24h FROM s WHERE event_time >= (SELECT max(event_time) FROM s) - INTERVAL 24 HOUR GROUP BY ALL ORDER BY avg_pm25_24h DESC NULLS LAST, station_id LIMIT 20"), "avg_pm25_24h max_pm25_24h avg_aqi_24h")
def agg9(spark, d):
    return G.hotspots(trailing(sensor(spark, d), "24 HOURS"))


@register("agg10", over("s", "SELECT region, date_trunc('hour', event_time) AS hour_ts, avg(pm25) AS avg_pm25, max(pm25) AS max_pm25, count(*) AS station_count FROM s GROUP BY ALL"), "avg_pm25 max_pm25")
def agg10(spark, d):
    return G.hourly_trend(sensor(spark, d))


_EVAL = "SELECT source AS model_name, CAST(event_id % 3 + 1 AS INTEGER) AS horizon, region, aqi AS prediction, pm25 AS actual, event_id FROM s"


def _evaluated(spark, d):
    return sensor(spark, d).select(F.col("source").alias("model_name"), (F.col("event_id") % 3 + 1).cast("int").alias("horizon"), "region", F.col("aqi").alias("prediction"), F.col("pm25").alias("actual"), "event_id")


@register("agg11", over("s", f"SELECT model_name, horizon, region, avg(abs(prediction - actual)) AS mae, sqrt(avg(pow(prediction - actual, 2))) AS rmse, count(*) AS n_samples FROM ({_EVAL}) GROUP BY ALL"), "mae rmse")
def agg11(spark, d):
    return G.error_by_region(_evaluated(spark, d))


_METRICS = "sqrt(avg(pow(actual - prediction, 2))) AS rmse, avg(abs(actual - prediction)) AS mae, 1 - sum(pow(actual - prediction, 2)) / (var_pop(actual) * count(actual)) AS r2"


@register("agg12", over("s", f"SELECT {_METRICS} FROM ({_EVAL}) WHERE actual IS NOT NULL"), "rmse mae r2")
def agg12(spark, d):
    return G.regression_metrics(_evaluated(spark, d).filter("actual IS NOT NULL"), "actual").select("rmse", "mae", "r2")


@register("agg13", over("s", f"SELECT coalesce(avg(CASE WHEN abs(actual) > 1e-9 THEN abs((actual - prediction) / actual) END) * 100, 0) AS mape FROM ({_EVAL})"), "mape")
def agg13(spark, d):
    return G.regression_metrics(_evaluated(spark, d), "actual").select("mape")


@register("agg14", over("s", f"SELECT coalesce(avg(CASE WHEN actual >= 75 THEN abs(actual - prediction) END), 0) AS mae_high FROM ({_EVAL})"), "mae_high")
def agg14(spark, d):
    return G.regression_metrics(_evaluated(spark, d), "actual").select("mae_high")




def _drift_sql() -> str:
    parts = []
    for f in _DRIFT_COLUMNS:
        parts.append(f"SELECT '{f}' AS feature_name, {f} AS v, CASE WHEN event_time <= TIMESTAMP '{TRAIN_END}' THEN 'e' ELSE 'a' END AS side FROM s WHERE {f} IS NOT NULL")
    return f"""WITH v AS ({' UNION ALL '.join(parts)}),
      q AS (SELECT feature_name, quantile_cont(v, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS cuts FROM v WHERE side = 'e' GROUP BY 1),
      b AS (SELECT v.feature_name, side, len(list_filter(cuts, lambda c: c <= v)) AS bin FROM v JOIN q USING (feature_name)),
      n AS (SELECT feature_name, bin, count(*) FILTER (side = 'e') AS ne, count(*) FILTER (side = 'a') AS na FROM b GROUP BY 1, 2),
      t AS (SELECT *, greatest(ne / sum(ne) OVER (PARTITION BY feature_name), 1e-9) AS pe, greatest(na / sum(na) OVER (PARTITION BY feature_name), 1e-9) AS pa FROM n),
      p AS (SELECT feature_name, sum((pa - pe) * ln(pa / pe)) AS psi FROM t GROUP BY 1),
      m AS (SELECT feature_name, avg(v) FILTER (side = 'e') AS mean_train, avg(v) FILTER (side = 'a') AS mean_serving, stddev_pop(v) FILTER (side = 'e') AS std_train, stddev_pop(v) FILTER (side = 'a') AS std_serving FROM v GROUP BY 1)
      SELECT *, CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'warning' ELSE 'critical' END AS status FROM p JOIN m USING (feature_name)"""


def _sides(spark, d):
    s = sensor(spark, d)
    return s.filter(f"event_time <= '{TRAIN_END}'"), s.filter(f"event_time > '{TRAIN_END}'")


@register("agg15", over("s", f"SELECT feature_name, psi FROM ({_drift_sql()}) WHERE feature_name = 'pm25'"), "psi")
def agg15(spark, d):
    return G.psi(*_sides(spark, d), "pm25", exact=True)


@register("agg16", over("s", f"SELECT * FROM ({_drift_sql()})"), "psi mean_train mean_serving std_train std_serving")
def agg16(spark, d):
    return G.drift(*_sides(spark, d), _DRIFT_COLUMNS, exact=True)


@register("agg16_sketch", over("s", f"SELECT feature_name, TRUE AS psi_within, mean_train, mean_serving, std_train, std_serving FROM ({_drift_sql().replace(TRAIN_END, '2024-01-20 23:59:59.999999')})"), "mean_train mean_serving std_train std_serving")
def agg16_sketch(spark, d):
    """Drift from merged daily sketches; psi is within 0.01 of that of the rows."""
    s, kept = _sketched(spark, d)
    cut = "2024-01-20 23:59:59.999999"
    exact = G.drift(s.filter(f"event_time <= '{cut}'"), s.filter(f"event_time > '{cut}'"), _DRIFT_COLUMNS, exact=True).select("feature_name", F.col("psi").alias("exact"))
    own = sketched_drift(kept.between(None, "2024-01-20"), kept.between("2024-01-21"))
    return own.join(exact, "feature_name").select("feature_name", (F.abs(F.col("psi") - F.col("exact")) <= 0.01).alias("psi_within"), "mean_train", "mean_serving", "std_train", "std_serving")


_SPLIT = f"CASE WHEN event_time <= TIMESTAMP '{TRAIN_END}' THEN 'train' WHEN event_time <= TIMESTAMP '{VAL_END}' THEN 'val' ELSE 'test' END"


@register("agg17", over("s", f"SELECT {_SPLIT} AS split, count(*) AS row_count FROM s GROUP BY 1"))
def agg17(spark, d):
    return G.rows_per_split(sensor(spark, d).withColumn("split", split_label(F.col("event_time"), TRAIN_END, VAL_END)))




def _snapshots(spark, d):
    """Evaluation snapshots made of the view: a run a day."""
    s = sensor(spark, d).select(F.lit("regression").alias("task"), F.col("source").alias("model_name"), (F.col("event_id") % 3 + 1).cast("int").alias("horizon"), F.date_trunc("day", "event_time").alias("recorded_at"), "pm25", "aqi")
    runs = s.groupBy("task", "model_name", "horizon", "recorded_at").agg(F.avg("pm25").alias("mae"), F.max("aqi").alias("mae_high")).withColumn("run_id", F.date_format("recorded_at", "yyyyMMdd")).filter("mae IS NOT NULL")
    return runs.select("task", "model_name", "horizon", "run_id", "recorded_at", F.lit("test").alias("split"), F.inline(F.array(*[F.struct(F.lit(n).alias("metric_name"), F.col(n).alias("metric_value")) for n in ("mae", "mae_high")])))


_RUNS = "SELECT 'regression' AS task, source AS model_name, CAST(event_id % 3 + 1 AS INTEGER) AS horizon, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS recorded_at, strftime(date_trunc('day', event_time), '%Y%m%d') AS run_id, avg(pm25) AS mae, max(aqi) AS mae_high FROM s GROUP BY ALL HAVING avg(pm25) IS NOT NULL"


@register("agg18", over("s", f"SELECT task, model_name, horizon, run_id, mae, mae_high FROM ({_RUNS})"), "mae mae_high")
def agg18(spark, d):
    return G.pivot_metrics(_snapshots(spark, d), ["task", "model_name", "horizon", "run_id"], ["mae", "mae_high"])


_T1 = f"lead(pm2_5, 1) {_WINDOW}) AS t1, lead(pm2_5, 6) {_WINDOW}) AS t6"


@register("agg19", over("j", f"SELECT count(t1) AS target_pm25_1h_count, count(t6) AS target_pm25_6h_count, CAST(sum(CASE WHEN t1 >= 35 THEN 1 ELSE 0 END) AS BIGINT) AS alert_count, avg(CASE WHEN t1 >= 35 THEN 1.0 ELSE 0.0 END) AS alert_rate FROM (SELECT {_T1} FROM j)"), "alert_rate")
def agg19(spark, d):
    out = J.add_alert_target(W.add_targets(station_hours(sensor(spark, d)), (1, 6)))
    return G.target_counts(out, ["target_pm25_1h", "target_pm25_6h"], "target_alert_1h")


@register("agg22", "SELECT 'events' AS table_name, count(*) AS row_count FROM events UNION ALL SELECT 'orders', count(*) FROM orders")
def agg22(spark, d):
    return G.table_counts({n: table(spark, d, n) for n in ("events", "orders")})


# ---- windows ----


@register("win1", over("l", f"SELECT station_id, timestamp, {_ALL_SQL} FROM l"), _ALL)
def win1(spark, d):
    return W.forward_fill(station_hours(sensor(spark, d)), bucket=BUCKET).select("station_id", "timestamp", *_ALL.split())


def _moving(name: str, columns: str):
    @register(name, over("f", f"SELECT station_id, timestamp, {', '.join(columns.split())} FROM f"), columns)
    def run(spark, d):
        return features(sensor(spark, d)).select("station_id", "timestamp", *columns.split())

    return run


_moving("win2", "pressure_delta_3h")
_moving("win3", "wind_shear_U wind_shear_V")
_moving("win4", "temp_mean_6h")
_moving("win5", "pm25_acc_12h")

_FEATURES = "coord_X dew_point theta_e air_density wind_U wind_V pressure_delta_3h wind_shear_U temp_mean_6h pm25_acc_12h"


@register("features", over("f", f"SELECT station_id, hour_ts, timestamp, is_stagnant_air, {', '.join(_FEATURES.split())} FROM f"), _FEATURES)
def feature_rows(spark, d):
    return features(sensor(spark, d)).select("station_id", "hour_ts", "timestamp", "is_stagnant_air", *_FEATURES.split())


def _lead(hours: tuple[int, ...]) -> tuple[list[str], str]:
    from ..schemas import TARGETS

    names = [f"target_{n}_{h}h" for h in hours for n in TARGETS]
    return names, ", ".join(f"lead({c}, {h}) {_WINDOW}) AS target_{n}_{h}h" for h in hours for n, c in TARGETS.items())


_NEAR, _NEAR_SQL = _lead(W.HORIZONS)
_FAR, _FAR_SQL = _lead(W.FAR_HORIZONS)


@register("win7", over("j", f"SELECT station_id, timestamp, {_NEAR_SQL} FROM j"), " ".join(_NEAR))
def win7(spark, d):
    return W.add_targets(station_hours(sensor(spark, d)), bucket=BUCKET).select("station_id", "timestamp", *_NEAR)


@register("win8", over("l", f"SELECT * FROM (SELECT station_id, timestamp, {_FAR_SQL} FROM l) WHERE {' AND '.join(c + ' IS NOT NULL' for c in _FAR if c.endswith('_24h'))}"), " ".join(_FAR))
def win8(spark, d):
    out = W.add_targets(W.forward_fill(station_hours(sensor(spark, d)), bucket=BUCKET), W.FAR_HORIZONS, drop_incomplete=True, bucket=BUCKET)
    return out.select("station_id", "timestamp", *_FAR)


@register("win9", over("s", f"SELECT station_id, event_id, event_time FROM s {_LATEST}"))
def win9(spark, d):
    return W.latest_per_key(sensor(spark, d), ["station_id"], "event_time").select("station_id", "event_id", "event_time")


@register("win10", over("s", f"SELECT task, model_name, horizon, run_id, mae, previous_mae FROM (SELECT *, lag(mae) OVER (PARTITION BY task, model_name, horizon ORDER BY recorded_at) AS previous_mae, row_number() OVER (PARTITION BY task, model_name, horizon ORDER BY recorded_at DESC) AS rn FROM ({_RUNS})) WHERE rn = 1"), "mae previous_mae")
def win10(spark, d):
    runs = G.pivot_metrics(_snapshots(spark, d), ["task", "model_name", "horizon", "run_id", "recorded_at"], ["mae"])
    return W.current_and_previous(runs).select("task", "model_name", "horizon", "run_id", "mae", "previous_mae")


@register("win11", over("s", "SELECT source AS metric_name, arg_max(aqi, event_time) AS metric_value, max(event_time) AS metric_time FROM s GROUP BY 1"), "metric_value")
def win11(spark, d):
    s = sensor(spark, d).select(F.col("source").alias("metric_name"), F.col("aqi").alias("metric_value"), F.col("event_time").alias("metric_time"))
    return W.latest_value(s)


@register("ded1", over("a", "SELECT 'w' AS side, station_id, hour_ts, timestamp FROM w UNION ALL SELECT 'a', station_id, hour_ts, timestamp FROM a"))
def ded1(spark, d):
    w, a = halves(sensor(spark, d))
    cols = ["station_id", "hour_ts", "timestamp"]
    return w.select(F.lit("w").alias("side"), *cols).unionByName(a.select(F.lit("a").alias("side"), *cols))


_SCALE = "SELECT l_suppkey, l_orderkey, l_linenumber, {} FROM lineitem"
_LINES = "OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber"


@register("scale_window", _SCALE.format(f"CAST(l_extendedprice AS DOUBLE) - lag(CAST(l_extendedprice AS DOUBLE), 3) {_LINES}) AS delta, avg(CAST(l_extendedprice AS DOUBLE)) {_LINES} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS mean6"), "delta mean6")
def scale_window(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber")
    price = F.col("l_extendedprice").cast("double")
    return table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", (price - F.lag(price, 3).over(w)).alias("delta"), F.avg(price).over(w.rowsBetween(-5, 0)).alias("mean6"))


# ---- order, limit, union ----


@register("top1", over("s", "SELECT station_id, avg(pm25) AS m FROM s GROUP BY 1 ORDER BY m DESC NULLS LAST, station_id LIMIT 20"), "m")
def top1(spark, d):
    return sensor(spark, d).groupBy("station_id").agg(F.avg("pm25").alias("m")).orderBy(F.col("m").desc_nulls_last(), "station_id").limit(20)


@register("top2", over("s", "SELECT event_id, event_time, aqi FROM s ORDER BY event_time DESC, event_id DESC LIMIT 500"), "aqi")
def top2(spark, d):
    return sensor(spark, d).select("event_id", "event_time", "aqi").orderBy(F.desc("event_time"), F.desc("event_id")).limit(500)


@register("top3", over("s", "SELECT region, source, count(*) AS n, row_number() OVER (ORDER BY region, count(*) DESC, source) AS place FROM s GROUP BY region, source"))
def top3(spark, d):
    from pyspark.sql import Window

    per = sensor(spark, d).groupBy("region", "source").agg(F.count("*").alias("n"))
    return per.withColumn("place", F.row_number().over(Window.orderBy("region", F.desc("n"), "source")).cast("long"))


@register("top4", over("s", "SELECT event_id, region, aqi FROM s ORDER BY event_id LIMIT 200"), "aqi")
def top4(spark, d):
    return sensor(spark, d).select("event_id", "region", "aqi").orderBy("event_id").limit(200)


@register("set2", over("s", f"SELECT 'max_silence' AS metric_name, max(silence_minutes) AS metric_value, CAST(NULL AS VARCHAR) AS column_name FROM ({_SILENCE}) UNION ALL SELECT 'missing_rate', missing_rate, column_name FROM ({_MISSING_SQL})"), "metric_value")
def set2(spark, d):
    s = sensor(spark, d)
    one = G.max_silence(s, _as_of()).select(F.lit("max_silence").alias("metric_name"), F.col("max_silence_minutes").alias("metric_value"))
    many = G.missing_rate(s, _MISSING).select(F.lit("missing_rate").alias("metric_name"), F.col("missing_rate").alias("metric_value"), "column_name")
    return one.unionByName(many, allowMissingColumns=True)


# ---- contract and monitor ----

_SMALL = C.Contract({"station_id": ("string", False), "event_time": ("timestamp", False), "temperature_c": ("numeric", False), "humidity": ("string", True), "absent": ("numeric", True)}, keys=["station_id", "event_time"], regions=["bac", "trung"])
_CHECKS = """SELECT 'null_rate' AS check_name, 'station_id' AS column_name, 0.0::DOUBLE AS value UNION ALL SELECT 'null_rate', 'event_time', 0.0 UNION ALL SELECT 'null_rate', 'temperature_c', (SELECT avg(CASE WHEN temperature_c IS NULL THEN 1 ELSE 0 END) FROM s)
 UNION ALL SELECT 'duplicate_rows', 'station_id,event_time', (SELECT CAST(sum(n - 1) AS DOUBLE) FROM (SELECT count(*) AS n FROM s GROUP BY station_id, event_time))
 UNION ALL SELECT 'invalid_regions', 'region', (SELECT CAST(count(*) AS DOUBLE) FROM s WHERE region NOT IN ('bac', 'trung'))"""


@register("con4", over("s", _CHECKS), "value")
def con4(spark, d):
    return C.data_checks(sensor(spark, d), _SMALL)


@register("con5", over("s", "SELECT 'station_id' AS column_name, 0::BIGINT AS failures UNION ALL SELECT 'source', count(*) FROM s"))
def con5(spark, d):
    return C.cast_failures(sensor(spark, d), C.Contract({"station_id": ("string", True), "source": ("numeric", True)}))


@register("con6", over("s", f"SELECT code, severity, column_name FROM (SELECT 'missing_column' AS code, 'error' AS severity, 'absent' AS column_name UNION ALL SELECT 'type_mismatch', 'error', 'humidity' UNION ALL SELECT check_name, CASE WHEN check_name = 'duplicate_rows' THEN 'warning' ELSE 'error' END, column_name FROM ({_CHECKS}) WHERE value > 0)"))
def con6(spark, d):
    return C.issues(sensor(spark, d), _SMALL).select("code", "severity", "column_name")


@register("con7", over("j", "SELECT station_id, timestamp FROM j"))
def con7(spark, d):
    rows = station_hours(sensor(spark, d))
    return C.gated(rows, C.Contract({"station_id": ("string", False), "timestamp": ("timestamp", False)})).select("station_id", "timestamp")


_THRESHOLD = "CASE WHEN {v} >= {c} THEN 'critical' WHEN {v} >= {w} THEN 'warning' ELSE 'stable' END"
_MON = " UNION ALL ".join(
    [f"SELECT 'data_quality' AS category, 'missing_rate_' || column_name AS metric_name, missing_rate AS metric_value, {_THRESHOLD.format(v='missing_rate', w=0.05, c=0.10)} AS severity FROM ({_MISSING_SQL})"]
    + [f"SELECT 'data_quality', 'duplicate_rate', duplicate_rate, {_THRESHOLD.format(v='duplicate_rate', w=0.01, c=0.03)} FROM ({_DUP})"]
    + [f"SELECT 'freshness', 'max_station_silence_minutes', v, {_THRESHOLD.format(v='v', w=30, c=60)} FROM (SELECT max(silence_minutes) AS v FROM ({_SILENCE}))"]
    + [f"SELECT 'freshness', 'ingestion_delay_p95_seconds', v, {_THRESHOLD.format(v='v', w=900, c=1800)} FROM (SELECT p95_delay_seconds AS v FROM ({_DELAY}))"]
)


_GROWTH = "(mae - previous) / nullif(previous, 0)"
_PERFORMANCE = f"""SELECT 'performance' AS category, 'mae_vs_previous' AS metric_name, mae AS metric_value,
 CASE WHEN previous IS NULL OR previous <= 0 THEN 'unknown' WHEN {_GROWTH} > 0.20 THEN 'critical' WHEN {_GROWTH} > 0.10 THEN 'warning' ELSE 'stable' END AS severity
 FROM (SELECT mae, lead(mae) OVER w AS previous, row_number() OVER w AS n FROM ({_RUNS}) WINDOW w AS (PARTITION BY task, model_name, horizon ORDER BY recorded_at DESC, run_id DESC)) WHERE n = 1"""


@register("mon1", over("s", f"{_MON} UNION ALL {_PERFORMANCE}"), "metric_value")
def mon1(spark, d):
    s = sensor(spark, d).withColumn("hour_ts", F.date_trunc("hour", "event_time"))
    return M.daily(s, _as_of(), _MISSING, ["station_id", "hour_ts"], _snapshots(spark, d), exact=True).select("category", "metric_name", "metric_value", "severity")


@register("mon1_sketch", over("s", f"SELECT metric_name, CASE WHEN category = 'data_quality' THEN metric_value END AS metric_value, severity FROM ({_MON}) WHERE metric_name LIKE 'missing%' OR metric_name LIKE 'ingestion%'"), "metric_value")
def mon1_sketch(spark, d):
    """Of the percentile only the severity is compared: its value comes from the sketches."""
    out = M.sketched_metrics(_sketched(spark, d)[1].between(), _as_of(), _MISSING, _DELAYED)
    return out.select("metric_name", F.when(F.col("category") == "data_quality", F.col("metric_value")).alias("metric_value"), "severity")


_OUTSIDE = " UNION ALL ".join(f"SELECT 'out_of_range_rate_{c}' AS metric_name, avg(CASE WHEN {test} THEN 1.0 ELSE 0.0 END) FILTER ({c} IS NOT NULL) AS v FROM s" for c, test in (("humidity", "humidity < 5 OR humidity > 95"), ("pm25", "pm25 <= 1"), ("temperature_c", "temperature_c > 39")))


@register("mon1_ranges", over("s", f"SELECT metric_name, v AS metric_value, {_THRESHOLD.format(v='v', w=0.01, c=0.03)} AS severity FROM ({_OUTSIDE})"), "metric_value")
def mon1_ranges(spark, d):
    ranges = {"humidity": (5, 95, False), "pm25": (1, None, True), "temperature_c": (None, 39, False), "absent": (0, 1, False)}
    return M.range_metrics(sensor(spark, d), _as_of(), ranges).select("metric_name", "metric_value", "severity")


@register("con7_closed", over("s", "SELECT 'null_rate temperature_c' AS issue, 0 AS written_rows"))
def con7_closed(spark, d):
    """A contract that the view breaks closes the gate before the write: nothing is materialised, and the error says why."""
    out = VersionedTable(spark, scratch(spark, "con7"))
    contract = C.Contract({"station_id": ("string", False), "temperature_c": ("numeric", False)}, keys=["event_id"])
    issue = "none"
    try:
        out.append(C.gated(sensor(spark, d), contract))
    except ValueError as e:
        issue = " ".join(str(e).split("; ")[0].split()[:2])
    written = out.read().count() if out.version() else 0
    return table(spark, d, "events").limit(1).select(F.lit(issue).alias("issue"), F.lit(written).alias("written_rows"))


@register("ml6", over("s", f"SELECT task, model_name, horizon, run_id, mae, mae_high FROM ({_RUNS}) WHERE mae > 0 AND mae_high <= mae * 2.5"), "mae mae_high")
def ml6(spark, d):
    from ..ml.regression import promotable

    return promotable(_snapshots(spark, d), 2.5, "test")


# ---- sinks: written, then read back ----


def _written(spark, df, name, write):
    path = scratch(spark, name)
    write(df, path)
    return spark.read.parquet(path)




@register("snk1", over("j", "SELECT station_id, timestamp, CAST(extract(year FROM timestamp) AS INT) AS year, CAST(extract(month FROM timestamp) AS INT) AS month FROM j"))
def snk1(spark, d):
    rows = J.add_time_parts(station_hours(sensor(spark, d))).select("station_id", "timestamp", "year", "month")
    return _written(spark, rows, "snk1", sinks.write_features)


@register("snk2", over("j", "SELECT station_id, timestamp, CAST(extract(doy FROM timestamp) AS INT) AS day_of_year FROM j"))
def snk2(spark, d):
    rows = J.add_time_parts(station_hours(sensor(spark, d))).select("station_id", "timestamp", "year", "month", "day_of_year")
    return _written(spark, rows, "snk2", sinks.write_increment).select("station_id", "timestamp", "day_of_year")


@register("snk3", over("s", "SELECT event_id, region FROM s"))
def snk3(spark, d):
    return _written(spark, sensor(spark, d).select("event_id", "region"), "snk3", lambda df, p: sinks.write_dataset(df, p, by=["region"]))


@register("snk5", over("s", "SELECT event_id, station_id FROM s"))
def snk5(spark, d):
    return _written(spark, sensor(spark, d), "snk5", lambda df, p: sinks.write_documents(df, ["event_id", "absent", "station_id"], "parquet", {"path": p}))


_UPSERT = "SELECT station_id, hour_ts AS timestamp, CAST(max(event_id) AS BIGINT) AS event_id FROM (SELECT *, date_trunc('hour', event_time) AS hour_ts FROM s) GROUP BY 1, 2"


@register("snk6", over("s", f"SELECT station_id, timestamp, CAST(CASE WHEN event_id % 2 = 0 THEN -event_id ELSE event_id END AS BIGINT) AS event_id FROM ({_UPSERT})"))
def snk6(spark, d):
    s = sensor(spark, d).withColumn("timestamp", F.date_trunc("hour", "event_time"))
    old = s.groupBy("station_id", "timestamp").agg(F.max("event_id").alias("event_id")).withColumn("day", F.to_date("timestamp"))
    path = scratch(spark, "snk6")
    sinks.upsert(spark, old, path, ["day"], key=["station_id", "timestamp"])
    sinks.upsert(spark, old.filter("event_id % 2 = 0").withColumn("event_id", -F.col("event_id")), path, ["day"], key=["station_id", "timestamp"])
    return VersionedTable(spark, path).read().select("station_id", "timestamp", "event_id")


@register("snk7", over("s", "SELECT event_id, CASE WHEN temperature_c IS NOT NULL THEN station_id || '|' || CAST(event_id AS VARCHAR) WHEN pm25 IS NOT NULL THEN region || '|' || source ELSE sha256('{\"event_id\":' || event_id || '}') END AS k FROM s"))
def snk7(spark, d):
    s = sensor(spark, d)
    e = s.withColumns({"a": F.when(F.col("temperature_c").isNotNull(), F.col("station_id")), "b": F.when(F.col("pm25").isNotNull(), F.col("region"))})
    full = e.select("event_id", "a", "b", "source")
    digest = F.sha2(F.to_json(F.struct("event_id")), 256)
    return full.select("event_id", F.coalesce(F.when(F.col("a").isNotNull(), sinks.upsert_key(full, ["a", "event_id"], ["b", "source"])), F.when(F.col("b").isNotNull(), sinks.upsert_key(full, ["a", "event_id"], ["b", "source"])), digest).alias("k"))


@register("snk9", over("s", "SELECT event_id, 'region_' || region AS key, '{\"event_id\":' || event_id || ',\"region\":\"' || region || '\"}' AS value FROM s"))
def snk9(spark, d):
    path = scratch(spark, "snk9")
    sinks.publish(sensor(spark, d).select("event_id", "region"), "broker:9092", "alerts", fmt="parquet", options={"path": path})
    return spark.read.parquet(path).select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), "key", "value")


@register("snk11", over("s", "SELECT event_id, station_id FROM s"))
def snk11(spark, d):
    path = scratch(spark, "snk11")
    sinks.export_lines(sensor(spark, d).select("kafka_topic", "event_id", "station_id"), path, metadata=False)
    return spark.read.schema("event_id bigint, station_id string").json(path)


@register("snk12", over("s", f"SELECT model_name, horizon, CAST('mae' AS VARCHAR) AS metric_name, mae AS metric_value FROM ({_RUNS}) UNION ALL SELECT model_name, horizon, 'mae_high', mae_high FROM ({_RUNS})"), "metric_value")
def snk12(spark, d):
    return _written(spark, _snapshots(spark, d), "snk12", sinks.append_evaluation).select("model_name", "horizon", "metric_name", "metric_value")


@register("snk13", over("s", f"SELECT metric_name, metric_value, severity FROM ({_MON})"), "metric_value")
def snk13(spark, d):
    s = sensor(spark, d).withColumn("hour_ts", F.date_trunc("hour", "event_time"))
    rows = M.daily(s, _as_of(), _MISSING, ["station_id", "hour_ts"], exact=True)
    return _written(spark, rows, "snk13", sinks.append_metrics).select("metric_name", "metric_value", "severity")


@register("snk15", over("s", "SELECT event_id FROM s WHERE event_time >= (SELECT max(event_time) FROM s) - INTERVAL 48 HOUR"))
def snk15(spark, d):
    return sinks.retained(sensor(spark, d), 48, "event_time").select("event_id")
