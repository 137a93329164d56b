"""The sensor view over `events`, station tables built on it, and the registry of queries with their SQL."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.physics import add_physics, hour_bucket
from ..operators.filters import of_topic
from ..operators.joins import merge_station_hours
from ..operators.projections import add_time_parts, canonical_air, canonical_weather
from ..operators.windows import add_changes, forward_fill, one_per_key

#: The sensor view: expression and name. The text is read by Spark and by the oracle alike.
SENSOR = [
    ("event_id", "event_id"),
    ("CONCAT('st_', CAST(user_id % 10 AS STRING))", "station_id"),
    ("CONCAT('City ', CAST(user_id % 10 AS STRING))", "city"),
    ("CASE WHEN user_id % 10 < 4 THEN 'bac' WHEN user_id % 10 < 7 THEN 'trung' ELSE 'nam' END", "region"),
    ("CAST(9.0 + (user_id % 10) * 1.4 AS DOUBLE)", "latitude"),
    ("CAST(105.0 + (user_id % 10) * 0.4 AS DOUBLE)", "longitude"),
    ("CAST(ts AS TIMESTAMP)", "event_time"),
    ("event_type", "source"),
    ("CASE WHEN event_type IN ('view','click','signup') THEN 'weather.raw.stream' ELSE 'air_quality.raw.stream' END", "kafka_topic"),
    ("CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(8 + event_id % 33 AS DOUBLE) END", "temperature_c"),
    ("CAST(event_id % 101 AS DOUBLE)", "humidity"),
    ("CAST(995 + event_id % 30 AS DOUBLE)", "pressure_hpa"),
    ("CAST(event_id % 53 AS DOUBLE) / 2", "wind_speed_mps"),
    ("CAST(event_id % 360 AS DOUBLE)", "wind_direction_deg"),
    ("CASE WHEN event_id % 4 = 0 THEN value / 8 ELSE CAST(0 AS DOUBLE) END", "precipitation_mm"),
    ("CAST(event_id % 97 AS DOUBLE)", "cloud_cover_pct"),
    ("CAST(event_id % 900 AS DOUBLE)", "shortwave_radiation_wm2"),
    ("CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(10 + event_id % 25 AS DOUBLE) END", "soil_temperature_0_to_7cm_c"),
    ("CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END", "pm25"),
    ("value * 1.5E0", "aqi"),
    ("CAST(ts AS TIMESTAMP) + CAST(event_id % 40 AS INT) * INTERVAL '1' MINUTE", "ingestion_time"),
]
WEATHER_TOPIC, AIR_TOPIC = "weather.raw.stream", "air_quality.raw.stream"
KEYS = ["station_id", "hour_ts", "timestamp", "region", "city", "latitude", "longitude"]
AS_OF = "2024-02-01 00:00:00"
#: Unit of time that one task of a station's window holds at most.
BUCKET = "week"
TRAIN_END, VAL_END = "2024-01-20 23:00:00", "2024-01-25 23:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stations that the users of the events are dealt over; the SQL has 10.
STATIONS = 10


def sensors(events: DataFrame) -> DataFrame:
    own = {n: e.replace("user_id % 10", f"user_id % {STATIONS}") if n in ("station_id", "city") else e for e, n in SENSOR}
    return events.selectExpr(*[f"{e} AS {n}" for n, e in own.items()])


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors(table(spark, sf_dir, "events"))


def halves(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One weather and one air row per station and hour: the latest."""
    keyed = s.withColumns({"timestamp": F.col("event_time"), "hour_ts": hour_bucket(F.col("event_time"))})
    one = lambda topic: one_per_key(of_topic(keyed, topic), ["station_id", "hour_ts"], newest="timestamp")
    return canonical_weather(one(WEATHER_TOPIC), KEYS), canonical_air(one(AIR_TOPIC), KEYS)


def station_hours(s: DataFrame) -> DataFrame:
    weather, air = halves(s)
    side = air.select("station_id", "hour_ts", "timestamp", "pm2_5", "us_aqi", F.col("region").alias("_r"), F.col("city").alias("_c"))
    out = merge_station_hours(weather, side)
    return out.withColumns({"region": F.coalesce("region", "_r"), "city": F.coalesce("city", "_c")}).drop("_r", "_c")


def features(s: DataFrame) -> DataFrame:
    """Merge, time parts, forward fill, stateless features, moving features, in buckets of a station's history."""
    filled = forward_fill(add_time_parts(station_hours(s)), bucket=BUCKET)
    return add_changes(add_physics(filled), bucket=BUCKET)


_S = "SELECT " + ", ".join(f"{e} AS {n}" for e, n in SENSOR) + " FROM events"
_W = """SELECT station_id, date_trunc('hour', event_time) AS hour_ts, event_time AS timestamp, region, city, latitude, longitude,
 temperature_c AS temp_c, humidity, pressure_hpa AS pressure, wind_speed_mps AS wind_speed, wind_direction_deg AS wind_dir,
 precipitation_mm AS precipitation, cloud_cover_pct AS cloud_cover, shortwave_radiation_wm2 AS shortwave_radiation,
 soil_temperature_0_to_7cm_c AS soil_temperature FROM s WHERE kafka_topic = 'weather.raw.stream'
 QUALIFY row_number() OVER (PARTITION BY station_id, date_trunc('hour', event_time) ORDER BY event_time DESC, event_id DESC) = 1"""
_A = """SELECT station_id, date_trunc('hour', event_time) AS hour_ts, event_time AS timestamp, region, city, latitude, longitude,
 pm25 AS pm2_5, aqi AS us_aqi FROM s WHERE kafka_topic = 'air_quality.raw.stream'
 QUALIFY row_number() OVER (PARTITION BY station_id, date_trunc('hour', event_time) ORDER BY event_time DESC, event_id DESC) = 1"""
_MEASURES = "temp_c humidity pressure wind_speed wind_dir precipitation cloud_cover shortwave_radiation soil_temperature".split()
_J = f"""SELECT coalesce(w.station_id, a.station_id) AS station_id, coalesce(w.hour_ts, a.hour_ts) AS hour_ts, coalesce(w.timestamp, a.timestamp) AS timestamp,
 coalesce(w.region, a.region) AS region, coalesce(w.city, a.city) AS city, w.latitude, w.longitude, {', '.join('w.' + m for m in _MEASURES)}, a.pm2_5, a.us_aqi
 FROM w FULL OUTER JOIN a ON w.station_id = a.station_id AND w.hour_ts = a.hour_ts"""
_ALL = [*_MEASURES, "pm2_5", "us_aqi"]
_L = f"""SELECT * FROM (SELECT station_id, hour_ts, timestamp, region, city, latitude, longitude,
 CAST(extract(hour FROM timestamp) AS INT) AS hour, CAST(extract(month FROM timestamp) AS INT) AS month, CAST(extract(doy FROM timestamp) AS INT) AS day_of_year, CAST(extract(year FROM timestamp) AS INT) AS year,
 {', '.join(f'last_value({m} IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {m}' for m in _ALL)} FROM j)
 WHERE coalesce({', '.join(_ALL)}) IS NOT NULL"""
_P1 = """SELECT *, cos(radians(latitude)) * cos(radians(longitude)) AS coord_X, cos(radians(latitude)) * sin(radians(longitude)) AS coord_Y, sin(radians(latitude)) AS coord_Z,
 -wind_speed * sin(radians(wind_dir)) AS wind_U, -wind_speed * cos(radians(wind_dir)) AS wind_V,
 (pressure * 100) / nullif(287.05 * (temp_c + 273.15), 0) AS air_density,
 ln(CASE WHEN humidity <= 0 THEN 0.000001 ELSE humidity END / 100.0) + 17.625 * temp_c / (243.04 + temp_c) AS gamma,
 sin(hour * (2 * pi() / 24)) AS hour_sin, cos(hour * (2 * pi() / 24)) AS hour_cos, sin(day_of_year * (2 * pi() / 365)) AS day_sin, cos(day_of_year * (2 * pi() / 365)) AS day_cos,
 CASE WHEN wind_speed < 1.0 AND pressure > 1010 THEN 1 ELSE 0 END AS is_stagnant_air,
 CASE WHEN temp_c > 24 THEN temp_c - 24 ELSE 0.0::DOUBLE END AS cooling_degree_days FROM l"""
_P2 = "SELECT * EXCLUDE (gamma), 243.04 * gamma / nullif(17.625 - gamma, 0) AS dew_point FROM p1"
_P3 = "SELECT *, 6.112 * exp(17.67 * dew_point / (dew_point + 243.5)) AS vapour FROM p2"
_P = "SELECT * EXCLUDE (vapour), (temp_c + 273.15) * pow(1000.0 / nullif(pressure, 0), 0.286) * exp(2675.0 * (0.622 * vapour / nullif(pressure - vapour, 0)) / (dew_point + 273.15)) AS theta_e FROM p3"
_OVER = "OVER (PARTITION BY station_id ORDER BY timestamp"
_F = f"""SELECT *, pressure - lag(pressure, 3) {_OVER}) AS pressure_delta_3h, wind_U - lag(wind_U, 1) {_OVER}) AS wind_shear_U, wind_V - lag(wind_V, 1) {_OVER}) AS wind_shear_V,
 avg(temp_c) {_OVER} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS temp_mean_6h, sum(pm2_5) {_OVER} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS pm25_acc_12h FROM p"""
_CTES = {"s": _S, "w": _W, "a": _A, "j": _J, "l": _L, "p1": _P1, "p2": _P2, "p3": _P3, "p": _P, "f": _F}


def over(last: str, body: str) -> str:
    """SQL of `body` over the station tables up to `last`: s, w, a, j (merged), l (filled), p (physics), f (features)."""
    names = list(_CTES)
    return "WITH " + ", ".join(f"{n} AS ({_CTES[n]})" for n in names[: names.index(last) + 1]) + " " + body


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def settle(f: T.StructField) -> Column:
    """The column for comparison: doubles to six places, times without a zone."""
    c = F.col(f"`{f.name}`")
    if f.dataType == T.DoubleType():
        return F.round(c, 6) + F.lit(0.0)
    return c.cast("timestamp_ntz") if f.dataType == T.TimestampType() else c


def settled(df: DataFrame) -> DataFrame:
    return df.select(*[settle(f).alias(f.name) for f in df.schema.fields])


def register(name: str, sql: str | None = None, doubles: str = "", settle: bool = True) -> Callable:
    """Register a query; doubles names the columns of its SQL that are rounded like the query's own. settle=False: the query
    rounds them itself."""

    def keep(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = (lambda spark, sf_dir: settled(fn(spark, sf_dir))) if settle else fn
        if sql:
            rounded = ", ".join(f"round({d}, 6) + 0.0 AS {d}" for d in doubles.split())
            ORACLES[name] = f"SELECT * REPLACE ({rounded}) FROM ({sql})" if rounded else sql
        return fn

    return keep


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        if own.isDefined():
            root = own.get()
        elif not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:  # one machine, as in tests
            root = tempfile.mkdtemp(prefix="aeros-plans-")
            spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"
