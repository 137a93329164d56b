"""Queries of scans, normalisation, projections, filters, scalar features, codes and quality."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import normalize as N
from ..functions import physics as P
from ..functions import rules as R
from ..functions.catalog import locations, match_provider, place, region_of, select_locations
from ..operators import filters as X
from ..operators import projections as J
from ..operators import quality as Q
from ..operators.windows import split_repeats
from ..sources import readers
from ..sources.versions import VersionedTable
from .base import AIR_TOPIC, TRAIN_END, VAL_END, WEATHER_TOPIC, features, over, register, scratch, sensor, station_hours, table

# ---- scans ----


@register("src1", over("s", "SELECT event_id, event_time AS timestamp, lower(trim(city)) AS city_key, station_id FROM s"))
def src1(spark, d):
    text = sensor(spark, d).withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return readers.with_record_keys(text).select("event_id", "timestamp", "city_key", "station_id")


@register("src3", over("s", "SELECT kafka_topic, event_id, station_id, humidity FROM s"), "humidity")
def src3(spark, d):
    s = sensor(spark, d)
    wrapped = s.select("kafka_topic", F.struct("event_id", "station_id", "humidity").alias("value"))
    return readers.unwrap(wrapped)


@register("src6", "SELECT event_type AS kafka_topic, event_id AS kafka_offset, props AS value_json, props AS value_text FROM events")
def src6(spark, d):
    raw, path = table(spark, d, "events").select(F.col("event_type").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("props").alias("value")), scratch(spark, "src6")
    raw.write.partitionBy("topic").parquet(path)
    topics = [r["topic"] for r in raw.select("topic").distinct().collect()]
    return readers.kafka_batch(spark, "broker:9092", topics, fmt="parquet", options={"path": path}).select("kafka_topic", "kafka_offset", "value_json", "value_text")


@register("src7", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN props END AS value_json, CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 3 = 1 THEN 'raw ' || event_type END AS value_text FROM events")
def src7(spark, d):
    e = table(spark, d, "events")
    value = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("raw "), "event_type"))
    return e.select("event_id", *readers.decode(value))


@register("src8", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def src8(spark, d):
    return readers.dataset(spark, f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")


@register("src9", "SELECT count(*) AS n, count(DISTINCT event_id) AS keys FROM events")
def src9(spark, d):
    return readers.training_table(spark, f"{d}/events.parquet").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("keys"))


@register("src10", over("s", "SELECT event_id, CAST(extract(year FROM event_time) AS INT) AS year, CAST(extract(month FROM event_time) AS INT) AS month, CAST(extract(hour FROM event_time) AS INT) AS hour, CASE WHEN station_id IN ('st_0','st_1') THEN 'bac' WHEN station_id IN ('st_2','st_3') THEN 'trung' ELSE 'nam' END AS region, station_id AS city FROM s"))
def src10(spark, d):
    s = sensor(spark, d).select("event_id", "station_id", "event_time")
    return readers.prepare_features(s, "event_time", north=["st_0", "st_1"], centre=["st_2", "st_3"]).select("event_id", "year", "month", "hour", "region", "city")


@register("src11", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def src11(spark, d):
    """The records as exported lines: an object a line, read with a fixed schema."""
    path = scratch(spark, "src11")
    props = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"props":'), "props", F.lit("}"))
    table(spark, d, "events").select(props).write.text(path)
    schema = T._parse_datatype_string("event_id bigint, props struct<k: bigint>")
    return readers.records_for_check(spark, path, schema).select("event_id", "props.k")


@register("src12", "SELECT n_name AS city, CASE WHEN n_nationkey >= 18 THEN 'bac' WHEN n_nationkey >= 14 THEN 'trung' ELSE 'nam' END AS region, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def src12(spark, d):
    catalog = table(spark, d, "nation").select(F.col("n_name").alias("city"), region_of(F.col("n_nationkey")).alias("region"), "n_regionkey")
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return catalog.join(F.broadcast(regions), "n_regionkey").select("city", "region", "r_name")


@register("src13", over("s", "SELECT version, count(*) AS n FROM s, (VALUES (1), (2)) v(version) WHERE version = 2 OR event_id % 2 = 0 GROUP BY version"))
def src13(spark, d):
    """A table written twice: what each version holds, pinned by its number."""
    path = scratch(spark, "src13")
    e, versioned = table(spark, d, "events").select("event_id"), VersionedTable(spark, path)
    versions = []
    for part in (e.filter("event_id % 2 = 0"), e.filter("event_id % 2 <> 0")):
        versioned.append(part)
        versions.append(readers.dataset_version(spark, path))
    one = lambda v: versioned.read(v).agg(F.count("*").alias("n")).select(F.lit(v).cast("int").alias("version"), "n")
    return one(versions[0]).unionByName(one(versions[1]))


# ---- normalisation: payloads are made from the sensor view as JSON text ----

_CITY = "CASE event_id % 5 WHEN 0 THEN 'Hanoi' WHEN 1 THEN 'Ho Chi Minh City' WHEN 2 THEN 'Nowhere' WHEN 3 THEN 'hue' END"
_PLACED = """CASE event_id % 5 WHEN 0 THEN 'bac' WHEN 1 THEN 'nam' WHEN 3 THEN 'trung' ELSE CASE WHEN latitude >= 18 THEN 'bac' WHEN latitude >= 14 THEN 'trung' ELSE 'nam' END END AS region,
 CASE event_id % 5 WHEN 0 THEN 'Hanoi' WHEN 1 THEN 'HCMC' WHEN 2 THEN 'Nowhere' WHEN 3 THEN 'Hue' ELSE {none} END AS city,
 CASE event_id % 5 WHEN 0 THEN 21.0285 WHEN 1 THEN 10.7769 WHEN 3 THEN 16.4637 ELSE latitude END::DOUBLE AS latitude,
 CASE event_id % 5 WHEN 0 THEN 105.8542 WHEN 1 THEN 106.6964 WHEN 3 THEN 107.5909 ELSE longitude END::DOUBLE AS longitude"""
_ANCHOR = "CASE WHEN latitude >= 18 THEN 'Hanoi' WHEN latitude >= 14 THEN 'Da Nang' ELSE 'HCMC' END"
_COORDS = "latitude longitude"


def _with_city(spark, d):
    return sensor(spark, d).withColumn("city", F.expr(_CITY))


def _json(df, **fields):
    return df.select(F.to_json(F.struct(*[(c if not isinstance(c, str) else F.col(c)).alias(n) for n, c in fields.items()])).alias("payload"))


def _text(name):
    return F.col(name).cast("string")




def _iso():
    return F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")


_NRM_COLS = ["source", "region", "city", "latitude", "longitude", "event_time"]


@register(
    "nrm1",
    over("s", f"""SELECT 'open-meteo' AS source, {_PLACED.format(none="'Asia/Bangkok'")}, date_trunc('second', event_time) AS event_time, temperature_c, humidity, pressure_hpa,
      round(wind_speed_mps * 0.27778, 4) AS wind_speed_mps, precipitation_mm, soil_temperature_0_to_7cm_c,
      CASE event_id % 4 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Rain' WHEN 2 THEN 'Unknown' END AS weather_main,
      CASE event_id % 4 WHEN 0 THEN 'Clear sky' WHEN 1 THEN 'Moderate rain' WHEN 2 THEN 'Unknown weather condition' END AS weather_desc FROM s"""),
    f"{_COORDS} temperature_c humidity pressure_hpa wind_speed_mps precipitation_mm soil_temperature_0_to_7cm_c",
)
def nrm1(spark, d):
    s = _with_city(spark, d)
    code = F.expr("CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 63 WHEN 2 THEN 7 END")
    current = F.struct(_iso().alias("time"), _text("temperature_c").alias("temperature_2m"), F.col("humidity").alias("relative_humidity_2m"), F.col("pressure_hpa").alias("pressure_msl"), F.col("wind_speed_mps").alias("wind_speed_10m"), F.col("precipitation_mm").alias("precipitation"), F.col("soil_temperature_0_to_7cm_c").alias("soil_temperature_0_to_10cm"), code.alias("weather_code"))
    payload = _json(s, city="city", latitude="latitude", longitude="longitude", timezone=F.lit("Asia/Bangkok"), current=current)
    return N.open_meteo_weather(payload, locations(spark), defaults=False).select(*_NRM_COLS, "temperature_c", "humidity", "pressure_hpa", "wind_speed_mps", "precipitation_mm", "soil_temperature_0_to_7cm_c", "weather_main", "weather_desc")


@register(
    "nrm2",
    over("s", f"""SELECT 'openweathermap' AS source, {_PLACED.format(none=_ANCHOR)}, date_trunc('second', event_time) AS event_time, temperature_c, humidity, pressure_hpa, pressure_hpa AS surface_pressure_hpa,
      wind_speed_mps, precipitation_mm, cloud_cover_pct, CASE WHEN event_id % 2 = 0 THEN 'Clouds' END AS weather_main FROM s"""),
    f"{_COORDS} temperature_c humidity pressure_hpa surface_pressure_hpa wind_speed_mps precipitation_mm cloud_cover_pct",
)
def nrm2(spark, d):
    s = _with_city(spark, d)
    sky = F.when(F.col("event_id") % 2 == 0, F.array(F.struct(F.lit("Clouds").alias("main"), F.lit("few").alias("description"))))
    rain = F.when(F.col("event_id") % 3 == 0, F.struct(F.col("precipitation_mm").alias("1h"), F.lit(None).cast("double").alias("3h"))).otherwise(F.struct(F.lit(None).cast("double").alias("1h"), F.col("precipitation_mm").alias("3h")))
    payload = _json(s, name="city", dt=F.unix_timestamp("event_time"), coord=F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")), main=F.struct(F.col("temperature_c").alias("temp"), "humidity", F.col("pressure_hpa").alias("pressure")), wind=F.struct(F.col("wind_speed_mps").alias("speed")), rain=rain, clouds=F.struct(F.col("cloud_cover_pct").alias("all")), weather=sky)
    return N.open_weather_weather(payload, locations(spark), defaults=False).select(*_NRM_COLS, "temperature_c", "humidity", "pressure_hpa", "surface_pressure_hpa", "wind_speed_mps", "precipitation_mm", "cloud_cover_pct", "weather_main")


_LEVEL = "CASE WHEN aqi IS NULL THEN NULL WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate' WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN aqi <= 200 THEN 'Unhealthy' WHEN aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END"
_AIR = "aqi, quality_level, pm25, pm10"


@register(
    "nrm3",
    over("s", f"SELECT 'aqicn' AS source, {_PLACED.format(none=_ANCHOR)}, date_trunc('second', event_time) AS event_time, CAST(event_id AS VARCHAR) AS station_id, aqi, {_LEVEL} AS quality_level, pm25, CAST(NULL AS DOUBLE) AS pm10 FROM (SELECT * REPLACE (CASE WHEN event_id % 6 = 0 THEN NULL ELSE aqi END AS aqi) FROM s)"),
    f"{_COORDS} aqi pm25 pm10",
)
def nrm3(spark, d):
    s = _with_city(spark, d)
    aqi = F.when(F.col("event_id") % 6 == 0, F.lit("-")).otherwise(_text("aqi"))
    data = F.struct(F.col("event_id").alias("idx"), aqi.alias("aqi"), F.struct(F.col("city").alias("name"), F.array("latitude", "longitude").alias("geo")).alias("city"), F.struct(F.concat(_iso(), F.lit("Z")).alias("iso")).alias("time"), F.struct(F.struct(F.col("pm25").alias("v")).alias("pm25")).alias("iaqi"))
    return N.aqicn_air(_json(s, data=data), locations(spark), defaults=False).select(*_NRM_COLS, "station_id", "aqi", "quality_level", "pm25", "pm10")


@register(
    "nrm4",
    over("s", f"SELECT 'iqair' AS source, {_PLACED.format(none=_ANCHOR)}, date_trunc('second', event_time) AS event_time, 'iqair_station' AS station_id, aqi, {_LEVEL} AS quality_level, pm25 FROM s"),
    f"{_COORDS} aqi pm25",
)
def nrm4(spark, d):
    s = _with_city(spark, d)
    iso = F.concat(F.date_format(F.col("event_time") + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))
    current = F.struct(F.struct(iso.alias("ts"), F.col("aqi").alias("aqius"), "pm25").alias("pollution"))
    return N.iqair_air(_json(s, city="city", latitude="latitude", longitude="longitude", current=current), locations(spark), defaults=False).select(*_NRM_COLS, "station_id", "aqi", "quality_level", "pm25")


@register(
    "nrm5",
    over("s", f"SELECT 'open-meteo' AS source, {_PLACED.format(none=_ANCHOR)}, date_trunc('second', event_time) - INTERVAL 7 HOUR AS event_time, aqi, {_LEVEL} AS quality_level, pm25, humidity AS co, wind_speed_mps AS no2 FROM s"),
    f"{_COORDS} aqi pm25 co no2",
)
def nrm5(spark, d):
    s = _with_city(spark, d)
    current = F.struct(_iso().alias("time"), F.col("aqi").alias("us_aqi"), F.col("pm25").alias("pm2_5"), F.col("humidity").alias("carbon_monoxide"), F.col("wind_speed_mps").alias("no2"))
    return N.open_meteo_air(_json(s, city="city", latitude="latitude", longitude="longitude", current=current), locations(spark), source_tz="Asia/Bangkok", defaults=False).select(*_NRM_COLS, "aqi", "quality_level", "pm25", "co", "no2")


@register(
    "nrm6",
    over("s", f"SELECT 'openweathermap' AS source, {_PLACED.format(none=_ANCHOR)}, date_trunc('second', event_time) AS event_time, CAST(event_id % 7 AS DOUBLE) AS aqi, CASE event_id % 7 WHEN 1 THEN 'Good' WHEN 2 THEN 'Fair' WHEN 3 THEN 'Moderate' WHEN 4 THEN 'Poor' WHEN 5 THEN 'Very Poor' ELSE 'Unknown' END AS quality_level, pm25 FROM s"),
    f"{_COORDS} aqi pm25",
)
def nrm6(spark, d):
    s = _with_city(spark, d)
    item = F.struct(F.unix_timestamp("event_time").alias("dt"), F.struct((F.col("event_id") % 7).alias("aqi")).alias("main"), F.struct(F.col("pm25").alias("pm2_5")).alias("components"))
    return N.open_weather_air(_json(s, city="city", lat="latitude", lon="longitude", list=F.array(item)), locations(spark), defaults=False).select(*_NRM_COLS, "aqi", "quality_level", "pm25")


@register("nrm7", over("s", "SELECT event_id, round(wind_speed_mps * 0.27778, 4) AS mps FROM s"), "mps")
def nrm7(spark, d):
    return sensor(spark, d).select("event_id", N.kmh_to_mps(F.col("wind_speed_mps")).alias("mps"))


@register("nrm8", over("s", "SELECT event_id, CASE WHEN latitude >= 18 THEN 'bac' WHEN latitude >= 14 THEN 'trung' ELSE 'nam' END AS region FROM s"))
def nrm8(spark, d):
    return sensor(spark, d).select("event_id", region_of(F.col("latitude")).alias("region"))


@register("nrm9", over("s", f"SELECT event_id, {_PLACED.format(none=_ANCHOR)} FROM s"), _COORDS)
def nrm9(spark, d):
    return place(_with_city(spark, d).select("event_id", "city", "latitude", "longitude"), locations(spark)).select("event_id", "region", "city", "latitude", "longitude")


@register("nrm10", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Rain' WHEN 2 THEN 'Unknown' END AS weather_main, CASE event_id % 4 WHEN 0 THEN 'Clear sky' WHEN 1 THEN 'Violent rain showers' WHEN 2 THEN 'Unknown weather condition' END AS weather_desc FROM events")
def nrm10(spark, d):
    e = table(spark, d, "events").select("event_id", F.expr("CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 82 WHEN 2 THEN 100 END").alias("weather_code"))
    return N.with_weather_text(e).select("event_id", "weather_main", "weather_desc")


@register("nrm11", over("s", f"SELECT event_id, {_LEVEL} AS level FROM s"))
def nrm11(spark, d):
    return sensor(spark, d).select("event_id", N.aqi_level(F.col("aqi")).alias("level"))


@register("nrm12", "SELECT event_id, CASE event_id % 7 WHEN 1 THEN 'Good' WHEN 2 THEN 'Fair' WHEN 3 THEN 'Moderate' WHEN 4 THEN 'Poor' WHEN 5 THEN 'Very Poor' ELSE 'Unknown' END AS level FROM events")
def nrm12(spark, d):
    return table(spark, d, "events").select("event_id", N.owm_aqi_level((F.col("event_id") % 7).cast("double")).alias("level"))


@register("nrm13", "SELECT event_id, CASE WHEN event_id % 5 < 4 THEN date_trunc('second', CAST(ts AS TIMESTAMP)) END AS event_time FROM events")
def nrm13(spark, d):
    s = sensor(spark, d)
    forms = [F.unix_timestamp("event_time").cast("string"), F.concat(_iso(), F.lit("Z")), F.concat(F.date_format(F.col("event_time") - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")), _iso(), F.lit("")]
    text = F.element_at(F.array(*forms), (F.col("event_id") % 5 + 1).cast("int"))
    return s.select("event_id", N.parse_time(text).alias("event_time"))


@register("nrm14", over("s", "SELECT event_id, 'open-meteo_' || replace(lower(city), ' ', '_') AS station FROM s"))
def nrm14(spark, d):
    return sensor(spark, d).select("event_id", N.station_id(F.lit("open-meteo"), F.col("city")).alias("station"))


@register("nrm15", "SELECT count(*) AS n, count(*) AS with_id, count(*) AS with_time, 'v1' AS data_version FROM events")
def nrm15(spark, d):
    out = N.with_defaults(table(spark, d, "events").select("value"))
    return out.agg(F.count("*").alias("n"), F.count("event_id").alias("with_id"), F.count("ingestion_time").alias("with_time"), F.max("data_version").alias("data_version"))


@register("nrm16", over("s", "SELECT event_id, 'p' AS pipeline_name, 'b1' AS batch_id, 'e' AS source_endpoint, 'success' AS ingestion_status, 'region_' || region AS partition_key FROM s"))
def nrm16(spark, d):
    return N.with_metadata(sensor(spark, d), "p", "b1", "e").select("event_id", "pipeline_name", "batch_id", "source_endpoint", "ingestion_status", "partition_key")


@register("nrm17", over("s", """SELECT city, event_time, temperature_2m, precipitation FROM (
    SELECT station_id AS city, hour_ts AS event_time, temp_c AS temperature_2m, CASE WHEN row_number() OVER (PARTITION BY station_id ORDER BY hour_ts) <= 5 THEN pressure END AS precipitation
    FROM (SELECT station_id, date_trunc('hour', event_time) AS hour_ts, max(temperature_c) AS temp_c, max(pressure_hpa) AS pressure FROM s GROUP BY ALL))"""), "temperature_2m precipitation")
def nrm17(spark, d):
    hours = sensor(spark, d).groupBy("station_id", F.date_trunc("hour", "event_time").alias("h")).agg(F.max("temperature_c").alias("t"), F.max("pressure_hpa").alias("p"))
    rows = F.array_sort(F.collect_list(F.struct("h", "t", "p")))
    arrays = hours.groupBy("station_id").agg(rows.alias("r"))
    hourly = F.struct(F.transform("r", lambda x: F.date_format(x["h"], "yyyy-MM-dd'T'HH:mm")).alias("time"), F.transform("r", lambda x: x["t"]).alias("temperature_2m"), F.slice(F.transform("r", lambda x: x["p"]), 1, 5).alias("precipitation"))
    payload = arrays.select(F.col("station_id").alias("city"), F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"}).alias("payload"))
    return N.explode_hourly(payload).select("city", "event_time", "temperature_2m", "precipitation")


# ---- projections ----

_WEATHER = "temperature_c AS temp_c, humidity, pressure_hpa AS pressure, wind_speed_mps AS wind_speed, wind_direction_deg AS wind_dir, precipitation_mm AS precipitation, cloud_cover_pct AS cloud_cover, shortwave_radiation_wm2 AS shortwave_radiation, soil_temperature_0_to_7cm_c AS soil_temperature"
_W_NAMES = "temp_c humidity pressure wind_speed wind_dir precipitation cloud_cover shortwave_radiation soil_temperature"


@register("prj1", over("s", f"SELECT event_id, station_id, {_WEATHER} FROM s"), _W_NAMES)
def prj1(spark, d):
    return J.canonical_weather(sensor(spark, d), ["event_id", "station_id"])


@register("prj2", over("s", "SELECT event_id, station_id, pm25 AS pm2_5, aqi AS us_aqi FROM s"), "pm2_5 us_aqi")
def prj2(spark, d):
    return J.canonical_air(sensor(spark, d), ["event_id", "station_id"])


@register("prj3", over("s", f"SELECT event_id, {_WEATHER.replace('cloud_cover_pct AS', 'CAST(NULL AS DOUBLE) AS')} FROM s"), _W_NAMES)
def prj3(spark, d):
    return J.canonical_weather(sensor(spark, d).drop("cloud_cover_pct"), ["event_id"])


@register("prj4", over("s", "SELECT event_id, humidity, CAST(NULL AS DOUBLE) AS no2 FROM s"), "humidity no2")
def prj4(spark, d):
    s = sensor(spark, d)
    return s.select("event_id", J.col_or_null(s, "humidity"), J.col_or_null(s, "no2"))


@register("prj5", over("s", "SELECT event_id, lower(trim('  ' || city || ' ')) AS city_key FROM s"))
def prj5(spark, d):
    return sensor(spark, d).select("event_id", J.city_key(F.concat(F.lit("  "), "city", F.lit(" "))).alias("city_key"))


@register("prj6", over("j", "SELECT station_id, hour_ts, coalesce(wind_dir, 0) AS wind_dir, coalesce(precipitation, 0) AS precipitation, coalesce(cloud_cover, 0) AS cloud_cover, coalesce(shortwave_radiation, 0) AS shortwave_radiation, coalesce(soil_temperature, temp_c) AS soil_temperature, 0.0::DOUBLE AS elevation FROM j"), "wind_dir precipitation cloud_cover shortwave_radiation soil_temperature elevation")
def prj6(spark, d):
    out = J.fill_defaults(station_hours(sensor(spark, d)))
    return out.select("station_id", "hour_ts", "wind_dir", "precipitation", "cloud_cover", "shortwave_radiation", "soil_temperature", "elevation")


@register("prj7", over("s", "SELECT event_id, CAST(extract(hour FROM event_time) AS INT) AS hour, CAST(extract(month FROM event_time) AS INT) AS month, CAST(extract(doy FROM event_time) AS INT) AS day_of_year, CAST(extract(year FROM event_time) AS INT) AS year FROM s"))
def prj7(spark, d):
    return J.add_time_parts(sensor(spark, d), "event_time").select("event_id", "hour", "month", "day_of_year", "year")


@register("prj8", over("a", "SELECT coalesce(w.station_id, a.station_id) AS station_id, coalesce(w.region, a.region, 'unknown') AS region, coalesce(w.timestamp, a.timestamp) AS timestamp FROM w FULL OUTER JOIN a ON w.station_id = a.station_id AND w.hour_ts = a.hour_ts"))
def prj8(spark, d):
    from .base import halves

    w, a = halves(sensor(spark, d))
    w, a = (x.select(*[F.col(c).alias(f"{p}_{c}") for c in ("station_id", "hour_ts", "region", "timestamp")]) for x, p in ((w, "w"), (a, "a")))
    both = w.join(a, (F.col("w_station_id") == F.col("a_station_id")) & (F.col("w_hour_ts") == F.col("a_hour_ts")), "full_outer")
    names = ["station_id", "region", "timestamp"]
    return J.unify_keys(both, {n: f"w_{n}" for n in names}, {n: f"a_{n}" for n in names}, ("region",)).select(*names)


@register("prj9", over("f", "SELECT station_id, timestamp, temp_c, pm25_acc_12h FROM f"), "temp_c pm25_acc_12h")
def prj9(spark, d):
    return J.existing(features(sensor(spark, d)), ["station_id", "timestamp", "absent", "temp_c", "pm25_acc_12h"])


@register("prj10", over("s", "SELECT event_id, CASE WHEN station_id IN ('st_0', 'st_1') THEN 'bac' WHEN station_id = 'st_2' THEN 'trung' ELSE 'nam' END AS region FROM s"))
def prj10(spark, d):
    return J.region_from_station(sensor(spark, d).drop("region"), ["st_0", "st_1"], ["st_2"]).select("event_id", "region")


_TARGET = "lead(pm2_5, 1) OVER (PARTITION BY station_id ORDER BY timestamp)"


def _targets(spark, d):
    from ..operators.windows import add_targets

    return add_targets(features(sensor(spark, d)), (1, 2))


@register("prj11", over("f", f"SELECT station_id, timestamp, region, city, temp_c, humidity, {_TARGET} AS target_pm25_1h FROM f"), "temp_c humidity target_pm25_1h")
def prj11(spark, d):
    return J.for_training(_targets(spark, d), "target_pm25_1h", ["temp_c", "humidity"])


@register("prj12", over("f", f"SELECT station_id, timestamp, CASE WHEN {_TARGET} >= 35 THEN 1 ELSE 0 END AS target_alert_1h FROM f"))
def prj12(spark, d):
    return J.add_alert_target(_targets(spark, d)).select("station_id", "timestamp", "target_alert_1h")


@register("prj15", over("s", "SELECT event_id, CAST(3 AS INTEGER) AS horizon, TIMESTAMP '2024-02-01 00:00:00' AS prediction_time, DATE '2024-02-01' AS prediction_date, 'pm25_h3' AS model_name, '7' AS model_version, 'b' AS batch_id FROM s"))
def prj15(spark, d):
    out = J.stamp(sensor(spark, d).select("event_id"), 3, "models:/pm25_h3/7", "7", "b", F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    return out


@register("prj17", over("s", "SELECT CAST(event_id AS DOUBLE) AS event_id, station_id, humidity FROM s"), "event_id humidity")
def prj17(spark, d):
    return J.numeric_to_double(sensor(spark, d).select("event_id", "station_id", "humidity"))


@register("prj18", over("s", "SELECT event_id, station_id, 'unknown' AS region, station_id AS city FROM s"))
def prj18(spark, d):
    return J.ensure_place(sensor(spark, d).select("event_id", "station_id"))


# ---- filters ----


@register("flt1", over("s", "SELECT event_id, temperature_c FROM s WHERE kafka_topic = 'weather.raw.stream' OR temperature_c IS NOT NULL OR pressure_hpa IS NOT NULL"), "temperature_c")
def flt1(spark, d):
    return X.weather_rows(sensor(spark, d)).select("event_id", "temperature_c")


@register("flt2", over("s", "SELECT event_id, pm25 FROM (SELECT * EXCLUDE (aqi) FROM s) WHERE kafka_topic = 'air_quality.raw.stream' OR pm25 IS NOT NULL"), "pm25")
def flt2(spark, d):
    return X.air_rows(sensor(spark, d).drop("aqi")).select("event_id", "pm25")


@register("flt3", over("s", "SELECT event_id FROM s WHERE kafka_topic = 'weather.raw.stream'"))
def flt3(spark, d):
    return X.of_pipeline(sensor(spark, d).withColumnRenamed("kafka_topic", "pipeline_name"), WEATHER_TOPIC).select("event_id")


@register("flt4", over("s", "SELECT event_id FROM s WHERE contains(kafka_topic, 'air')"))
def flt4(spark, d):
    return X.mentions(sensor(spark, d), "air", "kafka_topic").select("event_id")


@register("flt5", over("s", "SELECT event_id FROM s WHERE kafka_topic = 'air_quality.raw.stream'"))
def flt5(spark, d):
    return X.of_topic(sensor(spark, d), AIR_TOPIC).select("event_id")


@register("flt6", over("s", "SELECT event_id, event_time FROM s WHERE CAST(event_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10'"))
def flt6(spark, d):
    return X.in_dates(sensor(spark, d), "2024-01-05", "2024-01-10", "event_time").select("event_id", "event_time")


@register("flt7", over("s", "SELECT event_id, temperature_c, pm25 FROM s WHERE temperature_c IS NOT NULL AND pm25 IS NOT NULL"), "temperature_c pm25")
def flt7(spark, d):
    return X.with_keys(sensor(spark, d), ["temperature_c", "pm25"]).select("event_id", "temperature_c", "pm25")


@register("flt8", over("s", "SELECT event_id FROM s WHERE temperature_c IS NOT NULL OR soil_temperature_0_to_7cm_c IS NOT NULL"))
def flt8(spark, d):
    return X.any_sensor(sensor(spark, d), ["temperature_c", "soil_temperature_0_to_7cm_c"]).select("event_id")


@register("flt9", over("s", f"SELECT event_id, CASE WHEN event_time <= TIMESTAMP '{TRAIN_END}' THEN 'train' WHEN event_time <= TIMESTAMP '{VAL_END}' THEN 'val' ELSE 'test' END AS split FROM s"))
def flt9(spark, d):
    parts = X.time_split(sensor(spark, d), TRAIN_END, VAL_END, "event_time")
    train, val, test = (p.select("event_id", F.lit(n).alias("split")) for p, n in zip(parts, ("train", "val", "test")))
    return train.unionByName(val).unionByName(test)


@register("flt10", over("s", "SELECT event_id, pm25 FROM s WHERE pm25 IS NOT NULL"), "pm25")
def flt10(spark, d):
    return X.training_rows(sensor(spark, d), "pm25", "event_time").select("event_id", "pm25")


_SEEN = "SELECT city, max(event_time) AS last_event_time FROM s WHERE event_time <= TIMESTAMP '2024-01-15 00:00:00' AND city <> 'City 3' GROUP BY city"


@register("flt11", over("s", f"SELECT event_id, city FROM s LEFT JOIN ({_SEEN}) USING (city) WHERE last_event_time IS NULL OR event_time > last_event_time"))
def flt11(spark, d):
    s = sensor(spark, d)
    seen = X.update_seen(s.filter("event_time <= '2024-01-15 00:00:00' AND city <> 'City 3'"))
    return X.newer_than_seen(s, seen).select("event_id", "city")


@register("flt12", over("s", "SELECT city, max(event_time) AS last_event_time, arg_max(event_id, (event_time, event_id)) AS last_id FROM s GROUP BY city"))
def flt12(spark, d):
    return X.update_seen(sensor(spark, d))


@register("flt13", "SELECT n_name AS city, CAST(n_nationkey AS VARCHAR) AS alias FROM nation WHERE lower(n_name) IN (SELECT lower(n_name) FROM nation WHERE n_nationkey = 2) OR n_nationkey = 7")
def flt13(spark, d):
    catalog = table(spark, d, "nation").select(F.col("n_name").alias("city"), F.col("n_nationkey").cast("string").alias("alias"))
    second = catalog.filter("alias = '2'").first()["city"]
    return select_locations(catalog, [second.upper(), "7"])


@register("flt14", over("s", "SELECT event_id, pm25 FROM s WHERE pm25 >= 75"), "pm25")
def flt14(spark, d):
    return X.at_least(sensor(spark, d), "pm25", 75.0).select("event_id", "pm25")


@register("flt15", over("s", "SELECT event_id, region FROM s WHERE region NOT IN ('bac', 'nam')"))
def flt15(spark, d):
    return X.outside_regions(sensor(spark, d), ["bac", "nam"]).select("event_id", "region")


@register("flt16", over("s", "SELECT event_id FROM s WHERE event_time >= (SELECT max(event_time) FROM s) - INTERVAL 7 DAY"))
def flt16(spark, d):
    return X.trailing(sensor(spark, d), "7 DAYS").select("event_id")


# ---- scalar features ----


def _scalar(name: str, columns: str, doubles: str | None = None):
    names = columns.split()

    @register(name, over("p", f"SELECT station_id, timestamp, {', '.join(names)} FROM p"), columns if doubles is None else doubles)
    def run(spark, d):
        from ..operators.windows import forward_fill

        filled = forward_fill(J.add_time_parts(station_hours(sensor(spark, d))))
        return P.add_physics(filled).select("station_id", "timestamp", *names)

    return run


_scalar("sca1", "coord_X coord_Y coord_Z")
_scalar("sca2", "wind_U wind_V")
_scalar("sca3", "air_density")
_scalar("sca5", "dew_point")
_scalar("sca7", "hour_sin hour_cos")
_scalar("sca8", "day_sin day_cos")
_scalar("sca9", "is_stagnant_air", "")
_scalar("sca10", "cooling_degree_days")


@register("sca4", over("s", "SELECT event_id, 243.04 * g / (17.625 - g) AS dew_point FROM (SELECT event_id, CASE WHEN humidity > 0 THEN ln(CASE WHEN humidity > 0 THEN humidity END / 100.0) END + 17.625 * temperature_c / (243.04 + temperature_c) AS g FROM s)"), "dew_point")
def sca4(spark, d):
    return sensor(spark, d).select("event_id", P.dew_point(F.col("temperature_c"), F.col("humidity"), floor=False).alias("dew_point"))


@register("sca6", over("p3", "SELECT station_id, timestamp, vapour, 0.622 * vapour / nullif(pressure - vapour, 0) AS mixing, (temp_c + 273.15) * pow(1000.0 / pressure, 0.286) AS theta, (temp_c + 273.15) * pow(1000.0 / pressure, 0.286) * exp(2675.0 * (0.622 * vapour / nullif(pressure - vapour, 0)) / (dew_point + 273.15)) AS theta_e FROM p3"), "vapour mixing theta theta_e")
def sca6(spark, d):
    from ..operators.windows import forward_fill

    p = P.add_physics(forward_fill(J.add_time_parts(station_hours(sensor(spark, d)))))
    dew, pressure, temp = F.col("dew_point"), F.col("pressure"), F.col("temp_c")
    return p.select("station_id", "timestamp", P.vapour_pressure(dew).alias("vapour"), P.mixing_ratio(dew, pressure).alias("mixing"), P.potential_temperature(temp, pressure).alias("theta"), "theta_e")


@register("sca11", over("p", "SELECT station_id, timestamp, theta_e, hour_cos, 0.0::DOUBLE AS pressure_delta_3h, temp_c AS temp_mean_6h, pm2_5 AS pm25_acc_12h FROM p"), "theta_e hour_cos pressure_delta_3h temp_mean_6h pm25_acc_12h")
def sca11(spark, d):
    from ..operators.windows import forward_fill

    out = P.add_realtime_features(forward_fill(station_hours(sensor(spark, d))))
    return out.select("station_id", "timestamp", "theta_e", "hour_cos", "pressure_delta_3h", "temp_mean_6h", "pm25_acc_12h")


@register("sca13", over("s", "SELECT event_id, date_trunc('hour', event_time) AS hour_ts FROM s"))
def sca13(spark, d):
    return sensor(spark, d).select("event_id", P.hour_bucket(F.col("event_time")).alias("hour_ts"))


# ---- codes and severities ----

_PRED = "temperature_c AS pred_temp, precipitation_mm AS pred_precipitation, wind_speed_mps AS pred_wind_speed, cloud_cover_pct AS pred_cloud_cover, pm25 AS pred_pm25, shortwave_radiation_wm2 AS pred_solar_rad, humidity / 100 AS pred_storm_prob, humidity / 200 AS pred_inversion"
_CODES = {
    "rul1": ("Temp_Code", "CASE WHEN pred_temp >= 40 THEN 6 WHEN pred_temp >= 37 THEN 5 WHEN pred_temp >= 35 THEN 4 WHEN pred_temp <= 13 THEN 3 WHEN pred_temp <= 15 THEN 2 ELSE 1 END"),
    "rul2": ("Rain_Code", "CASE WHEN pred_precipitation > 50 THEN 5 WHEN pred_precipitation >= 7.6 THEN 4 WHEN pred_precipitation >= 2.6 THEN 3 WHEN pred_precipitation >= 0.1 THEN 2 ELSE 1 END"),
    "rul3": ("Wind_Code", "CASE WHEN pred_wind_speed > 20.7 THEN 5 WHEN pred_wind_speed >= 17.2 THEN 4 WHEN pred_wind_speed >= 13.9 THEN 3 WHEN pred_wind_speed >= 10.8 THEN 2 ELSE 1 END"),
    "rul4": ("Cloud_Code", "CASE WHEN pred_cloud_cover > 70 THEN 4 WHEN pred_cloud_cover >= 41 THEN 3 WHEN pred_cloud_cover >= 11 THEN 2 ELSE 1 END"),
    "rul5": ("PM25_Code", "CASE WHEN pred_pm25 > 150.4 THEN 5 WHEN pred_pm25 >= 55.5 THEN 4 WHEN pred_pm25 >= 35.5 THEN 3 WHEN pred_pm25 >= 12.1 THEN 2 ELSE 1 END"),
    "rul6": ("Solar_Code", "CASE WHEN pred_solar_rad > 0 THEN 1 ELSE 0 END"),
    "rul7": ("Alert_Thunderstorm", "CASE WHEN pred_precipitation > 0 AND pred_wind_speed >= 10.8 THEN 1 ELSE 0 END"),
    "rul8": ("Alert_Storm_Prob, Alert_Inversion", "CASE WHEN pred_storm_prob > 0.3 THEN 1 ELSE 0 END AS Alert_Storm_Prob, CASE WHEN pred_inversion > 0.5 THEN 1 ELSE 0 END"),
}


def _code(name: str, columns: str, case: str):
    names = columns.split(", ")

    @register(name, over("s", f"SELECT event_id, {case} AS {names[-1]} FROM (SELECT event_id, {_PRED} FROM s)"))
    def run(spark, d):
        return R.add_codes(sensor(spark, d).selectExpr("event_id", *_PRED.split(", "))).select("event_id", *names)


for _name, (_columns, _case) in _CODES.items():
    _code(_name, _columns, _case)


@register("sev1", over("s", "SELECT event_id, CASE WHEN aqi >= 150 THEN 'critical' WHEN aqi >= 75 THEN 'warning' ELSE 'stable' END AS severity FROM s"))
def sev1(spark, d):
    return sensor(spark, d).select("event_id", R.severity(F.col("aqi"), 75, 150).alias("severity"))


@register("sev2", over("s", "SELECT event_id, CASE WHEN humidity / 300 < 0.1 THEN 'stable' WHEN humidity / 300 < 0.25 THEN 'warning' ELSE 'critical' END AS status FROM s"))
def sev2(spark, d):
    return sensor(spark, d).select("event_id", R.psi_status(F.col("humidity") / 300).alias("status"))


@register("sev3", over("s", "SELECT event_id, CASE WHEN temperature_c IS NULL OR humidity <= 0 THEN 'unknown' WHEN (temperature_c - humidity) / humidity > 0.2 THEN 'critical' WHEN (temperature_c - humidity) / humidity > 0.1 THEN 'warning' ELSE 'stable' END AS status FROM s"))
def sev3(spark, d):
    return sensor(spark, d).select("event_id", R.mae_drift_status(F.col("temperature_c"), F.col("humidity")).alias("status"))


# ---- quality: the view with values out of range ----

_BAD = "SELECT * REPLACE (CASE WHEN event_id % 17 = 0 THEN -5 ELSE pm25 END AS pm25, humidity + 40 AS humidity, CASE WHEN event_id % 19 = 0 THEN '' ELSE city END AS city) FROM s"


def _bad(spark, d):
    return sensor(spark, d).withColumns({"pm25": F.expr("CASE WHEN event_id % 17 = 0 THEN -5 ELSE pm25 END"), "humidity": F.col("humidity") + 40, "city": F.expr("CASE WHEN event_id % 19 = 0 THEN '' ELSE city END")})


_WEATHER_ERRORS = "concat_ws('; ', CASE WHEN city = '' THEN 'city is required' END, CASE WHEN humidity > 100 THEN 'humidity must be <= 100' END)"
_AIR_ERRORS = "concat_ws('; ', CASE WHEN city = '' THEN 'city is required' END, CASE WHEN pm25 < 0 THEN 'pm25 must be >= 0' END)"


@register("qua1", over("s", f"SELECT event_id, CASE WHEN city = '' THEN 'city is required' END AS error FROM ({_BAD})"))
def qua1(spark, d):
    return _bad(spark, d).select("event_id", Q.not_null(F.col("city"), "city").alias("error"))


@register("qua2", over("s", f"SELECT event_id, CASE WHEN humidity > 100 THEN 'humidity must be <= 100' END AS error FROM ({_BAD})"))
def qua2(spark, d):
    return _bad(spark, d).select("event_id", Q.between(F.col("humidity"), "humidity", 0, 100).alias("error"))


@register("qua5", over("s", f"SELECT event_id, {_WEATHER_ERRORS} AS errors FROM ({_BAD})"))
def qua5(spark, d):
    return Q.validate_weather(_bad(spark, d)).select("event_id", F.array_join("errors", "; ").alias("errors"))


@register("qua6", over("s", f"SELECT event_id, {_AIR_ERRORS} AS errors FROM ({_BAD})"))
def qua6(spark, d):
    return Q.validate_air(_bad(spark, d)).select("event_id", F.array_join("errors", "; ").alias("errors"))


@register("qua8", over("s", f"SELECT event_id, CASE WHEN e = '' THEN 'accepted' ELSE 'validation_failed' END AS outcome, nullif(e, '') AS error_message FROM (SELECT event_id, {_WEATHER_ERRORS} AS e FROM ({_BAD}))"))
def qua8(spark, d):
    good, bad = Q.route(Q.validate_weather(_bad(spark, d)))
    return good.select("event_id", F.lit("accepted").alias("outcome"), F.lit(None).cast("string").alias("error_message")).unionByName(bad.select("event_id", F.col("error_type").alias("outcome"), "error_message"))


@register("qua9", over("s", f"SELECT avg(CASE WHEN {_WEATHER_ERRORS} <> '' THEN 1 ELSE 0 END) AS out_of_range_rate FROM ({_BAD})"), "out_of_range_rate")
def qua9(spark, d):
    return Q.out_of_range_rate(Q.validate_weather(_bad(spark, d)))


@register("agg20", over("s", f"SELECT count(*) AS record_count, count(*) FILTER (e = '') AS success_count, count(*) FILTER (e <> '') AS failure_count FROM (SELECT {_WEATHER_ERRORS} AS e FROM ({_BAD}))"))
def agg20(spark, d):
    return Q.quality_report(Q.validate_weather(_bad(spark, d)))


@register("snk10", over("s", f"SELECT region, nullif({_AIR_ERRORS}, '') AS error_message, count(*) AS n FROM ({_BAD}) WHERE {_AIR_ERRORS} <> '' GROUP BY ALL"))
def snk10(spark, d):
    _, bad = Q.route(Q.validate_air(_bad(spark, d)))
    return Q.dead_letter(bad, "p", "b", "e").groupBy("region", "error_message").agg(F.count("*").alias("n"))


_FIRST = "row_number() OVER (PARTITION BY source, city, station_id, date_trunc('hour', event_time) ORDER BY event_id)"


@register("ded2", over("s", f"SELECT event_id, CASE WHEN {_FIRST} > 1 THEN 'duplicate_event' END AS error_type FROM s"))
def ded2(spark, d):
    s = sensor(spark, d).withColumn("hour_ts", F.date_trunc("hour", "event_time"))
    return split_repeats(s, ["source", "city", "station_id", "hour_ts"], ["event_id"]).select("event_id", "error_type")


@register("agg21", over("s", f"SELECT CASE WHEN n > 1 THEN 'duplicate_event' ELSE 'success' END AS outcome, count(*) AS record_count FROM (SELECT {_FIRST} AS n FROM s) GROUP BY ALL"))
def agg21(spark, d):
    from ..operators.aggregates import run_counters

    s = sensor(spark, d).withColumn("hour_ts", F.date_trunc("hour", "event_time"))
    return run_counters(split_repeats(s, ["source", "city", "station_id", "hour_ts"], ["event_id"]))


@register("jon7", "SELECT n_name AS city, CAST(NULL AS VARCHAR) AS alias, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'none' END AS provider_city FROM nation")
def jon7(spark, d):
    nation = table(spark, d, "nation")
    mine = nation.select(F.col("n_name").alias("city"), F.lit(None).cast("string").alias("alias"))
    theirs = nation.filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("city"), F.lower("n_name").alias("alias"))
    return match_provider(mine, theirs, "none")


@register("jon5", "SELECT c_custkey, n_name AS city, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def jon5(spark, d):
    from ..operators.joins import lookup

    catalog = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"), "r_name")
    return lookup(table(spark, d, "customer"), catalog, "c_nationkey").select("c_custkey", "city", "r_name")


