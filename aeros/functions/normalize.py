"""Provider payloads (JSON text) to the two record types.

Provider numbers may arrive as text, so every leaf is read as a string and cast with try_cast. Aliases use coalesce: zero
is data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import AIR, WEATHER
from .catalog import place

#: Weather codes of the WMO: group and description (fixed values).
WMO = [
    (0, "Clear", "Clear sky"),
    (1, "Partly Cloudy", "Mainly clear"),
    (2, "Partly Cloudy", "Partly cloudy"),
    (3, "Overcast", "Overcast"),
    (45, "Fog", "Fog"),
    (48, "Fog", "Depositing rime fog"),
    (51, "Drizzle", "Light drizzle"),
    (53, "Drizzle", "Moderate drizzle"),
    (55, "Drizzle", "Dense drizzle"),
    (61, "Rain", "Slight rain"),
    (63, "Rain", "Moderate rain"),
    (65, "Rain", "Heavy rain"),
    (71, "Snow", "Slight snow fall"),
    (73, "Snow", "Moderate snow fall"),
    (75, "Snow", "Heavy snow fall"),
    (80, "Rain", "Rain showers"),
    (81, "Rain", "Rain showers"),
    (82, "Rain", "Violent rain showers"),
    (95, "Thunderstorm", "Thunderstorm"),
    (96, "Thunderstorm", "Thunderstorm with slight hail"),
    (99, "Thunderstorm", "Thunderstorm with heavy hail"),
]
_POLLUTANTS = ["pm25", "pm10", "co", "no2", "so2", "o3"]
_OWM_LEVELS = ["Good", "Fair", "Moderate", "Poor", "Very Poor"]

_TEXT = lambda *names: ", ".join(f"{n}: string" for n in names)
OPEN_METEO = f"struct<{_TEXT('source', 'city', 'name', 'timezone', 'station_id', 'latitude', 'longitude')}, current: struct<{_TEXT('time', 'temperature_2m', 'relative_humidity_2m', 'pressure_msl', 'surface_pressure', 'wind_speed_10m', 'wind_direction_10m', 'precipitation', 'cloud_cover', 'shortwave_radiation', 'soil_temperature_0_to_7cm', 'soil_temperature_0_to_10cm', 'weather_code', 'us_aqi', 'pm2_5', 'pm10', 'co', 'carbon_monoxide', 'no2', 'nitrogen_dioxide', 'so2', 'sulphur_dioxide', 'o3', 'ozone')}>>"
OPEN_WEATHER = f"struct<{_TEXT('source', 'name', 'city', 'dt', 'lat', 'lon', 'station_id', 'surface_pressure', 'shortwave_radiation', 'soil_temperature')}, coord: struct<lat: string, lon: string>, main: struct<{_TEXT('temp', 'humidity', 'pressure')}>, wind: struct<speed: string, deg: string>, weather: array<struct<main: string, description: string>>, rain: struct<`1h`: string, `3h`: string>, clouds: struct<all: string>, list: array<struct<dt: string, main: struct<aqi: string>, components: struct<{_TEXT('pm2_5', 'pm10', 'co', 'no2', 'so2', 'o3')}>>>>"
AQICN = f"struct<station_id: string, data: struct<idx: string, aqi: string, city: struct<name: string, geo: array<string>>, time: struct<iso: string, s: string>, iaqi: struct<{', '.join(f'{p}: struct<v: string>' for p in _POLLUTANTS)}>>>"
IQAIR = f"struct<{_TEXT('city', 'latitude', 'longitude', 'event_time', 'station_id')}, data: struct<city: string>, station: struct<id: string>, current: struct<pollution: struct<{_TEXT('ts', 'aqius', 'aqicn', *_POLLUTANTS)}>>>"
HOURLY = ["temperature_2m", "relative_humidity_2m", "pressure_msl", "surface_pressure", "wind_speed_10m", "wind_direction_10m", "precipitation", "cloud_cover", "shortwave_radiation", "soil_temperature_0_to_7cm", "weather_code"]


def number(c: Column | str) -> Column:
    """As a double; text that is none is NULL."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def parse_time(text: Column, source_tz: str = "UTC") -> Column:
    """Epoch seconds, ISO text with Z or an offset, or naive text in source_tz; NULL for anything else."""
    t = F.trim(text)
    epoch = F.timestamp_seconds(F.when(t.rlike(r"^-?\d+(\.\d+)?$"), t.try_cast("double")))
    zoned = F.when(t.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), t.try_cast("timestamp"))
    return F.coalesce(epoch, zoned, F.to_utc_timestamp(t.try_cast("timestamp_ntz").cast("timestamp"), source_tz))


def kmh_to_mps(speed: Column) -> Column:
    return F.round(speed * 0.27778, 4)


def aqi_level(aqi: Column) -> Column:
    cuts = [(50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"), (200, "Unhealthy"), (300, "Very Unhealthy")]
    out = F.when(aqi.isNull(), None)
    for most, level in cuts:
        out = out.when(aqi <= most, level)
    return out.otherwise("Hazardous")


def owm_aqi_level(aqi: Column) -> Column:
    levels = F.create_map(*[x for i, n in enumerate(_OWM_LEVELS, 1) for x in (F.lit(i), F.lit(n))])
    return F.when(aqi.isNotNull(), F.coalesce(F.try_element_at(levels, aqi.cast("int")), F.lit("Unknown")))


def with_weather_text(df: DataFrame, code: str = "weather_code") -> DataFrame:
    """weather_main and weather_desc of a WMO code; unknown codes say so, NULL stays NULL. The table has 21 rows."""
    table = df.sparkSession.createDataFrame(WMO, "_code int, _main string, _desc string")
    joined = df.join(F.broadcast(table), F.col(code).cast("int") == F.col("_code"), "left")
    known = lambda c, other: F.when(F.col(code).isNotNull(), F.coalesce(c, F.lit(other)))
    return joined.withColumns({"weather_main": known("_main", "Unknown"), "weather_desc": known("_desc", "Unknown weather condition")}).drop("_code", "_main", "_desc")


def station_id(source: Column, city: Column) -> Column:
    return F.concat(source, F.lit("_"), F.replace(F.lower(city), F.lit(" "), F.lit("_")))


def with_defaults(df: DataFrame) -> DataFrame:
    """event_id, ingestion_time and data_version where they are missing."""
    fill = {"event_id": F.expr("uuid()"), "ingestion_time": F.current_timestamp(), "data_version": F.lit("v1")}
    return df.withColumns({n: F.coalesce(F.col(n), v) if n in df.columns else v for n, v in fill.items()})


def with_metadata(df: DataFrame, pipeline: str, batch_id: str, endpoint: str, status: str = "success") -> DataFrame:
    return df.withColumns({"pipeline_name": F.lit(pipeline), "batch_id": F.lit(batch_id), "source_endpoint": F.lit(endpoint), "ingestion_status": F.lit(status), "partition_key": F.concat(F.lit("region_"), F.coalesce("region", F.lit("unknown")))})


def _finish(df: DataFrame, catalog: DataFrame, schema, defaults: bool) -> DataFrame:
    out = place(df, catalog)
    out = out.withColumn("station_id", F.coalesce("station_id", station_id(F.col("source"), F.col("city"))))
    out = with_defaults(out) if defaults else out
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in out.columns])


def open_meteo_weather(df: DataFrame, catalog: DataFrame, payload: str = "payload", source: str = "open-meteo", source_tz: str = "UTC", defaults: bool = True) -> DataFrame:
    p = df.select(F.from_json(payload, OPEN_METEO).alias("p")).select("p.*")
    c = lambda name: F.col(f"current.{name}")
    speed = number(c("wind_speed_10m"))
    flat = p.select(
        F.lit(source).alias("source"),
        F.coalesce(F.col("city"), F.col("name"), F.col("timezone"), F.lit("Hanoi")).alias("city"),
        "station_id",
        number("latitude").alias("latitude"),
        number("longitude").alias("longitude"),
        parse_time(c("time"), source_tz).alias("event_time"),
        number(c("temperature_2m")).alias("temperature_c"),
        number(c("relative_humidity_2m")).alias("humidity"),
        number(c("pressure_msl")).alias("pressure_hpa"),
        number(c("surface_pressure")).alias("surface_pressure_hpa"),
        (kmh_to_mps(speed) if source == "open-meteo" else speed).alias("wind_speed_mps"),
        number(c("wind_direction_10m")).alias("wind_direction_deg"),
        number(c("precipitation")).alias("precipitation_mm"),
        number(c("cloud_cover")).alias("cloud_cover_pct"),
        number(c("shortwave_radiation")).alias("shortwave_radiation_wm2"),
        F.coalesce(number(c("soil_temperature_0_to_7cm")), number(c("soil_temperature_0_to_10cm"))).alias("soil_temperature_0_to_7cm_c"),
        number(c("weather_code")).cast("int").alias("weather_code"),
    )
    return _finish(with_weather_text(flat), catalog, WEATHER, defaults)


def open_weather_weather(df: DataFrame, catalog: DataFrame, payload: str = "payload", source: str = "openweathermap", defaults: bool = True) -> DataFrame:
    p = df.select(F.from_json(payload, OPEN_WEATHER).alias("p")).select("p.*")
    sky = F.get("weather", F.lit(0))
    flat = p.select(
        F.lit(source).alias("source"),
        F.coalesce("name", "city").alias("city"),
        "station_id",
        F.coalesce(number("coord.lat"), number("lat")).alias("latitude"),
        F.coalesce(number("coord.lon"), number("lon")).alias("longitude"),
        parse_time(F.col("dt")).alias("event_time"),
        number("main.temp").alias("temperature_c"),
        number("main.humidity").alias("humidity"),
        number("main.pressure").alias("pressure_hpa"),
        F.coalesce(number("surface_pressure"), number("main.pressure")).alias("surface_pressure_hpa"),
        number("wind.speed").alias("wind_speed_mps"),
        number("wind.deg").alias("wind_direction_deg"),
        F.coalesce(number("rain.1h"), number("rain.3h")).alias("precipitation_mm"),
        number("clouds.all").alias("cloud_cover_pct"),
        number("shortwave_radiation").alias("shortwave_radiation_wm2"),
        number("soil_temperature").alias("soil_temperature_0_to_7cm_c"),
        sky["main"].alias("weather_main"),
        sky["description"].alias("weather_desc"),
    )
    return _finish(flat, catalog, WEATHER, defaults)


def _air(flat: DataFrame, catalog: DataFrame, level, defaults: bool) -> DataFrame:
    return _finish(flat.withColumn("quality_level", level(F.col("aqi"))), catalog, AIR, defaults)


def aqicn_air(df: DataFrame, catalog: DataFrame, payload: str = "payload", defaults: bool = True) -> DataFrame:
    p = df.select(F.from_json(payload, AQICN).alias("p")).select("p.*")
    geo = F.col("data.city.geo")
    flat = p.select(
        F.lit("aqicn").alias("source"),
        F.col("data.city.name").alias("city"),
        F.coalesce("data.idx", "station_id", F.lit("aqicn_station")).alias("station_id"),
        number(F.get(geo, F.lit(0))).alias("latitude"),
        number(F.get(geo, F.lit(1))).alias("longitude"),
        parse_time(F.coalesce("data.time.iso", "data.time.s")).alias("event_time"),
        number("data.aqi").alias("aqi"),
        *[number(f"data.iaqi.{x}.v").alias(x) for x in _POLLUTANTS],
    )
    return _air(flat, catalog, aqi_level, defaults)


def iqair_air(df: DataFrame, catalog: DataFrame, payload: str = "payload", defaults: bool = True) -> DataFrame:
    p = df.select(F.from_json(payload, IQAIR).alias("p")).select("p.*")
    of = "current.pollution."
    flat = p.select(
        F.lit("iqair").alias("source"),
        F.coalesce(F.col("city"), F.col("data.city")).alias("city"),
        F.coalesce("station.id", "station_id", F.lit("iqair_station")).alias("station_id"),
        number("latitude").alias("latitude"),
        number("longitude").alias("longitude"),
        parse_time(F.coalesce(F.col(of + "ts"), F.col("event_time"))).alias("event_time"),
        F.coalesce(number(of + "aqius"), number(of + "aqicn")).alias("aqi"),
        *[number(of + x).alias(x) for x in _POLLUTANTS],
    )
    return _air(flat, catalog, aqi_level, defaults)


def open_meteo_air(df: DataFrame, catalog: DataFrame, payload: str = "payload", source_tz: str = "UTC", defaults: bool = True) -> DataFrame:
    p = df.select(F.from_json(payload, OPEN_METEO).alias("p")).select("p.*")
    either = lambda *names: F.coalesce(*[number(f"current.{n}") for n in names])
    flat = p.select(
        F.lit("open-meteo").alias("source"),
        F.coalesce("city", "name").alias("city"),
        F.coalesce(F.col("station_id"), station_id(F.lit("open-meteo"), F.coalesce("city", "name", F.lit("unknown")))).alias("station_id"),
        number("latitude").alias("latitude"),
        number("longitude").alias("longitude"),
        parse_time(F.col("current.time"), source_tz).alias("event_time"),
        either("us_aqi").alias("aqi"),
        either("pm2_5").alias("pm25"),
        either("pm10").alias("pm10"),
        either("co", "carbon_monoxide").alias("co"),
        either("no2", "nitrogen_dioxide").alias("no2"),
        either("so2", "sulphur_dioxide").alias("so2"),
        either("o3", "ozone").alias("o3"),
    )
    return _air(flat, catalog, aqi_level, defaults)


def open_weather_air(df: DataFrame, catalog: DataFrame, payload: str = "payload", defaults: bool = True) -> DataFrame:
    p = df.select(F.from_json(payload, OPEN_WEATHER).alias("p")).select("p.*")
    first = F.get("list", F.lit(0))
    flat = p.select(
        F.lit("openweathermap").alias("source"),
        F.coalesce("city", "name").alias("city"),
        F.coalesce(F.col("station_id"), station_id(F.lit("openweathermap"), F.coalesce("city", "name", F.lit("unknown")))).alias("station_id"),
        number("lat").alias("latitude"),
        number("lon").alias("longitude"),
        parse_time(F.coalesce(first["dt"], F.col("dt"))).alias("event_time"),
        number(first["main"]["aqi"]).alias("aqi"),
        *[number(first["components"]["pm2_5" if x == "pm25" else x]).alias(x) for x in _POLLUTANTS],
    )
    return _air(flat, catalog, owm_aqi_level, defaults)


def explode_hourly(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("city",)) -> DataFrame:
    """One row an hour from aligned arrays; short or missing arrays give NULL."""
    schema = f"struct<latitude: string, longitude: string, hourly: struct<time: array<string>, {', '.join(f'{n}: array<string>' for n in HOURLY)}>>"
    p = df.select(*keep, F.from_json(payload, schema).alias("p"))
    arrays = [F.coalesce(F.col(f"p.hourly.{n}"), F.array().cast("array<string>")).alias(n) for n in ("time", *HOURLY)]
    rows = p.select(*keep, number("p.latitude").alias("latitude"), number("p.longitude").alias("longitude"), F.size(F.coalesce("p.hourly.time", F.array().cast("array<string>"))).alias("_n"), F.posexplode(F.arrays_zip(*arrays)).alias("_i", "h"))
    return rows.filter(F.col("_i") < F.col("_n")).select(*keep, "latitude", "longitude", parse_time(F.col("h.time")).alias("event_time"), *[number(f"h.{n}").alias(n) for n in HOURLY])
