"""Fixed schemas of the records and tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, L, I, DT = T.StringType(), T.DoubleType(), T.TimestampType(), T.LongType(), T.IntegerType(), T.DateType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_KEYS = dict(event_id=S, source=S, region=S, city=S, station_id=S, latitude=D, longitude=D, event_time=TS, ingestion_time=TS)
_WEATHER = dict(temperature_c=D, humidity=D, pressure_hpa=D, surface_pressure_hpa=D, wind_speed_mps=D, wind_direction_deg=D, precipitation_mm=D, cloud_cover_pct=D, shortwave_radiation_wm2=D, soil_temperature_0_to_7cm_c=D)
_AIR = dict(aqi=D, quality_level=S, pm25=D, pm10=D, co=D, no2=D, so2=D, o3=D)

WEATHER = struct(**_KEYS, **_WEATHER, weather_main=S, weather_desc=S, data_version=S)
AIR = struct(**_KEYS, **_AIR, data_version=S)
UNIFIED = struct(**_KEYS, **_WEATHER, weather_main=S, weather_desc=S, **_AIR, data_version=S)
#: Exported records: times are text until they are parsed.
EXPORTED = T.StructType([T.StructField(f.name, S if f.dataType == TS else f.dataType) for f in UNIFIED.fields] + [T.StructField("pipeline_name", S), T.StructField("batch_id", S)])
ENVELOPE = T.StructType([*struct(kafka_topic=S, kafka_partition=I, kafka_offset=L, exported_at=S).fields, T.StructField("value", EXPORTED)])
STREAM_SCORING = T.StructType([T.StructField(f.name, S if f.name == "event_time" else f.dataType) for f in UNIFIED.fields if f.name not in ("event_id", "ingestion_time", "quality_level", "data_version")])
EVALUATION = struct(recorded_at=TS, run_id=S, task=S, model_name=S, horizon=I, split=S, metric_name=S, metric_value=D, data_path=S, data_format=S, dataset_version=S)
METRICS = struct(metric_time=TS, metric_date=DT, category=S, metric_name=S, metric_value=D, severity=S, model_name=S, horizon=I, window=S, entity=S)

#: Measures of a station row, and how raw fields are named in it.
SENSORS = ["temp_c", "humidity", "pressure", "wind_speed", "wind_dir", "precipitation", "cloud_cover", "shortwave_radiation", "soil_temperature", "pm2_5", "us_aqi"]
RENAMED = {
    "temperature_c": "temp_c",
    "humidity": "humidity",
    "pressure_hpa": "pressure",
    "wind_speed_mps": "wind_speed",
    "wind_direction_deg": "wind_dir",
    "precipitation_mm": "precipitation",
    "cloud_cover_pct": "cloud_cover",
    "shortwave_radiation_wm2": "shortwave_radiation",
    "soil_temperature_0_to_7cm_c": "soil_temperature",
    "pm25": "pm2_5",
    "aqi": "us_aqi",
}
#: Targets: name in the target column, and the measure it leads.
TARGETS = {"temp": "temp_c", "pm25": "pm2_5", "cloud_cover": "cloud_cover", "precipitation": "precipitation", "wind_speed": "wind_speed", "pressure": "pressure"}
SERVING = ["station_id", "timestamp", "latitude", "longitude", *SENSORS, "is_stagnant_air", "cooling_degree_days", "pm25_acc_12h"]
OBSERVATION = [*SERVING, "pressure_delta_3h", "wind_shear_U", "wind_shear_V", "temp_mean_6h"]
ALERT = ["station_id", "timestamp", "target_feature", "forecast_horizon", "predicted_value"]
