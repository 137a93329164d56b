"""Projections between record, station and serving columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.physics import time_parts
from ..functions.rules import alert_label
from ..schemas import RENAMED, TARGETS

WEATHER_FIELDS = [n for n in RENAMED if n not in ("pm25", "aqi")]
AIR_FIELDS = ["pm25", "aqi"]
METADATA = ["event_id", "source", "ingestion_time", "data_version", "pipeline_name", "batch_id", "elevation"]


def col_or_null(df: DataFrame, name: str, kind: str = "double") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def city_key(city: Column) -> Column:
    return F.lower(F.trim(city))


def canonical(df: DataFrame, fields: list[str], keys: list[str]) -> DataFrame:
    """Keys as they are, measures renamed; measures that are absent are NULL."""
    return df.select(*keys, *[col_or_null(df, n).alias(RENAMED[n]) for n in fields])


def canonical_weather(df: DataFrame, keys: list[str]) -> DataFrame:
    return canonical(df, WEATHER_FIELDS, keys)


def canonical_air(df: DataFrame, keys: list[str]) -> DataFrame:
    return canonical(df, AIR_FIELDS, keys)


def fill_defaults(df: DataFrame) -> DataFrame:
    zero = {n: F.coalesce(n, F.lit(0.0)) for n in ("wind_dir", "precipitation", "cloud_cover", "shortwave_radiation")}
    return df.withColumns(zero | {"soil_temperature": F.coalesce("soil_temperature", "temp_c"), "elevation": F.lit(0.0)})


def add_time_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns(time_parts(F.col(ts)))


def existing(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select([n for n in names if n in df.columns])


def unify_keys(df: DataFrame, left: dict[str, str], right: dict[str, str], unknown: tuple[str, ...] = ()) -> DataFrame:
    """Keys of either side of an outer join; names in `unknown` are never NULL."""
    both = {n: F.coalesce(left[n], right[n], *([F.lit("unknown")] if n in unknown else [])) for n in left}
    gone = {*left.values(), *right.values()} - {*left}
    return df.withColumns(both).drop(*gone)


def region_from_station(df: DataFrame, north: list[str], centre: list[str], station: str = "station_id") -> DataFrame:
    if "region" in df.columns:
        return df
    return df.withColumn("region", F.when(F.lower(station).isin(north), "bac").when(F.lower(station).isin(centre), "trung").otherwise("nam"))


def for_training(df: DataFrame, target: str, features: list[str] | None = None, keep: tuple[str, ...] = ("station_id", "timestamp", "region", "city")) -> DataFrame:
    """Features and one target, without metadata and other targets; named features must exist."""
    if features is not None and (missing := [f for f in features if f not in df.columns]):
        raise ValueError(f"missing feature columns: {missing}")
    chosen = features or [c for c in df.columns if not c.startswith("target_") and c not in METADATA and c not in keep]
    return df.select(*[k for k in keep if k in df.columns and k not in chosen], *chosen, target)


def add_alert_target(df: DataFrame, source: str = "target_pm25_1h", name: str = "target_alert_1h", threshold: float = 35.0) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, alert_label(F.col(source), threshold))


def stamp(df: DataFrame, horizon: int, model_uri: str, version: str, batch_id: str, as_of: Column | None = None) -> DataFrame:
    """Prediction metadata. The model's name is the first part of its address's path."""
    now = F.current_timestamp() if as_of is None else as_of
    name = F.get(F.split(F.lit(model_uri), "/"), F.lit(1))
    return df.withColumns({"horizon": F.lit(horizon), "prediction_time": now, "prediction_date": F.to_date(now), "model_name": F.coalesce(name, F.lit(model_uri)), "model_version": F.lit(version), "batch_id": F.lit(batch_id)})


def numeric_to_double(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    numeric = {"tinyint", "smallint", "int", "bigint", "float"}
    return df.withColumns({n: F.col(n).cast("double") for n, t in df.dtypes if n not in skip and (t in numeric or t.startswith("decimal"))})


def ensure_place(df: DataFrame, region: str = "unknown", city_from: str = "station_id") -> DataFrame:
    add = {"region": F.lit(region)} if "region" not in df.columns else {}
    return df.withColumns(add | ({"city": F.col(city_from)} if "city" not in df.columns else {}))


def target_columns(hours: list[int]) -> list[str]:
    return [f"target_{n}_{h}h" for h in hours for n in TARGETS]
