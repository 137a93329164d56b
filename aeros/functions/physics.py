"""Stateless features of a station row: geometry, wind, thermodynamics, cycles and flags.

All divisions are guarded: a zero divisor gives NULL, never a failed job.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Magnus coefficients, gas constant of dry air, zero Celsius in Kelvin.
MAGNUS_B, MAGNUS_C, DRY_AIR, KELVIN = 17.625, 243.04, 287.05, 273.15
#: Least relative humidity (%) that a dew point is computed for.
HUMIDITY_FLOOR = 1e-6


def coordinates(lat: Column, lon: Column) -> dict[str, Column]:
    a, b = F.radians(lat), F.radians(lon)
    return {"coord_X": F.cos(a) * F.cos(b), "coord_Y": F.cos(a) * F.sin(b), "coord_Z": F.sin(a)}


def wind_vector(speed: Column, direction: Column) -> dict[str, Column]:
    d = F.radians(direction)
    return {"wind_U": -speed * F.sin(d), "wind_V": -speed * F.cos(d)}


def air_density(pressure: Column, temp: Column) -> Column:
    return F.try_divide(pressure * 100.0, DRY_AIR * (temp + KELVIN))


def dew_point(temp: Column, humidity: Column, floor: bool = True) -> Column:
    """floor: humidity of 0 or less counts as HUMIDITY_FLOOR; without it the result is NULL there."""
    h = F.when(humidity <= 0, F.lit(HUMIDITY_FLOOR)).otherwise(humidity) if floor else F.when(humidity > 0, humidity)
    gamma = F.ln(h / 100.0) + F.try_divide(MAGNUS_B * temp, MAGNUS_C + temp)
    return F.try_divide(MAGNUS_C * gamma, MAGNUS_B - gamma)


def vapour_pressure(dew: Column) -> Column:
    return 6.112 * F.exp(F.try_divide(17.67 * dew, dew + 243.5))


def mixing_ratio(dew: Column, pressure: Column) -> Column:
    e = vapour_pressure(dew)
    return F.try_divide(0.622 * e, pressure - e)


def potential_temperature(temp: Column, pressure: Column) -> Column:
    return (temp + KELVIN) * F.pow(F.try_divide(F.lit(1000.0), pressure), F.lit(0.286))


def theta_e(temp: Column, dew: Column, pressure: Column) -> Column:
    return potential_temperature(temp, pressure) * F.exp(F.try_divide(2675.0 * mixing_ratio(dew, pressure), dew + KELVIN))


def cycle(value: Column, period: float, name: str) -> dict[str, Column]:
    angle = value * (2 * math.pi / period)
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def is_stagnant(speed: Column, pressure: Column) -> Column:
    return F.when((speed < 1.0) & (pressure > 1010), 1).otherwise(0)


def cooling_degrees(temp: Column, base: float = 24.0) -> Column:
    return F.when(temp > base, temp - base).otherwise(F.lit(0.0))


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def time_parts(ts: Column) -> dict[str, Column]:
    return {"hour": F.hour(ts), "month": F.month(ts), "day_of_year": F.dayofyear(ts), "year": F.year(ts)}


def add_physics(df: DataFrame, floor: bool = True) -> DataFrame:
    """The whole stateless block in two projections: the second needs the dew point."""
    c = F.col
    first = coordinates(c("latitude"), c("longitude")) | wind_vector(c("wind_speed"), c("wind_dir")) | {"air_density": air_density(c("pressure"), c("temp_c")), "dew_point": dew_point(c("temp_c"), c("humidity"), floor)}
    if "hour" in df.columns:
        first |= cycle(c("hour"), 24, "hour")
    if "day_of_year" in df.columns:
        first |= cycle(c("day_of_year"), 365, "day")
    first |= {"is_stagnant_air": is_stagnant(c("wind_speed"), c("pressure")), "cooling_degree_days": cooling_degrees(c("temp_c"))}
    return df.withColumns(first).withColumn("theta_e", theta_e(c("temp_c"), c("dew_point"), c("pressure")))


def add_realtime_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The stateless block for a scorer that has no history: changes are 0, means and sums are the value itself."""
    out = add_physics(df.withColumns(time_parts(F.col(ts))))
    neutral = {"pressure_delta_3h": F.lit(0.0), "wind_shear_U": F.lit(0.0), "wind_shear_V": F.lit(0.0), "temp_mean_6h": F.col("temp_c"), "pm25_acc_12h": F.col("pm2_5")}
    return out.withColumns(neutral)
