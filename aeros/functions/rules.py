"""Codes, alerts and severities from thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(*cases: tuple[Column, object], default: object) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(default)


def temp_code(t: Column) -> Column:
    return first_match((t >= 40.0, 6), (t >= 37.0, 5), (t >= 35.0, 4), (t <= 13.0, 3), (t <= 15.0, 2), default=1)


def rain_code(r: Column) -> Column:
    return first_match((r > 50.0, 5), (r >= 7.6, 4), (r >= 2.6, 3), (r >= 0.1, 2), default=1)


def wind_code(w: Column) -> Column:
    return first_match((w > 20.7, 5), (w >= 17.2, 4), (w >= 13.9, 3), (w >= 10.8, 2), default=1)


def cloud_code(c: Column) -> Column:
    return first_match((c > 70.0, 4), (c >= 41.0, 3), (c >= 11.0, 2), default=1)


def pm25_code(p: Column) -> Column:
    return first_match((p > 150.4, 5), (p >= 55.5, 4), (p >= 35.5, 3), (p >= 12.1, 2), default=1)


def flag(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


def add_codes(df: DataFrame) -> DataFrame:
    """Codes of a forecast row (pred_*); those of optional forecasts only where the column exists."""
    c = F.col
    codes = {
        "Temp_Code": temp_code(c("pred_temp")),
        "Rain_Code": rain_code(c("pred_precipitation")),
        "Wind_Code": wind_code(c("pred_wind_speed")),
        "Cloud_Code": cloud_code(c("pred_cloud_cover")),
        "Alert_Thunderstorm": flag((c("pred_precipitation") > 0) & (c("pred_wind_speed") >= 10.8)),
    }
    optional = {
        "pred_pm25": ("PM25_Code", pm25_code),
        "pred_solar_rad": ("Solar_Code", lambda x: flag(x > 0)),
        "pred_storm_prob": ("Alert_Storm_Prob", lambda x: flag(x > 0.3)),
        "pred_inversion": ("Alert_Inversion", lambda x: flag(x > 0.5)),
    }
    return df.withColumns(codes | {name: f(c(col)) for col, (name, f) in optional.items() if col in df.columns})


def severity(value: Column, warning: object, critical: object) -> Column:
    return F.when(value >= critical, "critical").when(value >= warning, "warning").otherwise("stable")


def psi_status(psi: Column) -> Column:
    return F.when(psi < 0.10, "stable").when(psi < 0.25, "warning").otherwise("critical")


def mae_drift_status(current: Column, baseline: Column) -> Column:
    """Relative growth of the error; without a positive baseline it is unknown."""
    growth = F.try_divide(current - baseline, baseline)
    return F.when(baseline.isNull() | (baseline <= 0) | current.isNull(), "unknown").when(growth > 0.20, "critical").when(growth > 0.10, "warning").otherwise("stable")


def alert_label(target: Column, threshold: float = 35.0) -> Column:
    return F.when(target >= threshold, 1).otherwise(0).cast("int")
