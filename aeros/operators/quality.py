"""Quality rules as one column of error messages, and routing by it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that must have a value, and allowed ranges (low, high, low is strict) of each kind of record: fixed values.
REQUIRED = ["event_time", "city", "source"]
WEATHER_RANGES = {
    "temperature_c": (-20, 60, False),
    "humidity": (0, 100, False),
    "wind_speed_mps": (0, None, False),
    "wind_direction_deg": (0, 360, False),
    "precipitation_mm": (0, None, False),
    "cloud_cover_pct": (0, 100, False),
    "shortwave_radiation_wm2": (0, None, False),
    "pressure_hpa": (0, None, True),
    "surface_pressure_hpa": (0, None, True),
}
AIR_RANGES = {"aqi": (0, None, False), "pm25": (0, None, False), "pm10": (0, None, False)}
WEATHER_NUMERIC = ["temperature_c", "humidity", "pressure_hpa", "wind_speed_mps", "wind_direction_deg", "precipitation_mm", "cloud_cover_pct", "shortwave_radiation_wm2", "soil_temperature_0_to_7cm_c"]
AIR_NUMERIC = ["aqi", "pm25", "pm10", "co", "no2", "so2", "o3"]


@dataclass(frozen=True)
class Rule:
    """kind: not_null or between."""

    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    strict_low: bool = False
    strict_high: bool = False

    @classmethod
    def of(cls, spec: dict) -> Rule:
        """From an expectation document's entry."""
        k = spec["kwargs"]
        if spec["expectation_type"] == "expect_column_values_to_not_be_null":
            return cls("not_null", k["column"])
        if spec["expectation_type"] == "expect_column_values_to_be_between":
            return cls("between", k["column"], k.get("min_value"), k.get("max_value"), k.get("strict_min", False), k.get("strict_max", False))
        raise ValueError(f"unsupported expectation: {spec['expectation_type']}")

    def document(self) -> dict:
        if self.kind == "not_null":
            return {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": self.column}}
        ends = {"min_value": self.low, "max_value": self.high, "strict_min": self.strict_low or None, "strict_max": self.strict_high or None}
        return {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": self.column} | {n: v for n, v in ends.items() if v is not None}}

    def error(self, columns: list[str]) -> Column:
        """The message of the first failure, or NULL."""
        name = self.column
        if self.kind == "not_null":
            return not_null(F.col(name), name) if name in columns else F.lit(f"{name} is required")
        return between(F.col(name), name, self.low, self.high, self.strict_low, self.strict_high) if name in columns else F.lit(None).cast("string")


def not_null(value: Column, name: str) -> Column:
    return F.when(value.isNull() | (value.cast("string") == ""), f"{name} is required")


def not_finite(value: Column) -> Column:
    number = value.try_cast("double")
    return number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))


def between(value: Column, name: str, low=None, high=None, strict_low: bool = False, strict_high: bool = False) -> Column:
    """NULL passes; a value that is no finite number fails."""
    number = value.try_cast("double")
    out = F.when(value.isNull(), None).when(not_finite(value), f"{name} must be numeric")
    if low is not None:
        out = out.when(number <= low if strict_low else number < low, f"{name} must be {'>' if strict_low else '>='} {low}")
    if high is not None:
        out = out.when(number >= high if strict_high else number > high, f"{name} must be {'<' if strict_high else '<='} {high}")
    return out


def suite(kind: str) -> list[Rule]:
    ranges = {"weather": WEATHER_RANGES, "air_quality": AIR_RANGES}.get(kind)
    if ranges is None:
        raise ValueError(f"no suite for {kind}")
    return [Rule("not_null", c) for c in REQUIRED] + [Rule("between", c, low, high, strict) for c, (low, high, strict) in ranges.items()]


def suite_document(kind: str) -> dict:
    return {"suite_name": f"{kind}_input_quality_suite", "expectations": [r.document() for r in suite(kind)]}


def errors(df: DataFrame, rules: list[Rule], numeric: list[str] = (), coordinates: bool = True) -> Column:
    """All messages of a row, in order of the rules."""
    found = []
    for c in ("latitude", "longitude") if coordinates else ():
        found.append(F.when(F.col(c).isNull(), f"{c} is required").when(not_finite(F.col(c)), f"{c} must be numeric") if c in df.columns else F.lit(f"{c} is required"))
    found += [F.when(F.col(c).isNotNull() & not_finite(F.col(c)), f"{c} must be numeric") for c in numeric if c in df.columns]
    found += [r.error(df.columns) for r in rules]
    return F.array_compact(F.array(*found))


def validate_weather(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", errors(df, suite("weather"), WEATHER_NUMERIC))


def validate_air(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", errors(df, suite("air_quality"), AIR_NUMERIC))


def route(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected rows say why."""
    accepted = df.filter(F.size("errors") == 0).drop("errors")
    rejected = df.filter(F.size("errors") > 0).withColumns({"error_type": F.lit("validation_failed"), "error_message": F.array_join("errors", "; ")})
    return accepted, rejected


def out_of_range_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.avg((F.size("errors") > 0).cast("int")).alias("out_of_range_rate"))


def quality_report(df: DataFrame) -> DataFrame:
    bad = F.count_if(F.size("errors") > 0)
    return df.agg(F.count("*").alias("record_count"), (F.count("*") - bad).alias("success_count"), bad.alias("failure_count"))


def failing_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.filter(F.size("errors") > 0).select(*keys, F.array_join("errors", "; ").alias("error_message"))


def dead_letter(rejected: DataFrame, pipeline: str, batch_id: str, endpoint: str, raw: str | None = None) -> DataFrame:
    """Rejected rows as dead-letter messages with their raw and normalised payloads."""
    skip = {"errors", "error_type", "error_message"}
    body = F.to_json(F.struct(*[c for c in rejected.columns if c not in skip]))
    return rejected.select(
        F.expr("uuid()").alias("dlq_id"),
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(endpoint).alias("source_endpoint"),
        *[F.col(c) if c in rejected.columns else F.lit(None).cast("string").alias(c) for c in ("source", "region", "city")],
        "error_type",
        "error_message",
        (F.col(raw) if raw else F.lit(None).cast("string")).alias("raw_payload"),
        body.alias("normalized_payload"),
        F.current_timestamp().alias("failed_at"),
        F.to_json(F.struct(F.size("errors").alias("error_count"))).alias("extra"),
    )
