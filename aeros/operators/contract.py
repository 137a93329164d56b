"""The feature table's contract: columns, type families, keys, regions, and a gate before writing."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SENSORS
from .aggregates import duplicate_rate, missing_rate
from .projections import target_columns

REGIONS = ["bac", "trung", "nam", "unknown"]
_FAMILIES = {
    "string": (T.StringType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "boolean": (T.BooleanType,),
}
_FAMILIES["numeric"] = (*_FAMILIES["integer"], T.FloatType, T.DoubleType, T.DecimalType)
DERIVED = ["coord_X", "coord_Y", "coord_Z", "wind_U", "wind_V", "air_density", "dew_point", "hour_sin", "hour_cos", "theta_e", "is_stagnant_air", "cooling_degree_days", "pressure_delta_3h", "wind_shear_U", "wind_shear_V", "temp_mean_6h", "pm25_acc_12h"]
ISSUE = "code string, severity string, column_name string, detail string"


@dataclass
class Contract:
    """columns: name -> (family, nullable)."""

    columns: dict[str, tuple[str, bool]]
    keys: list[str] = field(default_factory=lambda: ["station_id", "timestamp"])
    regions: list[str] = field(default_factory=lambda: list(REGIONS))
    targets: list[str] = field(default_factory=list)


def feature_contract(horizons: tuple[int, ...] = (1, 2, 3, 4, 5, 6), extra: dict[str, tuple[str, bool]] | None = None) -> Contract:
    targets = target_columns(list(horizons))
    columns = {"station_id": ("string", False), "timestamp": ("timestamp", False), "region": ("string", True), "city": ("string", True)}
    columns |= {n: ("numeric", True) for n in ("latitude", "longitude", *SENSORS, *DERIVED, *targets)}
    return Contract(columns | (extra or {}), targets=targets)


def missing_columns(df: DataFrame, contract: Contract) -> list[str]:
    return [c for c in contract.columns if c not in df.columns]


def type_mismatches(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [(c, family, kinds[c].simpleString()) for c, (family, _) in contract.columns.items() if c in kinds and not isinstance(kinds[c], _FAMILIES[family])]


def cast_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, failures): values of the whole table that the family's type cannot hold."""
    to = {"numeric": "double", "integer": "bigint", "timestamp": "timestamp", "boolean": "boolean", "string": "string"}
    present = {c: to[f] for c, (f, _) in contract.columns.items() if c in df.columns}
    counts = [F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull()).alias(c) for c, t in present.items()]
    one = df.agg(*counts)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in present])))


def data_checks(df: DataFrame, contract: Contract) -> DataFrame:
    """(check_name, column_name, value): NULL rates of keys, duplicate rows, rows outside the regions."""
    strict = [c for c, (_, nullable) in contract.columns.items() if not nullable and c in df.columns]
    out = missing_rate(df, strict).select(F.lit("null_rate").alias("check_name"), "column_name", F.col("missing_rate").alias("value"))
    if all(k in df.columns for k in contract.keys):
        dup = duplicate_rate(df, contract.keys)
        out = out.unionByName(dup.select(F.lit("duplicate_rows").alias("check_name"), F.lit(",".join(contract.keys)).alias("column_name"), F.col("duplicate_rows").cast("double").alias("value")))
    if "region" in df.columns:
        bad = df.agg(F.count_if(F.col("region").isNotNull() & ~F.col("region").isin(contract.regions)).cast("double").alias("value"))
        out = out.unionByName(bad.select(F.lit("invalid_regions").alias("check_name"), F.lit("region").alias("column_name"), "value"))
    return out


def issues(df: DataFrame, contract: Contract) -> DataFrame:
    """One row an issue. Missing columns, wrong families, NULL keys and foreign regions are errors, duplicates a warning."""
    spark = df.sparkSession
    rows = [("missing_column", "error", c, "") for c in missing_columns(df, contract)]
    rows += [("type_mismatch", "error", c, f"expected {want}, got {got}") for c, want, got in type_mismatches(df, contract)]
    fixed = spark.createDataFrame(rows, ISSUE)
    level = F.when(F.col("check_name") == "duplicate_rows", "warning").otherwise("error")
    found = data_checks(df, contract).filter("value > 0").select(F.col("check_name").alias("code"), level.alias("severity"), "column_name", F.round("value", 6).cast("string").alias("detail"))
    return fixed.unionByName(found)


def report(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: passed, errors, warnings."""
    n = lambda s: F.count_if(F.col("severity") == s)
    return issues(df, contract).agg((n("error") == 0).alias("passed"), n("error").alias("error_count"), n("warning").alias("warning_count"))


def gated(df: DataFrame, contract: Contract) -> DataFrame:
    """df, if the contract holds; else an error that names the issues (at most one per check and column)."""
    bad = issues(df, contract).filter("severity = 'error'").collect()
    if bad:
        raise ValueError("; ".join(f"{r['code']} {r['column_name']} {r['detail']}".strip() for r in bad))
    return df
