"""The daily monitor as one long metrics table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import mae_drift_status, severity
from .aggregates import delay_stats, duplicate_rate, max_silence, missing_rate, pivot_metrics, unpivot
from .sketches import quantiles
from .windows import current_and_previous

#: Warning and critical thresholds (fixed values).
THRESHOLDS = {"missing_rate": (0.05, 0.10), "duplicate_rate": (0.01, 0.03), "delay_p95_seconds": (900.0, 1800.0), "station_silence_minutes": (30.0, 60.0), "out_of_range_rate": (0.01, 0.03)}


def metric(df: DataFrame, as_of: Column, category: str, name: Column | str, value: str, threshold: str) -> DataFrame:
    warning, critical = THRESHOLDS[threshold]
    name = F.lit(name) if isinstance(name, str) else name
    return df.select(as_of.alias("metric_time"), F.to_date(as_of).alias("metric_date"), F.lit(category).alias("category"), name.alias("metric_name"), F.col(value).cast("double").alias("metric_value"), severity(F.col(value), warning, critical).alias("severity"))


def quality_metrics(df: DataFrame, as_of: Column, columns: list[str], keys: list[str], station: str = "station_id", event: str = "event_time", ingestion: str = "ingestion_time", exact: bool = False) -> DataFrame:
    """exact: take the delay's percentile from all values and not from a sketch."""
    parts = [
        metric(missing_rate(df, columns), as_of, "data_quality", F.concat(F.lit("missing_rate_"), "column_name"), "missing_rate", "missing_rate"),
        metric(duplicate_rate(df, keys), as_of, "data_quality", "duplicate_rate", "duplicate_rate", "duplicate_rate"),
        metric(max_silence(df, as_of, station, event), as_of, "freshness", "max_station_silence_minutes", "max_silence_minutes", "station_silence_minutes"),
    ]
    if ingestion in df.columns:
        delays = delay_stats(df, event, ingestion, exact=exact)
        parts.append(metric(delays, as_of, "freshness", "ingestion_delay_p95_seconds", "p95_delay_seconds", "delay_p95_seconds"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def sketched_metrics(sketches: DataFrame, as_of: Column, columns: list[str], delay: str = "delay_seconds") -> DataFrame:
    """Missing rates, exactly, and the delay's 95th percentile from daily sketches (see sketches.py), without a scan of the rows."""
    read = quantiles(sketches, {"p95": 0.95})
    rates = metric(read.filter(F.col("column_name").isin(columns)), as_of, "data_quality", F.concat(F.lit("missing_rate_"), "column_name"), "missing_rate", "missing_rate")
    return rates.unionByName(metric(read.filter(F.col("column_name") == delay), as_of, "freshness", "ingestion_delay_p95_seconds", "p95", "delay_p95_seconds"))


def range_metrics(df: DataFrame, as_of: Column, ranges: dict[str, tuple]) -> DataFrame:
    """The share of values outside (low, high, low is strict) of each column that df has; without values it is NULL."""
    own = {c: r for c, r in ranges.items() if c in df.columns}

    def outside(c: str, low: float | None, high: float | None, strict: bool) -> Column:
        tests = [F.col(c) <= low if strict else F.col(c) < low] if low is not None else []
        tests += [F.col(c) > high] if high is not None else []
        bad = F.lit(False)
        for t in tests:
            bad = bad | t
        return F.avg(F.when(F.col(c).isNotNull(), bad.cast("int")))

    one = df.agg(*[outside(c, *r).alias(c) for c, r in own.items()])
    return metric(unpivot(one, list(own), "column_name", "rate"), as_of, "data_quality", F.concat(F.lit("out_of_range_rate_"), "column_name"), "rate", "out_of_range_rate")


def performance_metrics(snapshots: DataFrame, as_of: Column, split: str = "test") -> DataFrame:
    """MAE of each model's latest run against the run before it."""
    runs = pivot_metrics(snapshots.filter(F.col("split") == split), ["task", "model_name", "horizon", "run_id", "recorded_at"], ["mae"])
    both = current_and_previous(runs)
    return both.select(as_of.alias("metric_time"), F.to_date(as_of).alias("metric_date"), F.lit("performance").alias("category"), F.lit("mae_vs_previous").alias("metric_name"), F.col("mae").alias("metric_value"), mae_drift_status(F.col("mae"), F.col("previous_mae")).alias("severity"), "model_name", "horizon")


def daily(df: DataFrame, as_of: Column, columns: list[str], keys: list[str], snapshots: DataFrame | None = None, **names) -> DataFrame:
    out = quality_metrics(df, as_of, columns, keys, **names)
    return out if snapshots is None else out.unionByName(performance_metrics(snapshots, as_of), allowMissingColumns=True)
