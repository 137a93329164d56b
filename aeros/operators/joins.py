"""Joins of weather and air halves, catalog lookups and source fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import first_per_key, latest_per_key


def merge_station_hours(weather: DataFrame, air: DataFrame, station: str = "station_id", hour: str = "hour_ts", ts: str = "timestamp") -> DataFrame:
    """Full outer join on (station, hour bucket), keys from either side."""
    a = air.withColumnRenamed(ts, "_air_ts")
    return weather.join(a, [station, hour], "full_outer").withColumn(ts, F.coalesce(ts, "_air_ts")).drop("_air_ts")


def merge_exact(weather: DataFrame, air: DataFrame, keys: tuple[str, ...] = ("city_key", "timestamp")) -> DataFrame:
    return weather.join(air, list(keys), "inner")


def merge_latest(weather: DataFrame, air: DataFrame, key: str = "city", ts: str = "event_time") -> DataFrame:
    """Latest row of each side per key, inner join, the later of both times."""
    w = latest_per_key(weather, [key], ts)
    a = latest_per_key(air, [key], ts).withColumnRenamed(ts, "_air_ts")
    return w.join(a, key).withColumn(ts, F.greatest(ts, "_air_ts")).drop("_air_ts")


def within(left: DataFrame, right: DataFrame, seconds: int, key: str = "station_id", ts: str = "event_time", how: str = "full_outer") -> DataFrame:
    """Rows of a key whose times lie at most `seconds` apart, both ends included; with "left" or "full_outer" also those of one
    or both sides that meet none. The right side's key and time are named a_*, its other clashing columns are dropped.

    Times are cut into bins of that length: a row of one side meets the bins of its time and its two neighbours on the other,
    so both joins are equi-joins on (key, bin) that Spark can deal out and split where a bin is large.
    """
    if how not in ("inner", "left", "full_outer"):
        raise ValueError(f"how is inner, left or full_outer, not {how!r}")
    clash = [c for c in right.columns if c in left.columns and c not in (key, ts)]
    r = right.drop(*clash).withColumnsRenamed({key: f"a_{key}", ts: f"a_{ts}"})
    # times as numbers are made once a row, not once a pair
    r = r.withColumn("_a_us", F.unix_micros(F.col(f"a_{ts}").cast("timestamp")))
    timed = left.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    bin_ = lambda us: F.floor(F.col(us) / F.lit(max(1, seconds) * 1_000_000)).cast("long")
    spread = lambda us: F.explode(F.array(bin_(us) - 1, bin_(us), bin_(us) + 1))
    near = (F.col(key) == F.col(f"a_{key}")) & (F.abs(F.col("_us") - F.col("_a_us")) <= seconds * 1_000_000)
    extra = ("_bin", "_a_bin", "_us", "_a_us")
    wide = r.filter(F.col(f"a_{ts}").isNotNull()).withColumn("_a_bin", spread("_a_us"))
    out = timed.withColumn("_bin", bin_("_us")).join(wide, near & (F.col("_bin") == F.col("_a_bin")), "left" if how != "inner" else "inner").drop(*extra)
    if how != "full_outer":
        return out
    others = timed.filter(F.col(ts).isNotNull()).select(key, "_us").withColumn("_bin", spread("_us"))
    alone = r.withColumn("_a_bin", bin_("_a_us")).join(others, near & (F.col("_bin") == F.col("_a_bin")), "left_anti").drop(*extra)
    return out.unionByName(alone, allowMissingColumns=True)


def lookup(df: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Left lookup. Spark sends the dimension to every task if its size is below spark.sql.autoBroadcastJoinThreshold."""
    return df.join(dimension, on, "left")


def first_valid_source(df: DataFrame, keys: list[str], priority: list[str], valid, source: str = "source", tie: str = "event_id") -> DataFrame:
    """Per key, the valid record of the source that comes first in `priority`."""
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(source))
    return first_per_key(df.filter(valid & (rank > 0)).withColumn("_rank", rank), keys, ["_rank", tie]).drop("_rank")


