"""Per-station time series: fills, changes, moving sums, targets, latest rows and de-duplication.

Frames count rows. exact_hours=True counts time instead: a frame of n hours, and a lag or lead that must lie exactly n hours
away.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schemas import SENSORS, TARGETS
from .filters import any_sensor

HORIZONS, FAR_HORIZONS = (1, 2, 3, 4, 5, 6), (1, 2, 3, 4, 5, 6, 9, 15, 24)
HOUR = 3600


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], ts: str = "timestamp", tie: str | None = "event_id") -> DataFrame:
    """NULL times come last; ties go to the larger tie column."""
    return first_per_key(df, keys, [F.col(ts).desc_nulls_last(), *([F.col(tie).desc_nulls_last()] if tie and tie in df.columns else [])])


def one_per_key(df: DataFrame, keys: list[str], newest: str = "ingestion_time", tie: str = "event_id") -> DataFrame:
    """One row per key by a total order: the newest, then the larger tie column."""
    return latest_per_key(df, keys, newest, tie)


def split_repeats(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Tag rows: the first of each key passes, later ones are repeats."""
    w = Window.partitionBy(*keys).orderBy(*order)
    n = F.row_number().over(w)
    return df.withColumn("error_type", F.when(n > 1, "duplicate_event"))


def forward_fill(df: DataFrame, columns: list[str] = SENSORS, station: str = "station_id", ts: str = "timestamp", drop_empty: bool = True, bucket: str | None = None, ties: tuple[str, ...] = (), parts: tuple[str, ...] = ()) -> DataFrame:
    """Each null takes the station's last value before it.

    bucket (a unit of date_trunc, such as 'month') fills within a station's buckets and carries each bucket's last values
    into the next ones, so that no task sorts a station's whole history; only one row a bucket is ordered by station.
    ties names columns that order rows of the same time; parts, without a bucket, columns that part a station's rows too.
    """
    columns = [c for c in columns if c in df.columns]
    last = lambda w: {c: F.last(c, ignorenulls=True).over(w) for c in columns}
    if bucket is None:
        out = df.withColumns(last(Window.partitionBy(station, *parts).orderBy(ts, *ties).rowsBetween(Window.unboundedPreceding, 0)))
        return any_sensor(out, columns) if drop_empty else out
    cut = df.withColumn("_bucket", F.date_trunc(bucket, ts))
    # rows without a time come before all others, as in the station's order
    when = F.coalesce(F.col(ts), F.lit("0001-01-01").cast("timestamp"))
    at = F.struct(when, *ties) if ties else when
    ends = cut.groupBy(station, "_bucket").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])
    carried = ends.withColumns(last(Window.partitionBy(station).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
    carried = carried.select(F.col(station).alias("_station"), F.col("_bucket").alias("_from"), *[F.col(c).alias(f"_carried_{c}") for c in columns])
    inside = cut.withColumns(last(Window.partitionBy(station, "_bucket").orderBy(ts, *ties).rowsBetween(Window.unboundedPreceding, 0)))
    joined = inside.join(carried, F.col(station).eqNullSafe(F.col("_station")) & F.col("_bucket").eqNullSafe(F.col("_from")), "left")
    out = joined.withColumns({c: F.coalesce(c, f"_carried_{c}") for c in columns}).select(*df.columns)
    return any_sensor(out, columns) if drop_empty else out


def over_buckets(df: DataFrame, compute: Callable[[DataFrame, WindowSpec], DataFrame], bucket: str, before: int = 0, after: int = 0, station: str = "station_id", ts: str = "timestamp", ties: tuple[str, ...] = ()) -> DataFrame:
    """compute(df, window) of frames that reach `before` rows back, or `after` rows ahead, as over each station in order of ts,
    but in windows over a station's buckets (a unit of date_trunc), so that no task sorts a station's whole history.

    Rows whose frame lies within their bucket are done there. The others, at most before (after) rows a bucket, get a halo: the rows
    next to the bucket, taken from the last (first) rows of the buckets next to it, of which a row a bucket is ordered by
    station. All parts read one shuffle by station and bucket. ties names columns that order rows of the same time.
    """
    if (before > 0) == (after > 0):
        raise ValueError("frames reach either back or ahead")
    reach, names = before + after, df.columns
    w = Window.partitionBy(station, "_bucket").orderBy(ts, *ties)
    into, out = (F.lag, F.lead) if before else (F.lead, F.lag)
    # on the near side a row's frame may leave the bucket; the far side is the halo of other buckets
    marked = compute(df.withColumn("_bucket", F.date_trunc(bucket, ts)), w).withColumns({"_within": into(F.lit(True), reach).over(w), "_beyond": out(F.lit(True), reach).over(w)})
    inside = marked.filter("_within").drop("_bucket", "_within", "_beyond")
    edges = marked.filter("_within IS NULL").select(*names, "_bucket", F.lit(True).alias("_own"))
    far = marked.filter("_beyond IS NULL").groupBy(station, "_bucket").agg(F.array_sort(F.collect_list(F.struct(F.col(ts).alias("_t"), *ties, F.struct(*names).alias("r")))).alias("_rows"))
    near = Window.partitionBy(station).orderBy("_bucket").rowsBetween(*((-reach, -1) if before else (1, reach)))
    joined = F.flatten(F.collect_list("_rows").over(near))
    size = F.size("_halo")
    taken = F.slice("_halo", F.greatest(size - reach, F.lit(0)) + 1, reach) if before else F.slice("_halo", 1, reach)
    halo = far.withColumn("_halo", joined).filter(size > 0).select("_bucket", F.explode(taken).alias("h")).select(*[F.col("h.r")[n].alias(n) for n in names], "_bucket", F.lit(False).alias("_own"))
    own = compute(edges.unionByName(halo), w).filter("_own").drop("_bucket", "_own")
    return inside.unionByName(own)


def _back(value: str, n: int, w, exact: bool) -> Column:
    return F.max(value).over(w.rangeBetween(-n * HOUR, -n * HOUR)) if exact else F.lag(value, n).over(w)


def add_changes(df: DataFrame, station: str = "station_id", ts: str = "timestamp", exact_hours: bool = False, null_fill: float | None = None, bucket: str | None = None, ties: tuple[str, ...] = (), parts: tuple[str, ...] = ()) -> DataFrame:
    """pressure_delta_3h, wind_shear_U, wind_shear_V, temp_mean_6h, pm25_acc_12h over one ordering of each station.

    bucket (a unit of date_trunc) works in buckets of a station, with the rows before each; it needs frames of rows.
    ties names columns that order rows of the same time; parts, without a bucket, columns that part a station's rows too.
    """

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        frame = (lambda n: w.rangeBetween(-(n - 1) * HOUR, 0)) if exact_hours else (lambda n: w.rowsBetween(-(n - 1), 0))
        out = {
            "pressure_delta_3h": F.col("pressure") - _back("pressure", 3, w, exact_hours),
            "wind_shear_U": F.col("wind_U") - _back("wind_U", 1, w, exact_hours),
            "wind_shear_V": F.col("wind_V") - _back("wind_V", 1, w, exact_hours),
            "temp_mean_6h": F.avg("temp_c").over(frame(6)),
            "pm25_acc_12h": F.sum("pm2_5").over(frame(12)),
        }
        if null_fill is not None:
            out = {n: F.coalesce(c, F.lit(null_fill)) for n, c in out.items()}
        return rows.withColumns(out)

    if bucket is None:
        return compute(df, Window.partitionBy(station, *parts).orderBy(F.unix_timestamp(ts) if exact_hours else F.col(ts), *ties))
    if exact_hours:
        raise ValueError("buckets need frames of rows")
    return over_buckets(df, compute, bucket, before=11, station=station, ts=ts, ties=ties)


def add_targets(df: DataFrame, hours: tuple[int, ...] = HORIZONS, station: str = "station_id", ts: str = "timestamp", drop_incomplete: bool = False, exact_hours: bool = False, bucket: str | None = None) -> DataFrame:
    """target_<name>_<n>h: the value n rows (or exactly n hours) later; drop_incomplete drops rows without the farthest.

    bucket (a unit of date_trunc) works in buckets of a station, with the rows after each; it needs leads of rows.
    """
    value = (lambda c, h, w: F.max(c).over(w.rangeBetween(h * HOUR, h * HOUR))) if exact_hours else (lambda c, h, w: F.lead(c, h).over(w))
    compute = lambda rows, w: rows.withColumns({f"target_{n}_{h}h": value(c, h, w) for h in hours for n, c in TARGETS.items()})
    if bucket is None:
        out = compute(df, Window.partitionBy(station).orderBy(F.unix_timestamp(ts) if exact_hours else F.col(ts)))
    elif exact_hours:
        raise ValueError("buckets need leads of rows")
    else:
        out = over_buckets(df, compute, bucket, after=max(hours), station=station, ts=ts)
    return out.dropna(subset=[f"target_{n}_{max(hours)}h" for n in TARGETS]) if drop_incomplete else out


def current_and_previous(df: DataFrame, keys: tuple[str, ...] = ("task", "model_name", "horizon"), ts: str = "recorded_at", value: str = "mae") -> DataFrame:
    """The latest run per key with the run before it."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc(), F.col("run_id").desc())
    tagged = df.withColumns({"_rn": F.row_number().over(w), f"previous_{value}": F.lead(value).over(w)})
    return tagged.filter("_rn = 1").drop("_rn")


def latest_value(df: DataFrame, key: str = "metric_name", value: str = "metric_value", ts: str = "metric_time") -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, ts).alias(value), F.max(ts).alias(ts))
