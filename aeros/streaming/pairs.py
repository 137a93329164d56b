"""Pairs of two streams of which each row is stored once: a micro-batch adds its rows, and pairs are made when they are read.

The pairs of a station grow with the product of its rows of the same minutes. State, shuffles and disk here grow with the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import within
from ..operators.windows import add_changes, forward_fill
from ..sources.versions import VersionedTable
from .operators import CHANGES, HEARTBEAT, KEEP, TRACKED, table_sink

#: Seconds that a pair's times lie apart at most, and that the watermark stays behind the newest row.
TOLERANCE_S = LATE_S = 15 * 60
#: Rows before a pair that its moving features need, and pairs that a task sorts.
REACH, TASK_ROWS = KEEP - 1, 500_000


def sides_batch(path: str, sides: dict[str, Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame, int], None]:
    """A micro-batch job: what each function makes of the batch goes to a versioned table of its name under path, once however
    often the batch is retried."""
    writes = {name: table_sink(f"{path}/{name}") for name in sides}

    def run(df: DataFrame, batch_id: int) -> None:
        for name, make in sides.items():
            writes[name](make(df), batch_id)

    return run


def stored(spark: SparkSession, path: str, names: tuple[str, str] = ("weather", "air")) -> list[DataFrame]:
    """The rows that the stream has stored so far, heartbeats too."""
    return [VersionedTable(spark, f"{path}/{n}").read() for n in names]


def without_heartbeats(df: DataFrame, station: str = "station_id") -> DataFrame:
    return df.filter(~F.col(station).eqNullSafe(F.lit(HEARTBEAT)))


def watermark(weather: DataFrame, air: DataFrame, late: int = LATE_S, ts: str = "event_time"):
    """The time up to which both sides are whole: `late` seconds before the newest row of the side that is behind. None where
    a side has no row."""
    newest = [df.agg(F.max(ts).alias("t")).select((F.col("t") - F.make_dt_interval(secs=F.lit(late))).alias("t")).first()["t"] for df in (weather, air)]
    return None if None in newest else min(newest)


def joined(weather: DataFrame, air: DataFrame, passed, seconds: int = TOLERANCE_S, station: str = "station_id", ts: str = "event_time") -> DataFrame:
    """The full join of the rows of both sides within `seconds`; a row that meets none is given once the watermark `passed` has
    gone by all times that it could meet."""
    out = within(weather, air, seconds, station, ts)
    alone = F.unix_micros(F.coalesce(ts, f"a_{ts}").cast("timestamp")) + seconds * 1_000_000
    gone = F.lit(False) if passed is None else alone < F.unix_micros(F.lit(passed).cast("timestamp"))
    return out.filter((F.col(ts).isNotNull() & F.col(f"a_{ts}").isNotNull()) | gone)


def pair_changes(weather: DataFrame, air: DataFrame, scratch: str, columns: list[str], keep: list[str] | None = None, seconds: int = TOLERANCE_S, station: str = "station_id", ts: str = "timestamp", air_ts: str = "event_time", null_fill: float | None = 0.0, task_rows: int = TASK_ROWS) -> DataFrame:
    """`keep` (by default `columns`) of the pairs within `seconds`, at the weather's time, and what changes_batch() adds to them:
    moving features over all pairs of a station in order of time, those of the same time by a hash of `columns`.

    Pairs are made in bins of a station and time, and the windows work in the same bins, so that pairs are neither shuffled
    nor stored. What a bin needs of those before it is its halo: the last REACH pairs, filled. They come from the pairs of a
    bin's last times alone, which counts of pairs by time tell, and lie in a table under `scratch`, a few rows a bin.
    """
    us = 1_000_000
    bin_ = lambda t: F.floor(t / F.lit(2 * seconds * us)).cast("long")
    keep = keep or columns
    own = [c for c in air.columns if c in {*columns, *keep} and c not in weather.columns]
    a = air.select(F.col(station).alias("_a_station"), F.unix_micros(air_ts).alias("_a_us"), *own).filter("_a_station IS NOT NULL AND _a_us IS NOT NULL")
    a = a.withColumn("_a_bin", F.explode(F.sequence(bin_(F.col("_a_us") - seconds * us), bin_(F.col("_a_us") + seconds * us))))
    w = weather.withColumn("_us", F.unix_micros(ts)).withColumn("_bin", bin_(F.col("_us")))
    near = (F.col(station) == F.col("_a_station")) & (F.col("_bin") == F.col("_a_bin")) & (F.abs(F.col("_us") - F.col("_a_us")) <= seconds * us)
    key, of_bin = [station, "_bin"], Window.partitionBy(station, "_bin")

    counts = w.join(a, near).groupBy(*key, ts).agg(F.count("*").alias("_n"), *[F.count(c).alias(f"_n_{c}") for c in TRACKED]).persist()
    try:
        later = of_bin.orderBy(F.desc(ts)).rowsBetween(Window.unboundedPreceding, -1)
        after = lambda c: F.coalesce(F.sum(c).over(later), F.lit(0))
        # the last REACH pairs, and of each measure as many that are not null: one of them fills the first of those pairs
        wanted = reduce(or_, [(F.col(f"_n_{c}") > 0) & (after(f"_n_{c}") < REACH) for c in TRACKED], after("_n") < REACH)
        last_times = counts.withColumn("_wanted", wanted).filter("_wanted").select(*key, ts)
        total = counts.agg(F.sum("_n")).first()[0] or 0
        ends = w.join(last_times, [*key, ts], "left_semi").join(a, near).withColumn("_at", F.xxhash64(*columns)).select(*key, ts, "_at", *[F.col(c).cast("double").alias(c) for c in TRACKED])
        ends = forward_fill(ends, TRACKED, station, ts, drop_empty=False, ties=("_at",), parts=("_bin",))
        ends = ends.withColumn("_beyond", F.lead(F.lit(True), REACH).over(of_bin.orderBy(ts, "_at"))).filter("_beyond IS NULL").drop("_beyond")
        # a bin's last row holds its last values, so these few rows a station carry all that is to be filled
        ends = forward_fill(ends, TRACKED, station, ts, drop_empty=False, ties=("_at",))
        ends.withColumn("_pos", F.row_number().over(Window.partitionBy(station).orderBy(ts, "_at"))).write.parquet(f"{scratch}/ends")
    finally:
        counts.unpersist()

    spark = weather.sparkSession
    ends = spark.read.parquet(f"{scratch}/ends")
    first = ends.groupBy(*key).agg(F.min("_pos").alias("_first"))
    halo = ends.drop("_bin").withColumn("_first", F.explode(F.sequence(F.col("_pos") + 1, F.col("_pos") + REACH))).join(first, [station, "_first"])
    halo = halo.select(*key, ts, "_at", *[F.col(c).alias(f"_halo_{c}") for c in TRACKED], F.lit(False).alias("_own"))

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-total // task_rows), first.count()))
    rows = w.withColumn("_own", F.lit(True)).unionByName(halo, allowMissingColumns=True).repartition(n, *key)
    pairs = rows.join(a.repartition(n, "_a_station", "_a_bin"), F.col("_own") & near, "left").filter("NOT _own OR _a_us IS NOT NULL")
    # the features need filled values, the rows keep their own
    kept = {f"_row_{c}": F.col(c) for c in TRACKED}
    filled = {c: F.coalesce(F.col(c).cast("double"), f"_halo_{c}") for c in TRACKED}
    pairs = pairs.withColumn("_at", F.when(F.col("_own"), F.xxhash64(*columns)).otherwise(F.col("_at"))).withColumns(kept).withColumns(filled)
    pairs = forward_fill(pairs, TRACKED, station, ts, drop_empty=False, ties=("_at",), parts=("_bin",))
    out = add_changes(pairs, station, ts, null_fill=null_fill, ties=("_at",), parts=("_bin",))
    return out.filter("_own").select(*[F.col(f"_row_{c}" if c in TRACKED else c).alias(c) for c in keep], *CHANGES)
