"""Structured Streaming operators: parsing, the interval join, keyed state, windows and micro-batch jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.normalize import parse_time
from ..functions.physics import add_physics, add_realtime_features, time_parts
from ..operators.joins import merge_latest
from ..operators.projections import canonical_air, canonical_weather, existing
from ..operators.quality import route
from ..operators.windows import add_changes, forward_fill
from ..schemas import OBSERVATION
from ..sources.seen import SeenStore
from ..sources.versions import VersionedTable

LATE, TOLERANCE = "15 minutes", "15 minutes"
#: Rows of a station that the state keeps: the widest frame.
KEEP = 12
CHANGES = ["pressure_delta_3h", "wind_shear_U", "wind_shear_V", "temp_mean_6h", "pm25_acc_12h"]
TRACKED = ["pressure", "wind_U", "wind_V", "temp_c", "pm2_5"]


def parse(df: DataFrame, schema: T.StructType, topic: str | None = None, late: str | None = LATE, ts: str = "event_time") -> DataFrame:
    """Messages of one topic as columns, with a watermark on their time. Records without a time are dropped."""
    rows = df.filter(F.col("topic") == topic) if topic else df
    out = rows.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")
    if schema[ts].dataType == T.StringType():
        out = out.withColumn(ts, parse_time(F.col(ts)))
    out = out.filter(F.col(ts).isNotNull())
    return out.withWatermark(ts, late) if late else out


def interval_join(weather: DataFrame, air: DataFrame, station: str = "station_id", ts: str = "event_time", tolerance: str = TOLERANCE, how: str = "full_outer") -> DataFrame:
    """Rows of a station whose times lie within the tolerance; unmatched rows come once the watermark has passed them.

    Both sides need a watermark on ts. The air side's clashing columns are dropped, its key and time named a_*.

    Times are cut into bins of twice the tolerance, and an air row meets each bin that its tolerance reaches into. So the join is
    one on (station, bin), whose state and work are dealt out by time too, where a station alone would compare all its rows. In a
    full join the air rows that meet none come from a second one, in which the weather's times are spread and not theirs.
    """
    clash = [c for c in air.columns if c in weather.columns and c not in (station, ts)]
    a = air.drop(*clash).withColumnsRenamed({station: f"a_{station}", ts: f"a_{ts}"})
    length = F.expr(f"greatest(1, 2 * unix_micros(timestamp_micros(0) + INTERVAL {tolerance}))")
    bin_ = lambda t: F.floor(F.unix_micros(t) / length)
    one = lambda df, t, name: df.withColumn(name, bin_(F.col(t)))
    spread = lambda df, t, name: df.withColumn(name, F.explode(F.sequence(*[bin_(F.expr(f"{t} {sign} INTERVAL {tolerance}")) for sign in "-+"])))
    near = F.expr(f"{station} = a_{station} AND _bin = _a_bin AND a_{ts} >= {ts} - INTERVAL {tolerance} AND a_{ts} <= {ts} + INTERVAL {tolerance}")
    kind = how.replace("_", "").lower()
    if kind.startswith("right"):
        return spread(weather, ts, "_bin").join(one(a, f"a_{ts}", "_a_bin"), near, how).drop("_bin", "_a_bin")
    full = kind in ("full", "outer", "fullouter")
    out = one(weather, ts, "_bin").join(spread(a, f"a_{ts}", "_a_bin"), near, "left_outer" if full else how).drop("_bin", "_a_bin")
    if not full:
        return out
    met = one(a, f"a_{ts}", "_a_bin").join(spread(weather.select(station, ts), ts, "_bin"), near, "left_outer")
    return out.unionByName(met.filter(F.col(ts).isNull()).select(a.columns), allowMissingColumns=True)


HEARTBEAT = "heartbeat"


def heartbeats(spark, topics: list[str], at: str, station: str = "station_id", ts: str = "event_time") -> DataFrame:
    """A message for each topic that moves the watermark to a time: sent after the last record, it lets a join give the
    rows that met none. Filter its key (`heartbeat`) from what the join gives."""
    value = F.to_json(F.struct(F.lit(HEARTBEAT).alias(station), F.lit(at).alias(ts)))
    return spark.createDataFrame([(t,) for t in topics], "topic string").select("topic", F.lit(HEARTBEAT).alias("key"), value.alias("value"), F.lit(at).cast("timestamp").alias("timestamp"))


def unify(df: DataFrame, station: str = "station_id", ts: str = "event_time") -> DataFrame:
    """Keys of either side, `unknown` where a text key is missing, time parts, and the stateless features."""
    out = df.withColumns({station: F.coalesce(station, f"a_{station}", F.lit("unknown")), "timestamp": F.coalesce(ts, f"a_{ts}")}).drop(f"a_{station}", f"a_{ts}", ts)
    texts = {c: F.coalesce(c, F.lit("unknown")) for c in ("region", "city") if c in out.columns}
    out = out.withColumns(texts | time_parts(F.col("timestamp"))).filter(F.col("timestamp").isNotNull())
    return add_physics(out)


def changes_of(history: pd.DataFrame, backfill: bool, null_fill: float | None) -> pd.DataFrame:
    """The moving features of one station's rows in order of time."""
    x = history[TRACKED].astype(float).ffill()
    if backfill:
        x = x.bfill()
    out = pd.DataFrame(index=history.index)
    out["pressure_delta_3h"] = x["pressure"].diff(3)
    out["wind_shear_U"], out["wind_shear_V"] = x["wind_U"].diff(1), x["wind_V"].diff(1)
    out["temp_mean_6h"] = x["temp_c"].rolling(6, min_periods=1).mean()
    out["pm25_acc_12h"] = x["pm2_5"].rolling(KEEP, min_periods=1).sum()
    return out.fillna(null_fill) if null_fill is not None else out


def stateful_changes(df: DataFrame, station: str = "station_id", ts: str = "timestamp", null_fill: float | None = 0.0, backfill: bool = False, timeout_ms: int | None = None) -> DataFrame:
    """Lags and moving sums per station over the stream; the state is the last KEEP rows by time.

    A late row gets its own value from the rows that the state still has and changes later rows from then on; rows already
    given are not given again. backfill lets later rows of a batch fill earlier gaps. A state with a timeout ends
    after so long without rows. A station's rows of a micro-batch are held by one task; changes_batch() deals them out by time.
    """
    columns = [c for c in df.columns if c not in CHANGES]
    out_schema = T.StructType([df.schema[c] for c in columns] + [T.StructField(c, T.DoubleType()) for c in CHANGES])
    state_schema = T.StructType([T.StructField("times", T.ArrayType(T.LongType()))] + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in TRACKED])

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # the frames stay as they came, only times and tracked values are sorted
        given = list(frames)
        parts = [pd.DataFrame({"_t": f[ts].astype("int64"), "_new": True} | {c: f[c].astype(float) for c in TRACKED}) for f in given]
        if state.exists:
            times, *values = state.get
            parts.insert(0, pd.DataFrame({"_t": times, "_new": False} | {c: np.array(v, float) for c, v in zip(TRACKED, values)}))
        rows = pd.concat(parts, ignore_index=True)
        del parts
        rows = rows.sort_values(["_t", "_new"], kind="stable")
        last = rows.tail(KEEP)
        clean = lambda c: [None if pd.isna(v) else float(v) for v in last[c]]
        state.update((last["_t"].astype("int64").tolist(), *[clean(c) for c in TRACKED]))
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        features = changes_of(rows, backfill, null_fill).sort_index()
        at = len(rows) - sum(map(len, given))
        while given:
            f = given.pop(0)
            own = features.iloc[at : at + len(f)]
            at += len(f)
            yield pd.concat([f[columns].reset_index(drop=True), own.reset_index(drop=True)], axis=1)[[*columns, *CHANGES]]

    limit = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    return df.groupBy(station).applyInPandasWithState(run, out_schema, state_schema, "append", limit)


def hazard_alerts(df: DataFrame, threshold: float, hours: int, value: str = "pm2_5", station: str = "station_id", ts: str = "timestamp", late_hours: int = 24) -> DataFrame:
    """A row per hour of a station in which `value` has been at or above the threshold for `hours` hours or more in a row.

    An hour without rows ends a run. An alert is given with the micro-batch that reaches it; where later rows of the hour
    raise its peak, or a late hour lengthens its run, the hour is given again, so that its last row (the one of the
    largest hours_in_row and peak) counts. The state is the peaks of the last late_hours hours, which later batches may
    still change, and the hour before them with its run's length; rows of hours up to that one are dropped.
    """
    out = T.StructType([T.StructField(station, df.schema[station].dataType), T.StructField("hour_ts", T.TimestampType()), T.StructField("hours_in_row", T.LongType()), T.StructField("peak", T.DoubleType())])
    state_schema = T.StructType([T.StructField("last", T.LongType()), T.StructField("length", T.LongType()), T.StructField("hours", T.ArrayType(T.LongType())), T.StructField("peaks", T.ArrayType(T.DoubleType()))])

    def lengths(peaks: dict[int, float], last: int | None, length: int) -> dict[int, int]:
        found = {}
        for at in sorted(peaks):
            length = (length + 1 if last is not None and at == last + 1 else 1) if peaks[at] >= threshold else 0
            found[at], last = length, at
        return found

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(frames), ignore_index=True)
        new = new[new[value].notna()]
        last, length, kept, tops = state.get if state.exists else (None, 0, [], [])
        before = dict(zip(kept, tops))
        now = dict(before)
        for hour, peak in new.groupby(new[ts].dt.floor("h"))[value].max().items():
            at = int(hour.timestamp()) // 3600
            if last is None or at > last:
                now[at] = max(float(peak), now.get(at, float(peak)))
        given, runs = lengths(before, last, length), lengths(now, last, length)
        rows = [(key[0], pd.Timestamp(at * 3600, unit="s"), n, now[at]) for at, n in runs.items() if n >= hours and (n, now[at]) != (given.get(at), before.get(at))]
        if now:
            over = [at for at in now if at <= max(now) - late_hours]
            if over:
                last, length = max(over), runs[max(over)]
            left = sorted(at for at in now if last is None or at > last)
            state.update((last, length, left, [now[at] for at in left]))
        yield pd.DataFrame(rows, columns=[f.name for f in out.fields]).astype({"hours_in_row": np.int64, "hour_ts": "datetime64[ns]"})

    return df.select(station, ts, F.col(value).cast("double").alias(value)).groupBy(station).applyInPandasWithState(run, out, state_schema, "append", GroupStateTimeout.NoTimeout)


def sliding_averages(df: DataFrame, length: str = "1 hour", slide: str | None = "15 minutes", values: tuple[str, ...] = ("us_aqi", "pm2_5"), keys: tuple[str, ...] = ("station_id",), ts: str = "timestamp") -> DataFrame:
    """Averages over sliding windows; needs a watermark on ts where it runs as a stream."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    out = df.groupBy(*keys, w.alias("w")).agg(*[F.avg(v).alias(f"avg_{v}") for v in values], F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[f"avg_{v}" for v in values], "n")


def only_newer(df: DataFrame, key: str = "city", ts: str = "event_time") -> DataFrame:
    """Rows later than any before of their key; the state is the latest time of a key."""

    def run(k, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(frames), ignore_index=True).sort_values(ts, kind="stable", ignore_index=True)
        seen = state.get[0] if state.exists else None
        t = new[ts].astype("int64")
        before = t.cummax().shift(fill_value=np.iinfo(np.int64).min)
        keep = t > (before if seen is None else np.maximum(before, seen))
        state.update((int(max(t.max(), seen if seen is not None else t.max())),))
        yield new[keep]

    return df.filter(F.col(ts).isNotNull()).groupBy(key).applyInPandasWithState(run, df.schema, T.StructType([T.StructField("seen", T.LongType())]), "append", GroupStateTimeout.NoTimeout)


def without_repeats(df: DataFrame, keys: list[str], ts: str = "event_time", late: str = LATE) -> DataFrame:
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def start(df: DataFrame, checkpoint: str, trigger: str = "1 minute", mode: str = "append", fmt: str | None = None, path: str | None = None, batch: Callable | None = None, options: dict[str, str] | None = None):
    """Start a query. trigger: an interval, or `available-now`."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger == "available-now" else writer.trigger(processingTime=trigger)
    if batch:
        return writer.foreachBatch(batch).start()
    return writer.format(fmt or "parquet").options(**(options or {})).start(path)


def batch_name(df: DataFrame, batch_id: int) -> str:
    """The name of a micro-batch that its retries share: the id of the stream, which lies in its checkpoint, and the batch's number."""
    stream = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream or 'stream'}/{batch_id}"


def table_sink(path: str, columns: list[str] | None = None, fresh: bool = False) -> Callable[[DataFrame, int], None]:
    """Append micro-batches to a versioned table, each once however often it is retried. fresh: batch 0 replaces what is there."""

    def write(df: DataFrame, batch_id: int) -> None:
        out = df.select(*columns) if columns else df
        table = VersionedTable(df.sparkSession, path)
        (table.replace if fresh and batch_id == 0 else table.append)(out, batch_name(df, batch_id))

    return write


def fresh_batch(store: SeenStore, path: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch job: the rows that the store has not seen go to a versioned table, then the store notes the batch. A retry
    finds the rows written, the batch noted, or both, and adds nothing."""
    write = table_sink(path)

    def run(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            write(store.fresh(df), batch_id)
            store.remember(df, batch_name(df, batch_id))
        finally:
            df.unpersist()

    return run


def changes_batch(state: str, job: Callable[[DataFrame, int], None], station: str = "station_id", ts: str = "timestamp", null_fill: float | None = 0.0, bucket: str = "day") -> Callable[[DataFrame, int], None]:
    """A micro-batch job that adds what stateful_changes() adds, by windows over a station's buckets of time (a unit of
    date_trunc), and hands the rows to job. No task holds a station's rows of a micro-batch.

    The state, the last KEEP rows of each station by time, is a versioned table under the path `state`. A micro-batch reads
    what those before it in its stream have left, and leaves its own once job has ended, so a retry gives the same rows.
    Rows of the same time are ordered by a hash of their columns.
    """

    def before(spark, stream: str, batch_id: int) -> DataFrame | None:
        table = VersionedTable(spark, state)
        mine = {int(e["batch"].rsplit("/", 1)[1]): e["version"] for e in table.log() if e["batch"] and e["batch"].rsplit("/", 1)[0] == stream}
        past = [n for n in mine if n < batch_id]
        return table.read(mine[max(past)]) if past else None

    def run(df: DataFrame, batch_id: int) -> None:
        name, columns = batch_name(df, batch_id), [c for c in df.columns if c not in CHANGES]
        order = lambda new, at: F.struct(F.lit(new).alias("new"), at.alias("at")).alias("_order")
        tracked = [F.col(c).cast("double").alias(c) for c in TRACKED]
        new = df.select(station, ts, *tracked, order(True, F.xxhash64(*columns)), F.struct(*columns).alias("_row")).persist()
        try:
            if new.isEmpty():
                job(new.select("_row.*", *[F.lit(null_fill).cast("double").alias(c) for c in CHANGES]), batch_id)
                return
            old = before(df.sparkSession, name.rsplit("/", 1)[0], batch_id)
            rows = new if old is None else new.unionByName(old.withColumn("_order", order(False, F.col("at"))).drop("at"), allowMissingColumns=True)
            filled = forward_fill(rows, TRACKED, station, ts, drop_empty=False, bucket=bucket, ties=("_order",))
            out = add_changes(filled, station, ts, null_fill=null_fill, bucket=bucket, ties=("_order",))
            job(out.filter("_order.new").select("_row.*", *CHANGES), batch_id)
            latest = Window.partitionBy(station).orderBy(F.col(ts).desc_nulls_last(), F.col("_order").desc())
            last = rows.drop("_row").withColumn("at", -F.row_number().over(latest).cast("long")).filter(F.col("at") >= -KEEP)
            VersionedTable(df.sparkSession, state).replace(last.drop("_order"), name)
        finally:
            new.unpersist()

    return run


def feature_batch(path: str, score: Callable[[DataFrame], DataFrame] | None = None, alerts_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """A micro-batch job: observations, then scored alerts, both into versioned tables. The first batch of a checkpoint replaces
    their rows, later ones append; a batch that is retried writes only what it had not committed."""
    observations, alerts = table_sink(path, fresh=True), table_sink(alerts_path, fresh=True) if alerts_path else None

    def run(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            if not df.isEmpty():
                observations(existing(df, OBSERVATION), batch_id)
                if score and alerts:
                    alerts(score(df), batch_id)
        finally:
            df.unpersist()

    return run


def scoring_batch(score: Callable[[DataFrame], DataFrame], path: str, weather_topic: str, air_topic: str, schema: T.StructType, key: str = "city") -> Callable[[DataFrame, int], None]:
    """A micro-batch job over raw messages: latest weather and air rows per key, features, scores, into a versioned table."""
    write = table_sink(path)

    def run(df: DataFrame, batch_id: int) -> None:
        out = latest_features(df, weather_topic, air_topic, schema, key).persist()
        try:
            if not out.isEmpty():
                write(score(out), batch_id)
        finally:
            out.unpersist()

    return run


def latest_features(df: DataFrame, weather_topic: str, air_topic: str, schema: T.StructType, key: str = "city") -> DataFrame:
    w = canonical_weather(parse(df, schema, weather_topic, late=None), [key, "region", "station_id", "latitude", "longitude", "event_time"])
    a = canonical_air(parse(df, schema, air_topic, late=None), [key, "event_time"])
    return add_realtime_features(merge_latest(w, a, key, "event_time").withColumnRenamed("event_time", "timestamp"))


def routing_batch(validate: Callable[[DataFrame], DataFrame], accept: Callable, reject: Callable, numbered: bool = False) -> Callable[[DataFrame, int], None]:
    """Validate once, send valid rows one way and the others the other. numbered: accept and reject also get the batch's number,
    as table_sink() needs it."""

    def run(df: DataFrame, batch_id: int) -> None:
        tagged = validate(df).persist()
        try:
            good, bad = route(tagged)
            number = (batch_id,) if numbered else ()
            accept(good, *number)
            reject(bad, *number)
        finally:
            tagged.unpersist()

    return run
