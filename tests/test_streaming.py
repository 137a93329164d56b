"""Streams over files, run to their end, against the batch operators on the same rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aeros.operators.windows import add_changes, forward_fill
from aeros.plans.base import scratch
from aeros.plans.registry import QUERIES
from aeros.sources.versions import VersionedTable
from aeros.streaming import operators as S
from aeros.streaming import silence

T0 = dt.datetime(2024, 1, 1)


def stream_of(spark, df, tmp_path, files=1, order="timestamp"):
    path = str(tmp_path / "in")
    rows = df.orderBy(order).collect()
    step = -(-len(rows) // files)
    for i in range(0, len(rows), step):
        spark.createDataFrame(rows[i : i + step], df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(df, name):
    spark = df.sparkSession
    path = scratch(spark, name)
    S.start(df, scratch(spark, name), "available-now", path=path).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@pytest.fixture(scope="module")
def rows(spark):
    made = [(f"s{i % 3}", T0 + dt.timedelta(hours=i // 3), 1000.0 + i % 7, float(i % 5), float(i % 4), 20.0 + i % 6, float(i % 11)) for i in range(90)]
    return spark.createDataFrame(made, "station_id string, timestamp timestamp, pressure double, wind_U double, wind_V double, temp_c double, pm2_5 double")


@pytest.mark.parametrize("files", [1, 4])
def test_stateful_changes_match_batch(spark, rows, tmp_path, files):
    got = run(S.stateful_changes(stream_of(spark, rows, tmp_path, files)), "l3")
    want = add_changes(rows, null_fill=0.0)
    key = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select("station_id", "timestamp", *S.CHANGES).collect())
    assert key(got) == key(want)


@pytest.mark.parametrize("files", [1, 4])
def test_changes_batch(spark, rows, tmp_path, files):
    """As the batch operator, with gaps to fill, equal times, and a stream that dies between its rows and its state."""
    v = F.when(F.col("pressure") % 3 > 0, F.col("pressure"))
    gaps = rows.withColumn("pressure", v).withColumn("timestamp", F.date_trunc("hour", F.col("timestamp") + F.expr("INTERVAL 2 DAYS") * F.floor(F.hour("timestamp") / 8)))
    gaps = gaps.unionByName(gaps.filter("station_id = 's1' AND hour(timestamp) = 5"))
    path, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "checkpoint"))
    write, seen = S.table_sink(path), set()

    def job(df, batch_id):
        write(df, batch_id)
        if batch_id not in seen:
            seen.add(batch_id)
            raise RuntimeError("killed before the state")

    stream = stream_of(spark, gaps, tmp_path, files)
    for _ in range(files):
        with pytest.raises(Exception, match="killed before the state"):
            S.start(stream, checkpoint, "available-now", batch=S.changes_batch(state, job)).awaitTermination()
    S.start(stream, checkpoint, "available-now", batch=S.changes_batch(state, job)).awaitTermination()
    want = add_changes(forward_fill(gaps, S.TRACKED, drop_empty=False), null_fill=0.0)
    key = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select("station_id", "timestamp", *S.CHANGES).collect())
    assert key(VersionedTable(spark, path).read()) == key(want) and VersionedTable(spark, path).read().select("pressure").filter("pressure IS NULL").count() == gaps.filter("pressure IS NULL").count()
    assert {r["n"] for r in VersionedTable(spark, state).read().groupBy("station_id").agg(F.count("*").alias("n")).collect()} == {S.KEEP}


@pytest.mark.parametrize("name", ["str3", "str5_features"])
def test_no_task_holds_a_station(spark, monkeypatch, name):
    """The queries' moving features do not go through a function that gets all rows of a station."""
    monkeypatch.setattr(S, "stateful_changes", lambda *a, **k: pytest.fail("one task a station"))
    assert QUERIES[name](spark, "/root/testdata/sf0.001").filter("pm25_acc_12h IS NOT NULL").count() > 0


def test_hazard(spark, tmp_path):
    levels = [40, 40, 40, 10, 40, 40, None, 40, 50, 60]
    df = spark.createDataFrame([("a", T0 + dt.timedelta(hours=h, minutes=5), float(v) if v is not None else None) for h, v in enumerate(levels)], "station_id string, timestamp timestamp, pm2_5 double")
    out = run(S.hazard_alerts(stream_of(spark, df, tmp_path, 3), 35.0, 3), "hazard").orderBy("hour_ts").collect()
    assert [(r["hour_ts"].hour, r["hours_in_row"], r["peak"]) for r in out] == [(2, 3, 40.0), (9, 3, 60.0)]


@pytest.mark.parametrize("late_hours", [24, 2])
def test_hazard_of_split_and_late_hours(spark, tmp_path, late_hours):
    """(file, hour, minute, value): hours 2 and 5 go on in a later file, hour 4 comes after hour 5."""
    made = [(0, 0, 5, 40.0), (0, 1, 5, 40.0), (0, 2, 5, 10.0), (1, 2, 30, 50.0), (1, 3, 5, 60.0), (2, 5, 5, 40.0), (3, 4, 5, 45.0), (3, 5, 50, 70.0), (4, 6, 5, 10.0)]
    path = str(tmp_path / "in")
    for f in range(5):
        rows = [("a", T0 + dt.timedelta(hours=h, minutes=m), v) for i, h, m, v in made if i == f]
        spark.createDataFrame(rows, "station_id string, timestamp timestamp, pm2_5 double").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("station_id string, timestamp timestamp, pm2_5 double").option("maxFilesPerTrigger", 1).parquet(path)
    out = run(S.hazard_alerts(stream, 35.0, 3, late_hours=late_hours), "hazard").groupBy("hour_ts").agg({"hours_in_row": "max", "peak": "max"}).orderBy("hour_ts").collect()
    assert [(r[0].hour, r["max(hours_in_row)"], r["max(peak)"]) for r in out] == [(2, 3, 50.0), (3, 4, 60.0), (4, 5, 45.0), (5, 6, 70.0)]


def test_only_newer(spark, tmp_path):
    df = spark.createDataFrame([(i, "a", T0 + dt.timedelta(minutes=m)) for i, m in enumerate([1, 3, 3, 2, 5])], "event_id int, city string, event_time timestamp")
    out = run(S.only_newer(stream_of(spark, df, tmp_path, 5, "event_id")), "newer")
    assert sorted(r["event_id"] for r in out.collect()) == [0, 1, 4]


def test_interval_join(spark, tmp_path):
    """Matched within 15 minutes; unmatched rows of both sides once a far later row has moved the watermark."""
    m = lambda x: T0 + dt.timedelta(minutes=x)
    far = 60 * 24 * 30
    w = spark.createDataFrame([("a", m(0), 1.0), ("a", m(100), 2.0), ("z", m(far), 9.0)], "station_id string, event_time timestamp, temp_c double")
    a = spark.createDataFrame([("a", m(14), 5.0), ("a", m(130), 6.0), ("z", m(far + 20), 9.0)], "station_id string, event_time timestamp, pm2_5 double")
    (tmp_path / "w").mkdir(), (tmp_path / "a").mkdir()
    ws = stream_of(spark, w, tmp_path / "w", 3, "event_time").withWatermark("event_time", "15 minutes")
    as_ = stream_of(spark, a, tmp_path / "a", 3, "event_time").withWatermark("event_time", "15 minutes")
    out = run(S.interval_join(ws, as_), "join")
    pairs = {(r["temp_c"], r["pm2_5"]) for r in out.filter("coalesce(station_id, a_station_id) = 'a'").collect()}
    assert pairs == {(1.0, 5.0), (2.0, None), (None, 6.0)}


@pytest.mark.parametrize("how", ["inner", "left_outer", "right_outer", "full_outer"])
def test_interval_join_by_time(spark, how):
    """Pairs as by brute force, with times on the edges of bins and before 1970; the join's keys are the station and a bin."""
    at = lambda minutes: dt.datetime(1969, 12, 31, 20) + dt.timedelta(minutes=minutes)
    w = [("ab"[i % 2], at(m)) for i, m in enumerate([0, 15, 29, 30, 45, 200, 215, 240, 241, 255, 400])] + [("a", at(30)), ("b", at(900))]
    a = [("ab"[i % 2], at(m)) for i, m in enumerate([0, 14, 30, 31, 60, 185, 230, 256, 270, 270, 600])] + [("a", at(15)), ("c", at(30))]
    pairs = [(x, y) for x in w for y in a if x[0] == y[0] and abs(x[1] - y[1]) <= dt.timedelta(minutes=15)]
    want = pairs + [(x, (None, None)) for x in w if how in ("left_outer", "full_outer") and all(p[0] != x for p in pairs)]
    want += [((None, None), y) for y in a if how in ("right_outer", "full_outer") and all(p[1] != y for p in pairs)]
    frames = [spark.createDataFrame(rows, "station_id string, event_time timestamp") for rows in (w, a)]
    out = S.interval_join(*frames, how=how)
    assert sorted(str(((r[0], r[1]), (r[2], r[3]))) for r in out.collect()) == sorted(map(str, want))
    joins = [line for line in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    assert joins and all("station_id" in line and "_bin" in line.split("]")[0] for line in joins)


def test_sliding(spark, rows, tmp_path):
    s = stream_of(spark, rows, tmp_path).withWatermark("timestamp", "15 minutes")
    got = run(S.sliding_averages(s, "3 hours", "1 hour", ("pm2_5",)), "slide")
    want = S.sliding_averages(rows, "3 hours", "1 hour", ("pm2_5",))
    closed = {tuple(r) for r in got.collect()}
    assert closed and closed <= {tuple(r) for r in want.collect()}


def test_routing(spark, tmp_path):
    df = spark.createDataFrame([(1, ["e"]), (2, [])], "event_id int, errors array<string>")
    seen = {}
    job = S.routing_batch(lambda x: x, lambda x: seen.update(good=x.count()), lambda x: seen.update(bad=[r["error_message"] for r in x.collect()]))
    job(df, 0)
    assert seen == {"good": 1, "bad": ["e"]}


def test_retried_batch_changes_nothing(spark, rows, tmp_path):
    """A stream that dies between its two sinks and is restarted gives every row once in both."""
    ok = {"yes": False}
    path, alerts, checkpoint = (str(tmp_path / n) for n in ("obs", "alerts", "checkpoint"))

    def score(df):
        if not ok["yes"]:
            raise RuntimeError("killed between the sinks")
        return df.select("station_id", "timestamp")

    stream = stream_of(spark, rows, tmp_path, 3)
    with pytest.raises(Exception, match="killed between the sinks"):
        S.start(stream, checkpoint, "available-now", batch=S.feature_batch(path, score, alerts)).awaitTermination()
    observations = VersionedTable(spark, path)
    assert observations.version() == 1 and VersionedTable(spark, alerts).version() is None
    ok["yes"] = True
    S.start(stream, checkpoint, "available-now", batch=S.feature_batch(path, score, alerts)).awaitTermination()
    for p in (path, alerts):
        table = VersionedTable(spark, p)
        assert table.read().select("station_id", "timestamp").distinct().count() == table.read().count() == 90
    assert observations.version() == 3 and len({r["batch"] for r in observations.history().collect()}) == 3
    # a new checkpoint is a new stream: its first batch replaces what is there
    S.start(stream, str(tmp_path / "other"), "available-now", batch=S.feature_batch(path, score, alerts)).awaitTermination()
    assert observations.read().count() == 90 and observations.read(3).count() == 90 and observations.version() == 6


def test_direct_replay_and_routes(spark, tmp_path):
    df = spark.createDataFrame([(1, ["e"]), (2, []), (3, [])], "event_id int, errors array<string>")
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    job = S.routing_batch(lambda x: x, S.table_sink(good, ["event_id"]), S.table_sink(bad, ["event_id", "error_message"]), numbered=True)
    for number in (0, 0, 1, 0):
        job(df, number)
    assert VersionedTable(spark, good).read().count() == 4 and VersionedTable(spark, bad).read().count() == 2


def test_silence(spark, tmp_path):
    """A gap within a file, one over two files, one that the timer tells before the next row, and a station that stays away."""
    m = lambda x: T0 + dt.timedelta(minutes=x)
    made = [("a", 0), ("a", 30), ("b", 0), ("a", 130), ("c", 140), ("c", 200), ("c", 600), ("a", 610), ("c", 640), ("c", 650)]
    df = spark.createDataFrame([(s, m(t)) for s, t in made], "station_id string, event_time timestamp")
    before = spark.conf.get(silence.STORE[0])
    silence.with_timers(spark)
    try:
        stream = stream_of(spark, df, tmp_path, 5, "event_time").withWatermark("event_time", "10 minutes")
        path = str(tmp_path / "out")
        query = S.start(silence.silence_alerts(stream, 60), str(tmp_path / "checkpoint"), "available-now", path=path)
        query.awaitTermination()
        left = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    finally:
        spark.conf.set(silence.STORE[0], before)
    out = spark.read.parquet(path).collect()
    assert sorted((r["station_id"], r["last_seen"]) for r in out) == [("a", m(30)), ("a", m(130)), ("b", m(0)), ("c", m(200))]
    assert all(r["silent_from"] - r["last_seen"] == dt.timedelta(minutes=60) for r in out)
    # the state of b is gone: what is left is of a and c, a value and a timer each with the timer's index
    assert left <= 6
