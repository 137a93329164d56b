"""Pairs of two stored streams: whole, as the batch operators give them, and never written."""

from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from aeros.operators.joins import within
from aeros.operators.windows import add_changes, forward_fill
from aeros.plans import models
from aeros.plans.registry import QUERIES
from aeros.streaming import operators as S
from aeros.streaming import pairs as P

T0 = dt.datetime(2024, 1, 1)
WEATHER = "station_id string, timestamp timestamp, temp_c double, pressure double, wind_U double, wind_V double"
AIR = "station_id string, event_time timestamp, pm2_5 double"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def text(df, columns):
    return sorted(tuple("NULL" if v is None else repr(round(v, 9)) if isinstance(v, float) else str(v) for v in r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """The smallest events, and 100 of them 40 times within 100 minutes: pairs grow 1,600 fold there."""
    folder = tmp_path_factory.mktemp("copies")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    some = events.filter("event_id < 100").crossJoin(spark.range(1, 41).select(F.col("id").alias("k")))
    ts = F.lit(T0).cast(events.schema["ts"].dataType) + F.expr("make_dt_interval(0, 0, event_id % 100)")
    many = events.unionByName(some.withColumns({"ts": ts, "event_id": F.expr("event_id + k * 100000"), "user_id": F.expr("user_id + k * 1500")}).drop("k"))
    many.write.parquet(f"{folder}/events.parquet")
    return str(folder), many.count()


@pytest.mark.parametrize("name", ["str5", "jon4", "str5_features", "str5_alerts"])
def test_pairs_are_not_written(spark, copies, tmp_path, monkeypatch, name):
    """What a query of the joined stream leaves on disk grows with the events; pairs are many times more."""
    made = iter(range(1000))
    monkeypatch.setattr(models, "scratch", lambda spark, n: str(tmp_path / f"{n}-{next(made)}"))
    folder, events = copies
    pairs = QUERIES[name](spark, folder).count()
    written = sum(pq.read_metadata(f).num_rows for f in tmp_path.rglob("*.parquet") if "registry" not in str(f))
    assert pairs > 5 * events and written <= 3 * events


def test_stored_join(spark, tmp_path):
    """Rows alone come once the watermark has passed all that they could meet, late rows find theirs, a batch that is retried
    adds nothing, heartbeats are no rows."""
    batches = [[("a", 0, 1.0, "w"), ("a", 14, 5.0, "a"), ("b", 3, 7.0, "a")], [("a", 100, 2.0, "w"), ("a", 130, 6.0, "a")], [("b", 18, 3.0, "w"), ("a", 115, 8.0, "a"), (None, 5, 9.0, "w")]]
    batches += [[(S.HEARTBEAT, 2000, None, "w"), (S.HEARTBEAT, 2000, None, "a")]]
    side = lambda kind, name: lambda df: df.filter(f"kind = '{kind}'").select("station_id", "event_time", F.col("x").alias(name))
    job, seen = P.sides_batch(str(tmp_path / "sides"), {"weather": side("w", "temp_c"), "air": side("a", "pm2_5")}), []
    for number, rows in enumerate(batches):
        df = spark.createDataFrame([(s, at(m), x, k) for s, m, x, k in rows], "station_id string, event_time timestamp, x double, kind string")
        job(df, number), job(df, number)
        stored = P.stored(spark, str(tmp_path / "sides"))
        out = P.joined(*(P.without_heartbeats(s) for s in stored), P.watermark(*stored))
        seen.append({(r["station_id"], r["temp_c"], r["pm2_5"]) for r in out.collect()} if out.count() == out.distinct().count() else None)
    met = {("a", 1.0, 5.0)}
    assert seen[0] == met and seen[1] == met | {(None, None, 7.0)}
    assert seen[2] == met | {("a", 2.0, 8.0), ("b", 3.0, 7.0), (None, 9.0, None)}
    assert seen[3] == seen[2] | {(None, None, 6.0)}


def sides(spark, seed):
    """Rows of three stations over two days: crowded and empty half hours, equal times, gaps, and measures that stay away."""
    import random

    r = random.Random(seed)
    some = lambda v, p: None if r.random() < p else float(v)
    times = [m for m in range(0, 2880, 7) if m % 720 < 400]
    w = [(s, at(m), some(r.randrange(30), 0.3), some(1000 + r.randrange(20), 0.2), some(r.randrange(9), 0.9), some(r.randrange(9), 0.0)) for s in "abc" for m in times for _ in range(r.choice([0, 1, 1, 3]))]
    w += [("c", at(5000 + 31 * i), None, None, 1.0, None) for i in range(40)] + [("a", at(-31), 1.0, 2.0, 3.0, 4.0)]
    a = [(s, at(m + r.randrange(6)), some(r.randrange(50), 0.4)) for s in "abd" for m in times if r.random() < 0.6] + [("c", at(5000 + 31 * i), None) for i in range(40)]
    return spark.createDataFrame(w, WEATHER), spark.createDataFrame(a, AIR)


@pytest.mark.parametrize("task_rows", [50, 10**6])
def test_pair_changes(spark, tmp_path, task_rows):
    """As the batch operators over all pairs of a station, ties by the same hash."""
    w, a = sides(spark, task_rows)
    columns = ["station_id", "timestamp", "temp_c", "pressure", "wind_U", "wind_V", "pm2_5"]
    pairs = within(w, a.withColumnRenamed("event_time", "timestamp"), P.TOLERANCE_S, ts="timestamp", how="inner").select(*columns)
    rows = pairs.withColumns({"tie": F.xxhash64(*columns), "raw": F.struct(*S.TRACKED)})
    want = add_changes(forward_fill(rows, S.TRACKED, drop_empty=False, ties=("tie",)), null_fill=0.0, ties=("tie",)).select("station_id", "timestamp", "raw.*", *S.CHANGES)
    out = P.pair_changes(w, a, str(tmp_path / "ends"), columns, task_rows=task_rows)
    names = ["station_id", "timestamp", *S.TRACKED, *S.CHANGES]
    assert out.columns == [*columns, *S.CHANGES] and out.count() > 1000 and text(out, names) == text(want, names)


def test_pairs_are_not_shuffled(spark, tmp_path):
    """Above the join that makes the pairs there is no exchange, and the few rows a bin that it reads besides are stored."""
    w, a = sides(spark, 1)
    out = P.pair_changes(w, a, str(tmp_path / "ends"), ["station_id", "timestamp", "temp_c", "pressure", "wind_U", "wind_V", "pm2_5"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan.split("Join")[0] and "Exchange" not in plan.split("Join")[0]
    bins = w.join(a.withColumnRenamed("event_time", "t"), "station_id").select("station_id", F.floor(F.unix_timestamp("timestamp") / 1800)).distinct().count()
    assert spark.read.parquet(str(tmp_path / "ends/ends")).count() <= S.KEEP * bins


def test_pairs_of_features_are_rounded_before_they_are_made(spark):
    """str5_features: above the join, where rows are pairs, only the moving features are rounded."""
    plan = QUERIES["str5_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join " in plan and plan.split("Join ")[0].count("round(") == len(S.CHANGES) < plan.count("round(")


def test_pair_changes_of_nothing(spark, tmp_path):
    w, a = sides(spark, 2)
    assert P.pair_changes(w, a.filter("station_id = 'd'"), str(tmp_path / "ends"), ["station_id", "timestamp", "pm2_5"]).count() == 0
