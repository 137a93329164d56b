"""Hand-computed rows for the operators, NULL, zero and late cases included."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeros.functions import normalize, physics, rules
from aeros.functions.catalog import locations, place, select_locations
from aeros.operators import aggregates, contract, filters, joins, quality, sketches, windows
from aeros.operators.sketches import SketchTable
from aeros.operators.projections import add_alert_target, for_training, stamp
from aeros.schemas import TARGETS
from aeros.sources import readers, sinks
from aeros.sources.seen import SeenStore
from aeros.sources.versions import Conflict, VersionedTable

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


@pytest.fixture(scope="module")
def station(spark):
    rows = [("a", at(h), 1000.0 + h, float(h), 0.5 * h, 10.0 + h if h != 3 else None, float(h)) for h in range(8)]
    return spark.createDataFrame(rows, "station_id string, timestamp timestamp, pressure double, wind_U double, wind_V double, temp_c double, pm2_5 double")


def test_moving_features(station):
    out = [r.asDict() for r in windows.add_changes(station).orderBy("timestamp").collect()]
    assert [r["pressure_delta_3h"] for r in out[:4]] == [None, None, None, 3.0]
    assert out[0]["wind_shear_U"] is None and out[5]["wind_shear_U"] == 1.0 and out[5]["wind_shear_V"] == 0.5
    assert out[5]["temp_mean_6h"] == pytest.approx((10 + 11 + 12 + 14 + 15) / 5) and out[7]["pm25_acc_12h"] == 28.0
    filled = windows.add_changes(station, null_fill=0.0).orderBy("timestamp").first()
    assert filled["pressure_delta_3h"] == 0.0


def test_exact_hours_skip_gaps(station):
    gap = station.filter("hour(timestamp) <> 2")
    out = {r["timestamp"].hour: r for r in windows.add_changes(gap, exact_hours=True).collect()}
    assert out[3]["wind_shear_U"] is None and out[5]["pressure_delta_3h"] is None and out[4]["pressure_delta_3h"] == 3.0
    rows = {r["timestamp"].hour: r for r in windows.add_changes(gap).collect()}
    assert rows[3]["wind_shear_U"] == 2.0


def test_targets(spark, station):
    frame = station.withColumns({"cloud_cover": F.lit(1.0), "precipitation": F.lit(0.0), "wind_speed": F.lit(2.0)})
    out = windows.add_targets(frame, (1, 2)).orderBy("timestamp").collect()
    assert out[0]["target_pm25_2h"] == 2.0 and out[7]["target_pm25_1h"] is None
    assert windows.add_targets(frame, (1, 2), drop_incomplete=True).count() == 5  # an hour without a temperature drops out too
    exact = windows.add_targets(frame.filter("hour(timestamp) <> 1"), (1,), exact_hours=True).orderBy("timestamp").first()
    assert exact["target_pm25_1h"] is None


def test_forward_fill(spark):
    df = spark.createDataFrame([("a", at(0), None, None), ("a", at(1), 5.0, None), ("a", at(2), None, 1.0), ("b", at(0), None, None)], "station_id string, timestamp timestamp, temp_c double, humidity double")
    out = windows.forward_fill(df).orderBy("timestamp").collect()
    assert [(r["temp_c"], r["humidity"]) for r in out] == [(5.0, None), (5.0, 1.0)]


def test_physics_guards(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1000.0, 20.0, 0.0, 90.0, 2.0), (10.0, 20.0, 0.0, -243.04, 50.0, None, 0.5)], "latitude double, longitude double, pressure double, temp_c double, humidity double, wind_dir double, wind_speed double")
    a, b = physics.add_physics(df).collect()
    assert a["coord_X"] == 1.0 and a["wind_U"] == pytest.approx(-2.0) and a["air_density"] == pytest.approx(100000 / (287.05 * 293.15))
    gamma = math.log(1e-8) + 17.625 * 20 / 263.04
    assert a["dew_point"] == pytest.approx(243.04 * gamma / (17.625 - gamma))
    assert b["dew_point"] is None and b["theta_e"] is None and b["wind_U"] is None and b["air_density"] == 0.0
    assert df.select(physics.dew_point(F.col("temp_c"), F.col("humidity"), floor=False)).first()[0] is None


def test_codes(spark):
    df = spark.createDataFrame([(40.0, 50.1, 10.8, 70.1, 35.5), (15.0, 0.0, 20.7, 10.9, None), (None, None, None, None, 12.1)], "pred_temp double, pred_precipitation double, pred_wind_speed double, pred_cloud_cover double, pred_pm25 double")
    out = [tuple(r[c] for c in ("Temp_Code", "Rain_Code", "Wind_Code", "Cloud_Code", "PM25_Code", "Alert_Thunderstorm")) for r in rules.add_codes(df).collect()]
    assert out == [(6, 5, 2, 4, 3, 1), (2, 1, 4, 1, 1, 0), (1, 1, 1, 1, 2, 0)]
    assert "Solar_Code" not in rules.add_codes(df).columns


def test_split_is_a_partition(spark):
    df = spark.createDataFrame([("a", dt.datetime(2026, m, 1), 1.0) for m in (1, 2, 3)], "station_id string, timestamp timestamp, value double")
    parts = filters.time_split(df, "2026-01-31 23:59:59", "2026-02-28 23:59:59")
    assert [p.count() for p in parts] == [1, 1, 1]
    with pytest.raises(ValueError):
        for_training(df, "value", ["absent"])


def test_drift(spark):
    frame = lambda values: spark.createDataFrame([(float(v), float(v) / 2) for v in values], "pm2_5 double, humidity double")
    same = {r["feature_name"]: r for r in aggregates.drift(frame([1, 2, 3, 4]), frame([1, 2, 3, 4]), ["pm2_5", "humidity", "absent"]).collect()}
    assert set(same) == {"pm2_5", "humidity"} and all(r["psi"] == 0 and r["status"] == "stable" for r in same.values())
    assert aggregates.psi(frame([1, 2, 3, 4, 5]), frame([1, 2, 3, 4, 10]), "pm2_5").first()["psi"] >= 0
    constant = aggregates.psi(frame([2, 2, 2]), frame([2, 2]), "pm2_5").first()["psi"]
    assert constant == 0


def test_metrics(spark):
    df = spark.createDataFrame([(100.0, 90.0), (0.0, 1.0), (50.0, 50.0)], "label double, prediction double")
    r = aggregates.regression_metrics(df).first()
    assert r["mae"] == pytest.approx(11 / 3) and r["mape"] == pytest.approx(5.0) and r["mae_high"] == 10.0
    assert aggregates.regression_metrics(df.filter("label < 0")).first()["mae_high"] == 0.0


def test_duplicates_and_missing(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, v int")
    assert aggregates.duplicate_rate(df, ["k"]).first().asDict() == {"total_rows": 3, "duplicate_rows": 1, "duplicate_rate": pytest.approx(1 / 3)}
    assert aggregates.duplicate_rate(df.limit(0), ["k"]).first()["duplicate_rate"] == 0.0
    assert {r["column_name"]: r["missing_rate"] for r in aggregates.missing_rate(df, ["k", "v"]).collect()} == {"k": 0.0, "v": pytest.approx(1 / 3)}


def test_quality(spark):
    df = spark.createDataFrame([(T0, "x", "s", 1.0, 2.0, 61.0, 50.0, float("nan")), (None, "", None, None, 2.0, None, 101.0, 0.0)], "event_time timestamp, city string, source string, latitude double, longitude double, temperature_c double, humidity double, pressure_hpa double")
    first, second = (r["errors"] for r in quality.validate_weather(df).collect())
    assert first == ["pressure_hpa must be numeric", "temperature_c must be <= 60", "pressure_hpa must be numeric"]
    assert second == ["latitude is required", "event_time is required", "city is required", "source is required", "humidity must be <= 100", "pressure_hpa must be > 0"]
    good, bad = quality.route(quality.validate_weather(df))
    assert good.count() == 0 and bad.count() == 2
    letters = quality.dead_letter(bad, "p", "b", "e").collect()
    assert len(letters[0]) == 13 and letters[0]["error_type"] == "validation_failed"
    with pytest.raises(ValueError):
        quality.suite("water")
    assert [quality.Rule.of(e) for e in quality.suite_document("air_quality")["expectations"]] == quality.suite("air_quality")


def test_contract(spark):
    good = contract.feature_contract()
    kinds = {"string": "'x'", "timestamp": "timestamp'2024-01-01'", "numeric": "1.0D"}
    row = spark.range(1).selectExpr(*[f"{kinds[f]} AS {c}" for c, (f, _) in good.columns.items()]).withColumn("region", F.lit("bac"))
    assert contract.report(row, good).first()["passed"] and len(good.targets) == 36
    only = row.select("station_id")
    assert not contract.report(only, good).first()["passed"]
    with pytest.raises(ValueError, match="missing_column timestamp"):
        contract.gated(only, good)
    twice = contract.report(row.union(row), good).first()
    assert twice["passed"] and twice["warning_count"] == 1


def test_place(spark):
    df = spark.createDataFrame([("HO CHI MINH CITY ", None, None), ("Elsewhere", 15.0, 100.0), (None, 20.0, 100.0), (None, None, None)], "city string, latitude double, longitude double")
    out = [tuple(r) for r in place(df, locations(spark)).select("region", "city", "latitude").collect()]
    assert sorted(out) == sorted([("nam", "HCMC", 10.7769), ("trung", "Elsewhere", 15.0), ("bac", "Hanoi", 20.0), ("bac", "Hanoi", 21.0285)])
    assert locations(spark).count() == 63
    assert {r["city"] for r in select_locations(locations(spark), ["hue", "ho chi minh city"]).collect()} == {"Hue", "HCMC"}


def test_times(spark):
    texts = ["1704067200", "2024-01-01T00:00:00Z", "2024-01-01T07:00:00+07:00", "2024-01-01 00:00:00", "", "no", None]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select(normalize.parse_time(F.col("t")).cast("timestamp_ntz").alias("x")).collect()
    assert [r["x"] for r in out] == [T0] * 4 + [None] * 3


def test_fallback_and_merge(spark):
    df = spark.createDataFrame([("k", "b", 1, True), ("k", "a", 2, False), ("k", "c", 3, True), ("m", "a", 4, True), ("m", "z", 5, True)], "k string, source string, event_id int, ok boolean")
    out = joins.first_valid_source(df, ["k"], ["a", "b", "c"], F.col("ok"))
    assert {(r["k"], r["event_id"]) for r in out.collect()} == {("k", 1), ("m", 4)}
    w = spark.createDataFrame([("s", T0, at(0), 1.0)], "station_id string, hour_ts timestamp, timestamp timestamp, temp_c double")
    a = spark.createDataFrame([("s", T0, at(0.5), 2.0), ("q", T0, at(0.2), 3.0)], "station_id string, hour_ts timestamp, timestamp timestamp, pm2_5 double")
    rows = {r["station_id"]: r for r in joins.merge_station_hours(w, a).collect()}
    assert rows["s"]["pm2_5"] == 2.0 and rows["s"]["timestamp"] == at(0) and rows["q"]["temp_c"] is None and rows["q"]["timestamp"] == at(0.2)


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    row = "k int, day string, v int"
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "b", 1)], row)
    sinks.upsert(spark, old, path, ["day"], key=["k"])
    sinks.upsert(spark, spark.createDataFrame([(2, "b", 9), (4, "c", 9)], row), path, ["day"], key=["k"])
    table = VersionedTable(spark, path, ["day"])
    assert {(r["k"], r["v"]) for r in table.read().collect()} == {(1, 1), (2, 9), (3, 1), (4, 9)}
    assert {(r["k"], r["v"]) for r in table.read(1).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert [(r["version"], r["operation"], r["row_count"]) for r in table.history().orderBy("version").collect()] == [(1, "merge", 3), (2, "merge", 3)]
    # a write that fails leaves the version before, and a batch is merged once
    broken = spark.createDataFrame([(1, "a", 5)], row).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        sinks.upsert(spark, broken, path, ["day"], key=["k"])
    assert table.version() == 2 and table.read().count() == 4
    more = spark.createDataFrame([(5, None, 1)], row)
    assert [sinks.upsert(spark, more, path, ["day"], key=["k"], batch="b") for _ in range(2)] == [3, 3]
    assert sinks.upsert(spark, more.withColumn("v", F.lit(7)), path, ["day"], key=["k"]) == 4
    assert {(r["k"], r["day"], r["v"]) for r in table.read().filter("k = 5").collect()} == {(5, None, 7)} and table.read().count() == 5


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.version() is None
    with pytest.raises(ValueError, match="nothing was written"):
        table.read()
    rows = spark.range(3)
    assert [table.append(rows, "a"), table.append(rows.limit(1)), table.append(rows, "a"), table.replace(rows.limit(2), "c")] == [1, 2, 1, 3]
    assert [table.read(v).count() for v in (1, 2, 3)] == [3, 4, 2]
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)
    with pytest.raises(ValueError, match="columns"):
        table.append(rows.withColumnRenamed("id", "other"))
    # an entry that a failed writer cut short is none, and its number stays unused
    (tmp_path / "t" / "versions" / "000000000004.json").write_text('{"version": 4, "oper')
    assert table.version() == 3 and table.append(rows) == 5 and table.read().count() == 5
    # of two writers of one version the second is told so
    log = table.log()
    table.append(rows)
    with pytest.raises(Conflict):
        table._commit(log, "merge", None, [], [], 0, rows.schema)
    assert VersionedTable(spark, str(tmp_path / "empty")).append(rows.limit(0)) == 1 and VersionedTable(spark, str(tmp_path / "empty")).read().count() == 0


def test_seen_and_retention(spark):
    df = spark.createDataFrame([(1, "a", at(1)), (2, "a", at(3)), (3, "b", at(0)), (4, "c", None)], "event_id int, city string, event_time timestamp")
    seen = filters.update_seen(df.filter("event_id < 2"))
    assert {r["event_id"] for r in filters.newer_than_seen(df, seen).collect()} == {2, 3, 4}
    assert {r["event_id"] for r in sinks.retained(df, 2, "event_time").collect()} == {1, 2}


def test_decode_and_unwrap(spark, tmp_path):
    df = spark.createDataFrame([('{"a":1}',), ("plain",), (None,)], "value string")
    assert [tuple(r) for r in df.select(*readers.decode(F.col("value"))).collect()] == [('{"a":1}', '{"a":1}'), (None, "plain"), (None, None)]
    path = tmp_path / "r.jsonl"
    path.write_text('{"kafka_topic":"t","value":{"event_time":"2024-01-01T00:00:00Z","city":" Hue ","humidity":1.5}}\n')
    r = readers.exported_records(spark, str(path)).first()
    assert r["city_key"] == "hue" and r["humidity"] == 1.5 and r["kafka_topic"] == "t"
    path.write_text('{"other":1}\n')
    with pytest.raises(ValueError):
        readers.exported_records(spark, str(path), schema=None)


def test_stamp_and_alert(spark):
    df = spark.createDataFrame([(34.9,), (35.0,), (None,)], "target_pm25_1h double")
    out = add_alert_target(df)
    assert [r["target_alert_1h"] for r in out.collect()] == [0, 1, 0] and add_alert_target(out) is out
    assert stamp(df, 1, "models:/name/3", "3", "b").first()["model_name"] == "name"


@pytest.mark.parametrize("bucket", ["day", "hour", "month"])
def test_forward_fill_by_buckets(spark, bucket):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), T0 + dt.timedelta(hours=7 * i), rng.choice([None, None, float(i)]), rng.choice([None, 2.0 * i])) for i in range(200)]
    df = spark.createDataFrame(rows, "station_id string, timestamp timestamp, humidity double, pressure double")
    whole = windows.forward_fill(df, ["humidity", "pressure"])
    parts = windows.forward_fill(df, ["humidity", "pressure"], bucket=bucket)
    assert parts.columns == whole.columns and sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))


def test_drift_keeps_digits(spark):
    """A large mean with a small spread."""
    rows = [(1e9 + i % 7,) for i in range(2000)]
    df = spark.createDataFrame(rows, "pressure double")
    row = aggregates.drift(df, df, ["pressure"]).first()
    assert row["std_train"] == pytest.approx(float(np.std([r[0] for r in rows])), rel=1e-9) and row["mean_serving"] == pytest.approx(1e9 + 3, abs=0.01)


@pytest.mark.parametrize("bucket", ["day", "week"])
def test_buckets_equal_whole_stations(spark, bucket):
    """One station holds nearly all rows, with gaps that leave buckets of a row or two."""
    rng, rows = random.Random(2), []
    some = lambda: rng.choice([None, float(rng.randint(0, 50))])
    for station, n in (("a", 300), ("b", 20)):
        t = 0
        for _ in range(n):
            t += rng.choice([1, 1, 1, 2, 5, 30, 100])
            rows.append((station, at(t), *[some() for _ in range(9)]))
    rows.append(("b", None, *[1.0] * 9))
    names = ["pressure", "wind_U", "wind_V", *dict.fromkeys(c for c in TARGETS.values() if c != "pressure")]
    names += [c for c in ("temp_c", "pm2_5") if c not in names]
    df = spark.createDataFrame([r[: 2 + len(names)] for r in rows], "station_id string, timestamp timestamp, " + ", ".join(f"{n} double" for n in names))
    same = lambda x, y: sorted(map(str, x.collect())) == sorted(map(str, y.select(*x.columns).collect()))
    assert same(windows.add_changes(df, bucket=bucket), windows.add_changes(df))
    assert same(windows.add_targets(df, (1, 6, 24), bucket=bucket), windows.add_targets(df, (1, 6, 24)))
    assert same(windows.forward_fill(df, names, bucket=bucket), windows.forward_fill(df, names))
    # the largest window holds a bucket, not a station
    largest = df.groupBy("station_id", F.date_trunc(bucket, "timestamp")).count().agg(F.max("count")).first()[0]
    assert largest < 100
    with pytest.raises(ValueError):
        windows.add_changes(df, exact_hours=True, bucket=bucket)


def test_within(spark):
    """Ends of the tolerance, before the epoch, no partner on either side, rows without a time, several partners."""
    m = lambda x: None if x is None else T0 + dt.timedelta(minutes=x)
    old = -60 * 24 * 365 * 60
    w = spark.createDataFrame([(k, m(t), float(i)) for i, (k, t) in enumerate([("a", 0), ("a", 100), ("b", 0), ("a", old), ("a", None), (None, 0)])], "station_id string, event_time timestamp, temp_c double")
    a = spark.createDataFrame([(k, m(t), float(i)) for i, (k, t) in enumerate([("a", 15), ("a", -15), ("a", 16), ("a", old - 15), ("c", 0), ("a", None)])], "station_id string, event_time timestamp, pm2_5 double")
    pairs = lambda how: sorted(((r["temp_c"], r["pm2_5"]) for r in joins.within(w, a, 900, how=how).collect()), key=str)
    both = [(0.0, 0.0), (0.0, 1.0), (3.0, 3.0)]
    left = both + [(1.0, None), (2.0, None), (4.0, None), (5.0, None)]
    assert pairs("inner") == sorted(both, key=str) and pairs("left") == sorted(left, key=str)
    assert pairs("full_outer") == sorted(left + [(None, 2.0), (None, 4.0), (None, 5.0)], key=str)
    with pytest.raises(ValueError):
        joins.within(w, a, 900, how="cross")


def test_seen_store(spark, tmp_path):
    row = "event_id int, city string, event_time timestamp"
    store = SeenStore(spark, str(tmp_path / "seen"))
    one = spark.createDataFrame([(1, "a", at(1)), (2, "a", at(2)), (2, "a", at(2)), (3, "b", at(0)), (4, None, at(1)), (5, "b", None)], row)
    ids = lambda df: sorted(r["event_id"] for r in store.fresh(df).collect())
    assert ids(one) == [1, 2, 3]
    assert [store.remember(one, "x"), store.remember(one, "x")] == [1, 1]
    two = spark.createDataFrame([(1, "a", at(1)), (2, "a", at(2)), (6, "a", at(2)), (7, "a", at(3)), (8, "c", at(0)), (9, "b", at(-1))], row)
    assert ids(two) == [6, 7, 8]
    store.remember(two, "y")
    assert ids(one) == [] and ids(two) == []
    assert {(r["city"], r["last_id"]) for r in store.seen().collect()} == {("a", 7), ("b", 3), ("c", 8)}


def test_sketches_merge(spark, tmp_path):
    """Days that came in several batches, a batch noted twice, nulls, NaN and a column without values."""
    rng = random.Random(5)
    rows = [(at(rng.randint(0, 24 * 9)), rng.choice([None, float("nan"), rng.gauss(0, 1), rng.gauss(0, 1)]), None) for _ in range(6000)]
    df = spark.createDataFrame(rows, "event_time timestamp, x double, y double")
    table = SketchTable(spark, str(tmp_path / "s"))
    for batch, part in (("a", df.limit(2500)), ("b", df.subtract(df.limit(2500)))):
        table.add(part, ["x", "y"], batch=batch)
    before = table.table.read().count()
    table.add(df, ["x", "y"], batch="b")
    assert table.table.read().count() == before
    noted = spark.createDataFrame(rows[:3000], df.schema)
    again = SketchTable(spark, str(tmp_path / "t"))
    for i in range(3):
        again.add(noted.filter(F.pmod(F.hash("event_time"), F.lit(3)) == i), ["x", "y"])
    values = sorted(v for _, v, _ in rows[:3000] if v is not None and v == v)
    got = {r["column_name"]: r for r in sketches.quantiles(again.between(), {"p50": 0.5, "p95": 0.95}).collect()}
    for name, q in (("p50", 0.5), ("p95", 0.95)):
        assert abs(sum(v <= got["x"][name] for v in values) / len(values) - q) < sketches.ERROR + 1 / len(values)
    assert got["x"]["mean"] == pytest.approx(sum(values) / len(values)) and got["x"]["most"] == values[-1] and got["x"]["missing_rate"] == pytest.approx(1 - len(values) / 3000)
    assert got["y"]["p50"] is None and got["y"]["missing_rate"] == 1.0
    days = again.between(str(T0.date()), str(T0.date()))
    assert {str(r["day"]) for r in days.collect()} == {"2024-01-01"}
    half = lambda lo, hi: noted.filter((F.col("event_time") >= F.lit(at(lo))) & (F.col("event_time") < F.lit(at(hi))) & ~F.isnan("x"))
    drift = sketches.sketched_drift(again.between(None, "2024-01-04"), again.between("2024-01-05")).collect()
    assert [r["feature_name"] for r in drift] == ["x"]
    assert drift[0]["psi"] == pytest.approx(aggregates.psi(half(0, 96), half(96, 999), "x", exact=True).first()["psi"], abs=0.01)


def test_pairs_are_rounded_before_they_are_made(spark):
    """jon4_batch: above its joins, where rows are pairs, nothing is rounded or converted."""
    from aeros.plans.registry import QUERIES

    plan = QUERIES["jon4_batch"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join ")[0]
    assert "Join " in plan and "round(" in plan and not any(f in above for f in ("round(", "cast(event_time"))
