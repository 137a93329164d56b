"""Training, scoring, promotion and versions on a small frame."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeros.ml import jobs
from aeros.ml import regression as L
from aeros.ml.forest import load_forests, score_set
from aeros.operators.windows import add_targets
from aeros.plans.base import TRAIN_END, VAL_END, features, sensor

SF, TARGET = "/root/testdata/sf0.001", "target_pm25_1h"
NUMERIC = ["pm2_5", "humidity", "hour_sin"]


@pytest.fixture(scope="module")
def frame(spark):
    return add_targets(features(sensor(spark, SF)), (1,)).cache()


@pytest.fixture(scope="module")
def trained(frame):
    return L.train(frame, TARGET, NUMERIC, TRAIN_END, VAL_END, params={"maxIter": 2, "maxDepth": 2})


def test_importances_name_every_slot(trained):
    rows = L.importances(*trained).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert {"pm2_5_imp", "humidity_imp", "hour_sin_imp"} <= {r["feature"] for r in rows} and len(rows) > 5


def test_snapshot_and_promotion(trained):
    snap = L.snapshot(trained[1], TARGET)
    assert {(r["split"], r["metric_name"]) for r in snap.collect()} == {(s, m) for s in ("val", "test") for m in L.METRICS}
    rows = snap.withColumns({"task": F.lit("t"), "model_name": F.lit("m"), "horizon": F.lit(1), "run_id": F.lit("r")})
    assert L.promotable(rows, 1000.0).count() == 1 and L.promotable(rows, 0.0).count() <= 1


def test_score_many_and_versions(spark, frame, trained, tmp_path):
    model, path = trained[0], str(tmp_path)
    assert [L.save_version(spark, model, path, "a", "r") for _ in range(2)] == [1, 2]
    loaded = L.load_models(spark, path, ["a", "none"])
    assert loaded["none"] is None
    out = L.score_many(frame.drop(TARGET), {"x": (loaded["a"], NUMERIC), "y": (model, NUMERIC), "z": (None, []), "w": (model, ["absent"])}, cut_every=1)
    row = out.filter("x IS NOT NULL").first()
    assert row["x"] == row["y"] and row["z"] is None and row["w"] is None
    assert set(frame.drop(TARGET).columns) < set(out.columns)


@pytest.mark.parametrize("kind", ["gbt", "random_forest"])
def test_node_arrays_score_as_the_models(spark, frame, tmp_path, kind):
    """Missing numbers, unknown and missing categories; latest versions; models without a forest or a column give NULLs."""
    root = str(tmp_path)
    params = {"maxIter": 5, "numTrees": 4, "maxDepth": 4}
    models = {L.model_name("pm25", h): m for h, m in L.train_set(frame, "pm25", (1,), [*NUMERIC, "temp_c"], TRAIN_END, VAL_END, kind=kind, params=params).items()}
    models["other"] = L.train(frame, TARGET, NUMERIC, TRAIN_END, VAL_END, kind=kind, params={"maxIter": 3, "numTrees": 2, "maxDepth": 6})[0]
    assert L.save_versions(spark, models, root, "r") == {"pm25_h1": 1, "other": 1}
    assert L.save_versions(spark, {"other": models["pm25_h1"]}, root, "r") == {"other": 2}
    rows = frame.select("station_id", "timestamp", *L.CATEGORICAL, *NUMERIC, "temp_c")
    n = F.abs(F.hash("timestamp")) % 7
    odd = rows.withColumns({"city": F.when(n == 0, "elsewhere").when(n != 1, F.col("city")), "region": F.when(n != 2, F.col("region")), "humidity": F.when(n == 3, float("nan")).when(n != 4, F.col("humidity"))})
    forests = load_forests(spark, root, ["pm25_h1", "other", "none"])
    assert forests["none"] is None
    got = score_set(odd, {"a": forests["pm25_h1"], "b": forests["other"], "c": None}).toPandas().sort_values(["station_id", "timestamp"])
    want = L.score_many(odd, {"a": (models["pm25_h1"], [*NUMERIC, "temp_c"])}).toPandas().sort_values(["station_id", "timestamp"])
    assert np.allclose(got["a"], want["a"], rtol=0, atol=1e-9) and (got["a"] == got["b"]).all() and got["c"].isna().all()
    assert score_set(odd.drop("temp_c"), {"a": forests["pm25_h1"]}).filter("a IS NOT NULL").count() == 0


def test_registry_fits_what_is_missing(spark, frame, tmp_path):
    data, root = str(tmp_path / "data"), str(tmp_path / "root")
    frame.write.parquet(data)
    matrix = [("pm25", 1, NUMERIC)]
    fit = lambda m: jobs.train_missing(spark, data, root, m, TRAIN_END, VAL_END, params={"maxIter": 1, "maxDepth": 2})
    assert [fit(matrix), fit(matrix)] == [["pm25_h1"], []]
    out = jobs.score_all(spark, frame, root, [*matrix, ("temp", 2, NUMERIC)])
    assert {(r["target_feature"], r["forecast_horizon"]) for r in out.collect()} == {("pm25", "h1")} and out.count() == frame.count()


def test_train_and_score_jobs(spark, frame, tmp_path):
    """A run is noted in any case and registered if it passes; scoring takes the latest version and appends."""
    data, root, out = (str(tmp_path / n) for n in ("data", "root", "out"))
    frame.write.parquet(data)
    run = lambda ratio, **kw: jobs.train_job(spark, data, root, "m", TARGET, NUMERIC, 1, TRAIN_END, VAL_END, kind="linear", ratio=ratio, **kw)[1]
    assert run(0.0, run_id="refused") is None
    with pytest.raises(ValueError, match="no version"):
        jobs.batch_score(spark, data, root, out, "m", NUMERIC, 1)
    assert [run(1000.0, run_id="a"), run(1000.0, register=False), run(1000.0, run_id="b")] == [1, None, 2]
    noted = jobs.evaluations(spark, root)
    assert noted.count() == 4 * 2 * len(L.METRICS) and noted.filter("run_id = 'refused' AND split = 'val' AND metric_name = 'mae' AND metric_value > 0").count() == 1
    want = L.evaluate(L.train(frame, TARGET, NUMERIC, TRAIN_END, VAL_END, kind="linear")[1].filter("split = 'test'"), TARGET).first()["mae"]
    assert noted.filter("run_id = 'a' AND split = 'test' AND metric_name = 'mae'").first()["metric_value"] == pytest.approx(want)
    ids = [jobs.batch_score(spark, data, root, out, "m", NUMERIC, 1) for _ in range(2)]
    rows = spark.read.parquet(out).groupBy("batch_id", "model_name", "model_version").count().collect()
    assert sorted((r[0], r[1], str(r[2]), r[3]) for r in rows) == sorted((i, "m", "2", frame.count()) for i in ids)


def test_errors(frame):
    with pytest.raises(ValueError, match="no regressor"):
        L.regressor("forest", "y")
    with pytest.raises(ValueError, match="no rows"):
        L.train(frame, TARGET, NUMERIC, "2030-01-01", "2031-01-01")
    assert len(L.job_matrix()) == 36


def test_registered_models_have_the_settings(spark, monkeypatch):
    """Each query that trains does so with the 36 jobs' settings; ml10, which fits all 36, with fewer rounds."""
    from aeros.plans import models
    from aeros.plans.registry import QUERIES

    class Seen(Exception):
        pass

    def train(*args, params=None, **kwargs):
        assert params == L.GBT == {"maxDepth": 6, "maxIter": 100, "stepSize": 0.05, "subsamplingRate": 0.85}
        raise Seen

    def train_set(*args, params=None, **kwargs):
        assert params == {**L.GBT, "maxIter": models._ROUNDS}
        raise Seen

    monkeypatch.setattr(L, "train", train)
    monkeypatch.setattr(L, "train_set", train_set)
    for name in ("ml1_plain", "ml2", "ml4_gbt", "ml5_gbt", "ml7_gbt", "ml9_gbt", "ml10", "ml12_plain"):
        with pytest.raises(Seen):
            QUERIES[name](spark, SF)


def test_all_jobs_are_scored(spark, monkeypatch):
    from aeros.plans.registry import QUERIES

    from aeros.plans import models

    monkeypatch.setattr(L, "GBT", {"maxDepth": 1})
    monkeypatch.setattr(models, "_ROUNDS", 1)
    out = QUERIES["ml10"](spark, SF)
    rows = features(sensor(spark, SF)).count()
    counts = {(r["target_feature"], r["forecast_horizon"]): r["count"] for r in out.groupBy("target_feature", "forecast_horizon").count().collect()}
    assert counts == {(t, f"h{h}"): rows for t, h, _ in L.job_matrix()}
