"""Queries of training, evaluation, registry and batch scoring with a ridge model, whose fit SQL can state.

The SQL imputes medians, standardises the features over the training rows, sums their cross moments, and solves the normal
equations by Gauss-Jordan elimination. The penalty is regParam over the deviation of the target, on standardised features.
Numbers are compared to three places.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..ml import jobs
from ..ml import regression as L
from ..operators.windows import add_targets
from .base import TRAIN_END, VAL_END, features, over, register, scratch, sensor

_NUMERIC = L.FEATURES["pm25"]
_TARGET = "target_pm25_1h"
#: relativeError is the imputer's: the SQL's medians are exact.
RIDGE = {"regParam": 1.0, "relativeError": 1e-6}
_REGIONS, _CITIES = ("bac", "trung", "nam"), tuple(f"City {i}" for i in range(10))
#: Names of the slots of the feature vector.
_SLOTS = [f"{c}_imp" for c in _NUMERIC] + [f"region_oh_{r}" for r in _REGIONS] + [f"city_oh_{c}" for c in _CITIES]
_P = len(_SLOTS)

_VECTOR = ", ".join([f"coalesce(t.{c}, med.{c})::DOUBLE" for c in _NUMERIC] + [f"(t.region = '{r}')::INT::DOUBLE" for r in _REGIONS] + [f"(t.city = '{c}')::INT::DOUBLE" for c in _CITIES])
#: CTEs up to fitted(i, b, mu, sd), base(ybar) and x(station_id, timestamp, split, y, v).
_FIT = f"""WITH RECURSIVE t AS (SELECT *, lead(pm2_5, 1) OVER (PARTITION BY station_id ORDER BY timestamp) AS y,
  CASE WHEN timestamp <= TIMESTAMP '{TRAIN_END}' THEN 'train' WHEN timestamp <= TIMESTAMP '{VAL_END}' THEN 'val' ELSE 'test' END AS split FROM f WHERE timestamp IS NOT NULL),
 med AS (SELECT {', '.join(f'quantile_disc({c}, 0.5) AS {c}' for c in _NUMERIC)} FROM t WHERE split = 'train' AND y IS NOT NULL),
 x AS (SELECT row_number() OVER () AS r, t.station_id, t.timestamp, t.split, t.y, [{_VECTOR}] AS v FROM t, med),
 base AS (SELECT avg(y) AS ybar, stddev_pop(y) AS ysd FROM x WHERE split = 'train'),
 cells AS (SELECT r, y, unnest(generate_series(1, {_P})) AS i, unnest(v) AS a FROM x WHERE split = 'train' AND y IS NOT NULL),
 m AS (SELECT i, avg(a) AS mu, stddev_pop(a) AS sd FROM cells GROUP BY i),
 z AS (SELECT r, y, i, CASE WHEN sd > 1e-9 THEN (a - mu) / sd ELSE 0 END AS a FROM cells JOIN m USING (i)),
 moments AS (SELECT p.i, q.i AS j, avg(p.a * q.a) + CASE WHEN p.i = q.i THEN {RIDGE['regParam']} / (SELECT ysd FROM base) ELSE 0 END AS v FROM z p JOIN z q USING (r) GROUP BY 1, 2
  UNION ALL SELECT i, {_P + 1}, avg(a * (y - (SELECT ybar FROM base))) FROM z GROUP BY i),
 solve AS (SELECT 1 AS k, list(g ORDER BY i) AS g FROM (SELECT i, list(v ORDER BY j) AS g FROM moments GROUP BY i)
  UNION ALL SELECT k + 1, list_transform(g, lambda row, i: CASE WHEN i = k THEN list_transform(row, lambda e: e / g[k][k]) ELSE list_transform(row, lambda e, j: e - row[k] * g[k][j] / g[k][k]) END) FROM solve WHERE k <= {_P}),
 fitted AS (SELECT i, b, mu, sd FROM (SELECT unnest(generate_series(1, {_P})) AS i, unnest(list_transform(g, lambda row: row[{_P + 1}])) AS b FROM solve WHERE k = {_P + 1}) JOIN m USING (i)),
 scored AS (SELECT x.r, any_value(x.station_id) AS station_id, any_value(x.timestamp) AS timestamp, any_value(x.split) AS split, any_value(x.y) AS y,
  (SELECT ybar FROM base) + sum(CASE WHEN sd > 1e-9 THEN b * (x.v[i] - mu) / sd ELSE 0 END) AS prediction FROM x, fitted GROUP BY x.r)"""


def _sql(body: str) -> str:
    return over("f", f"SELECT * FROM ({_FIT} {body})")


def _metrics(e: str = "y - prediction") -> str:
    """SQL of the metrics over the columns y and prediction, as regression_metrics gives them."""
    return f"""sqrt(avg(pow({e}, 2))) AS rmse, avg(abs({e})) AS mae, 1 - sum(pow({e}, 2)) / (var_pop(y) * count(y)) AS r2,
  coalesce(avg(CASE WHEN abs(y) > 1e-9 THEN abs(({e}) / y) END) * 100, 0) AS mape, coalesce(avg(CASE WHEN y >= 75 THEN abs({e}) END), 0) AS mae_high, count(*)::DOUBLE AS n"""


def _frame(spark, d):
    return add_targets(features(sensor(spark, d)), (1,))


def _trained(spark, d):
    return L.train(_frame(spark, d), _TARGET, _NUMERIC, TRAIN_END, VAL_END, kind="linear", params=RIDGE)


def _to_three(c: str):
    return F.round(c, 3).alias(c)


@register("ml1", _sql("SELECT station_id, timestamp, split, round(prediction, 3) + 0.0 AS prediction FROM scored WHERE split <> 'train' AND y IS NOT NULL"))
def ml1(spark, d):
    return _trained(spark, d)[1].select("station_id", "timestamp", "split", _to_three("prediction"))


_NAMES = "[" + ", ".join(f"'{s}'" for s in _SLOTS) + "]"


@register("ml4", _sql(f"SELECT {_NAMES}[i] AS feature, round(CASE WHEN sd > 1e-9 THEN b / sd ELSE 0 END, 3) + 0.0 AS importance FROM fitted"))
def ml4(spark, d):
    """Coefficients of the slots that training has seen; the slot of unknown categories has none."""
    return L.importances(*_trained(spark, d)).filter(F.col("feature").isin(_SLOTS)).select("feature", _to_three("importance"))


@register("ml5", _sql(f"SELECT round(rmse, 3) AS rmse, round(mae, 3) AS mae, round(r2, 3) AS r2, round(mape, 3) AS mape, round(mae_high, 3) AS mae_high, n::BIGINT AS n FROM (SELECT {_metrics()} FROM scored WHERE split <> 'train' AND y IS NOT NULL)"))
def ml5(spark, d):
    return L.evaluate(_trained(spark, d)[1], _TARGET).select(*[_to_three(c) for c in L.METRICS[:-1]], "n")


@register("ml7", _sql(f"SELECT split, metric_name, round(metric_value, 3) + 0.0 AS metric_value FROM (SELECT split, {_metrics()} FROM scored WHERE split <> 'train' AND y IS NOT NULL GROUP BY split) UNPIVOT (metric_value FOR metric_name IN ({', '.join(L.METRICS)}))"))
def ml7(spark, d):
    """The metrics that the training job notes."""
    data, root = scratch(spark, "ml7-curated"), scratch(spark, "ml7")
    _frame(spark, d).write.parquet(data)
    jobs.train_job(spark, data, root, "pm25_h1", _TARGET, _NUMERIC, 1, TRAIN_END, VAL_END, kind="linear", params=RIDGE)
    return jobs.evaluations(spark, root).select("split", "metric_name", _to_three("metric_value"))


@register("ml9", _sql("SELECT station_id, timestamp, round(prediction, 3) + 0.0 AS prediction, 1 AS horizon, 'pm25_h1' AS model_name FROM scored"))
def ml9(spark, d):
    """What the batch scoring job writes for a stored table by the registered model."""
    data, root, out = scratch(spark, "ml9-curated"), scratch(spark, "ml9"), scratch(spark, "ml9-predictions")
    L.save_version(spark, _trained(spark, d)[0], root, "pm25_h1", "r1")
    features(sensor(spark, d)).select("station_id", "timestamp", *L.CATEGORICAL, *_NUMERIC).write.parquet(data)
    jobs.batch_score(spark, data, root, out, "pm25_h1", _NUMERIC, 1)
    return spark.read.parquet(out).select("station_id", "timestamp", _to_three("prediction"), "horizon", "model_name")


@register("ml12", _sql("SELECT station_id, timestamp, round(prediction, 3) + 0.0 AS p, NULL::DOUBLE AS absent, 2 AS version FROM scored"))
def ml12(spark, d):
    """Two saves of one name: the latest version scores; a name without a version gives NULLs."""
    model, path = _trained(spark, d)[0], scratch(spark, "models")
    for _ in range(2):
        version = L.save_version(spark, model, path, "pm25_h1", "r1")
    loaded = L.load_models(spark, path, ["pm25_h1", "pm25_h9"])
    out = L.score_many(features(sensor(spark, d)), {"p": (loaded["pm25_h1"], _NUMERIC), "absent": (loaded["pm25_h9"], _NUMERIC)})
    return out.select("station_id", "timestamp", _to_three("p"), "absent", F.lit(version).alias("version"))
