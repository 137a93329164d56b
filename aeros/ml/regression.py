"""Regression pipelines, evaluation, promotion, versions and scoring."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import pivot_metrics, regression_metrics
from ..operators.filters import split_label, training_rows
from ..operators.projections import stamp
from ..operators.windows import HORIZONS, first_per_key
from .forest import append_forests

CATEGORICAL = ["region", "city"]
_CYCLES, _PLACE = ["hour_sin", "hour_cos"], ["coord_X", "coord_Y", "coord_Z"]
#: Numeric features of each target's models (fixed values; the same for every horizon).
FEATURES = {
    "pm25": ["pm2_5", "us_aqi", "pm25_acc_12h", "humidity", "pressure", "wind_speed", "wind_dir", "wind_U", "wind_V", "is_stagnant_air", "temp_c", *_CYCLES, *_PLACE],
    "temp": ["temp_c", "humidity", "pressure", "wind_speed", "wind_dir", "cloud_cover", "shortwave_radiation", "soil_temperature", *_CYCLES, *_PLACE, "temp_mean_6h"],
    "cloud_cover": ["cloud_cover", "humidity", "pressure", "temp_c", "dew_point", "precipitation", "shortwave_radiation", *_CYCLES, *_PLACE],
    "precipitation": ["precipitation", "cloud_cover", "humidity", "pressure", "pressure_delta_3h", "temp_c", "dew_point", "theta_e", "wind_speed", "wind_dir", "wind_U", "wind_V", *_CYCLES, *_PLACE],
    "pressure": ["pressure", "pressure_delta_3h", "temp_c", "humidity", "wind_speed", "wind_U", "wind_V", "air_density", "theta_e", *_CYCLES, *_PLACE],
    "wind_speed": ["wind_speed", "wind_dir", "wind_U", "wind_V", "wind_shear_U", "wind_shear_V", "pressure", "pressure_delta_3h", "temp_c", "humidity", "cloud_cover", *_CYCLES, *_PLACE],
}
GBT = {"maxDepth": 6, "maxIter": 100, "stepSize": 0.05, "subsamplingRate": 0.85}
#: Training rows of a partition.
ROWS = 200_000
METRICS = ["rmse", "mae", "r2", "mape", "mae_high", "n"]
_REGRESSORS = {"linear": LinearRegression, "random_forest": RandomForestRegressor, "gbt": GBTRegressor}


def regressor(kind: str, label: str, params: dict | None = None, seed: int = 42):
    """By name; parameters that the regressor lacks are passed over."""
    if kind not in _REGRESSORS:
        raise ValueError(f"no regressor {kind!r}; there are {sorted(_REGRESSORS)}")
    made = _REGRESSORS[kind](featuresCol="features", labelCol=label, predictionCol="prediction")
    known = {p.name for p in made.params}
    return made._set(**{n: v for n, v in ({"seed": seed} | (params or {})).items() if n in known})


def _prepared(numeric: list[str], categorical: list[str], params: dict | None = None) -> list:
    filled = [f"{n}_imp" for n in numeric]
    stages = [Imputer(strategy="median", inputCols=numeric, outputCols=filled, relativeError=(params or {}).get("relativeError", 0.001))]
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_oh", handleInvalid="keep")]
    return [*stages, VectorAssembler(inputCols=filled + [f"{c}_oh" for c in categorical], outputCol="features", handleInvalid="keep")]


def pipeline(numeric: list[str], categorical: list[str], label: str, kind: str = "gbt", params: dict | None = None) -> Pipeline:
    """Median imputer, indexed and one-hot encoded categories (unknown ones kept), assembler, regressor.

    params are the regressor's, and relativeError of the medians' ranks."""
    return Pipeline(stages=[*_prepared(numeric, categorical, params), regressor(kind, label, params)])


def for_model(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Numeric features as doubles, as the imputer needs."""
    return df.withColumns({n: F.col(n).cast("double") for n in numeric})


def importances(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """(feature, importance), by the names in the vector's metadata, so that one-hot slots have their own."""
    last = model.stages[-1]
    attrs = scored.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a.get("name", str(a["idx"])) for kind in attrs.values() for a in kind}
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    rows = [(names.get(i, str(i)), float(v)) for i, v in enumerate(values.toArray())]
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def evaluate(df: DataFrame, label: str, prediction: str = "prediction", high: float = 75.0) -> DataFrame:
    return regression_metrics(df, label, prediction, high)


def train(df: DataFrame, target: str, numeric: list[str], train_end: str, val_end: str, categorical: list[str] = tuple(CATEGORICAL), kind: str = "gbt", params: dict | None = None, ts: str = "timestamp"):
    """(model, scored validation and test rows with `split`): fit on rows up to train_end. All three parts must have rows."""
    rows = for_model(training_rows(df, target, ts), numeric).withColumn("split", split_label(F.col(ts), train_end, val_end))
    rows = rows.select(*dict.fromkeys([*numeric, *categorical, target, ts, "station_id", "split"]))
    sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    if missing := {"train", "val", "test"} - sizes.keys():
        raise ValueError(f"no rows for {sorted(missing)}")
    fitting = gathered(rows.filter("split = 'train'"), sizes["train"]).persist()
    try:
        model = pipeline(numeric, list(categorical), target, kind, params).fit(fitting)
    finally:
        fitting.unpersist()
    return model, model.transform(rows.filter("split <> 'train'"))


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """df in as few partitions as its number of rows needs: a fit runs many jobs, and of small frames their tasks are the cost."""
    return df.coalesce(max(1, -(-rows // ROWS)))


def train_set(df: DataFrame, target: str, hours: tuple[int, ...], numeric: list[str], train_end: str, val_end: str, categorical: list[str] = tuple(CATEGORICAL), kind: str = "gbt", params: dict | None = None, ts: str = "timestamp", side_by_side: int = 4) -> dict[int, PipelineModel]:
    """A model for each horizon of a target. Medians, categories and vectors are made once, of all training rows of the target's
    features; a horizon's regressor takes the rows that have its label."""
    labels = {h: f"target_{target}_{h}h" for h in hours}
    label = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in labels.values()}
    rows = for_model(df, numeric).filter(split_label(F.col(ts), train_end, val_end) == "train").select(*dict.fromkeys([*numeric, *categorical]), *[v.alias(c) for c, v in label.items()])
    rows = rows.filter(F.coalesce(*labels.values()).isNotNull())
    fitting = gathered(rows, rows.count()).persist()
    prepared = Pipeline(stages=_prepared(numeric, list(categorical), params)).fit(fitting)
    vectors = prepared.transform(fitting).select("features", *labels.values()).persist()

    def one(h: int) -> tuple[int, PipelineModel]:
        own = vectors.filter(F.col(labels[h]).isNotNull())
        return h, PipelineModel(stages=[*prepared.stages, regressor(kind, labels[h], params).fit(own)])

    try:
        with ThreadPoolExecutor(side_by_side) as pool:  # fits are many short jobs, so they run side by side
            return dict(pool.map(one, hours))
    finally:
        vectors.unpersist()
        fitting.unpersist()


def snapshot(scored: DataFrame, target: str, high: float = 75.0) -> DataFrame:
    """(split, metric_name, metric_value) of the scored parts."""
    per = None
    for split in ("val", "test"):
        one = evaluate(scored.filter(F.col("split") == split), target, high=high).withColumn("split", F.lit(split))
        per = one if per is None else per.unionByName(one)
    return per.select("split", F.inline(F.array(*[F.struct(F.lit(m).alias("metric_name"), F.col(m).cast("double").alias("metric_value")) for m in METRICS])))


def promotable(snapshots: DataFrame, ratio: float = 2.0, split: str = "val") -> DataFrame:
    """Runs whose MAE is positive and whose MAE on high values is at most ratio times it."""
    runs = pivot_metrics(snapshots.filter(F.col("split") == split), ["task", "model_name", "horizon", "run_id"], ["mae", "mae_high"])
    return runs.filter((F.col("mae") > 0) & (F.col("mae_high") <= F.col("mae") * ratio))


def score(df: DataFrame, model: PipelineModel, numeric: list[str], horizon: int, model_uri: str, version: str, batch_id: str, as_of=None) -> DataFrame:
    """df's columns, the prediction, and its stamp columns."""
    out = model.transform(for_model(df, numeric)).select(*df.columns, "prediction")
    return stamp(out, horizon, model_uri, version, batch_id, as_of)


def score_many(df: DataFrame, models: dict[str, tuple[PipelineModel | None, list[str]]], cut_every: int = 0) -> DataFrame:
    """One column a model (name -> (model, numeric features)); a model that is None or lacks a column gives NULLs.

    Only the base columns and the new one are kept between models. cut_every: checkpoint after so many.
    """
    out, n = df, 0
    for name, (model, numeric) in models.items():
        base = out.columns
        if model is None or any(c not in df.columns for c in (*numeric, *CATEGORICAL)):
            out = out.withColumn(name, F.lit(None).cast("double"))
            continue
        own = {f"_{c}": F.col(c) for c in numeric}
        scored = model.transform(for_model(out.withColumns(own), numeric))
        back = [F.col(f"_{c}").alias(c) if c in numeric else F.col(c) for c in base]
        out = scored.select(*back, F.col("prediction").alias(name))
        n += 1
        if cut_every and n % cut_every == 0:
            out = out.checkpoint()
    return out


def long_predictions(df: DataFrame, columns: dict[str, tuple[str, str]], keys: tuple[str, ...] = ("station_id", "timestamp")) -> DataFrame:
    """columns: prediction column -> (target_feature, forecast_horizon)."""
    rows = [F.struct(F.lit(t).alias("target_feature"), F.lit(h).alias("forecast_horizon"), F.col(c).alias("predicted_value")) for c, (t, h) in columns.items()]
    return df.select(*keys, F.inline(F.array(*rows))).filter("predicted_value IS NOT NULL")


def save_version(spark: SparkSession, model: PipelineModel, path: str, name: str, run_id: str) -> int:
    """Save a model under the next version and note it in the table of versions."""
    return save_versions(spark, {name: model}, path, run_id)[name]


def save_versions(spark: SparkSession, models: dict[str, PipelineModel], path: str, run_id: str, side_by_side: int = 4) -> dict[str, int]:
    """Save each model under its name's next version, tree ensembles also as node arrays, and note them in the table of versions."""
    old = {r["model_name"]: r["v"] for r in versions(spark, path).filter(F.col("model_name").isin(list(models))).groupBy("model_name").agg(F.max("version").alias("v")).collect()}
    saved = {n: (old.get(n, 0) + 1, m) for n, m in models.items()}
    with ThreadPoolExecutor(side_by_side) as pool:
        list(pool.map(lambda n: saved[n][1].write().overwrite().save(f"{path}/models/{n}/v={saved[n][0]}"), saved))
    append_forests(spark, saved, path)
    rows = spark.createDataFrame([(n, v, run_id) for n, (v, _) in saved.items()], "model_name string, version int, run_id string").withColumn("registered_at", F.current_timestamp())
    rows.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return {n: v for n, (v, _) in saved.items()}


def versions(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{path}/versions")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "model_name string, version int, run_id string, registered_at timestamp")


def load_models(spark: SparkSession, path: str, names: list[str], loaded: dict[str, PipelineModel] | None = None) -> dict[str, PipelineModel | None]:
    """The latest version of each name; names that are loaded already are kept, names without a version are None."""
    latest = {r["model_name"]: r["version"] for r in first_per_key(versions(spark, path).filter(F.col("model_name").isin(names)), ["model_name"], [F.desc("version")]).collect()}
    have = dict(loaded or {})
    for n in names:
        if n not in have:
            have[n] = PipelineModel.load(f"{path}/models/{n}/v={latest[n]}") if n in latest else None
    return have


def model_name(target: str, hours: int) -> str:
    return f"{target}_h{hours}"


def job_matrix() -> list[tuple[str, int, list[str]]]:
    """(target, horizon, numeric features) of the 36 models."""
    return [(t, h, f) for t, f in FEATURES.items() for h in HORIZONS]
