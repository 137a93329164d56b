"""Jobs over stored tables: train, evaluate and register a model; score a table in batch."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import append_evaluation, evaluation_rows, write_dataset
from . import regression as L
from .forest import load_forests, score_set


def train_job(spark: SparkSession, data_path: str, root: str, model_name: str, target: str, numeric: list[str], horizon: int, train_end: str, val_end: str, kind: str = "gbt", params: dict | None = None, high: float = 75.0, ratio: float = 2.0, register: bool = True, fmt: str = "parquet", run_id: str | None = None) -> tuple[PipelineModel, int | None]:
    """Load, split by time, fit, evaluate and note the metrics under root/evaluation; (model, its version).

    The model is registered under root if its validation metrics pass the promotion gate; else, or without `register`,
    its version is None. A part of the split without rows is an error.
    """
    run_id = run_id or uuid.uuid4().hex
    model, scored = L.train(spark.read.format(fmt).load(data_path), target, numeric, train_end, val_end, kind=kind, params=params)
    fixed = {"recorded_at": F.current_timestamp(), "run_id": run_id, "task": "regression", "model_name": model_name, "horizon": horizon, "data_path": data_path, "data_format": fmt}
    rows = None
    for split in ("val", "test"):
        one = evaluation_rows(L.evaluate(scored.filter(F.col("split") == split), target, high=high), L.METRICS, split=split, **fixed)
        rows = one if rows is None else rows.unionByName(one)
    append_evaluation(rows, f"{root}/evaluation")
    passed = not L.promotable(evaluations(spark, root).filter(F.col("run_id") == run_id), ratio).isEmpty()
    return model, L.save_version(spark, model, root, model_name, run_id) if register and passed else None


def train_missing(spark: SparkSession, data_path: str, root: str, matrix: list[tuple[str, int, list[str]]], train_end: str, val_end: str, kind: str = "gbt", params: dict | None = None, fmt: str = "parquet", run_id: str | None = None) -> list[str]:
    """Fit and register the models of the matrix (target, horizon, numeric features) that the registry lacks; their names.

    The models of a target share their preparation and are fitted side by side.
    """
    have = {r["model_name"] for r in L.versions(spark, root).select("model_name").distinct().collect()}
    todo: dict[str, tuple[list[str], list[int]]] = {}
    for target, hours, numeric in matrix:
        if L.model_name(target, hours) not in have:
            todo.setdefault(target, (numeric, []))[1].append(hours)
    models, frame = {}, spark.read.format(fmt).load(data_path)

    def one(target: str) -> dict:
        numeric, hours = todo[target]
        own = L.train_set(frame, target, tuple(hours), numeric, train_end, val_end, kind=kind, params=params)
        return {L.model_name(target, h): m for h, m in own.items()}

    with ThreadPoolExecutor(3) as pool:
        for own in pool.map(one, todo):
            models |= own
    if models:
        L.save_versions(spark, models, root, run_id or uuid.uuid4().hex)
    return list(models)


def score_all(spark: SparkSession, df: DataFrame, root: str, matrix: list[tuple[str, int, list[str]]], loaded: dict | None = None) -> DataFrame:
    """(station_id, timestamp, target_feature, forecast_horizon, predicted_value) of every model of the matrix, in one pass over df."""
    columns = {L.model_name(t, h): (t, f"h{h}") for t, h, _ in matrix}
    return L.long_predictions(score_set(df, load_forests(spark, root, list(columns), loaded)), columns)


def evaluations(spark: SparkSession, root: str) -> DataFrame:
    """The metrics of all runs."""
    return spark.read.parquet(f"{root}/evaluation")


def batch_score(spark: SparkSession, data_path: str, root: str, output: str, model_name: str, numeric: list[str], horizon: int, fmt: str = "parquet", batch_id: str | None = None, as_of: Column | None = None) -> str:
    """Score a stored table by the latest registered version and append to the predictions; the batch's id."""
    model = L.load_models(spark, root, [model_name])[model_name]
    if model is None:
        raise ValueError(f"no version of {model_name!r} is registered")
    version = L.versions(spark, root).filter(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
    batch_id = batch_id or uuid.uuid4().hex
    out = L.score(spark.read.format(fmt).load(data_path), model, numeric, horizon, f"models:/{model_name}/{version}", str(version), batch_id, as_of)
    write_dataset(out, output, fmt, mode="append", by=["prediction_date", "horizon"])
    return batch_id
