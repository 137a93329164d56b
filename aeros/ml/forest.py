"""Tree ensembles as node arrays: a registry row a model, and one pass that scores any number of models.

A saved pipeline is flattened once, when its version is registered: imputed medians, categories and their slots, and for each
tree the feature, threshold, children and value of each node. Scoring loads the rows of the models it needs, sends them
with the task's function, and walks all trees of a model down together for a block of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import ImputerModel, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import first_per_key

_NODES = T.ArrayType(T.StructType([T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()), T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()), T.StructField("value", T.DoubleType())]))
SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("numeric", T.ArrayType(T.StringType())),
        T.StructField("medians", T.ArrayType(T.DoubleType())),
        T.StructField("categories", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("values", T.ArrayType(T.StringType()))]))),
        T.StructField("trees", T.ArrayType(T.StructType([T.StructField("tree", T.IntegerType()), T.StructField("weight", T.DoubleType()), T.StructField("nodes", _NODES)]))),
    ]
)
#: Rows that walk down the trees together.
ROWS = 1024


def is_forest(model: PipelineModel) -> bool:
    return hasattr(model.stages[-1], "treeWeights")


def append_forests(spark: SparkSession, saved: dict[str, tuple[int, PipelineModel]], root: str) -> None:
    """Append the node arrays of the tree ensembles among these pipelines (name -> (version, model)), which are saved under root."""
    own = {n: (v, m) for n, (v, m) in saved.items() if is_forest(m)}
    if not own:
        return
    folder = {n: f"{root}/models/{n}/v={v}/stages/*_{m.stages[-1].uid}" for n, (v, m) in own.items()}
    name = F.regexp_extract("_metadata.file_path", "/models/([^/]+)/v=", 1).alias("model_name")
    d = F.col("nodeData")
    # a split on a slot of a category sends one of its two values to the left
    first = F.try_element_at(d["split"]["leftCategoriesOrThreshold"], F.lit(1))
    category, leaf = d["split"]["numCategories"] != -1, d["leftChild"] < 0
    swapped = category & (first == 1.0)
    node = F.struct(
        d["id"].alias("id"),
        F.when(leaf, 0).otherwise(d["split"]["featureIndex"]).alias("feature"),
        F.when(leaf, float("inf")).when(category, 0.5).otherwise(first).alias("threshold"),
        F.when(leaf, d["id"]).when(swapped, d["rightChild"]).otherwise(d["leftChild"]).alias("left"),
        F.when(leaf, d["id"]).when(swapped, d["leftChild"]).otherwise(d["rightChild"]).alias("right"),
        d["prediction"].alias("value"),
    )
    nodes = spark.read.parquet(*[f"{f}/data" for f in folder.values()]).select(name, F.col("treeID").alias("tree"), node.alias("node"))
    nodes = nodes.groupBy("model_name", "tree").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    weights = spark.read.parquet(*[f"{f}/treesMetadata" for f in folder.values()]).select(name, F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    trees = nodes.join(weights, ["model_name", "tree"]).groupBy("model_name").agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees"))
    medians: dict[str, dict[str, float]] = {}
    rows = []
    for n, (version, model) in own.items():
        imputer = next(s for s in model.stages if isinstance(s, ImputerModel))
        if imputer.uid not in medians:
            medians[imputer.uid] = imputer.surrogateDF.first().asDict()
        known = medians[imputer.uid]
        numeric, even = list(imputer.getInputCols()), type(model.stages[-1]).__name__.startswith("RandomForest")
        categories = [(s.getInputCol(), list(s.labels)) for s in model.stages if isinstance(s, StringIndexerModel)]
        rows.append((n, version, numeric, [float(known[c]) for c in numeric], categories, 1.0 / model.stages[-1].getNumTrees if even else None))
    fixed = spark.createDataFrame(rows, T.StructType([*SCHEMA.fields[:5], T.StructField("even", T.DoubleType())]))
    pick = lambda n: F.struct(*[n[c] for c in ("feature", "threshold", "left", "right", "value")])
    plain = F.transform("trees", lambda t: F.struct(t["tree"], F.coalesce("even", t["weight"]), F.transform(t["nodes"], pick)))
    fixed.join(trees, "model_name").withColumn("trees", plain.cast(SCHEMA["trees"].dataType)).select(*SCHEMA.fieldNames()).write.mode("append").parquet(f"{root}/forests")


@dataclass
class Forest:
    """One model's arrays; nodes of all trees stand behind one another."""

    numeric: list[str]
    medians: np.ndarray
    categories: list[tuple[str, dict[str, int]]]
    weights: np.ndarray
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    @classmethod
    def of(cls, row) -> Forest:
        sizes = [len(t["nodes"]) for t in row["trees"]]
        roots = np.append(0, np.cumsum(sizes)[:-1]).astype(np.int32)
        flat = [(n["feature"], n["threshold"], n["left"] + r, n["right"] + r, n["value"]) for t, r in zip(row["trees"], roots.tolist()) for n in t["nodes"]]
        feature, threshold, left, right, value = zip(*flat)
        left, right = np.array(left, np.int32), np.array(right, np.int32)
        depth, at = 0, roots
        while True:  # as deep as the deepest tree
            at = np.unique(np.concatenate([left[at], right[at]]))
            if (left[at] == at).all() and (right[at] == at).all():
                break
            depth += 1
        return cls(row["numeric"], np.array(row["medians"]), [(c["name"], {v: i for i, v in enumerate(c["values"])}) for c in row["categories"]], np.array([t["weight"] for t in row["trees"]]), roots, np.array(feature, np.int32), np.array(threshold), left, right, np.array(value), depth + 1)

    def slots(self, df: pd.DataFrame) -> np.ndarray:
        """The feature vectors: numbers with medians for missing ones, then a slot for each category and one for all others."""
        x = df[self.numeric].to_numpy(dtype=float, na_value=np.nan)
        parts = [np.where(np.isnan(x), self.medians, x)]
        for name, values in self.categories:
            at = df[name].map(values).fillna(len(values)).to_numpy(dtype=int)
            parts.append(np.eye(len(values) + 1)[at])
        return np.concatenate(parts, axis=1)

    def predict(self, df: pd.DataFrame) -> np.ndarray:
        x, out = self.slots(df), np.empty(len(df))
        for i in range(0, len(x), ROWS):
            own = np.ascontiguousarray(x[i : i + ROWS])
            base = (np.arange(len(own)) * x.shape[1])[:, None]
            flat, node = own.ravel(), np.broadcast_to(self.roots, (len(own), len(self.roots)))
            for _ in range(self.depth):
                node = np.where(flat[base + self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[i : i + ROWS] = self.value[node] @ self.weights
        return out


def load_forests(spark: SparkSession, root: str, names: list[str], loaded: dict[str, Forest] | None = None) -> dict[str, Forest | None]:
    """The latest version of each name, in one read; names that are loaded already are kept, names without a forest are None."""
    have = dict(loaded or {})
    missing = [n for n in names if n not in have]
    if missing:
        rows = spark.read.schema(SCHEMA).parquet(f"{root}/forests").filter(F.col("model_name").isin(missing))
        have |= dict.fromkeys(missing)
        have |= {r["model_name"]: Forest.of(r) for r in first_per_key(rows, ["model_name"], [F.desc("version")]).collect()}
    return have


def score_set(df: DataFrame, forests: dict[str, Forest | None], keys: tuple[str, ...] = ("station_id", "timestamp")) -> DataFrame:
    """keys and a column a model, all in one pass over df; a model that is None or lacks a column gives NULLs."""
    usable = {n: f for n, f in forests.items() if f is not None and all(c in df.columns for c in (*f.numeric, *[c for c, _ in f.categories]))}
    numeric = list(dict.fromkeys(c for f in usable.values() for c in f.numeric))
    texts = list(dict.fromkeys(c for f in usable.values() for c, _ in f.categories))
    given = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    source = df.select(*given, *[F.col(c).cast("double").alias(c) for c in numeric], *[F.col(c).cast("string").alias(c) for c in texts if c not in numeric])
    own = [f"_key{i}" for i in range(len(keys))]
    schema = T.StructType([source.schema[k] for k in own] + [T.StructField(n, T.DoubleType()) for n in usable])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.concat([f[own], pd.DataFrame({n: m.predict(f) for n, m in usable.items()}, index=f.index)], axis=1)

    out = source.mapInPandas(run, schema) if usable else source
    return out.select(*[F.col(k).alias(name) for k, name in zip(own, keys)], *[F.col(n) if n in usable else F.lit(None).cast("double").alias(n) for n in forests])
