"""Writers: partitioned tables, keyed upserts, messages, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import trailing
from ..operators.windows import first_per_key
from ..schemas import EVALUATION, METRICS
from .versions import VersionedTable

KEY, FALLBACK_KEY = ["station_id", "timestamp", "model_name", "horizon"], ["station_id", "timestamp", "target_feature", "forecast_horizon"]


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", by: list[str] = ()) -> None:
    """Rows of one partition value are brought together first, so a partition has few files; AQE splits large ones over tasks."""
    out = df.hint("rebalance", *by) if by else df
    writer = out.write.format(fmt).mode(mode)
    (writer.partitionBy(*by) if by else writer).save(path)


def write_features(df: DataFrame, path: str) -> None:
    write_dataset(df, path, by=["year", "month"])


def write_increment(df: DataFrame, path: str, mode: str = "append", by: list[str] = ("year", "month", "day_of_year")) -> bool:
    if df.isEmpty():
        return False
    write_dataset(df, path, mode=mode, by=list(by))
    return True


def write_documents(df: DataFrame, columns: list[str], fmt: str, options: dict[str, str], mode: str = "append") -> bool:
    """To a document store's connector (any format), the columns that exist."""
    if df.isEmpty():
        return False
    df.select([c for c in columns if c in df.columns]).write.format(fmt).options(**options).mode(mode).save()
    return True


def upsert_key(df: DataFrame, key: list[str] = KEY, fallback: list[str] = FALLBACK_KEY) -> Column:
    """The key fields if all have values, else the fallback's, else a digest of the whole row with its columns in order."""
    def tried(names: list[str]) -> list[Column]:
        if any(n not in df.columns for n in names):
            return []
        whole = F.lit(True)
        for n in names:
            whole = whole & F.col(n).isNotNull()
        return [F.when(whole, F.concat_ws("|", *[F.col(n).cast("string") for n in names]))]

    return F.coalesce(*tried(key), *tried(fallback), F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256))


def merged(old: DataFrame, new: DataFrame, key: list[str] = KEY, fallback: list[str] = FALLBACK_KEY) -> DataFrame:
    """Old and new rows, the new one where both have a key; of equal keys within new, the later prediction_time."""
    tag = lambda df, n: df.withColumns({"_key": upsert_key(df, key, fallback), "_new": F.lit(n)})
    both = tag(old, 0).unionByName(tag(new, 1), allowMissingColumns=True)
    order = [F.desc("_new"), *([F.col("prediction_time").desc_nulls_last()] if "prediction_time" in both.columns else [])]
    order += [F.xxhash64(*[c for c in both.columns if c not in ("_key", "_new")])]
    return first_per_key(both, ["_key"], order).drop("_key", "_new")


def upsert(spark: SparkSession, new: DataFrame, path: str, by: list[str], key: list[str] = KEY, batch: str | None = None) -> int:
    """Merge into the versioned table at path, partitioned by `by`; its new version.

    Only partitions that new rows touch are read and rewritten, and they change all at once: readers see the version before
    until the new one is committed, and a write that fails leaves it. A batch that was merged before is not merged again.
    """
    return VersionedTable(spark, path, by).merge(new, lambda old, rows: merged(old, rows, key), batch)


def messages(df: DataFrame, region: str = "region") -> DataFrame:
    """(key, value): a key per region, the row as JSON."""
    return df.select(F.concat(F.lit("region_"), F.coalesce(region, F.lit("unknown"))).alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish(df: DataFrame, servers: str, topic: str, fmt: str = "kafka", options: dict[str, str] | None = None) -> None:
    own = {"kafka.bootstrap.servers": servers, "topic": topic} if fmt == "kafka" else {}
    messages(df).write.format(fmt).options(**(own | (options or {}))).mode("append").save()


def export_lines(df: DataFrame, path: str, metadata: bool = True) -> None:
    kafka = ["kafka_topic", "kafka_partition", "kafka_offset", "exported_at"]
    (df if metadata else df.drop(*kafka)).write.mode("overwrite").json(path)


def evaluation_rows(metrics: DataFrame, names: list[str], **fixed: object) -> DataFrame:
    """One row per metric, with the explicit schema; fixed gives run_id, task, model_name and the like."""
    long = metrics.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric_name"), F.col(n).cast("double").alias("metric_value")) for n in names])))
    return _typed(long.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in fixed.items()}), EVALUATION)


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def append_evaluation(rows: DataFrame, path: str) -> None:
    write_dataset(_typed(rows, EVALUATION), path, mode="append", by=["task", "model_name", "horizon", "split"])


def append_metrics(rows: DataFrame, path: str) -> None:
    write_dataset(_typed(rows, METRICS), path, mode="append", by=["metric_date", "category"])


def retained(df: DataFrame, hours: int = 48, ts: str = "timestamp", as_of: Column | None = None) -> DataFrame:
    return trailing(df, f"{hours} HOURS", ts, as_of)


def foreach_batch(observations, alerts, score):
    """A micro-batch function: keep the batch once, write observations, score, write alerts; empty batches do nothing."""

    def run(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            if not df.isEmpty():
                observations(df, batch_id)
                alerts(score(df), batch_id)
        finally:
            df.unpersist()

    return run
