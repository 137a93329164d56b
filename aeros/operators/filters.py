"""Filters and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_kind(df: DataFrame, topics: list[str], fields: list[str], topic: str = "kafka_topic") -> Column:
    """By topic, or by a measure that only this kind has."""
    tests = [F.coalesce(F.col(topic).isin(topics), F.lit(False))] if topic in df.columns else []
    tests += [F.col(f).isNotNull() for f in fields if f in df.columns]
    out = tests[0] if tests else F.lit(False)
    for t in tests[1:]:
        out = out | t
    return out


def weather_rows(df: DataFrame, topics: tuple[str, ...] = ("weather.raw.batch", "weather.raw.stream")) -> DataFrame:
    return df.filter(is_kind(df, list(topics), ["temperature_c", "pressure_hpa"]))


def air_rows(df: DataFrame, topics: tuple[str, ...] = ("air_quality.raw.batch", "air_quality.raw.stream")) -> DataFrame:
    return df.filter(is_kind(df, list(topics), ["pm25", "aqi"]))


def of_pipeline(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("pipeline_name") == name)


def mentions(df: DataFrame, word: str, raw: str = "value") -> DataFrame:
    """By a word anywhere in the raw text. Routing by topic is safer: a source's name may hold the word."""
    return df.filter(F.contains(F.col(raw), F.lit(word)))


def of_topic(df: DataFrame, topic: str, column: str = "kafka_topic") -> DataFrame:
    return df.filter(F.col(column) == topic)


def in_dates(df: DataFrame, start: str, end: str, ts: str = "timestamp") -> DataFrame:
    """Inclusive days, as a range on the timestamp itself so that it reaches the scan."""
    return df.filter((F.col(ts) >= F.to_timestamp(F.lit(start))) & (F.col(ts) < F.to_timestamp(F.lit(end)) + F.expr("INTERVAL 1 DAY")))


def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def any_sensor(df: DataFrame, sensors: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=sensors)


def split_label(ts: Column, train_end: str, val_end: str) -> Column:
    return F.when(ts <= F.to_timestamp(F.lit(train_end)), "train").when(ts <= F.to_timestamp(F.lit(val_end)), "val").when(ts.isNotNull(), "test")


def time_split(df: DataFrame, train_end: str, val_end: str, ts: str = "timestamp") -> tuple[DataFrame, DataFrame, DataFrame]:
    labelled = df.withColumn("_split", split_label(F.col(ts), train_end, val_end))
    return tuple(labelled.filter(F.col("_split") == s).drop("_split") for s in ("train", "val", "test"))


def training_rows(df: DataFrame, label: str, ts: str = "timestamp", drop_null: bool = True) -> DataFrame:
    out = df.withColumn(label, F.col(label).cast("double")).filter(F.col(ts).isNotNull())
    return out.filter(F.col(label).isNotNull() & ~F.isnan(label)) if drop_null else out


def newer_than_seen(df: DataFrame, seen: DataFrame, key: str = "city", ts: str = "event_time") -> DataFrame:
    """Rows later than what `seen` (key, last_event_time) has, and rows of unseen keys."""
    return df.join(seen.select(key, "last_event_time"), key, "left").filter(F.col("last_event_time").isNull() | (F.col(ts) > F.col("last_event_time"))).drop("last_event_time")


def update_seen(df: DataFrame, key: str = "city", ts: str = "event_time", tie: str = "event_id") -> DataFrame:
    latest = F.max(F.struct(F.col(ts).alias("last_event_time"), F.col(tie).alias("last_id")))
    return df.filter(F.col(ts).isNotNull()).groupBy(key).agg(latest.alias("m")).select(key, "m.*")


def at_least(df: DataFrame, label: str, threshold: float) -> DataFrame:
    return df.filter(F.col(label) >= threshold)


def outside_regions(df: DataFrame, allowed: list[str], region: str = "region") -> DataFrame:
    return df.filter(F.col(region).isNotNull() & ~F.col(region).isin(allowed))


def trailing(df: DataFrame, interval: str, ts: str = "event_time", as_of: Column | None = None) -> DataFrame:
    """The last `interval` (such as '7 DAYS') up to as_of; without one, up to the latest row (one aggregate)."""
    if as_of is None:
        as_of = F.lit(df.agg(F.max(ts)).first()[0])
    return df.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {interval}"))
