"""Scans: exported records, datasets, Kafka topics, feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalize import parse_time
from ..functions.physics import time_parts
from ..operators.projections import city_key, region_from_station
from ..schemas import ENVELOPE
from .versions import VersionedTable


def unwrap(df: DataFrame) -> DataFrame:
    """The envelope's value, with the topic if there is one; other frames as they are."""
    if "value" not in df.columns or not isinstance(df.schema["value"].dataType, T.StructType):
        return df
    topic = ["kafka_topic"] if "kafka_topic" in df.columns else []
    return df.select(*topic, "value.*")


def exported_records(spark: SparkSession, path: str, schema: T.StructType | None = ENVELOPE) -> DataFrame:
    """Exported JSON lines with `timestamp` and `city_key`. schema=None infers, and checks that the fields exist."""
    raw = spark.read.schema(schema).json(path) if schema is not None else spark.read.json(path)
    if "value" not in raw.columns:
        raise ValueError("records need a top-level `value`")
    out = unwrap(raw)
    if missing := {"event_time", "city"} - {*out.columns}:
        raise ValueError(f"records need {sorted(missing)}")
    return with_record_keys(out)


def with_record_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"timestamp": parse_time(F.col("event_time").cast("string")), "city_key": city_key(F.col("city"))})


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest", options: dict[str, str] | None = None, fmt: str = "kafka", schema: T.StructType | None = None) -> DataFrame:
    """(topic, key, value, timestamp) of the topics as a stream; fmt, options and schema let a file source stand in for a broker."""
    own = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting, "failOnDataLoss": "false"} if fmt == "kafka" else {}
    reader = spark.readStream.format(fmt).options(**(own | (options or {})))
    return (reader.schema(schema) if schema is not None else reader).load().filter(F.col("topic").isin(topics))


def kafka_batch(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest", ending: str = "latest", most: int | None = None, metadata: bool = True, fmt: str = "kafka", options: dict[str, str] | None = None) -> DataFrame:
    own = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting, "endingOffsets": ending} if fmt == "kafka" else {}
    raw = spark.read.format(fmt).options(**(own | (options or {}))).load()
    out = raw.filter(F.col("topic").isin(topics))
    out = out.limit(most) if most else out
    return envelope(out) if metadata else out.select("value")


def envelope(df: DataFrame, exported_at=None) -> DataFrame:
    now = F.current_timestamp() if exported_at is None else exported_at
    return df.select(F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), now.cast("string").alias("exported_at"), *decode(F.col("value")))


def decode(value) -> list:
    """`value_json` (NULL where the text is no JSON) and `value_text`."""
    text = value.cast("string")
    valid = F.try_parse_json(text).isNotNull()
    return [F.when(valid, text).alias("value_json"), text.alias("value_text")]


def dataset(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def training_table(spark: SparkSession, path: str, fmt: str = "parquet", max_rows: int | None = None) -> DataFrame:
    df = dataset(spark, path, fmt)
    return df.limit(max_rows) if max_rows else df


def prepare_features(df: DataFrame, ts: str = "timestamp", north: list[str] = ("hanoi", "hai phong"), centre: list[str] = ("da nang", "hue")) -> DataFrame:
    """Timestamp cast, time parts, region and city added where absent."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    parts = {n: c for n, c in time_parts(F.col(ts)).items() if n in ("year", "month", "hour") and n not in df.columns}
    df = region_from_station(df.withColumns(parts), list(north), list(centre))
    return df if "city" in df.columns else df.withColumn("city", F.col("station_id"))


def feature_table(spark: SparkSession, path: str, fmt: str = "parquet", **names) -> DataFrame:
    return prepare_features(dataset(spark, path, fmt), **names)


def records_for_check(spark: SparkSession, path: str, schema: T.StructType, lines: bool = True) -> DataFrame:
    """JSON lines, or (lines=False) one object or array per file."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def dataset_version(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """The latest version where the table keeps versions."""
    if fmt != "delta":
        return VersionedTable(spark, path).version()
    return spark.sql(f"DESCRIBE HISTORY delta.`{path}` LIMIT 1").first()["version"]
