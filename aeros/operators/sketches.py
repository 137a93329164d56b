"""Daily quantile sketches: a row a day and column that merges over days, so that reports read sketches and not history.

Sketches are KLL sketches of doubles. A rank that is read from one, or from any merger of them, is off by at most ERROR
with 99 % confidence, whatever the number of rows; counts, sums and extremes are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import psi_status
from ..sources.versions import VersionedTable
from .aggregates import EPSILON, unpivot

#: Size of a sketch, and the rank error that goes with it; quantiles at which shares are read.
K, ERROR, GRID = 4096, 0.002, 1000


def daily_sketches(df: DataFrame, columns: list[str], ts: str = "event_time", k: int = K) -> DataFrame:
    """(day, column_name, row_count, present, total, squares, least, most, sketch) of the columns of each day."""
    long = unpivot(df.withColumn("day", F.to_date(ts)), columns, "column_name", "value", ["day"])
    value = F.nanvl("value", F.lit(None).cast("double"))
    return long.groupBy("day", "column_name").agg(
        F.count("*").alias("row_count"), F.count(value).alias("present"), F.sum(value).alias("total"), F.sum(value * value).alias("squares"),
        F.min(value).alias("least"), F.max(value).alias("most"), F.kll_sketch_agg_double(value, k).alias("sketch"),
    )


class SketchTable:
    """The sketches of a table's days, each batch of rows noted once; a day may have several rows, which merge."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path)

    def add(self, df: DataFrame, columns: list[str], ts: str = "event_time", batch: str | None = None) -> int:
        return self.table.append(daily_sketches(df, columns, ts), batch)

    def between(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """The rows of the days from first to last."""
        rows = self.table.read()
        rows = rows if first is None else rows.filter(F.col("day") >= F.lit(first).cast("date"))
        return rows if last is None else rows.filter(F.col("day") <= F.lit(last).cast("date"))


def merged(sketches: DataFrame, keys: tuple[str, ...] = ("column_name",)) -> DataFrame:
    """The sketches of a column over all their days, as one row."""
    return sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"), F.sum("present").alias("present"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def quantiles(sketches: DataFrame, at: dict[str, float]) -> DataFrame:
    """A row a column with its mean, extremes and missing rate, exactly, and the quantiles that `at` names; a column without values has none."""
    one = merged(sketches)
    has = F.col("present") > 0
    read = [F.when(has, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(n) for n, q in at.items()]
    return one.select("column_name", F.try_divide("total", "present").alias("mean"), "least", "most", (1 - F.col("present") / F.col("row_count")).alias("missing_rate"), *read)


def sketched_drift(expected: DataFrame, actual: DataFrame, bins: int = 10) -> DataFrame:
    """psi, means and deviations on both sides and status of each column, as drift() gives them from the rows.

    Bins are cut at the expected side's quantiles; a bin's share is off by at most 2 ERROR + 1 / GRID.
    """
    e, a = (merged(side).filter("present > 0").select("column_name", *[F.col(c).alias(f"{c}_{n}") for c in ("present", "total", "squares", "sketch")]) for side, n in ((expected, "e"), (actual, "a")))
    both = e.join(a, "column_name")
    read = lambda side, at: F.kll_sketch_get_quantile_double(f"sketch_{side}", F.array(*[F.lit(q) for q in at]))
    grid = [(i + 0.5) / GRID for i in range(GRID)]
    both = both.select("*", read("e", [i / bins for i in range(1, bins)]).alias("cuts"), read("e", grid).alias("grid_e"), read("a", grid).alias("grid_a"))
    # a bin's share is that of the grid's values in it; a value at a cut belongs above it
    above = lambda side, i: F.lit(1.0) if i == 0 else F.lit(0.0) if i == bins else F.size(F.filter(f"grid_{side}", lambda v: v >= F.col("cuts")[i - 1])) / GRID
    shares = lambda side: [F.greatest(above(side, i) - above(side, i + 1), F.lit(EPSILON)) for i in range(bins)]
    psi = sum(((q - p) * F.ln(q / p) for p, q in zip(shares("e"), shares("a"))), F.lit(0.0))
    mean = lambda s: F.col(f"total_{s}") / F.col(f"present_{s}")
    spread = lambda s: F.sqrt(F.greatest(F.col(f"squares_{s}") / F.col(f"present_{s}") - mean(s) * mean(s), F.lit(0.0)))
    out = both.select(F.col("column_name").alias("feature_name"), psi.alias("psi"), mean("e").alias("mean_train"), mean("a").alias("mean_serving"), spread("e").alias("std_train"), spread("a").alias("std_serving"))
    return out.withColumn("status", psi_status(F.col("psi")))
