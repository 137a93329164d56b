"""What was seen before: a keyed store that runs of any kind share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import newer_than_seen
from ..operators.windows import first_per_key
from .versions import VersionedTable


class SeenStore:
    """The latest time of each key and the ids at that time, in a versioned table that batch runs and streams share.

    A row is new if its key is unknown, its time later than the key's latest, or its time the latest and its id not among
    those kept. Rows before the latest time count as seen. Rows without a key, a time or an id are never new.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "city", ts: str = "event_time", tie: str = "event_id"):
        self.key, self.ts, self.tie = key, ts, tie
        self.table = VersionedTable(spark, path)

    def seen(self) -> DataFrame | None:
        """(key, last_event_time, last_id): a row for each id at a key's latest time."""
        return self.table.read() if self.table.version() is not None else None

    def fresh(self, df: DataFrame) -> DataFrame:
        """The new rows of df, one for each id."""
        known = df.filter(F.col(self.key).isNotNull() & F.col(self.ts).isNotNull() & F.col(self.tie).isNotNull())
        once = first_per_key(known, [self.tie], [F.col(self.ts)])
        if (seen := self.seen()) is None:
            return once
        later = newer_than_seen(once, seen.select(self.key, "last_event_time").distinct(), self.key, self.ts)
        same = once.join(seen.select(self.key, F.col("last_event_time").alias(self.ts)).distinct(), [self.key, self.ts], "left_semi")
        return later.unionByName(same.join(seen.select(self.key, F.col("last_id").alias(self.tie)), [self.key, self.tie], "left_anti").select(*later.columns))

    def remember(self, df: DataFrame, batch: str | None = None) -> int:
        """Note the rows of df; the store's new version. A batch that was noted before is not noted again."""
        new = df.filter(F.col(self.key).isNotNull() & F.col(self.ts).isNotNull()).select(self.key, F.col(self.ts).alias("last_event_time"), F.col(self.tie).alias("last_id"))
        seen = self.seen()
        both = new if seen is None else seen.unionByName(new)
        latest = both.groupBy(self.key).agg(F.max("last_event_time").alias("last_event_time"))
        return self.table.replace(both.join(latest, [self.key, "last_event_time"], "left_semi").select(self.key, "last_event_time", "last_id").distinct(), batch)
