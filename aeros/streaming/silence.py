"""Stations that fall silent: event-time timers over one value of state a station."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keyed timers need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def with_timers(spark: SparkSession) -> None:
    """Set the session's state store to the one that timers need; for queries started from then on."""
    spark.conf.set(*STORE)


class _Silence(StatefulProcessor):
    """The time of a station's last row, and a timer that ends with its silence; both go when the timer fires."""

    def __init__(self, micros: int, station: str):
        self.micros, self.station = micros, station

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last bigint")

    def _rows(self, key, times: list[int]) -> pd.DataFrame:
        at = np.array(times, np.int64)
        return pd.DataFrame({self.station: pd.Series([key[0]] * len(times), dtype=object), "last_seen": at.astype("datetime64[us]"), "silent_from": (at + self.micros).astype("datetime64[us]")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        silent = []
        for t in sorted(t for f in rows for t in f["micros"].tolist()):
            if last is not None and t - last > self.micros:
                silent.append(last)
            last = t if last is None else max(last, t)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.last.update((last,))
        self.handle.registerTimer((last + self.micros) // 1000 + 1)
        yield self._rows(key, silent)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0]
        self.last.clear()
        yield self._rows(key, [last])

    def close(self) -> None:
        pass


def silence_alerts(df: DataFrame, minutes: int, station: str = "station_id", ts: str = "event_time") -> DataFrame:
    """(station, last_seen, silent_from) for each time that a station sends nothing for more than `minutes`.

    df has a watermark on ts. A gap between two rows of a station is told with the later row, or by the timer if the watermark has
    passed its end before. A station that stays away keeps no state. Rows without a station or time take no part.
    """
    out = T.StructType([df.schema[station], T.StructField("last_seen", T.TimestampType()), T.StructField("silent_from", T.TimestampType())])
    rows = df.filter(F.col(station).isNotNull() & F.col(ts).isNotNull()).select(station, ts, F.unix_micros(ts).alias("micros"))
    return rows.groupBy(station).transformWithStateInPandas(_Silence(minutes * 60_000_000, station), out, "Append", "eventTime")
