"""Parquet tables with versions: immutable folders of rows, and a log of which folders make up each version.

A write stages its rows in a folder of its own (a folder for each value of the partition columns) and becomes visible when its
entry is created in the log; an entry that exists already is never replaced. So a write that fails half way changes nothing
that a reader sees, readers can pin a version, and a write that names a batch happens once however often it is retried.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMIT = "_commit"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ENTRY = "version long, operation string, batch string, added array<string>, removed array<string>, row_count long, columns string, at string"


class Conflict(RuntimeError):
    """Another writer has made the version first."""


class VersionedTable:
    """The table under a path; `by` names its partition columns and is fixed by the first write."""

    def __init__(self, spark: SparkSession, path: str, by: list[str] | tuple[str, ...] = ()):
        self.spark, self.path, self.by = spark, path.rstrip("/"), list(by)

    # ---- the log ----

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def log(self) -> list:
        """The entries in order. Entries cut short by a failed writer are none."""
        files, at = self._files(f"{self.path}/versions")
        if not files.exists(at):
            return []
        rows = self.spark.read.schema(_ENTRY).json(f"{self.path}/versions").filter(F.col("at").isNotNull()).collect()
        return sorted(rows, key=lambda e: e["version"])

    def _cut_short(self, log: list) -> list[int]:
        """0 and the numbers of entries that no reader sees; they stay unused."""
        files, at = self._files(f"{self.path}/versions/*.json")
        known = {e["version"] for e in log}
        found = [int(str(s.getPath().getName()).split(".")[0]) for s in files.globStatus(at) or []]
        return [0] + [n for n in found if n not in known and n <= max(known, default=0) + 1 and self._incomplete(n)]

    def _incomplete(self, number: int) -> bool:
        row = self.spark.read.schema(_ENTRY).json(f"{self.path}/versions/{number:012d}.json").first()
        return row is None or row["at"] is None

    def version(self) -> int | None:
        """The latest version; None where nothing was written."""
        return max((e["version"] for e in self.log()), default=None)

    def history(self) -> DataFrame:
        """A row a version: version, operation, batch, row_count (of the rows written), folders, at."""
        kept = [(e["version"], e["operation"], e["batch"], e["row_count"], len(e["added"]), e["at"]) for e in self.log()]
        return self.spark.createDataFrame(kept, "version long, operation string, batch string, row_count long, folders int, at string")

    def _state(self, version: int | None = None) -> tuple[list, list[str]]:
        """The entries up to a version, and the folders that make it up."""
        log = self.log()
        if version is not None:
            if version not in {e["version"] for e in log}:
                raise ValueError(f"no version {version} of {self.path}")
            log = [e for e in log if e["version"] <= version]
        live: dict[str, None] = {}
        for e in log:
            live = {f: None for f in live if f not in set(e["removed"])} | dict.fromkeys(e["added"])
        return log, list(live)

    # ---- reading ----

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        with_commit = T.StructType([*schema.fields, T.StructField(_COMMIT, T.StringType())])
        rows = self.spark.read.schema(with_commit).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{f}" for f in folders])
        return rows.select(*[f"`{f.name}`" for f in schema.fields])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the latest."""
        log, live = self._state(version)
        if not log:
            raise ValueError(f"nothing was written to {self.path}")
        return self._read(live, T.StructType.fromJson(json.loads(log[-1]["columns"])))

    # ---- writing ----

    def _stage(self, df: DataFrame) -> tuple[list[str], int]:
        """Write df into a folder of its own; its folders by partition and its number of rows."""
        own = f"{_COMMIT}={uuid.uuid4().hex}"
        out = df.hint("rebalance", *self.by) if self.by else df
        writer = out.write.mode("errorifexists")
        (writer.partitionBy(*self.by) if self.by else writer).parquet(f"{self.path}/data/{own}")
        folders = [own]
        if self.by:
            files, at = self._files(f"{self.path}/data/{own}/" + "/".join(f"{b}=*" for b in self.by))
            folders = sorted(own + str(s.getPath().toString()).split(own, 1)[1] for s in files.globStatus(at) or [])
        return folders, self._read(folders, df.schema).count()

    def _commit(self, log: list, operation: str, batch: str | None, added: list[str], removed: list[str], rows: int, schema: T.StructType) -> int:
        version = 1 + max([e["version"] for e in log] + self._cut_short(log))
        entry = {"version": version, "operation": operation, "batch": batch, "added": added, "removed": removed, "row_count": rows, "columns": json.dumps(schema.jsonValue()), "at": datetime.now(timezone.utc).isoformat()}
        files, at = self._files(f"{self.path}/versions/{version:012d}.json")
        if files.exists(at):
            raise Conflict(f"version {version} of {self.path} was written meanwhile")
        out = files.create(at, False)
        out.write(bytearray((json.dumps(entry) + "\n").encode()))
        out.close()
        return version

    def _write(self, operation: str, df: DataFrame, batch: str | None, replaced) -> int:
        log, live = self._state()
        done = [e["version"] for e in log if batch is not None and e["batch"] == batch]
        if done:
            return done[0]
        if log and json.loads(log[-1]["columns"]) != json.loads(df.schema.json()) and operation != "replace":
            names = [f["name"] for f in json.loads(log[-1]["columns"])["fields"]]
            if sorted(names) != sorted(df.columns):
                raise ValueError(f"{self.path} has the columns {names}, not {df.columns}")
            wanted = T.StructType.fromJson(json.loads(log[-1]["columns"]))
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields])
        folders, rows = self._stage(df)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        for _ in range(20):
            try:
                return self._commit(log, operation, batch, folders, replaced(live), rows, schema)
            except Conflict:
                if operation != "append":  # what it replaces may have changed
                    raise
                log, live = self._state()
        raise Conflict(f"{self.path} is written too often")

    def append(self, df: DataFrame, batch: str | None = None) -> int:
        """Add rows; the version. A batch that was committed before is left as it is."""
        return self._write("append", df, batch, lambda live: [])

    def replace(self, df: DataFrame, batch: str | None = None) -> int:
        """Put df in place of all rows."""
        return self._write("replace", df, batch, lambda live: live)

    def partitions(self, df: DataFrame) -> set[tuple[str, ...]]:
        """The values of the partition columns in df, as the folders name them."""
        rows = df.select(*[F.coalesce(F.col(f"`{b}`").cast("string"), F.lit(_NO_VALUE)).alias(b) for b in self.by]).distinct().collect()
        return {tuple(r) for r in rows}

    def merge(self, new: DataFrame, merged, batch: str | None = None) -> int:
        """Rewrite the partitions that `new` has rows in: merged(old rows there, new) takes their place. Other folders are not read."""
        touched = self.partitions(new)
        log, live = self._state()
        values = lambda folder: tuple(unquote(part.split("=", 1)[1]) for part in folder.split("/")[1:])
        mine = [f for f in live if values(f) in touched]
        old = self._read(mine, T.StructType.fromJson(json.loads(log[-1]["columns"]))) if log else self.spark.createDataFrame([], new.schema)
        at = log[-1]["version"] if log else None

        def replaced(now: list[str]) -> list[str]:
            if [f for f in now if values(f) in touched] != mine:
                raise Conflict(f"the partitions of {self.path} were written after version {at}")
            return mine

        return self._write("merge", merged(old, new), batch, replaced)
