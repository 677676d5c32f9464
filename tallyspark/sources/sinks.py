"""Sinks: full refresh, append, partitioned, and versioned tables for upserts.

Plain parquet cannot be rewritten while it is being read, so an upserted table is a folder of numbered runs,
each written once: ``run=<n>-full`` replaces what came before, ``run=<n>-delta`` adds to it. The current
table is the last full run that has its success mark, and the marked deltas after it. There is no pointer that
could be lost: an interrupted write has no mark and is never read, and only a folder without any marked run is an empty table.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT_RUNS = 2                   # full runs kept, the current one included, for readers of the one before


def observed(seen: Observation, name: str) -> int:
    """A count that was taken right before a write; 0 if adaptive execution found nothing to write and left it out. (Further
    up in a plan that would not mean 0: there, an empty join takes the observed side away as well.)"""
    try:
        return seen.get[name]
    except Py4JJavaError:
        return 0


def write_counted(df: DataFrame, path: str) -> int:
    """Write a new table; the number of its rows, counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return observed(seen, "rows")


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh: nothing of the earlier table stays. Rows are clustered by the partition values
    first, so that a folder gets few files; the rebalance hint lets AQE split a hot value."""
    w = df.hint("rebalance", *partition_by) if partition_by else df
    w = w.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that ``df`` holds rows of; the others stay."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


class VersionedTable:
    """``commit`` writes a full run and deletes the runs before the last ``KEPT_RUNS`` full ones;
    ``append`` writes only the new rows, so an insert-only load costs the size of the delta;
    ``compact`` folds the runs into a full one. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self._path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _runs(self) -> list[tuple[int, str, bool]]:
        """(number, kind, has its mark) of all runs, in order."""
        if not self._fs.exists(self._path):
            return []
        out = []
        for s in self._fs.listStatus(self._path):
            number, dash, kind = s.getPath().getName().removeprefix("run=").partition("-")
            if dash and number.isdigit():
                mark = self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
                out.append((int(number), kind, bool(self._fs.exists(mark))))
        return sorted(out)

    def _folder(self, number: int, kind: str) -> str:
        return f"{self.root}/run={number:012d}-{kind}"

    def current_paths(self) -> list[str]:
        runs = [(n, kind) for n, kind, marked in self._runs() if marked]
        last = max((n for n, kind in runs if kind == "full"), default=-1)
        return [self._folder(n, kind) for n, kind in runs if n >= last]

    def current_path(self) -> str | None:
        paths = self.current_paths()
        return paths[-1] if paths else None

    def read(self) -> DataFrame:
        paths = self.current_paths()
        if not paths:
            if self.schema is None:
                raise FileNotFoundError(self.root)
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.parquet(*paths)

    def _write(self, df: DataFrame, kind: str, partition_by: list[str] | None) -> str:
        path = self._folder(max((n for n, _, _ in self._runs()), default=0) + 1, kind)
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return path

    def commit(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        path = self._write(df, "full", partition_by)
        full = [n for n, kind, marked in self._runs() if marked and kind == "full"]
        if len(full) > KEPT_RUNS:
            for n, kind, _ in self._runs():
                if n < full[-KEPT_RUNS]:
                    self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(n, kind)), True)
        return path

    def append(self, df: DataFrame, partition_by: list[str] | None = None,
               compact_after: int | None = None) -> str:
        """Add ``df`` as a delta; with ``compact_after``, fold all runs into one once
        their number exceeds it (bounds the listing and the small-file count)."""
        path = self._write(df, "delta", partition_by)
        if compact_after is not None and len(self.current_paths()) > compact_after:
            return self.compact()
        return path

    def compact(self) -> str:
        return self.commit(self.read())
