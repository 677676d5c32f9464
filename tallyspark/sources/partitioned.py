"""Keyed tables in folders by date or by key bucket, of which a load rewrites only the partitions it changes.

A partition is a month or a day of one date column (``none`` without a date), or a bucket of the key's hash: a key never leaves its bucket,
so an upsert into buckets reads nothing but the buckets of its own keys. By date, an upsert looks its keys up in the stored key
column, the only one read of all partitions, so a row is also found where its date has moved; then it reads and rewrites
the partitions that rows leave or enter, and no others. For each partition the digest of the rows that were last put in is kept: where
the same rows come again, nothing is read or written. Rewritten partitions are first written aside and then put in place by a
dynamic partition overwrite, so the table is never read while it is replaced; an interrupted upsert is mended by running it again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_dir
from .readers import read_or_empty

PART = "part"
NO_DATE = "none"
GRAINS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}


def partition_files(fs, path_of, root: str) -> dict[str, tuple[str, ...]]:
    """Of each partition folder of ``root`` the names of its data files: a new write always has new names."""
    out: dict[str, tuple[str, ...]] = {}
    if fs.exists(path_of(root)):
        for folder in fs.listStatus(path_of(root)):
            name = folder.getPath().getName()
            if name.startswith(f"{PART}="):
                files = [s.getPath().getName() for s in fs.listStatus(folder.getPath())]
                out[name.removeprefix(f"{PART}=")] = tuple(sorted(f for f in files if f.endswith(".parquet")))
    return {p: f for p, f in out.items() if f}


class PartitionedTable:
    """One writer at a time. ``date_col`` is a date or timestamp column of ``schema``; with ``buckets`` there is none, and partitions are
    buckets of the key's hash, so many that one is a task's work. The number belongs to the stored table and must not change."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, date_col: str | None = None, grain: str = "month",
                 buckets: int = 0):
        if (date_col is None) != bool(buckets):
            raise ValueError("a table is partitioned by a date column or by key buckets")
        self.spark, self.root, self.schema, self.key, self.date_col, self.grain = spark, root.rstrip("/"), schema, key, date_col, grain
        self.buckets = buckets
        self.digests = f"{self.root}-digests"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- reading
    def part_of(self, col: Column | None = None) -> Column:
        if self.buckets:
            return F.format_string("b%06d", F.pmod(F.xxhash64(F.col(self.key) if col is None else col), F.lit(self.buckets)))
        col = F.col(self.date_col) if col is None else col
        return F.coalesce(F.date_format(col, GRAINS[self.grain]), F.lit(NO_DATE))

    def with_parts(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])
        return read_or_empty(self.spark, self.root, schema)

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The table, or some of its partitions."""
        df = self.with_parts()
        if parts is not None:
            df = df.where(F.col(PART).isin(sorted(parts)))
        return df.select(*self.schema.names)

    def files(self) -> dict[str, tuple[str, ...]]:
        return partition_files(self._fs, self._path, self.root)

    def parts_between(self, first, end) -> list[str]:
        """The partitions that can hold rows dated from ``first`` to before ``end``."""
        low, high = (d.strftime("%Y-%m" if self.grain == "month" else "%Y-%m-%d") for d in (first, end - dt.timedelta(days=1)))
        return [p for p in self.files() if p != NO_DATE and low <= p <= high]

    # --- writing
    def _write(self, df: DataFrame, mode: str) -> None:
        (df.hint("rebalance", PART).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.root))

    def insert(self, rows: DataFrame, counted: Observation | None = None) -> None:
        """Add the rows whose key the table does not hold (files are added, none is rewritten); ``counted`` gets their number as ``rows``."""
        fresh = rows.select(*self.schema.names).join(self.with_parts().select(self.key), self.key, "left_anti")
        if counted is not None:
            fresh = fresh.observe(counted, F.count(F.lit(1)).alias("rows"))
        self._write(fresh.select(*self.schema.names, self.part_of().alias(PART)), "append")

    def _digest(self, rows: DataFrame, without: tuple[str, ...]) -> DataFrame:
        """(part, rows, digest): sums over rows, so that a large partition is digested by many tasks."""
        h = F.xxhash64(*(c for c in self.schema.names if c not in without)).cast("decimal(38,0)")
        return rows.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"), F.sum(h).alias("digest"))

    def upsert(self, incoming: DataFrame, stamp: str | None = None, newest_by: str | None = None) -> list[str]:
        """Rows with a stored key replace it, others are added, absent keys stay; the partitions that were rewritten.

        ``incoming`` has each key once. A row that equals the stored one but for the column ``stamp`` leaves it as it is.
        With ``newest_by``, a column, a row that is older than the stored one (both dated) arrived late and leaves it as it is, too."""
        incoming = incoming.select(*self.schema.names, self.part_of().alias(PART))
        seen = T.StructType([T.StructField(PART, T.StringType()), T.StructField("rows", T.LongType()), T.StructField("digest", T.DecimalType(38, 0))])
        if not self.files():                                 # nothing to meet
            self._write(incoming, "overwrite")
            stored = self.with_parts()
            self._digest(stored, (stamp,) if stamp else ()).write.mode("overwrite").parquet(self.digests)
            return sorted(self.files())
        spark = self.spark
        path = fresh_dir(spark, "upsert-rows")               # read several times below
        incoming.write.parquet(path)                         # aside, in any order: only what is put in place is dealt by partition
        incoming = spark.read.schema(T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])).parquet(path)
        new = {r[PART]: (r["rows"], r["digest"]) for r in self._digest(incoming, (stamp,) if stamp else ()).collect()}   # a row a partition
        old = {r[PART]: (r["rows"], r["digest"]) for r in read_or_empty(spark, self.digests, seen).collect()}
        enter = [p for p, d in new.items() if old.get(p) != d]
        if not enter:
            return []
        changed = incoming.where(F.col(PART).isin(enter))
        leave = []
        if not self.buckets:                                 # a key's bucket stays
            places = self.with_parts().select(self.key, F.col(PART).alias("old_part"))
            leave = [r[0] for r in places.join(changed.select(self.key, F.col(PART).alias("new_part")), self.key)
                     .where("old_part <> new_part").select("old_part").distinct().collect()]
        touched = sorted({*enter, *leave})
        # what is known of a partition counts no more once it may change
        kept = {p: d for p, d in old.items() if p not in touched}
        self._keep(kept, seen)
        current = self.with_parts().where(F.col(PART).isin(touched))
        whole = F.struct(*(F.col(c) for c in self.schema.names), PART)
        both = (current.select(self.key, whole.alias("_old"))
                .join(changed.select(self.key, whole.alias("_new")), self.key, "full"))
        stays = F.col("_new").isNull()
        if newest_by:
            stays = stays | F.coalesce(F.col(f"_old.{newest_by}") > F.col(f"_new.{newest_by}"), F.lit(False))
        if stamp:
            same = F.col("_old").isNotNull()
            for c in [*self.schema.names, PART]:
                if c != stamp:
                    same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
            stays = stays | same
        row = F.when(stays, F.col("_old")).otherwise(F.col("_new"))
        merged = both.select(row.alias("_row")).select("_row.*")
        if leave:                                            # a key seen twice: an earlier upsert was interrupted
            merged = merged.dropDuplicates([self.key])
        aside = fresh_dir(spark, "upsert-merged")
        merged.write.parquet(aside)
        merged = spark.read.schema(incoming.schema).parquet(aside)
        left = {r[0] for r in merged.select(PART).distinct().collect()}
        self._write(merged, "overwrite")
        for p in set(touched) - left:                        # nothing stayed there
            self._fs.delete(self._path(f"{self.root}/{PART}={p}"), True)
        self._keep(kept | {p: d for p, d in new.items() if p in touched and p in enter}, seen)
        return touched

    def _keep(self, digests: dict, schema: T.StructType) -> None:
        rows = [(p, n, d) for p, (n, d) in sorted(digests.items())]
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(self.digests)
