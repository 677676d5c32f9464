"""Helpers shared by the corpus operators: table reading, written stages, bounded bitmaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir

BATCH_BYTES = 4 << 20            # the row that reaches it is the last of its batch
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of about ``BATCH_BYTES`` in what runs inside. A batch is held several times over, for each core: by the JVM outside its
    heap, as it is filled and as it is sent, and by the Python worker. Ten thousand whole texts to a batch add up to hundreds of MB."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside has its shuffle files deleted as soon as its own query ends. Else they stay until the driver's JVM collects its garbage, which in
    a chain of many small queries comes late: the disk then holds the shuffles of all of them."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: read by several later steps, and
    still there when executors are lost."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` once all that reads them is written itself."""
    for df in tables:
        files = df.inputFiles()
        if files:
            jvm = df.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores added as make it differ from every column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """The rows of ``docs`` but those whose (doc_id, xxhash64 of the text) is in ``bad``(doc_id, tkey); all columns, whatever their names."""
    i, t = free_names(docs, "bad_id", "bad_key")
    bad = bad.select(F.col("doc_id").alias(i), F.col("tkey").alias(t)).distinct()
    return docs.join(bad, (F.col("doc_id").cast("bigint").eqNullSafe(F.col(i))) & (F.xxhash64("text") == F.col(t)), "left_anti")


def by_hash(df: DataFrame, hash_col: str, most: int, *ties: str) -> DataFrame:
    """The ``most`` rows with the smallest 64-bit hash. They are counted first, so that only about so many are ordered, whatever the partitions."""
    share = 1.1 * (most + 500) / max(1, df.count())
    if share < 1:
        df = df.filter(F.col(hash_col) < int(share * 2.0 ** 64) - 2 ** 63)
    return df.orderBy(hash_col, *ties).limit(most)


def dense_ids(df: DataFrame, name: str, id_col: str = "id") -> tuple[DataFrame, int]:
    """``df`` with ``id_col`` from 1 to its number of rows, and that number.

    Rows are numbered within partitions and written; offsets come from one count for each partition."""
    rows = written(df.withColumn("numbered", F.monotonically_increasing_id()), name)
    part = F.shiftright("numbered", 33)
    sizes = sorted(map(tuple, rows.groupBy(part.alias("p")).count().collect()))
    offsets, total = [], 0
    for p, n in sizes:
        offsets.append((p, total))
        total += n
    spark = df.sparkSession
    before = F.broadcast(spark.createDataFrame(offsets, "numbered_part bigint, numbered_before bigint"))   # a row a partition
    out = (rows.join(before, part == F.col("numbered_part"))
           .withColumn(id_col, F.col("numbered_before") + F.col("numbered").bitwiseAND((1 << 33) - 1) + 1)
           .drop("numbered", "numbered_part", "numbered_before"))
    return out, total


def split_of(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (NULL ids count as the empty text)."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % parts).cast("int")


def text_bytes(col: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return col.cast(pa.binary()).to_pylist()


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              schema: str) -> DataFrame:
    """``fn`` on each Arrow batch of each partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def hash_bitmap(df: DataFrame, col: str, bits: int) -> np.ndarray:
    """Bitmap over the top ``bits`` bits of a 64-bit hash column, packed in 64-bit words.

    The words are or-ed on the executors, so the driver gets 2**(bits-6) longs at most, in Arrow
    columns, whatever the number of rows. It only ever lets too much through.
    """
    slot = F.shiftrightunsigned(F.col(col), 64 - bits)
    rows = (df.filter(F.col(col).isNotNull())
            .groupBy(F.shiftrightunsigned(slot, 6).alias("w"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({col}, {64 - bits}) & 63 as int))")).alias("b")))
    out = np.zeros(1 << (bits - 6), np.uint64)
    got = rows.toArrow()
    out[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    return out


def in_bitmap(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = (len(words).bit_length() - 1) + 6
    slot = hashes >> np.uint64(64 - bits)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix): every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
