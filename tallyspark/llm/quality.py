"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text is read once and becomes a short vector of statistics, written as a table of its own. The trees
are fitted on the statistics of labelled rows (``max_train`` of them at most, those with the smallest hash of
their id) and all rows are scored from the table by vectorised traversal.

Results for odd input: NULL and empty texts have zero statistics and are scored like any other; rows without a
doc_id are scored but never learnt from; several labels of a doc_id each count; without labels of both classes every
score is the constant share of label 1 (0.5 without labels); other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gbdt
from .common import by_hash, map_arrow, split_of, table, text_bytes, without, written

HELD_OUT = (5, 0)               # crc32 of the id modulo 5 is 0: never learnt from
MAX_TRAIN = 20_000
THRESHOLD = 0.3

STATS = ("log_chars", "log_words", "word_mean", "word_max", "unique_share", "upper", "lower", "digit", "space",
         "high", "punct", "bang", "pipe", "hash", "dollar", "percent", "amp", "star", "stops", "quotes", "brackets",
         "lines", "line_unique", "line_mean", "entropy")


def statistics(text: bytes | None) -> list[float]:
    if not text:
        return [0.0] * len(STATS)
    n = len(text)
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = hist / n
    words = text.split()
    k = max(1, len(words))
    lines = text.split(b"\n")
    some = share[share > 0]
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), (n - hist[[9, 10, 11, 12, 13, 32]].sum()) / k,
        float(np.log1p(max(map(len, words), default=0))), len(set(words)) / k,
        share[65:91].sum(), share[97:123].sum(), share[48:58].sum(), share[32] + share[9], share[128:].sum(),
        share[33:48].sum() + share[58:65].sum() + share[91:97].sum() + share[123:127].sum(),
        hist[33] / k, hist[124] / k, hist[35] / k, hist[36] / k, hist[37] / k, hist[38] / k, hist[42] / k,
        hist[[46, 63]].sum() / k, hist[[34, 39]].sum() / k, hist[[40, 41, 60, 62, 91, 93, 123, 125]].sum() / k,
        float(np.log1p(len(lines))), len(set(lines)) / len(lines), float(np.log1p(n / len(lines))),
        float(-(some * np.log2(some)).sum()),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but for ``text`` and, as ``stats``, the statistics of that."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t) for t in text_bytes(batch.column("text"))], np.float64)
        stats = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, len(STATS)), pa.int32()),
                                         pa.array(rows.ravel()))
        return pa.record_batch([*(batch.column(c) for c in keep), stats], names=[*keep, "stats"])
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(docs, run, f"{schema}, stats array<double>")


def fit(stats: DataFrame, labels: DataFrame, target: str = "quality", max_train: int = MAX_TRAIN) -> gbdt.Forest:
    """Trees from labelled rows of ``stats``(doc_id, stats); the driver gets ``max_train`` of them at most."""
    parts, out = HELD_OUT
    marks = (labels.select(F.col("doc_id").cast("bigint").alias("l_id"), F.col(target).cast("int").alias("y"))
             .filter(F.col("y").isNotNull() & F.col("l_id").isNotNull() & (split_of("l_id", parts) != out)))
    known = stats.join(marks, stats["doc_id"] == marks["l_id"]).select("stats", "y", F.xxhash64("l_id").alias("h"), "l_id")
    rows = by_hash(known, "h", max_train, "l_id", "y").toPandas()
    x = np.stack(rows["stats"].to_numpy()) if len(rows) else np.zeros((0, len(STATS)))
    return gbdt.fit(x, (rows["y"].to_numpy() > 0).astype(float))


def score(stats: DataFrame, forest: gbdt.Forest) -> DataFrame:
    """``stats`` with ``score`` in place of the statistics."""
    keep = [c for c in stats.columns if c != "stats"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return pa.record_batch([*(batch.column(c) for c in keep), pa.array(forest.score(x))], names=[*keep, "score"])
    schema = ", ".join(f"`{c}` {stats.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(stats, run, f"{schema}, score double")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, tkey, score) of every row of ``docs``."""
    stats = written(document_statistics(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tkey"),
        F.col("text").cast("string").alias("text"))), "stats")
    return score(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns, whatever their names. Each row is judged by its own
    text; NULL and empty texts, repeated rows and rows without a doc_id are scored like any other; an empty table stays empty."""
    return without(docs, scored(docs, labels).filter(F.col("score") < threshold))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every whole document."""
    parts, out = HELD_OUT
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", (split_of("doc_id", parts) == out).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
