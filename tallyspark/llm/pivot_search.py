"""Exact top-k search by inner product, with elimination by a pivot table.

Every vector's distances to a few dozen pivots are stored beside it. For a query q and a vector x the
triangle inequality gives |q - x| >= max over pivots |d(q, p) - d(x, p)|, and with the norms an upper bound of
q . x. In each block of vectors a query evaluates its candidates in order of the bounds and stops where the bound falls
below its k-th best score, which is exact. Blocks give k rows a query, merged at the end.

Pivots come from a bounded sample (the ``SAMPLE`` rows with the smallest hash of their id), the farthest point first; they only affect
speed. Where scores of a block may pass 2**53 they are summed as whole numbers of any size; one that does not fit 64 bits is an error.

Results for odd input: vectors that are NULL or hold NULL or non-finite components, and rows with a NULL id, take no part; missing
components of a shorter vector count as 0; a query never meets rows with its own id; each repeated row is a candidate, and a repeated
query id is asked once, with its smallest vector; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import by_hash, map_arrow, table, written

TOP = 5
EVERY = 50
PIVOTS = 24
SAMPLE = 512
BLOCK = 4096                    # vectors in a block
QUERIES = 512                   # queries that meet a block together
UNIT = 256


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): floor(256 * x) of usable vectors, as doubles."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad)
            .select(F.col(id_col).cast("bigint").alias("vec_id"),
                    F.transform(v, lambda x: F.floor(x * UNIT).cast("double")).alias("v")))


def matrix(col: pa.Array, width: int = 0) -> np.ndarray:
    rows = col.to_pylist()
    out = np.zeros((len(rows), max([width, *map(len, rows)])))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """The farthest point first, from the vector farthest from the mean."""
    if not len(x):
        return x
    near = np.linalg.norm(x - x.mean(0), axis=1)
    picked = []
    for _ in range(min(n, len(x))):
        k = int(near.argmax())
        picked.append(k)
        d = np.linalg.norm(x - x[k], axis=1)
        near = d if len(picked) == 1 else np.minimum(near, d)
    return x[picked]


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with ``d``, the distances to the pivots."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(batch.column(1), pivots.shape[1])
        p = np.zeros((len(pivots), x.shape[1]))
        p[:, :pivots.shape[1]] = pivots
        d = np.stack([np.linalg.norm(x - q, axis=1) for q in p], 1)
        return pa.record_batch([*batch.columns, pa.array(d.tolist(), pa.list_(pa.float64()))], names=["vec_id", "v", "d"])
    return map_arrow(vectors, run, "vec_id bigint, v array<double>, d array<double>")


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def whole_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; an error where one does not fit 64 bits."""
    q = [int(c) for c in q]
    return np.array([sum(int(a) * c for a, c in zip(r, q)) for r in x], dtype=object).astype(np.int64)


def search_block(q: pa.Table, x: pa.Table, top: int) -> pa.Table:
    """The best ``top`` of a block for each query."""
    q, x = q.combine_chunks(), x.combine_chunks()
    out = [[], [], []]
    if q.num_rows and x.num_rows:
        width = max(matrix(t.column("v")).shape[1] for t in (q, x))
        qm, xm = matrix(q.column("v"), width), matrix(x.column("v"), width)
        qd, xd = matrix(q.column("d")), matrix(x.column("d"))
        xi = x.column("vec_id").to_numpy()
        norm = (xm ** 2).sum(1)
        for i, qid in enumerate(q.column("vec_id").to_pylist()):
            low = np.abs(xd - qd[i]).max(1)
            far = norm + (qm[i] ** 2).sum()
            bound = (far - low ** 2) / 2 + 1e-9 * far + 1e-6          # above rounding errors
            bound[xi == qid] = -np.inf
            order = np.argsort(-bound, kind="stable")
            ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            large = np.abs(qm[i]) @ np.abs(xm).max(0) >= 2.0 ** 53        # no partial sum of a product can be larger
            for at in range(0, len(order), 256):
                part = order[at:at + 256]
                if len(ids) == top and bound[part[0]] < scores[-1]:
                    break
                part = part[bound[part] > -np.inf]
                ids, scores = np.append(ids, xi[part]), np.append(scores, whole_products(xm[part], qm[i]) if large else (xm[part] @ qm[i]).astype(np.int64))
                keep = best(ids, scores, top)
                ids, scores = ids[keep], scores[keep]
            out[0] += [qid] * len(ids)
            out[1] += ids.tolist()
            out[2] += scores.tolist()
    return pa.table([pa.array(c, pa.int64()) for c in out], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: F.Column, top: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``top`` rows of the largest inner product, ties to the smaller id."""
    base = usable(vectors, id_col, vec_col)
    sample = by_hash(base.select(F.xxhash64("vec_id").alias("h"), "vec_id", "v"), "h", SAMPLE, "vec_id").toArrow()
    pivots = choose_pivots(matrix(sample.column("v")), PIVOTS) if sample.num_rows else np.zeros((1, 1))
    full = written(pivot_table(base, pivots), "pivot-table")
    asked = full.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "d")).alias("m")).select("vec_id", "m.v", "m.d")
    n = full.count()
    blocks, groups = max(1, -(-n // BLOCK)), max(1, -(-asked.count() // QUERIES))
    # every group of queries meets every block once; repeated rows of an id are dealt over the blocks
    q = (asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
         .withColumn("xb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    x = (full.withColumn("xb", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    found = (q.groupBy("qb", "xb").cogroup(x.groupBy("qb", "xb"))
             .applyInArrow(lambda a, b: search_block(a, b, top), "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def op5_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all embeddings for every one whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


#: DuckDB: all products.
ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({UNIT} * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.e, x.e) AS BIGINT) AS score
      FROM v q JOIN v x ON q.vec_id % {EVERY} = 0 AND x.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= {TOP}
"""
