"""Ranked lexical search by a dual-tree over items and documents.

*Score.* A document gives a term an *impact*, which grows with its occurrences and falls with the document's length; an item gives it a
*weight*, times its repeats. The score is the sum of their products, all integers, so a node's greatest impacts, times another
node's greatest weights, bound every score between their members from above.

*Trees.* Documents are range-partitioned by their heaviest term, so that alike ones meet, and cut into blocks of ``BLOCK`` rows; a block
has levels of nodes of ``FAN`` children each, down to the documents, and each level holds, for each term, the nodes where it occurs with their
greatest impact. Items, in the order of their heaviest terms, form batches, groups of ``FAN`` and single ones.

*Search.* Every batch is first searched in the blocks with the largest bounds, which gives its items' weakest k-th scores. A pair of block and batch whose
bound is below the weakest of the batch goes unread; in the others, items descend by groups, then alone, and leave a node
when its bound is below theirs. Only documents that reach an item's bound come back, ``top`` of a block at most.

Only terms of items matter: they get dense ids. Up to ``VOCABULARY`` terms are broadcast and looked up; more are joined.

Results for odd input: NULL and empty texts have no terms and neither count nor score; a row of documents without an id counts in
all statistics, but isn't listed; repeated rows are documents of their own; the rows of an item_id are one item, with the terms of all; an item
without an id, terms, or matches has no rows; empty tables give none; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dense_ids, map_arrow, table, text_bytes, written

TOP = 20
VOCABULARY = 1 << 20            # item terms that are broadcast: some 50 MB
BLOCK = 2048                    # documents; FAN ** 3 * 4
FAN = 8
BATCH_ITEMS = 64
BATCH_TERMS = 8192              # of a batch; a longer item is a batch of its own
SEEDS = 2                       # blocks that each batch is searched in first
SLICE = 256                     # batches that meet a block together

_KEEP = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all bytes above; A-Z lower-cased."""
    return text.translate(_KEEP).split() if text else []


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term, q: occurrences)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, words, counts = [], [], []
        for i, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            for w, q in Counter(terms(text)).items():
                ids.append(i)
                words.append(w)
                counts.append(q)
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(words, pa.binary()), pa.array(counts, pa.int64())],
                               names=["item_id", "term", "q"])
    base = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("item_id is not null")
    return map_arrow(base, run, "item_id bigint, term binary, q bigint").groupBy("item_id", "term").agg(F.sum("q").alias("q"))


def postings(docs: DataFrame, vocabulary: DataFrame, size: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, ids, tfs) of every document with a term: its length and its item terms, int32 each; and (id, df)."""
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if size > VOCABULARY:
        return _joined_postings(base, vocabulary)
    some = vocabulary.select("term", "id").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(some.column(0).to_pylist(), some.column(1).to_pylist())))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        rows, sizes, ids, tfs = [], [], [], []
        for k, text in enumerate(text_bytes(batch.column(1))):
            words = terms(text)
            if words:
                own, tf = np.unique(np.array([known[w] for w in words if w in known], np.int32), return_counts=True)
                rows.append(k)
                sizes.append(len(words))
                ids.append(own.tobytes())
                tfs.append(tf.astype(np.int32).tobytes())
        return pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                                pa.array(tfs, pa.binary())], names=["doc_id", "n", "ids", "tfs"])
    out = written(map_arrow(base, run, POSTINGS), "postings")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=size + 1)
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids), pa.array(total[ids])], names=["id", "df"])
    return out, out.select("ids").mapInArrow(counted, "id bigint, df bigint").groupBy("id").agg(F.sum("df").alias("df"))


POSTINGS = "doc_id bigint, n bigint, ids binary, tfs binary"


def _joined_postings(base: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for a vocabulary too large to broadcast: terms meet it in a join."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, sizes, words, tfs = [], [], [], []
        for k, text in enumerate(text_bytes(batch.column(1))):
            own = Counter(terms(text))
            if own:
                rows.append(k)
                sizes.append(own.total())
                words.append(list(own))
                tfs.append(list(own.values()))
        return pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(words, pa.list_(pa.binary())),
                                pa.array(tfs, pa.list_(pa.int32()))], names=["doc_id", "n", "words", "tfs"])
    rows = written(map_arrow(base, run, "doc_id bigint, n bigint, words array<binary>, tfs array<int>")
                   .withColumn("row", F.monotonically_increasing_id()), "terms")
    each = rows.select("row", F.explode(F.arrays_zip("words", "tfs")).alias("z")).select("row", F.col("z.words").alias("term"), F.col("z.tfs").alias("tf")) \
        .join(vocabulary.select("term", "id"), "term").select("row", "id", "tf")
    each = written(each, "term-rows")
    lists = each.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.col("id").cast("int").alias("id"), "tf"))).alias("p"))

    def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, tfs = ([np.array(x or [], np.int32).tobytes() for x in batch.column(c).to_pylist()] for c in ("i", "t"))
        return pa.record_batch([batch.column("doc_id"), batch.column("n"), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())],
                               names=["doc_id", "n", "ids", "tfs"])
    out = rows.select("row", "doc_id", "n").join(lists, "row", "left").select("doc_id", "n", F.col("p.id").alias("i"), F.col("p.tf").alias("t"))
    return written(map_arrow(out, packed, POSTINGS), "postings"), each.groupBy("id").agg(F.count("*").alias("df"))


# ---- trees ---------------------------------------------------------------------------------------------------------

class Sparse:
    """(term, node, value), sorted by term and node; ``of`` gives the entries of some terms, and which of the terms each belongs to."""

    def __init__(self, term: np.ndarray, node: np.ndarray, value: np.ndarray):
        self.node, self.value = node, value
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        self.term, self.first = term[first], np.append(first, len(term))

    def up(self, fan: int) -> Sparse:
        """The level above: the greatest value among ``fan`` nodes."""
        term, node = np.repeat(self.term, np.diff(self.first)), self.node // fan
        if not len(term):
            return self
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (node[1:] != node[:-1])]))
        return Sparse(term[new], node[new], np.maximum.reduceat(self.value, new))

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.term, ids)
        has = np.flatnonzero(at < len(self.term))
        has = has[self.term[at[has]] == ids[has]]
        begin, end = self.first[at[has]], self.first[at[has] + 1]
        size = end - begin
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return np.repeat(begin, size) + inside, np.repeat(has, size)

    def bounds(self, ids: np.ndarray, weights: np.ndarray, alive: np.ndarray) -> np.ndarray:
        """Of each node the sum of weight times value over ``ids``, for nodes that are ``alive``; others get -1."""
        at, of = self.of(ids)
        live = alive[self.node[at]]
        at, of = at[live], of[live]
        out = np.zeros(len(alive), np.int64)
        np.add.at(out, self.node[at], self.value[at] * weights[of])
        out[~alive] = -1
        return out


class Block:
    """Documents as a tree; ``levels[0]`` is the documents, the last one the root."""

    def __init__(self, doc_ids: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        self.doc_ids, self.sizes = doc_ids, [len(doc_ids)]
        self.levels = [Sparse(term, doc, impact)]
        while self.sizes[-1] > 1:
            self.levels.append(self.levels[-1].up(FAN))
            self.sizes.append(-(-self.sizes[-1] // FAN))

    def stored(self) -> bytes:
        """The documents alone; impacts are below 10**6."""
        low = self.levels[0]
        return pickle.dumps((self.doc_ids, low.term.astype(np.int32), low.first.astype(np.int32), low.node.astype(np.uint16), low.value.astype(np.int32)))

    @staticmethod
    def read(raw: bytes) -> Block:
        doc_ids, term, first, node, value = pickle.loads(raw)
        return Block(doc_ids, np.repeat(term.astype(np.int64), np.diff(first)), node.astype(np.int64), value.astype(np.int64))

    def children(self, alive: np.ndarray, level: int) -> np.ndarray:
        return np.repeat(alive, FAN)[:self.sizes[level]]


class Items:
    """A batch: for each item its term ids and weights; groups hold the greatest weights of ``FAN`` items."""

    def __init__(self, names: list[int], ids: list[np.ndarray], weights: list[np.ndarray]):
        self.names, self.ids, self.weights = names, ids, weights
        self.groups = [self._greatest(range(k, min(k + FAN, len(names)))) for k in range(0, len(names), FAN)]
        self.root = self._greatest(range(len(names)))

    def _greatest(self, some) -> tuple[np.ndarray, np.ndarray]:
        ids, weights = (np.concatenate([x[k] for k in some]) for x in (self.ids, self.weights))
        order = np.lexsort((-weights, ids))
        ids, weights = ids[order], weights[order]
        new = np.concatenate([[True], ids[1:] != ids[:-1]])
        return ids[new], weights[new]


def weakest(scores: np.ndarray, top: int, before: int) -> int:
    """The k-th best score, where there are as many, and not below what was known."""
    return max(before, int(np.partition(scores, len(scores) - top)[len(scores) - top])) if len(scores) >= top else before


def search(block: Block, items: Items, floors: np.ndarray, top: int) -> tuple[list[int], list[int], list[int]]:
    """(item, doc_id, score) of the documents that reach their item's floor, ``top`` at most for each item. ``floors``
    rise as scores are found."""
    out = ([], [], [])
    root = len(block.levels) - 1
    middle = min(2, root)                                    # groups of items go down to nodes of FAN ** 2 documents
    for g, (ids, weights) in enumerate(items.groups):
        members = range(g * FAN, min(g * FAN + FAN, len(items.names)))
        alive = np.ones(block.sizes[root], bool)
        for level in range(root, middle - 1, -1):
            if level < root:
                alive = block.children(alive, level)
            alive = block.levels[level].bounds(ids, weights, alive) >= floors[members].min()
            if not alive.any():
                break
        if not alive.any():
            continue
        for k in members:
            left = alive
            for level in range(middle, -1, -1):
                if level < middle:
                    left = block.children(left, level)
                got = block.levels[level].bounds(items.ids[k], items.weights[k], left)
                left = got >= max(1, floors[k])
                if not left.any():
                    break
            else:
                docs = np.flatnonzero(left)
                scores, names = got[docs], block.doc_ids[docs]
                best = np.lexsort((names, -scores))[:top]
                floors[k] = weakest(scores, top, floors[k])
                out[0].extend([items.names[k]] * len(best))
                out[1].extend(names[best].tolist())
                out[2].extend(scores[best].tolist())
    return out


def heaviest(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """``rows`` with ``head``: the id of the term of the greatest weight."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w, heads = shared.value, []
        for raw in batch.column("ids").to_pylist():
            ids = np.frombuffer(raw, np.int32)
            heads.append(int(ids[np.argmax(w[ids])]) if len(ids) else 0)
        return pa.record_batch([*batch.columns, pa.array(heads, pa.int64())], names=[*batch.schema.names, "head"])
    return map_arrow(rows, run, "doc_id bigint, n bigint, ids binary, tfs binary, head bigint")


def blocks(rows: DataFrame, documents: int, occurrences: int) -> DataFrame:
    """(block, term, most, body): each block with ``body``, and its greatest impacts by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held = TaskContext.get().partitionId() << 32, 0, []

        def sent() -> pa.RecordBatch:
            names = np.array([h[0] for h in held], np.int64)
            ids = [np.frombuffer(h[2], np.int32) for h in held]
            tf = np.concatenate([np.frombuffer(h[3], np.int32) for h in held]).astype(np.int64)
            m = np.array([75 + 25 * h[1] * documents // occurrences for h in held], np.int64)
            doc = np.repeat(np.arange(len(held)), [len(i) for i in ids])
            impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
            term = np.concatenate(ids).astype(np.int64)
            order = np.lexsort((doc, term))
            block = Block(names, term[order], doc[order], impact[order])
            top = block.levels[-1]
            k = len(top.term)
            return pa.record_batch([pa.array([task + made] * (k + 1)), pa.array([None, *top.term.tolist()], pa.int64()),
                                    pa.array([None, *top.value.tolist()], pa.int64()), pa.array([block.stored(), *[None] * k], pa.binary())],
                                   names=["block", "term", "most", "body"])
        for batch in batches:
            for h in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "tfs"))):
                held.append(h)
                if len(held) == BLOCK:
                    yield sent()
                    made, held = made + 1, []
        if held:
            yield sent()
    return rows.mapInArrow(run, "block bigint, term bigint, most bigint, body binary")


def batches_of(weighted: DataFrame) -> DataFrame:
    """(batch, items, terms): items with their weights, by heaviest term; ``weighted`` is (item_id, id, w)."""
    one = weighted.groupBy("item_id").agg(F.collect_list(F.struct("id", "w")).alias("terms"), F.max(F.struct("w", "id")).alias("head"))
    parts = max(1, one.count() // (8 * BATCH_ITEMS))
    one = one.repartitionByRange(parts, F.col("head.id"), "item_id").sortWithinPartitions(F.col("head.id"), "item_id").select("item_id", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def sent() -> pa.RecordBatch:
            ids = [np.array([t["id"] for t in h[1]], np.int64) for h in held]
            items = Items([h[0] for h in held], ids, [np.array([t["w"] for t in h[1]], np.int64) for h in held])
            k = len(items.root[0])
            return pa.record_batch([pa.array([task + made] * (k + 1)), pa.array([None, *items.root[0].tolist()], pa.int64()),
                                    pa.array([None, *items.root[1].tolist()], pa.int64()), pa.array([pickle.dumps(items), *[None] * k], pa.binary())],
                                   names=["batch", "term", "most", "body"])
        for batch in batches:
            for h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (len(held) == BATCH_ITEMS or size + len(h[1]) > BATCH_TERMS):
                    yield sent()
                    made, held, size = made + 1, [], 0
                held.append(h)
                size += len(h[1])
        if held:
            yield sent()
    return one.mapInArrow(run, "batch bigint, term bigint, most bigint, body binary")


def searched(pairs: DataFrame, trees: DataFrame, batches: DataFrame, floors: DataFrame, top: int) -> DataFrame:
    """(item_id, doc_id, score, batch) found in ``pairs``(block, batch); ``floors`` is (batch, item_id, floor)."""
    slices = max(1, batches.filter("body is not null").count() // SLICE)
    low = floors.groupBy("batch").agg(F.collect_list(F.struct("item_id", "floor")).alias("floors"))
    asked = (pairs.join(batches.filter("body is not null").select(F.col("batch"), F.col("body").alias("items")), "batch")
             .join(low, "batch", "left").withColumn("slice", F.pmod(F.xxhash64("batch"), F.lit(slices))))
    bodies = (trees.filter("body is not null").select(F.col("block").alias("block"), "body")
              .join(asked.select("block", "slice").distinct(), "block"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        for body in a.column("body").to_pylist():
            block = Block.read(body)
            for batch, raw, known in zip(*(b.column(c).to_pylist() for c in ("batch", "items", "floors"))):
                items = pickle.loads(raw)
                low = {x["item_id"]: x["floor"] for x in known or []}
                got = search(block, items, np.array([low.get(k, 1) for k in items.names], np.int64), top)
                for o, x in zip(out, (*got, [batch] * len(got[0]))):
                    o.extend(x)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["item_id", "doc_id", "score", "batch"])
    return (bodies.groupBy("block", "slice").cogroup(asked.select(F.col("block").alias("block"), F.col("slice").alias("slice"), "batch", "items", "floors").groupBy("block", "slice"))
            .applyInArrow(run, "item_id bigint, doc_id bigint, score bigint, batch bigint"))


def first_of(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id", "nth")
    return found.withColumn("nth", F.monotonically_increasing_id()).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).drop("nth")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, doc_col: str = "doc_id", item_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the ``top`` documents with the highest scores above 0."""
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    asked = written(item_terms(items, item_col, text_col), "item-terms")
    vocabulary, size = dense_ids(asked.select("term").distinct(), "item-vocabulary")
    if not size:
        return nothing
    full, frequencies = postings(docs, vocabulary, size, doc_col, text_col)
    n_docs, total = full.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return nothing
    ratio = (2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)
    weight = written(frequencies.withColumn("w", F.floor(1000.0 * F.log(ratio)).cast("bigint")), "weights")
    weighted = asked.join(vocabulary, "term").join(weight, "id").select("item_id", "id", (F.col("q") * F.col("w")).alias("w"))
    weighted = written(weighted.filter("w > 0"), "weighted-items")
    batches = written(batches_of(weighted), "batches")

    rows = full.filter("doc_id is not null and length(ids) > 0")
    head = F.xxhash64("ids")                                 # equal ones meet
    if size <= VOCABULARY:
        got, w = weight.select("id", "w").toArrow(), np.zeros(size + 1)
        w[got.column(0).to_numpy()] = got.column(1).to_numpy()
        rows, head = heaviest(rows, w), F.col("head")
    order = [head, F.xxhash64("ids", "doc_id")]
    rows = rows.repartitionByRange(max(1, -(-n_docs // (2 * BLOCK))), *order).sortWithinPartitions(*order)
    trees = written(blocks(rows, n_docs, total), "blocks")

    roots = trees.filter("term is not null").select("block", "term", F.col("most").alias("x"))
    bounds = (roots.join(batches.filter("term is not null").select("batch", "term", F.col("most").alias("y")), "term")
              .groupBy("block", "batch").agg(F.sum(F.col("x") * F.col("y")).alias("bound")))
    bounds = written(bounds, "pair-bounds")
    by_bound = Window.partitionBy("batch").orderBy(F.desc("bound"), "block")
    seeds = written(bounds.withColumn("nth", F.row_number().over(by_bound)).filter(F.col("nth") <= SEEDS).select("block", "batch"), "seeds")
    none = spark.createDataFrame([], "batch bigint, item_id bigint, floor bigint")
    first = written(first_of(searched(seeds, trees, batches, none, top), top), "first-found")
    floors = written(first.filter(F.col("rank") == top).select("batch", "item_id", F.col("score").alias("floor")), "floors")
    # a batch's weakest floor counts only if all its items have one
    sizes = weighted.select("item_id").distinct().join(_members(batches), "item_id").groupBy("batch").agg(F.count("*").alias("items"))
    weak = floors.groupBy("batch").agg(F.min("floor").alias("weakest"), F.count("*").alias("have")).join(sizes, "batch") \
        .select("batch", F.when(F.col("have") == F.col("items"), F.col("weakest")).otherwise(F.lit(1)).alias("weakest"))
    rest = (bounds.join(seeds, ["block", "batch"], "left_anti").join(weak, "batch", "left")
            .filter(F.col("bound") >= F.coalesce("weakest", F.lit(1))).select("block", "batch"))
    more = searched(written(rest, "pairs"), trees, batches, floors, top)
    out = first_of(first.drop("rank").unionByName(more), top)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _members(batches: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = [(b, k) for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for k in pickle.loads(raw).names]
        return pa.record_batch([pa.array([x[0] for x in names], pa.int64()), pa.array([x[1] for x in names], pa.int64())], names=["batch", "item_id"])
    return map_arrow(batches.filter("body is not null").select("batch", "body"), run, "batch bigint, item_id bigint")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for every benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: DuckDB: every pair that shares a term.
ORACLE = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w, row_number() OVER () AS row FROM documents WHERE text IS NOT NULL),
d AS MATERIALIZED (SELECT row, doc_id, len(w) AS n, w FROM t WHERE len(w) > 0),
s AS (SELECT count(*) AS docs, sum(n) AS total FROM d),
p AS MATERIALIZED (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term),
f AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT docs FROM s) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p GROUP BY term),
q AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL)
      GROUP BY item_id, term),
x AS (SELECT q.item_id, d.row, d.doc_id, sum(q.q * f.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * d.n * s.docs) // s.total)))) AS score
      FROM q JOIN p USING (term) JOIN f USING (term) JOIN d USING (row) CROSS JOIN s WHERE d.doc_id IS NOT NULL GROUP BY q.item_id, d.row, d.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= {TOP}
"""
