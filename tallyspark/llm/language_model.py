"""Language-model scoring: a gated recurrent network over words, with a class-factored output.

Counts of all training tokens come first (a shuffle that grows with the corpus). The ``SHORT`` most frequent tokens form
classes of about equal weight; all others are one further class, whose members share the class's probability by their
counts, plus one. The network reads the token before (all others as one), predicts the class by a softmax, and the
token within its class by another softmax; so every token has a probability and all of them sum to one, with one
unknown token counted in.

It is trained by truncated backpropagation in numpy. A hash of id and text deals the training documents to blocks of about
``TRAIN_TOKENS`` tokens, and the blocks to ``ROUNDS`` rounds, or as many as the root of the number of blocks. In a round each block trains the network of the
round before over its own texts, in parallel streams that hold each token once, and the networks are averaged by the tokens they saw. So what is
learnt depends on the rows alone, not on files or partitions, and more text gives more updates. A document is scored from its first token to
its end token; its state goes from window to window.

To look up counts, documents are dealt to blocks of bounded size, and each block gets the counts of its own distinct tokens only; no
vocabulary is sent to all tasks but the ``SHORT`` tokens.

Results for odd input: NULL and empty texts are one token, the end; without training documents N is 0 and the network is the initial one;
rows with equal or NULL ids give a row each; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from .common import map_arrow, split_of, table, text_bytes, written

HELD_OUT = (7, 2)
SHORT = 1024
CLASSES = 32                    # of the short list; one more for all other tokens
HIDDEN = 16
WINDOW = 16                     # tokens between updates, and of a scoring window
STREAMS = 512
LEARN_STREAMS = 256
UPDATES = 64                    # of a block at least, by fewer streams where it is small
TRAIN_TOKENS = UPDATES * WINDOW * LEARN_STREAMS
ROUNDS = 16                     # at least, one block each where there are no more
CHUNK = 1 << 13                 # parameters averaged in one group
RATE = 0.5
BLOCK_BYTES = 12 << 20
KEPT = 300_000                  # distinct tokens counted before partial counts go out
END = b""                       # no word is empty


def tokens_of(text: bytes | None) -> list[bytes]:
    """A-Z in lower case, split at ASCII white space; then the end."""
    return [*text.lower().split(), END] if text else [END]


class Network:
    """Parameters: gates of the token before (``x``) and of the state (``u``), class and member outputs."""

    def __init__(self, vocab: int, per_class: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        h, small = HIDDEN, lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        self.p = {"x": small(vocab + 2, 3 * h), "u": small(h, 3 * h), "c": small(h, CLASSES + 1),
                  "cb": np.zeros(CLASSES + 1, np.float32), "w": small(CLASSES, h, per_class),
                  "wb": np.zeros((CLASSES, per_class), np.float32)}
        self.seen = {k: np.full(v.shape, 1e-2, np.float32) for k, v in self.p.items()}      # squared gradients so far

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for part in (self.p, self.seen) for v in part.values()])

    def load(self, flat: np.ndarray) -> "Network":
        at = 0
        for part in (self.p, self.seen):
            for k, v in part.items():
                part[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size
        return self

    def steps(self, prev: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each of ``prev`` (time, batch), and what the way back needs."""
        n, u = HIDDEN, self.p["u"]
        x = self.p["x"][prev]
        out, kept = np.empty((*prev.shape, n), np.float32), []
        for t in range(len(prev)):
            g = x[t, :, :2 * n] + h @ u[:, :2 * n]
            g = 1 / (1 + np.exp(-g))
            z, r = g[:, :n], g[:, n:]
            rh = r * h
            c = np.tanh(x[t, :, 2 * n:] + rh @ u[:, 2 * n:])
            kept.append((h, z, r, rh, c))
            h = h + z * (c - h)
            out[t] = h
        return out, kept

    def log_probs(self, states: np.ndarray, cls: np.ndarray, member: np.ndarray, sizes: np.ndarray,
                  grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each (class, member); the last class has no members here. With ``grads``,
        adds the gradients of their sum and returns that of the states."""
        p, rows = self.p, np.arange(len(cls))
        logit = states @ p["c"] + p["cb"]
        logit[:, :CLASSES][:, sizes == 0] = -np.inf             # classes without members
        logit -= logit.max(1, keepdims=True)
        e = np.exp(logit)
        prob = e / e.sum(1, keepdims=True)
        out = np.log(np.maximum(prob[rows, cls], 1e-20))
        back = None
        if grads is not None:
            d = -prob
            d[rows, cls] += 1
            grads["c"] += states.T @ d
            grads["cb"] += d.sum(0)
            back = d @ p["c"].T
        order = np.argsort(cls, kind="stable")
        edge = np.searchsorted(cls[order], np.arange(CLASSES + 1))
        for k in np.flatnonzero(sizes > 1):                     # the only member of a class is certain
            at = order[edge[k]:edge[k + 1]]
            if not len(at):
                continue
            s, m = states[at], sizes[k]
            w = p["w"][k][:, :m]
            logit = s @ w + p["wb"][k][:m]
            logit -= logit.max(1, keepdims=True)
            e = np.exp(logit)
            prob = e / e.sum(1, keepdims=True)
            own = np.arange(len(at))
            out[at] += np.log(np.maximum(prob[own, member[at]], 1e-20))
            if grads is not None:
                d = -prob
                d[own, member[at]] += 1
                grads["w"][k][:, :m] += s.T @ d
                grads["wb"][k][:m] += d.sum(0)
                back[at] += d @ w.T
        return out, back

    def backward(self, prev: np.ndarray, kept: list, d_out: np.ndarray, grads: dict) -> None:
        n, u = HIDDEN, self.p["u"]
        d_h, d_x = np.zeros_like(d_out[0]), np.empty((*prev.shape, 3 * n), np.float32)
        for t in range(len(prev) - 1, -1, -1):
            h, z, r, rh, c = kept[t]
            d_h = d_h + d_out[t]
            a_c = d_h * z * (1 - c * c)
            d_rh = a_c @ u[:, 2 * n:].T
            a_z, a_r = d_h * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)
            a = np.concatenate([a_z, a_r], 1)
            d_x[t, :, :2 * n], d_x[t, :, 2 * n:] = a, a_c
            grads["u"][:, :2 * n] += h.T @ a
            grads["u"][:, 2 * n:] += rh.T @ a_c
            d_h = d_h * (1 - z) + d_rh * r + a @ u[:, :2 * n].T
        flat, ids = d_x.reshape(-1, 3 * n), prev.ravel()
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        grads["x"][ids[order][first]] += np.add.reduceat(flat[order], first)


class Vocabulary:
    """The short list, dealt to classes by running weight; totals of the counts."""

    def __init__(self, short: list[bytes], counts: list[int], total: int, distinct: int):
        self.place = {t: i for i, t in enumerate(short)}
        weight = np.cumsum(counts) / max(1, sum(counts))
        cls = np.minimum((weight * CLASSES - 1e-9).astype(int), CLASSES - 1) if short else np.zeros(0, int)
        self.cls = np.append(cls, CLASSES)                              # place -1: the class of all others
        self.sizes = np.bincount(cls, minlength=CLASSES)
        begin = np.cumsum(self.sizes) - self.sizes
        self.member = np.append(np.arange(len(short)) - begin[cls], 0)
        self.total, self.distinct, self.short_total = total, distinct, int(sum(counts))
        self.begin = len(short) + 1                                     # what is read before the first token
        self.rest = total - self.short_total + distinct - len(short) + 1

    def network(self) -> Network:
        return Network(len(self.place), int(max(1, self.sizes.max(initial=1))))

    def places(self, toks: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.place.get, toks, repeat(-1)), np.int64, len(toks))


def streams_of(flat: np.ndarray, mark: int) -> np.ndarray:
    """(time, batch): ``flat`` cut into streams, the last one filled with the mark. The first row is the token before each
    stream, so that every token is predicted once."""
    n = max(1, min(LEARN_STREAMS, len(flat) // (UPDATES * WINDOW)))
    rows = np.append(flat, np.full(-len(flat) % n, mark)).reshape(n, -1)
    return np.column_stack([np.append(mark, rows[:-1, -1]), rows]).T


def train(vocab: Vocabulary, streams: np.ndarray, net: Network) -> None:
    """One pass of truncated backpropagation over ``streams`` (time, batch) of places; the state carries over windows."""
    h = np.zeros((streams.shape[1], HIDDEN), np.float32)
    other = len(vocab.place)
    for at in range(0, len(streams) - 1, WINDOW):
        part = streams[at:at + WINDOW + 1]
        prev, now = np.where(part[:-1] < 0, other, part[:-1]), part[1:].ravel()
        fresh = prev[0] == vocab.begin
        h = np.where(fresh[:, None], 0, h).astype(np.float32)
        states, kept = net.steps(prev, h)
        keep = now != vocab.begin                                       # the mark itself is not predicted
        grads = {k: np.zeros_like(v) for k, v in net.p.items()}
        flat = states.reshape(-1, HIDDEN)
        back = np.zeros_like(flat)
        _, got = net.log_probs(flat[keep], vocab.cls[now[keep]], vocab.member[now[keep]], vocab.sizes, grads)
        back[keep] = got
        net.backward(prev, kept, back.reshape(states.shape), grads)
        scale = 1 / max(1, int(keep.sum()))
        for k, g in grads.items():
            g *= scale
            net.seen[k] += g * g * 100
            net.p[k] += RATE * g * 10 / np.sqrt(net.seen[k]) / 10
        h = states[-1]


def score_documents(vocab: Vocabulary, net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Sum of the natural log probabilities of class and member over each whole document, window by window."""
    out, sizes = np.zeros(len(docs)), np.array([len(d) for d in docs], np.int64)
    order = np.argsort(-sizes, kind="stable")
    begin = np.cumsum(sizes) - sizes
    flat = np.concatenate([np.zeros(0, np.int64), *docs])
    other = len(vocab.place)
    for at in range(0, len(order), STREAMS):
        part = order[at:at + STREAMS]
        size = sizes[part]
        h = np.zeros((len(part), HIDDEN), np.float32)
        last = np.full(len(part), vocab.begin)
        for t in range(0, int(size[0]), WINDOW):
            n = int((size > t).sum())                                   # longest first: the rest has ended
            width = min(WINDOW, int(size[0]) - t)
            step = np.arange(t, t + width)[:, None]
            now = np.where(step < size[:n], flat[np.minimum(begin[part[:n]] + step, len(flat) - 1)], -2)
            prev = np.vstack([last[:n], now[:-1]])
            states, _ = net.steps(np.where(prev < 0, other, prev), h[:n])
            keep = now.ravel() != -2
            own = now.ravel()[keep]
            lp, _ = net.log_probs(states.reshape(-1, HIDDEN)[keep], vocab.cls[own], vocab.member[own], vocab.sizes)
            np.add.at(out, np.tile(part[:n], width)[keep], lp)
            h, last = states[-1], now[-1]
    return out


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n) over all rows of ``docs``(text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["token", "n"])
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                c.update(tokens_of(text))
                if len(c) > KEPT:
                    yield out()
                    c.clear()
        if c:
            yield out()
    return docs.select("text").mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def copy_of(net: Network, vocab: Vocabulary) -> Network:
    """A copy of ``net``, to be trained."""
    return vocab.network().load(net.flat())


def trained_round(part: DataFrame, shared: Broadcast, net: Network) -> Network:
    """The networks that the blocks of ``part``(block, key, places) make of ``net``, averaged by their tokens."""
    model = part.sparkSession.sparkContext.broadcast(net)

    def learn(t: pa.Table) -> pa.Table:
        v, own = shared.value, copy_of(model.value, shared.value)
        docs = sorted(zip(t.column("key").to_pylist(), t.column("places").to_pylist()))     # not as they came
        mark = np.array([v.begin], np.int16).tobytes()
        flat = np.frombuffer(mark + mark.join(places for _, places in docs), np.int16).astype(np.int64)
        train(v, streams_of(flat, v.begin), own)
        out = own.flat()
        at = range(0, len(out), CHUNK)
        return pa.table([pa.array(range(len(at)), pa.int32()), pa.array([t.column("block")[0].as_py()] * len(at), pa.int64()),
                         pa.array([len(flat) - len(docs)] * len(at), pa.int64()),
                         pa.array([out[k:k + CHUNK].tobytes() for k in at], pa.binary())], names=["chunk", "block", "n", "v"])

    def average(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*(t.column(c).to_pylist() for c in ("block", "n", "v"))))        # sums in the same order
        total = sum(n for _, n, _ in rows)
        mean = sum(np.frombuffer(v, np.float32).astype(np.float64) * (n / total) for _, n, v in rows)
        return pa.table([t.column("chunk").slice(0, 1), pa.array([mean.astype(np.float32).tobytes()], pa.binary())], names=["chunk", "v"])
    rows = (part.groupBy("block").applyInArrow(learn, "chunk int, block bigint, n bigint, v binary")
            .groupBy("chunk").applyInArrow(average, "chunk int, v binary").collect())
    model.unpersist()
    if not rows:                                                        # no block of this round has a row
        return net
    flat = np.frombuffer(b"".join(bytes(r["v"]) for r in sorted(rows, key=lambda r: r["chunk"])), np.float32)
    return net.load(flat)


def trained(docs: DataFrame, vocab: Vocabulary, block_tokens: int = TRAIN_TOKENS) -> Network:
    """The network after all rounds over ``docs``(doc_id, text)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocab)
    blocks = 1 + vocab.total // block_tokens
    rounds = min(blocks, max(ROUNDS, 1 + isqrt(blocks - 1)))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        places = [shared.value.places(tokens_of(t)).astype(np.int16).tobytes() for t in text_bytes(batch.column(1))]
        return pa.record_batch([batch.column(0), pa.array(places, pa.binary())], names=["key", "places"])
    placed = map_arrow(docs.select(F.xxhash64("doc_id", "text"), "text"), place, "key bigint, places binary")
    block = F.pmod("key", F.lit(blocks))
    path = fresh_dir(spark, "llm-places")
    schema = "key bigint, places binary, block bigint, round int"
    (placed.withColumn("block", block).withColumn("round", (block % rounds).cast("int"))
     .repartition("round", "block").write.partitionBy("round").parquet(path))
    net = vocab.network()
    for k in range(rounds if vocab.total else 0):
        part = spark.read.schema(schema).parquet(path).filter(F.col("round") == k)
        # a stated number of tasks: by size, blocks that train side by side would be merged
        net = trained_round(part.repartition(4 * (1 + blocks // rounds), "block"), shared, net)
    return net


def log_likelihood(docs: DataFrame, is_training: F.Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``(doc_id, text)."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    learn = base.filter(is_training)
    counts = written(token_counts(learn), "token-counts")
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    short = counts.orderBy(F.desc("n"), "token").limit(SHORT).collect()
    vocab = Vocabulary([bytes(r["token"]) for r in short], [r["n"] for r in short], total or 0, distinct)
    model = spark.sparkContext.broadcast((vocab, trained(learn, vocab)))

    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    # blocks by id and text, so that rows without an id, or with the same one, are spread
    dealt = base.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def distinct_tokens(t: pa.Table) -> pa.Table:
        toks = set().union(*(tokens_of(x) for x in text_bytes(t.column("text").combine_chunks())))
        return pa.table([pa.array(list(toks), pa.binary()), pa.array(np.full(len(toks), t.column("block")[0].as_py()))],
                        names=["token", "block"])
    asked = dealt.groupBy("block").applyInArrow(distinct_tokens, "token binary, block bigint")
    known = asked.join(counts, "token").select("block", "token", "n")

    def score(key: tuple, t: pa.Table, c: pa.Table) -> pa.Table:
        v, net = model.value
        counted = c.column("token").to_pylist()                         # 0: not counted in training
        index = dict(zip(counted, range(1, len(counted) + 1)))
        n_at, place_at = np.append(0, c.column("n").to_numpy()), np.append(-1, v.places(counted))
        low = np.log10(v.total + v.distinct + 1)
        rows, docs_places = [], []
        for i, x in zip(t.column("doc_id").to_pylist(), text_bytes(t.column("text").combine_chunks())):
            toks = tokens_of(x)
            ids = np.fromiter(map(index.get, toks, repeat(0)), np.int64, len(toks))
            n, places = n_at[ids], place_at[ids]
            rest = n[places < 0]
            rows.append((i, len(toks), int((n > 0).sum()), v.total, float((np.log10(n + 1) - low).sum()),
                         float((np.log10(rest + 1) - np.log10(v.rest)).sum())))
            docs_places.append(places)
        lp = score_documents(v, net, docs_places)
        cols = list(zip(*rows)) or [[]] * 6
        return pa.table([*(pa.array(x, pa.int64()) for x in cols[:4]), pa.array(cols[4], pa.float64()),
                         pa.array(lp / np.log(10) + np.array(cols[5], float))],
                        names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return (dealt.groupBy("block").cogroup(known.groupBy("block"))
            .applyInArrow(score, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every whole document, learnt from those not held out."""
    parts, out = HELD_OUT
    held = split_of("doc_id", parts) == out
    return log_likelihood(table(spark, sf_dir, "documents"), ~held).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
