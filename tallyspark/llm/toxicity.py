"""Toxicity: a subsequence string kernel with Nyström landmarks and a linear support vector machine.

The kernel of two strings sums over all common subsequences of three characters, each weighted by LAMBDA for every
character that it spans in the one and in the other, divided by both strings' own values, so ``i.d-iot`` still is close to
``idiot``. Units are words, with marks for their start and end, with and without the punctuation around and within them, their parts between it, and runs of single
characters (``i d i o t``). A unit's features are its kernel values with the landmarks, times the inverse root of the landmarks' own kernel matrix (Nyström); a sentence is as toxic as its worst unit, and a
text as its worst sentence.

Landmarks are words that toxic documents have and others lack, picked greedily by the toxic documents that they cover and few others
do, and clean words: some of the most frequent ones, and those that are closest to the toxic ones. The machine learns from the worst unit of each
labelled sentence, chosen anew in some rounds, and from copies of the toxic ones with a character put in.

At most ``max_toxic`` and ``max_clean`` labelled documents are learnt from (those with the smallest hash of their id).
A long unit is cut into pieces first, wide and narrow ones that overlap, and is as toxic as its worst piece. A piece that holds less than
``SHARED`` of every toxic landmark's neighbouring characters (in order, two others between them at most), or is longer than three times the
landmark, or shorter than three fifths of it, is not put through the kernel: it counts as clean.

Results for odd input: NULL and empty texts have no unit and get the score of clean ones; without labels of both
classes every score is 0; several labels of a doc_id each count; rows with equal or NULL ids give a row each, and those
without an id are not learnt from; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import svm
from .common import map_arrow, split_of, table

HELD_OUT = (4, 2)
MAX_TOXIC, MAX_CLEAN = 1_500, 3_000
THRESHOLD = 0.3
LAMBDA = 0.6
WIDTH = 24                      # a longer unit is cut into windows that overlap by half
NARROW = 12                     # and any longer than this into such windows too, for short words glued to others
BLOCK = 64                      # strings compared with the landmarks at once: their sums stay in the processor's cache
LANDMARKS = 110
CLEAN_LANDMARKS = 20
SHARED = 0.7
CLEAN_KEPT = 1_200_000            # units far from all landmarks remembered per worker
NEAR_KEPT = 400_000               # margins of others remembered per worker
_SENTENCE = re.compile(r"[\n.!?]+\s")
_EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_INNER = re.compile("[" + re.escape(_EDGE) + "]+")
_SPELT = re.compile(r"(?<!\S)\S(?:[ \t]\S(?!\S)){2,}")


def sentences(text: str) -> list[str]:
    """Pieces between line ends and sentence marks before a blank."""
    return [s for s in _SENTENCE.split(text) if s] if text else []


def units(text: str) -> set[str]:
    """Distinct lower-case words, also without punctuation around them; where some is within, without that too, and
    its parts of three characters or more; and runs of three single characters or more as one word."""
    text = text.lower()
    out = set(text.split())
    bare = {w.strip(_EDGE) for w in out if not w.isalpha()}
    out |= bare
    for w in bare:
        if not w.isalnum():
            parts = _INNER.split(w)
            out.add("".join(parts))
            out.update([p for p in parts if len(p) > 2])
    if _SPELT.search(text):
        out.update("".join(m[0].split()) for m in _SPELT.finditer(text))
    out.discard("")
    return out


def pieces(unit: str) -> list[str]:
    """The unit with its marks, or windows of it, and narrower windows."""
    u = f"^{unit}$"
    if len(u) <= NARROW + 2:
        return [u]
    return list(dict.fromkeys(u[k:k + w] for w in (WIDTH, NARROW) for k in range(0, max(1, len(u) - w // 2), w // 2)))


def codes(strings: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(strings), width), np.int32)
    for i, s in enumerate(strings):
        out[i, :len(s)] = [ord(c) for c in s]
    return out


def common_weight(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the common subsequences of order 3 of each row of ``x`` (n, width) with ``y`` (n or 1, m, width): all pairs
    at once, character by character of ``x``, with running sums over the characters of ``y``."""
    lam = np.float32(LAMBDA)
    y = np.ascontiguousarray(np.moveaxis(y, 2, 0))                          # a character of all ``y`` after the other: each step is one block of memory
    shape = (len(y), len(x), y.shape[2])
    seen = [np.zeros(shape, np.float32), np.zeros(shape, np.float32)]       # subsequences of 1 and 2 so far
    before = np.zeros(shape, np.float32)                                    # its first block stays 0
    total = np.zeros(shape[1:], np.float32)
    for j in range(x.shape[1]):
        c = x[:, j][None, :, None]
        eq = ((c == y) & (c > 0)).astype(np.float32) * (lam * lam)
        ends = [eq]
        for s in seen:
            for t in range(1, shape[0]):
                np.multiply(before[t - 1], lam, out=before[t])
                before[t] += s[t - 1]
            ends.append(eq * before)
        total += np.ascontiguousarray(np.moveaxis(ends[2], 0, 2)).sum(2)
        for s, e in zip(seen, ends):
            s *= lam
            s += e
    return total


def kernel(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """The subsequence kernel of each string with each landmark, 1 for equal strings."""
    lm = codes(landmarks, max(map(len, landmarks)))
    own = np.diag(common_weight(lm, lm[None]))
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    order = np.argsort([len(s) for s in strings], kind="stable")
    for at in range(0, len(order), 512):
        part = order[at:at + 512]
        x = codes([strings[i] for i in part], max(len(strings[i]) for i in part))
        norm = np.maximum(common_weight(x, x[:, None]), 1e-9)
        both = np.concatenate([common_weight(x[k:k + BLOCK], lm[None]) for k in range(0, len(x), BLOCK)])
        out[part] = both / np.sqrt(norm * own[None])
    return out


def pair_masks(strings: list[str], reach: int) -> np.ndarray:
    """256 bits for the ordered pairs of characters of a string that lie ``reach`` places apart at most."""
    size = np.array([len(s) for s in strings])
    c = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.cumsum(size) - size
    of = np.repeat(np.arange(len(size)), size)
    bits = np.zeros((len(c), 4), np.uint64)
    for d in range(1, reach + 1):
        same = np.flatnonzero(of[d:] == of[:-d])
        slot = (c[same] * np.uint64(31) + c[same + d] * np.uint64(17)) & np.uint64(255)
        bits[same, (slot >> np.uint64(6)).astype(int)] |= np.uint64(1) << (slot & np.uint64(63))
    return np.bitwise_or.reduceat(bits, start)


class Model:
    def __init__(self, toxic: list[str], clean: list[str]):
        self.landmarks = toxic + clean
        value, vector = np.linalg.eigh(kernel(self.landmarks, self.landmarks).astype(np.float64))
        self.root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
        self.masks = pair_masks([s.strip("^$") for s in toxic], 1)
        self.sizes = np.array([len(s) - 2 for s in toxic])
        self.w, self.b, self.a, self.c = np.zeros(len(self.landmarks)), -1.0, 1.0, 0.0

    def features(self, strings: list[str]) -> np.ndarray:
        return kernel(strings, self.landmarks) @ self.root if strings else np.zeros((0, len(self.landmarks)))

    def margin(self, strings: list[str]) -> np.ndarray:
        return self.features(strings) @ self.w + self.b

    def near(self, cut: list[str]) -> np.ndarray:
        """Which pieces hold enough of a toxic landmark's neighbouring characters, in order."""
        if not cut:
            return np.zeros(0, bool)
        masks, size = pair_masks(cut, 3), np.array([len(s) - s.startswith("^") - s.endswith("$") for s in cut])
        out = np.zeros(len(cut), bool)
        for want, n in zip(self.masks, self.sizes):
            both = np.bitwise_count(masks & want).sum(1)
            out |= (both >= SHARED * np.bitwise_count(want).sum()) & (size <= 3 * n) & (size >= 0.6 * n)
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * margin + self.c, -30, 30)))


def pick_landmarks(docs: list[set[str]], y: np.ndarray) -> list[str]:
    """Words, greedily by the toxic documents that hold them and few chosen before."""
    bad, good = Counter(), Counter()
    starts = lambda d: {f"^{u}$" for u in d if 3 < len(u) <= WIDTH - 2}
    for d, label in zip(docs, y):
        if label:
            bad.update(starts(d))
    maybe = {s for s, n in bad.items() if n >= 4}
    for d, label in zip(docs, y):
        if not label:
            good.update(starts(d) & maybe)
    n_bad, n_good = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    lift = lambda s: (bad[s] / n_bad) / ((good[s] + 0.3) / n_good)
    usable = {s for s in maybe if lift(s) > 12}
    holds = [starts(d) & usable for d, label in zip(docs, y) if label]
    where = defaultdict(list)
    for k, h in enumerate(holds):
        for s in h:
            where[s].append(k)
    worth = np.ones(len(holds))                              # halved by each landmark that a document has
    out: list[str] = []
    while where and len(out) < LANDMARKS:
        gain = {s: worth[k].sum() for s, k in where.items()}
        best = max(gain, key=lambda s: (gain[s], s))
        if gain[best] < 1.2:
            break
        out.append(best)
        worth[where.pop(best)] /= 2
    return out


def fit(rows: list[tuple[list[set[str]], int]]) -> Model | None:
    """``rows``: the units of each sentence of a document, and its label."""
    distinct = {hash(frozenset().union(*s)): (s, y) for s, y in rows}       # copies count once
    rows = list(distinct.values())
    y = np.array([label for _, label in rows])
    if not len(y) or y.min() == y.max():
        return None
    toxic = pick_landmarks([set().union(*s) for s, _ in rows], y)
    if not toxic:
        return None
    common = Counter(u for (s, label) in rows if not label for u in set().union(*s) if len(u) > 1)
    first = Model(toxic, [])
    rivals = [u for u, n in common.most_common(20_000) if n > 2 and len(u) <= WIDTH - 2 and f"^{u}$" not in set(toxic)]
    rivals = [u for u, k in zip(rivals, first.near([f"^{u}$" for u in rivals])) if k]
    close = kernel([f"^{u}$" for u in rivals], toxic).max(1) if rivals else np.zeros(0)
    rivals = [rivals[i] for i in np.argsort(-close, kind="stable")[:CLEAN_LANDMARKS]]
    often = [u for u, _ in common.most_common(CLEAN_LANDMARKS // 2) if u not in rivals and len(u) <= WIDTH - 2]
    model = Model(toxic, [f"^{u}$" for u in rivals + often])
    names = sorted({f"^{u}$" for s, _ in rows for sent in s for u in sent if len(u) <= WIDTH - 2})
    names = [u for u, k in zip(names, model.near(names)) if k]
    place = {u: i for i, u in enumerate(names)}
    is_toxic = np.isin(np.array(names, object), toxic)
    feats = np.concatenate([model.features(names[k:k + 4096]) for k in range(0, len(names), 4096)])
    score = is_toxic.astype(float)                                          # before the first round
    known = [(label, [[place[f"^{u}$"] for u in sent if f"^{u}$" in place] for sent in s]) for s, label in rows]
    rng = np.random.default_rng(7)
    for turn in range(3):
        pos, neg = set(), Counter()
        for label, sents in known:
            for sent in filter(None, sents):
                top = max(sent, key=lambda i: (score[i], i))
                if not label:
                    neg[top] += 1                                           # the worst unit of a clean sentence
                elif is_toxic[top]:
                    pos.add(top)
        if turn == 0:                                                       # clean units at large
            neg.update(int(i) for i in rng.choice(len(names), min(len(names), 4000), replace=False) if not is_toxic[i])
            first = dict(neg)
        neg = {i for i in {*neg, *first} if i not in pos}
        bent = []                                                           # a character put into toxic units
        for i in sorted(pos):
            u = names[i][1:-1]
            for _ in range(3):
                k = int(rng.integers(1, max(2, len(u))))
                bent.append(f"^{u[:k]}{'*.-_x'[int(rng.integers(5))]}{u[k:]}$"[:WIDTH])
        xp, xn = np.array(sorted(pos), int), np.array(sorted(neg), int)
        x = np.concatenate([feats[xp], model.features(bent), feats[xn]])
        label = np.concatenate([np.ones(len(xp) + len(bent)), -np.ones(len(xn))])
        weight = np.concatenate([np.full(len(xp), 1 / max(1, len(xp))), np.full(len(bent), 0.15 / max(1, len(bent))),
                                 np.full(len(xn), 1.5 / max(1, len(xn)))])
        model.w, model.b = svm.fit(x, label, weight, ridge=1e-6, rounds=600)
        score = feats @ model.w + model.b
    doc = np.array([max([score[i] for sent in s for i in sent], default=-2.0) for _, s in known])
    model.a, model.c = svm.calibrate(np.clip(doc, -2, 2), np.array([label for label, _ in known]))
    return model


_SEEN: dict[str, tuple[set[str], dict[str, float]]] = {}     # per Python worker and model


def unit_margins(model: Model, names: list[str]) -> np.ndarray:
    """The worst piece of each unit; -2 if none comes near a landmark."""
    cut = [pieces(u) for u in names]
    flat, of = [p for c in cut for p in c], np.repeat(np.arange(len(names)), [len(c) for c in cut])
    near = np.flatnonzero(model.near(flat))
    worst = np.full(len(names), -2.0)
    if len(near):
        np.maximum.at(worst, of[near], np.clip(model.margin([flat[k] for k in near]), -2, 2))
    return worst


def text_margins(model: Model, seen: tuple[set[str], dict[str, float]], texts: list[str | None]) -> np.ndarray:
    """The worst unit of each text; -2 if none comes near a landmark. ``seen`` remembers the units that are far, and
    the margins of others."""
    far, known = seen
    own = [units(t or "") - far for t in texts]
    names = [u for u in set().union(*own) if u not in known]
    new = dict(zip(names, unit_margins(model, names).tolist()))
    out = np.array([max([known[u] if u in known else new[u] for u in mine], default=-2.0) for mine in own])
    far.update([u for u, m in new.items() if m <= -2][:max(0, CLEAN_KEPT - len(far))])
    known.update([x for x in new.items() if x[1] > -2][:max(0, NEAR_KEPT - len(known))])
    return out


def scored(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """(doc_id, score) of every row of ``docs``(doc_id, text)."""
    parts, out = HELD_OUT
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = (labels.select(F.col("doc_id").cast("bigint").alias("l_id"), F.col("toxic").cast("int").alias("y"))
             .filter(F.col("l_id").isNotNull() & F.col("y").isNotNull() & (split_of("l_id", parts) != out)))
    first = [F.xxhash64("l_id"), F.col("l_id"), F.col("y")]
    marks = marks.filter("y > 0").orderBy(*first).limit(max_toxic).unionByName(
        marks.filter("y <= 0").orderBy(*first).limit(max_clean))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        sents = [[list(units(s)) for s in sentences(t or "")] for t in batch.column(0).to_pylist()]
        return pa.record_batch([pa.array(sents, pa.list_(pa.list_(pa.string()))), batch.column(1)], names=["s", "y"])
    # max_toxic + max_clean ids at most: small enough to broadcast
    some = base.join(F.broadcast(marks), F.col("doc_id") == F.col("l_id")).select("text", "y")
    rows = map_arrow(some, cut, "s array<array<string>>, y int").toArrow().to_pylist()
    model = fit([([set(u) for u in r["s"]], int(r["y"] > 0)) for r in rows if r["s"]])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        if m is None:
            score = np.zeros(batch.num_rows)
        else:
            if key not in _SEEN:
                _SEEN.clear()
            seen = _SEEN.setdefault(key, (set(), {}))
            texts = batch.column(1).to_pylist()
            score = m.score(np.concatenate([text_margins(m, seen, texts[k:k + 500]) for k in range(0, len(texts), 500)]))
        return pa.record_batch([batch.column(0), pa.array(score)], names=["doc_id", "score"])
    return map_arrow(base, run, "doc_id bigint, score double")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document."""
    parts, out = HELD_OUT
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", (split_of("doc_id", parts) == out).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
