"""Language identification: the family first, then the language within it.

A text becomes a vector of hashed byte n-grams (1 to 3) of its lower-case form. One linear support vector machine for each family
(one against the rest) picks the family; within it, one machine for each pair of languages votes.

Every language of the training rows is learnt, whatever their number. The fit uses some ``per_lang`` documents of each, fewer where
all would pass ``MOST`` together (those whose hash falls under the language's share), and beside the whole text of
each, two short runs of its words, so that short texts are learnt too. Every text is predicted from all of its bytes.

Results for odd input: a text without a letter, or NULL, is ``und`` with score 0; without training rows all are ``und``; with one
language all others are that, with score 1; equal votes go to the larger margin, equal margins to the language first in order; rows with equal or NULL ids give a row each; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import svm
from .common import map_arrow, split_of, table

HELD_OUT = (3, 1)
PER_LANG = 700
MOST = 8_000                    # documents of all languages together: three vectors each go to the driver
ALIKE = 0.5                     # cosine from which a language outside the list joins another's family
DIM = 2048
# fixed value: families of ISO 639 codes; others are told from the texts
FAMILY = {"en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
          "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
          "pl": "slavic", "cs": "slavic", "ru": "slavic", "uk": "slavic", "bg": "slavic", "hr": "slavic"}


def features(text: str) -> np.ndarray:
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8).astype(np.uint32)
    two = (b[:-1] << 8) | b[1:]
    grams = [b[1:-1] + np.uint32(1 << 24), two + np.uint32(2 << 24), (two[:-1] << 8) | b[2:]]
    out = np.zeros(DIM)
    for g in grams:
        out += np.bincount((g * np.uint32(2654435761)) >> np.uint32(32 - 11), minlength=DIM)
    out = np.sqrt(out)
    return (out / (np.linalg.norm(out) or 1)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def training_rows(docs: DataFrame, per_lang: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and languages of the sample; three rows of 2 * DIM bytes for a document."""
    parts, out = HELD_OUT
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (split_of("doc_id", parts) != out))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}     # a row a language
    if not counts:
        return np.zeros((0, DIM), np.float32), np.array([])
    spark = docs.sparkSession
    per_lang = min(per_lang, max(2, MOST // len(counts)))
    shares = spark.createDataFrame([(lang, per_lang / n) for lang, n in counts.items()], "of string, share double")
    # rows of one id have places of their own by their texts; equal rows share one, and count once
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    some = (known.join(F.broadcast(shares), F.col("lang") == F.col("of")).filter(F.col("share") > place)
            .select("doc_id", "lang", "text").distinct())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vec, lang = [], []
        for i, name, text in zip(*(c.to_pylist() for c in batch.columns)):
            if not has_letter(text):
                continue
            words = text.split()
            rng = np.random.default_rng(crc32(str(i).encode()))
            runs = [text]
            for _ in range(2):
                n = int(rng.integers(3, 30))
                k = int(rng.integers(0, max(1, len(words) - n)))
                runs.append(" ".join(words[k:k + n]))
            for r in runs:
                vec.append(features(r).astype(np.float16).tobytes())
                lang.append(name)
        return pa.record_batch([pa.array(vec, pa.binary()), pa.array(lang, pa.string())], names=["v", "lang"])
    rows = map_arrow(some, run, "v binary, lang string").toPandas()
    if not len(rows):
        return np.zeros((0, DIM), np.float32), np.array([])
    return np.frombuffer(b"".join(rows["v"]), np.float16).reshape(-1, DIM).astype(np.float32), rows["lang"].to_numpy(str)


def families(langs: list[str], x: np.ndarray, lang: np.ndarray) -> dict[str, str]:
    """The family of each language: the listed one, else that of the language whose texts are most alike, if they are enough so."""
    out = {n: FAMILY.get(n, n) for n in langs}
    mean = np.stack([x[lang == n].mean(0) for n in langs])
    mean = mean - mean.mean(0)
    mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)
    near = mean @ mean.T
    np.fill_diagonal(near, -1)
    for k, n in enumerate(langs):
        if n not in FAMILY and near[k].max() >= ALIKE:
            old, new = out[n], out[langs[int(near[k].argmax())]]
            if old != new:
                out = {m: new if f == old else f for m, f in out.items()}
    return out


class Model:
    def __init__(self, x: np.ndarray, lang: np.ndarray):
        self.langs = sorted(set(lang.tolist()))
        of = families(self.langs, x, lang)
        family = np.array([of[n] for n in lang])
        self.families = sorted(set(family.tolist()))
        self.members = {f: sorted(set(lang[family == f].tolist())) for f in self.families}

        def two(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
            y = np.where(mask[rows], 1, -1)
            return svm.fit(x[rows], y, np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())))
        self.of_family = []
        if len(self.families) > 1:
            y = np.where(family[:, None] == np.array(self.families), 1, -1)
            ws, bs = svm.fit_each(x, y, np.where(y > 0, 1 / np.maximum(1, (y > 0).sum(0)), 1 / np.maximum(1, (y < 0).sum(0))))
            self.of_family = list(zip(ws.T, bs))
        self.pairs = {f: [(a, b, *two(lang == a, np.flatnonzero((lang == a) | (lang == b))))
                          for a, b in combinations(self.members[f], 2)] for f in self.families}

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        if self.of_family:
            m = np.stack([x @ w + b for w, b in self.of_family], 1)
            pick = m.argmax(1)
            top = np.sort(m, 1)
            sure = 1 / (1 + np.exp(-2 * (top[:, -1] - top[:, -2])))
        else:
            pick, sure = np.zeros(n, int), np.ones(n)
        out = np.empty(n, object)
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(pick == k)
            names = self.members[f]
            votes, edge = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
            for a, b, w, c in self.pairs[f]:
                s = x[rows] @ w + c
                for name, sign in ((a, s), (b, -s)):
                    votes[:, names.index(name)] += sign > 0
                    edge[:, names.index(name)] += np.tanh(sign)
            rank = votes + edge / (2 * len(names))
            best = rank.argmax(1)
            out[rows] = np.array(names, object)[best]
            if len(names) > 1:
                sure[rows] *= 1 / (1 + np.exp(-4 * edge[np.arange(len(rows)), best] / (len(names) - 1)))
        return out.tolist(), np.clip(sure, 0, 1)


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``(doc_id, text, lang)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    x, lang = training_rows(docs, per_lang)
    shared = docs.sparkSession.sparkContext.broadcast(Model(x, lang) if len(lang) else None)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, texts = shared.value, batch.column(1).to_pylist()
        pred, score = ["und"] * len(texts), np.zeros(len(texts))
        rows = [k for k, t in enumerate(texts) if model is not None and has_letter(t)]
        for at in range(0, len(rows), 256):
            part = rows[at:at + 256]
            names, sure = model.predict(np.stack([features(texts[k]) for k in part]))
            for k, name in zip(part, names):
                pred[k] = name
            score[part] = sure
        return pa.record_batch([batch.column(0), pa.array(pred), pa.array(score)], names=["doc_id", "lang_pred", "score"])
    return map_arrow(docs.select("doc_id", "text"), run, "doc_id bigint, lang_pred string, score double")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document."""
    parts, out = HELD_OUT
    return identify(table(spark, sf_dir, "documents")).select(
        "doc_id", (split_of("doc_id", parts) == out).alias("held_out"), "lang_pred", "score")
