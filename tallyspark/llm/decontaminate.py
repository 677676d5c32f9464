"""Benchmark decontamination: a prefix-filtered containment join.

A benchmark item becomes windows of 13 consecutive words (fewer if the item has fewer), a window
becomes its word shingles. A window occurs in a document only if all its shingles do, so one of them, the
*rarest* in the corpus, is the necessary prefix to join on. Steps:

1. shingle frequencies over all documents, for shingles that the benchmark has;
2. per window the rarest shingle (a window with a shingle that no document has is dropped);
3. every place in every document with such a shingle, with the words around it, joins the windows of
   that shingle; positional and length bounds first, then the words are compared exactly;
4. hit words are counted once per document, whatever the number of overlapping windows.

What reaches all tasks is a bitmap of fixed size over shingle hashes; it only keeps places that
cannot join from being shuffled. The windows themselves are never broadcast by this code, so the benchmark may grow.

Results for odd input: NULL or empty texts have no words (0, 0, 0, digest of the empty text, false);
items without words or with a NULL id never occur; repeated items count once; each row of
``documents`` gives one row, repeated rows and NULL ids included; other columns are not read.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hash_bitmap, in_bitmap, map_arrow, mix, small_batches, table, text_bytes, without, written

WINDOW = 13
SHINGLE = 3
BITMAP_BITS = 22                 # 512 KB

# a word is a run of ASCII letters or digits and of any other than ASCII characters, A-Z in lower case
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
_FACTOR = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = mix(np.fromiter(map(crc32, words), np.uint64, len(words)) + np.uint64(size << 32))
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += h[k:k + n] * _FACTOR[k]
    return mix(out)


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, window: its words joined by a blank, len, size: words per shingle, shingles)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for item, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            w = words_of(text)
            size = min(SHINGLE, len(w))
            if not w:
                continue
            h = shingle_hashes(w, size).view(np.int64)
            length = min(window, len(w))
            for i in range(len(w) - length + 1):
                rows.append((item, b" ".join(w[i:i + length]).decode(), length, size,
                             h[i:i + length - size + 1].tolist()))
        cols = list(zip(*rows)) or [[]] * 5
        types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)],
                               names=["item_id", "window", "len", "size", "shingles"])
    src = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string"))
    return map_arrow(src.filter("item_id is not null"), run,
                     "item_id bigint, window string, len int, size int, shingles array<bigint>")


def shingle_counts(docs: DataFrame, bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """(h, n): how often each shingle that the bitmap lets through occurs in the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = [np.zeros(0, np.uint64)]
        for text in text_bytes(batch.column(0)):
            w = words_of(text)
            for size in sizes:
                h = shingle_hashes(w, size)
                hits.append(h[in_bitmap(shared.value, h)])
        h, n = np.unique(np.concatenate(hits), return_counts=True)
        return pa.record_batch([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])
    return map_arrow(docs, run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def places(docs: DataFrame, bitmap: np.ndarray, sizes: list[int], window: int) -> DataFrame:
    """One row per document: (doc_id, tkey, n_words, at), ``at`` holding the places of necessary
    shingles: hash, position, and the words from ``window - 1`` before to ``window`` after."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, offsets, hs, poss, los, ctxs = [], [0], [], [], [], []
        for text in text_bytes(batch.column(2)):
            w = words_of(text)
            n_words.append(len(w))
            for size in sizes:
                h = shingle_hashes(w, size)
                at = np.flatnonzero(in_bitmap(shared.value, h))
                hs += h[at].view(np.int64).tolist()
                for p in at.tolist():
                    lo = max(0, p - window + 1)
                    poss.append(p)
                    los.append(lo)
                    ctxs.append(b" ".join(w[lo:p + window]).decode("utf-8", "replace"))
            offsets.append(len(hs))
        at = pa.StructArray.from_arrays(
            [pa.array(hs, pa.int64()), pa.array(poss, pa.int32()), pa.array(los, pa.int32()),
             pa.array(ctxs, pa.string())], names=["h", "pos", "lo", "words"])
        return pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), at)],
            names=["doc_id", "tkey", "n_words", "at"])
    return map_arrow(docs, run, "doc_id bigint, tkey bigint, n_words bigint, "
                                "at array<struct<h:bigint,pos:int,lo:int,words:string>>")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document row: doc_id, tkey (hash of its text), n_words, n_hit, item_ids (sorted as
    strings)."""
    with small_batches(docs.sparkSession):
        base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                           F.xxhash64(F.col(text_col)).alias("tkey"), F.col(text_col).cast("string").alias("text"))
        wins = written(benchmark_windows(items, item_col, item_text, window), "bench-windows")
        sizes = sorted(r["size"] for r in wins.select("size").distinct().collect())     # 1 to SHINGLE
        tokens = wins.select("window", "len", F.posexplode("shingles").alias("off", "h"))
        counts = shingle_counts(base.select("text"), hash_bitmap(tokens, "h", BITMAP_BITS), sizes)
        # a window whose rarest shingle is not in the corpus cannot occur: left join, then drop
        rarest = (tokens.dropDuplicates(["window", "off"]).join(counts, "h", "left")
                  .groupBy("window", "len")
                  .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "off")).alias("m"))
                  .filter("m.n > 0").select("window", "len", "m.h", "m.off"))
        prefix = written(rarest, "bench-prefix")

        found = written(places(base, hash_bitmap(prefix, "h", BITMAP_BITS), sizes, window), "places")
    start = F.col("p.pos") - F.col("off")
    hits = (found.select("doc_id", "tkey", "n_words", F.explode("at").alias("p"))
            .withColumn("h", F.col("p.h"))
            .join(prefix, "h")
            .filter((start >= 0) & (start + F.col("len") <= F.col("n_words"))
                    & (start >= F.col("p.lo")))
            .filter(F.concat_ws(" ", F.slice(F.split("p.words", " "), (start - F.col("p.lo") + 1).cast("int"),
                                             F.col("len"))) == F.col("window"))
            .select("doc_id", "tkey", start.alias("s"), (start + F.col("len")).alias("e"), "window"))
    hits = written(hits.distinct(), "hits")

    doc = ["doc_id", "tkey"]
    before = (Window.partitionBy(*doc).orderBy("s", "e")
              .rowsBetween(Window.unboundedPreceding, -1))
    covered = (hits.select(*doc, "s", "e").distinct()
               .withColumn("seen", F.coalesce(F.max("e").over(before), F.lit(0)))
               .groupBy(*doc)
               .agg(F.sum(F.greatest(F.lit(0), F.col("e") - F.greatest("s", "seen"))).alias("n_hit")))
    ids = (hits.select(*doc, "window").distinct()
           .join(wins.select("window", "item_id").distinct(), "window")
           .groupBy(*doc).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")))
    per_doc = (covered.alias("c").join(ids.alias("i"), F.expr("c.doc_id <=> i.doc_id and c.tkey = i.tkey"))
               .select(F.col("c.doc_id").alias("k_id"), F.col("c.tkey").alias("k_t"), "n_hit", "item_ids"))
    return (found.select("doc_id", "tkey", "n_words")
            .join(per_doc, F.expr("doc_id <=> k_id and tkey = k_t"), "left")
            .select("doc_id", "tkey", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> F.Column:
    """At least a twentieth of the words are hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns, whatever their names. Each row is judged by its own text;
    NULL and empty texts stay, as do all rows where there are no items; rows without a doc_id are judged like any other."""
    return without(docs, contamination(docs, items).filter(is_contaminated()))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every whole document by the whole benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"))


#: DuckDB: every window of every document looked up among the benchmark's windows.
ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w0 FROM documents),
dw AS (SELECT doc_id, CASE WHEN len(w0) = 1 AND w0[1] = '' THEN [] ELSE w0 END AS w FROM d),
b AS (SELECT item_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ') AS w FROM benchmark
      WHERE item_id IS NOT NULL),
bw AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE NOT (len(w) = 1 AND w[1] = '')),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bw)),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, dwin.n, i FROM dwin JOIN win ON dwin.n = win.n AND dwin.win = win.win),
pos AS (SELECT doc_id, count(*) AS n_hit FROM
        (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
