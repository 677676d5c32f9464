"""N-gram Jaccard join by partitioning the universe of shingles (pigeonhole), verified exactly.

A document is its set of distinct 5-word shingles; two link if 100 * |intersection| >= 80 * |union|.
For sets of sizes b <= a that means: at most (a + b) / 9 shingles are in one of the two only.

*Size bands.* Band k holds the sizes from 2**k to 2**(k+1) - 1. Each band cuts the universe of
hashes into m_k segments, somewhat more than a pair in it may have differences. A pair is looked for in
the band of its smaller set; the larger one may lie a quarter above, so a set is indexed in its own band
and, if its size allows, also looks into the band below.

*Pigeonhole.* A set z may differ from a partner in D_z shingles at most, and each spoils one segment
at most. With D_z + 1 credits, a credit being a segment that is compared, no partner is missed. Only segments that
are not empty count: empty ones are equal for everybody. A segment that no other set shares is a credit for free; a
set with more than D_z of those has no partner, and leaves with all its keys.

*Allocation by cost.* Who stays takes, until it has its credits: shared segments that few sets share; *one-deletion
neighbourhoods* of its free segments (a segment compared up to one missing shingle counts twice, since it takes
two differences to spoil it), cheapest first, their cost being the sets that share a deletion key;
segments that many share; in the last resort all segments up to one missing shingle. So a frequent passage costs no
pairs, as its documents pay with their other segments, and a large group of near copies, whose members
have nothing else, is met in its keys. The index of deletion keys is held back by a bitmap of fixed
size, which lets through what can meet a probe.

*Verification.* Each set is first compared with some members of its keys' groups that its size and parities allow, in rounds that go on while they
find links, and links join into components; what then still is in two components is compared pair by pair, so no link between components
is lost and a group of copies costs a row each. Comparison is exact, over the texts' own shingles.

Results for odd input: texts without words have no shingles (n_shingles 0) and link with nothing; a row without a doc_id has
n_shingles, a NULL component, and links with nothing; if a doc_id comes with several texts, it has the links of all of them, and each of
its rows the same component; repeated rows give a row each; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dense_ids, forget, free_names, hash_bitmap, in_bitmap, map_arrow, mix, shuffles_removed, small_batches, table, text_bytes, without, written
from .components import components

SHINGLE = 5
PERCENT = 80                    # the bounds below are those of 80 %: (1 - t) / (1 + t) = 1/9
BITMAP_BITS = 24                # 2 MB
CHEAP = 24                      # sets that share a key, or a deletion key, at little cost
MEMBERS = 3                     # of a key's group, whom its sets may be compared with in a round
ASKS = 3                        # comparisons of a set in a round
LEAST_FOUND = 0.05              # rounds go on while they find so many links for each pair compared and for each set that is open
OWN, BELOW = 0, 1
SKETCH = tuple(f"p{k}" for k in range(16))

_U = np.uint64
_FACTOR = (np.arange(1, 64, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def words_of(text: bytes | None) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII only: A-Z, and blank, tab to carriage return."""
    return text.lower().split() if text else []


def shingles(words: list[bytes], size: int = SHINGLE) -> set[bytes]:
    """The distinct shingles; the blank cannot be part of a word."""
    if not words:
        return set()
    if len(words) < size:
        return {b" ".join(words)}
    return set(map(b" ".join, zip(*(words[k:] for k in range(size)))))


# fixed random values for bytes, and powers of an odd number and of its inverse (modulo 2**64)
_BYTE = mix(np.arange(256, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(1))[
    np.frombuffer(bytes(range(256)).lower(), np.uint8)]
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x2545F4914F6CDD1D
CHUNK = 1 << 17                 # bytes hashed at a time; a longer text is a chunk of its own


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _U(_BASE)), np.full(n, _U(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _chunks(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for t in texts:
        t = t or b""
        if part and size + len(t) > CHUNK:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t) + 1
    if part:
        yield part


def hashed(texts: list[bytes | None], size: int = SHINGLE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunk by chunk: the sorted distinct 64-bit hashes of each text's shingles, one text after the other, and their
    number for each text.

    A word's hash is a polynomial in its bytes, taken from a running sum over the whole chunk.
    """
    for part in _chunks(texts):
        raw = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
        up, down = _powers(1 << max(17, len(raw).bit_length()))
        total = np.zeros(len(raw) + 1, _U)
        np.cumsum(_BYTE[raw] * up[:len(raw)], out=total[1:])
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _BLANK[raw]]).view(np.int8)))
        begin, end = edge[0::2], edge[1::2]                  # the last byte is blank: words end
        word = mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(_U))
        at = np.searchsorted(begin, np.cumsum([0] + [len(t) + 1 for t in part]))   # words before each text
        words = np.diff(at)
        long = np.zeros(len(word), _U)                       # of each word, the shingle that it begins
        inner = max(0, len(word) - size + 1)
        for k in range(size):
            long[:inner] += word[k:k + inner] * _FACTOR[k]
        long = mix(long + _U(size))
        begins = np.arange(len(word)) + size <= np.repeat(at[1:], words)
        for i in np.flatnonzero((words > 0) & (words < size)).tolist():            # too few words: the sequence itself
            few = word[at[i]:at[i + 1]]
            long[at[i]] = mix((few * _FACTOR[:len(few)]).sum(keepdims=True) + _U(len(few)))[0]
            begins[at[i]] = True
        h, first = long[begins], np.concatenate([[0], np.cumsum(begins)])[at]
        for x, y in zip(first[:-1].tolist(), first[1:].tolist()):
            h[x:y].sort()
        new = np.concatenate([[True], h[1:] != h[:-1]])[:len(h)]
        new[first[:-1][first[:-1] < first[1:]]] = True
        yield h[new], np.diff(np.concatenate([[0], np.cumsum(new)])[first])


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles."""
    for h, n in hashed(texts, size):
        yield from np.split(h, np.cumsum(n)[:-1])


def band_of(n: int) -> int:
    return n.bit_length() - 1


def segments_in(band: int) -> int:
    """More than the D + 1 credits of the band's largest set: room for empty and shared segments."""
    top = (2 << band) - 1
    return int(1.15 * (top // 4 + 1)) + 4


def probes_below(n: int) -> bool:
    """Is there a size in the band below that is 80 % of ``n`` or more?"""
    return n > 1 and 100 * ((1 << band_of(n)) - 1) >= PERCENT * n


_SEGMENTS = np.array([segments_in(band) for band in range(48)])


def sides_of(h: np.ndarray, n: np.ndarray) -> Iterator[tuple]:
    """For both sides: the side, which of a chunk's sets have it, their hashes, sizes and bands."""
    band = np.frexp(n.astype(float))[1].astype(np.int64) - 1
    below = (n > 1) & (100 * ((1 << np.maximum(band, 0)) - 1) >= PERCENT * n)
    for side, has in ((OWN, n > 0), (BELOW, below)):
        yield side, np.flatnonzero(has), h[np.repeat(has, n)], n[has], band[has] - side


def chunk_segments(h: np.ndarray, n: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, ...]:
    """``segment_sums`` of many sets at once: for each segment that is not empty its set, number, sum and size."""
    of = np.repeat(np.arange(len(n)), n)
    seg = ((h >> _U(32)) * np.repeat(_SEGMENTS[band].astype(_U), n)) >> _U(32)
    if not len(h):
        return of, seg, h, of
    first = np.flatnonzero(np.concatenate([[True], (seg[1:] != seg[:-1]) | (of[1:] != of[:-1])]))
    return of[first], seg[first], np.add.reduceat(mix(h + _FACTOR[7]), first), np.diff(np.append(first, len(h)))


def segment_sums(h: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each segment that is not empty: its number, the sum of its (mixed) hashes, its size."""
    m = segments_in(band)
    seg = ((h >> _U(32)) * _U(m)) >> _U(32)                 # ranges of the sorted hashes
    first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
    sums = np.add.reduceat(mix(h + _FACTOR[7]), first)
    return seg[first], sums, np.diff(np.append(first, len(h)))


def keys_of(seg: np.ndarray, sums: np.ndarray, band: int | np.ndarray) -> np.ndarray:
    return mix(sums + mix(seg * _U(64) + np.asarray(band).astype(_U)))


def _sides(n: int) -> list[tuple[int, int]]:
    return [(OWN, band_of(n))] + ([(BELOW, band_of(n) - 1)] if probes_below(n) else [])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, sig: digest of the set, n, and for both sides: segments that are not empty)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sig, sizes, full = [], [], ([], [])
        for h, n in hashed(text_bytes(batch.column(2))):
            last = np.cumsum(n)
            sig += [hashlib.blake2b(h[x:y].tobytes(), digest_size=16).digest()
                    for x, y in zip((last - n).tolist(), last.tolist())]
            sizes.append(n)
            for side, sets, own, m, band in sides_of(h, n):
                counts = np.full(len(n), -1)
                counts[sets] = np.bincount(chunk_segments(own, m, band)[0], minlength=len(sets))
                full[side].append(counts)
        own, below = (np.concatenate(x).astype(np.int32) for x in full)
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(sig, pa.binary()), pa.array(np.concatenate(sizes)),
                                pa.array(own, mask=own < 0), pa.array(below, mask=below < 0)],
                               names=["doc_id", "tkey", "sig", "n", "full_own", "full_below"])
    return map_arrow(docs, run, "doc_id bigint, tkey bigint, sig binary, n bigint, full_own int, full_below int")


def segment_keys(texts: DataFrame, bitmap: np.ndarray | None = None) -> DataFrame:
    """(key, id, side) for each segment that is not empty, in the own band and the one below; with ``bitmap``, only if that has the key."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, ids, sides = [np.zeros(0, _U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int8)]
        names, done = batch.column(0).to_numpy(), 0
        for h, n in hashed(text_bytes(batch.column(1))):
            for side, sets, own, m, band in sides_of(h, n):
                of, seg, sums, _ = chunk_segments(own, m, band)
                found = keys_of(seg, sums, band[of])
                if shared.value is not None:
                    some = in_bitmap(shared.value, found)
                    found, of = found[some], of[some]
                keys.append(found)
                ids.append(names[done + sets[of]])
                sides.append(np.full(len(of), side, np.int8))
            done += len(n)
        return pa.record_batch([pa.array(np.concatenate(x)) for x in
                                ([k.view(np.int64) for k in keys], ids, sides)], names=["key", "id", "side"])
    return map_arrow(texts, run, "key bigint, id bigint, side tinyint")


def with_rests(h: np.ndarray, band: int) -> tuple[np.ndarray, ...]:
    """All segments, empty ones included: sizes and keys; and of each shingle, its segment and the key of the rest."""
    m = segments_in(band)
    seg, sums, size = segment_sums(h, band)
    sizes, every = np.zeros(m, np.int64), np.zeros(m, _U)
    sizes[seg.astype(np.int64)], every[seg.astype(np.int64)] = size, sums
    of = np.repeat(seg, size)
    rest = np.repeat(sums, size) - mix(h + _FACTOR[7])
    return sizes, keys_of(np.arange(m, dtype=_U), every, band), of.astype(np.int64), keys_of(of, rest, band)


def neighbourhoods(texts: DataFrame) -> DataFrame:
    """(id, side, seg, size, kind, key) of ``texts``(id, side, text): of every segment, empty or not, its key (kind 0)
    and the keys with one shingle missing (kind 1)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = [[] for _ in range(6)]
        for i, side, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                              shingle_sets(text_bytes(batch.column(2)))):
            sizes, keys, of, rest = with_rests(h, band_of(len(h)) - side)
            m, n = len(sizes), len(of)
            for c, x in zip(cols, (np.full(m + n, i), np.full(m + n, side, np.int8),
                                   np.concatenate([np.arange(m), of]).astype(np.int32),
                                   np.concatenate([sizes, sizes[of]]).astype(np.int32),
                                   np.repeat(np.array([0, 1], np.int8), [m, n]),
                                   np.concatenate([keys, rest]).view(np.int64))):
                c.append(x)
        return pa.record_batch([pa.array(np.concatenate(c)) for c in cols],
                               names=["id", "side", "seg", "size", "kind", "key"])
    return map_arrow(texts.select("id", "side", "text"), run,
                     "id bigint, side tinyint, seg int, size int, kind tinyint, key bigint")


def deletion_index(texts: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(key, y, y_side, y_kind): keys and one-deletion keys of all sets that the bitmap lets through."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = [[np.zeros(0, t)] for t in (np.int64, np.int64, np.int8, np.int8)]
        names, done = batch.column(0).to_numpy(), 0
        for h, n in hashed(text_bytes(batch.column(1))):
            for side, sets, own, m, band in sides_of(h, n):
                of, seg, sums, size = chunk_segments(own, m, band)
                many = _SEGMENTS[band]
                before = np.cumsum(many) - many
                every = np.zeros(many.sum(), _U)             # segments that are empty have keys too
                every[before[of] + seg.astype(np.int64)] = sums
                at = np.repeat(np.arange(len(sets)), many)
                keys = keys_of((np.arange(len(at)) - before[at]).astype(_U), every, band[at])
                rests = keys_of(np.repeat(seg, size), np.repeat(sums, size) - mix(own + _FACTOR[7]), np.repeat(band, m))
                for kind, k, of in ((0, keys, at), (1, rests, np.repeat(np.arange(len(sets)), m))):
                    some = np.flatnonzero(in_bitmap(shared.value, k))
                    some = some[in_bitmap(shared.value, k[some] << _U(BITMAP_BITS))]
                    for c, x in zip(cols, (k[some].view(np.int64), names[done + sets[of[some]]],
                                           np.full(len(some), side, np.int8), np.full(len(some), kind, np.int8))):
                        c.append(x)
            done += len(n)
        return pa.record_batch([pa.array(np.concatenate(c)) for c in cols], names=["key", "y", "y_side", "y_kind"])
    return map_arrow(texts.select("id", "text"), run, "key bigint, y bigint, y_side tinyint, y_kind tinyint")


def sharers(rows: DataFrame) -> DataFrame:
    """(key, f: the sets that have it) of keys that two sets share, one of them at least in its own band."""
    return (rows.groupBy("key").agg(F.count("*").alias("f"), F.count_if(F.col("side") == OWN).alias("o"))
            .filter((F.col("f") > 1) & (F.col("o") > 0)).select("key", "f"))


def met(rows: DataFrame) -> DataFrame:
    """The shared keys, with ``f``. Counted apart, so that a key that very many share is split in the join."""
    return rows.join(sharers(rows), "key")


def largest(rows: DataFrame, sets: DataFrame) -> int | None:
    """The size of the largest of ``sets`` that is in ``rows``; each set is read once, whatever its number of rows."""
    return sets.join(rows.select("id").distinct(), "id", "left_semi").agg(F.max("n")).first()[0]


def candidates(texts: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, id, side, probe): shared keys of the sets that may have partners, ``probe`` if the set takes it as a credit;
    and (a, b): pairs from one-deletion neighbourhoods."""
    need = sets.select("id", F.explode(F.expr(
        "filter(array(struct(cast(0 as tinyint) as side, full_own as full, cast(n div 4 as int) as most),"
        " struct(cast(1 as tinyint) as side, full_below as full, most_below as most)), s -> s.full is not null)")).alias("s")) \
        .select("id", "s.side", "s.full", "s.most")
    # keys are made twice, first to be counted: then only those that are shared are shuffled with their sets
    every = texts.select("id", "text")
    counts = written(sharers(segment_keys(every)), "shared-keys")
    first = written(segment_keys(every, hash_bitmap(counts, "key", BITMAP_BITS)).join(counts, "key"), "met-keys")
    forget(counts)

    def balance(rows: DataFrame) -> DataFrame:
        """(id, side, credits): what a set needs besides its free segments; sets that need none are left out."""
        shared = rows.groupBy("id", "side").agg(F.count("*").alias("shared"))
        return (need.join(shared, ["id", "side"], "left").withColumn("shared", F.coalesce("shared", F.lit(0)))
                .withColumn("credits", F.col("most") + 1 - (F.col("full") - F.col("shared")))
                .filter("credits > 0").select("id", "side", "credits"))
    rows = first.drop("f")
    spent = []
    for _ in range(2):                                       # who leaves takes keys from others
        spent.append(written(met(rows.join(balance(rows).select("id", "side"), ["id", "side"])), "met-keys"))
        rows = spent[-1].drop("f")
    due = written(balance(rows), "credits")
    rows = met(rows.join(due.select("id", "side"), ["id", "side"]))
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("id", "side").orderBy("f", "key")))
    # a set whose keys left with others in the last round has free segments more than counted: fewer credits would do
    ranked = written(ranked.join(due, ["id", "side"])
                     .withColumn("cheap", (F.col("f") <= CHEAP) & (F.col("nth") <= F.col("credits"))), "ranked")
    forget(*spent)

    # who cannot pay with cheap keys takes one-deletion neighbourhoods of segments that are free or taken already
    paid = ranked.filter("cheap").groupBy("id", "side").agg(F.count("*").alias("paid"))
    lacking = written(due.join(paid, ["id", "side"], "left")
                      .withColumn("lack", F.col("credits") - F.coalesce("paid", F.lit(0)))
                      .filter("lack > 0").select("id", "side", "lack"), "lacking")
    near = written(neighbourhoods(texts.join(lacking, "id")), "neighbourhoods")
    costs = (near.filter("size > 0").join(first.select("key", "f").distinct(), "key", "left")
             .groupBy("id", "side", "seg", "size").agg(
                 F.sum(F.when(F.col("kind") == 1, F.coalesce("f", F.lit(0))).otherwise(0)).alias("cost"),
                 F.max(F.when(F.col("kind") == 0, F.coalesce("f", F.lit(1)))).alias("own")))
    cheapest = Window.partitionBy("id", "side").orderBy("cost", "seg")
    chosen = (costs.filter((F.col("cost") <= CHEAP) & (F.col("own") <= CHEAP) & (F.col("size") > 1))
              .withColumn("nth", F.row_number().over(cheapest)).join(lacking, ["id", "side"])
              .filter("nth <= lack").select("id", "side", "seg"))
    chosen = written(chosen, "chosen")
    got = chosen.groupBy("id", "side").agg(F.count("*").alias("got"))
    poor = (lacking.join(got, ["id", "side"], "left")
            .withColumn("lack", F.col("lack") - F.coalesce("got", F.lit(0))).filter("lack > 0"))
    # the rest is paid with segments that many share; if these don't suffice either, with everything
    hot = ranked.filter("not cheap").groupBy("id", "side").agg(F.count("*").alias("hot"))
    poor = written(poor.join(hot, ["id", "side"], "left")
                   .select("id", "side", (F.col("lack") > F.coalesce("hot", F.lit(0))).alias("all")), "poor")
    probes = (ranked.join(poor, ["id", "side"], "left")
              .select("key", "id", "side", (F.col("cheap") | F.col("all").isNotNull()).alias("probe")))
    asked = near.join(chosen, ["id", "side", "seg"]).select("key", "id", "side", "kind").unionByName(
        near.join(poor.filter("all"), ["id", "side"]).select("key", "id", "side", "kind"))
    asked = written(asked.distinct(), "deletion-probes")
    top = largest(asked, sets)
    if top is None:                                          # nobody asks
        return probes, asked.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    index = deletion_index(texts.filter(100 * F.lit(top) >= PERCENT * F.col("n")), hash_bitmap(
        asked.select(F.explode(F.array("key", F.shiftleft("key", BITMAP_BITS))).alias("key")), "key", BITMAP_BITS))
    pairs = (asked.join(index, "key").filter((F.col("id") != F.col("y")) & (F.col("kind") + F.col("y_kind") < 2)
                                             & (F.col("side") + F.col("y_side") < 2))
             .select(F.greatest("id", "y").alias("a"), F.least("id", "y").alias("b")).distinct())
    return probes, pairs


def parity(h: np.ndarray) -> list[int]:
    """1,024 parities: how many hashes fall on each place, modulo 2. Two sets' parities differ in no
    more places than the sets differ in shingles."""
    bits = (np.bincount((h & _U(64 * len(SKETCH) - 1)).astype(np.int64), minlength=64 * len(SKETCH)) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64).tolist()


def within_bounds(x: str, y: str) -> F.Column:
    """What a linking pair fulfils by its sizes and parities alone."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    apart = sum((F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in SKETCH[1:]),
                F.bit_count(F.col(f"{x}{SKETCH[0]}").bitwiseXOR(F.col(f"{y}{SKETCH[0]}"))))
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (9 * apart <= n + m)


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose texts link: exact, over the shingles themselves."""
    small = texts.drop("text")
    pairs = (pairs.join(small.select(*(F.col(c).alias(f"x_{c}") for c in small.columns)), F.col("a") == F.col("x_id"))
             .join(small.select(*(F.col(c).alias(f"y_{c}") for c in small.columns)), F.col("b") == F.col("y_id"))
             .filter(within_bounds("x_", "y_")).select("a", "b"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, last, set_a = [], None, set()
        ta, tb = text_bytes(batch.column(2)), text_bytes(batch.column(3))
        for i, (x, y) in enumerate(zip(ta, tb)):
            if x != last:
                last, set_a = x, shingles(words_of(x))
            set_b = shingles(words_of(y))
            both = len(set_a & set_b)
            if both and 100 * both >= PERCENT * (len(set_a) + len(set_b) - both):
                keep.append(i)
        keep = pa.array(keep, pa.int64())
        return pa.record_batch([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])
    return map_arrow(pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb"), run, "a bigint, b bigint")


def goes_on(found: int, asked: int, sets: int) -> bool:
    """Is another round worth it? Each reads the keys of all ``sets`` that are open, so a few links do not pay for it, however few pairs were
    compared: many sets that share a passage stay open, and the pairs that their bounds allow are compared afterwards anyway."""
    return found >= LEAST_FOUND * max(asked, sets)


def linked_components(probes: DataFrame, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component) of all sets that link with another."""
    probes, pairs = written(probes, "probes"), written(pairs, "deletion-pairs")
    ids = probes.select("id").union(pairs.select("a")).union(pairs.select("b")).distinct()
    ids = written(ids, "candidate-ids")
    # texts of candidates only: a bitmap first, so that the others' texts are not shuffled
    bitmap = hash_bitmap(ids.select(F.xxhash64("id").alias("h")), "h", BITMAP_BITS)
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def may_be(batch: pa.RecordBatch) -> pa.RecordBatch:
        h = batch.column("h").to_numpy().view(_U)
        return batch.select(["id", "n", "text"]).filter(pa.array(in_bitmap(shared.value, h)))
    few = map_arrow(texts.withColumn("h", F.xxhash64("id")).select("id", "n", "text", "h"), may_be,
                    "id bigint, n bigint, text string")

    def sketched(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([parity(h) for h in shingle_sets(text_bytes(batch.column("text")))], np.int64)
        return pa.record_batch([*batch.columns, *(pa.array(rows[:, k]) for k in range(len(SKETCH)))],
                               names=["id", "n", "text", *SKETCH])
    texts = written(map_arrow(few.join(ids, "id", "left_semi").select("id", "n", "text"), sketched,
                              "id bigint, n bigint, text string, " + ", ".join(f"{c} bigint" for c in SKETCH)),
                    "candidate-texts")

    links = written(compare(pairs, texts), "links")
    past: list[DataFrame] = []
    tried, small, turn = pairs, texts.drop("text"), 0
    x, y = (small.select(*(F.col(c).alias(f"{side}_{c}") for c in small.columns)) for side in "xy")
    while True:
        comp = written(components(links), "components")
        held = probes.join(comp, probes["id"] == comp["node"], "left") \
            .select("key", "id", "side", "probe", F.coalesce("component", "id").alias("c"))
        # keys whose sets lie in two components or more; counted apart, so that a key that very many share is not one task
        split = held.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select(F.col("key").alias("key"))
        rows = written(held.join(split, "key"), "open-keys")
        forget(*past)
        past = [comp, rows]
        # some members of each key's group, by several orders that are the same for all keys; those go first that the set's bounds allow
        some = rows.groupBy("key").agg(F.array_distinct(F.array(*(
            F.min(F.struct(F.xxhash64(F.lit(k + MEMBERS * turn), "id").alias("o"), "id", "c")) for k in range(MEMBERS)))).alias("some"))
        asks = (rows.filter("probe").select("key", "id", "c").join(some, "key")
                .select("id", "c", F.explode("some").alias("s")).filter("s.c <> c")
                .groupBy("id", F.col("s.id").alias("o")).agg(F.count("*").alias("keys"))
                .select("id", "keys", F.greatest("id", "o").alias("a"), F.least("id", "o").alias("b"))
                .join(tried, ["a", "b"], "left_anti")
                .join(x, F.col("a") == F.col("x_id")).join(y, F.col("b") == F.col("y_id")).filter(within_bounds("x_", "y_"))
                .withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("keys"), "a", "b")))
                .filter(F.col("nth") <= ASKS).select("a", "b").distinct())
        asks = written(asks, "asks")
        asked = asks.count()
        if not asked:
            break
        tried = tried.unionByName(asks)
        more = written(compare(asks, texts), "links")
        found = more.count()
        links, turn = links.unionByName(more), turn + 1
        if not goes_on(found, asked, rows.select("id").distinct().count()):
            break
    # what still is apart is compared pair by pair
    comp = written(components(links), "components")
    open_rows = rows.select("key", "id", "side", "probe").join(comp, F.col("id") == F.col("node"), "left") \
        .select("key", "id", "side", "probe", F.coalesce("component", "id").alias("c"))
    open_rows = written(open_rows.join(small, "id"), "open-sets")
    mine = open_rows.filter("probe").select("key", *(F.col(c).alias(f"x_{c}") for c in ("id", "c", "n", *SKETCH)))
    theirs = open_rows.select("key", *(F.col(c).alias(f"y_{c}") for c in ("id", "c", "n", *SKETCH)))
    may_link = (F.col("y_id") < F.col("x_id")) & (F.col("x_c") != F.col("y_c")) & within_bounds("x_", "y_")
    mine, theirs = mine.alias("x"), theirs.alias("y")
    last = (mine.join(theirs, (F.col("x.key") == F.col("y.key")) & may_link)
            .select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct()
            .join(tried, ["a", "b"], "left_anti"))
    return components(links.unionByName(compare(written(last, "last-pairs"), texts)))


def linked_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, bool]:
    """(doc_id, tkey: hash of the text, n, c) of every row of ``docs``, where c tells the component of its set (NULL without words or
    doc_id); (c, doc_id, tkey): of each component the smallest row; and whether any doc_id comes twice."""
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("tkey"),
                       F.col(text_col).cast("string").alias("text"))
    with small_batches(docs.sparkSession), shuffles_removed(docs.sparkSession):
        sigs = written(signatures(base), "signatures")
        repeats = bool(sigs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").take(1))
        # one text for each set; its doc_id names the set, unless a doc_id may have several
        sets = (sigs.filter("doc_id is not null and n > 0").groupBy("sig").agg(
            F.min(F.struct("doc_id", "tkey")).alias("of"), F.first("n").alias("n"), F.first("full_own").alias("full_own"),
            F.first("full_below").alias("full_below"))
            .withColumn("most_below", F.expr("cast((n + shiftleft(1L, cast(floor(log2(n + 0.5D)) as int)) - 1) div 9 as int)"))
            .select("sig", F.col("of.doc_id").alias("of_id"), F.col("of.tkey").alias("of_key"), "n", "full_own", "full_below", "most_below"))
        sets = written(dense_ids(sets, "set-numbers")[0] if repeats else sets.withColumn("id", F.col("of_id")), "sets")
        texts = base.join(sets.select("id", "n", "of_id", "of_key"), (F.col("doc_id") == F.col("of_id")) & (F.col("tkey") == F.col("of_key")))
        texts = written(texts.dropDuplicates(["id"]) if repeats else texts, "texts").select("id", "n", "text")
        comp = linked_components(*candidates(texts, sets), texts)
        of_set = written(sets.join(comp, F.col("id") == F.col("node"), "left")
                         .select("sig", F.coalesce("component", "id").alias("c"), "of_id", "of_key"), "set-components")
    first = of_set.groupBy("c").agg(F.min(F.struct("of_id", "of_key")).alias("of")) \
        .select("c", F.col("of.of_id").alias("doc_id"), F.col("of.of_key").alias("tkey"))
    rows = (sigs.join(of_set.select("sig", "c"), "sig", "left")
            .select("doc_id", "tkey", "n", F.when(F.col("doc_id").isNotNull(), F.col("c")).alias("c")))
    return rows, first, repeats


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    rows, first, repeats = linked_sets(docs, id_col, text_col)
    smallest = first.select("c", F.col("doc_id").alias("low"))
    if not repeats:
        return rows.join(smallest, "c", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id"))
    # components that share a doc_id are one: all of a doc_id hang under the smallest of them
    rows = written(rows, "set-rows")
    of_doc = rows.filter("c is not null").groupBy("doc_id").agg(F.min("c").alias("b"))
    edges = rows.filter("c is not null").join(of_doc, "doc_id").filter("c <> b").select(F.col("c").alias("a"), "b").distinct()
    joined = components(edges)
    whole = smallest.join(joined, F.col("c") == F.col("node"), "left").select("c", F.coalesce("component", "c").alias("whole"), "low")
    low = whole.join(whole.groupBy("whole").agg(F.min("low").alias("least")), "whole").select(F.col("c").alias("b"), "least")
    member = of_doc.join(low, "b").select("doc_id", "least")
    return (rows.select("doc_id", F.col("n").alias("n_shingles")).join(member, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each group of linked texts one row, that with the smallest doc_id, with all columns of ``docs``, whatever their names.

    A row is judged by its own text: where a doc_id comes with several, one may go and another stay. Of rows with the same doc_id that link, that with
    the smallest text hash stays; of rows with the same doc_id and text, that with the smallest hash of all columns. Rows without words or without
    a doc_id link with nothing and stay."""
    rows, first, repeats = linked_sets(docs)
    first = first.select("c", F.struct("doc_id", "tkey").alias("first"))
    kept = without(docs, rows.join(first, "c").filter(F.struct("doc_id", "tkey") != F.col("first")).select("doc_id", "tkey"))
    if not repeats:
        return kept
    i, t, row, order = free_names(docs, "twice_id", "twice_key", "twice_row", "twice_hash")
    twice = rows.filter("c is not null").groupBy("doc_id", "tkey").count().filter("count > 1").select(F.col("doc_id").alias(i), F.col("tkey").alias(t))
    same = (F.col("doc_id").cast("bigint") == F.col(i)) & (F.xxhash64("text") == F.col(t))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = (kept.join(twice, same).select(i, t, whole.alias(row), F.xxhash64(F.to_json(whole)).alias(order))
           .groupBy(i, t).agg(F.min_by(row, order).alias(row)).select(f"{row}.*"))
    return kept.join(twice, same, "left_anti").unionByName(one)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every whole document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


#: DuckDB: all pairs that share a shingle, then the closure by the smallest id.
ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w0 FROM documents),
w AS (SELECT doc_id, CASE WHEN w0[1] = '' AND len(w0) = 1 THEN [] ELSE w0 END AS w FROM t),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id
      HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE n.doc_id = a.doc_id) + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))),
r AS (SELECT a AS x, b AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a),
c AS (SELECT x, min(y) AS m FROM r GROUP BY x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(c.m, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.x = w.doc_id
"""
