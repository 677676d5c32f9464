"""Phrase collocation mining with counting quotient filters.

*Counters.* The ids of an n-gram's words are packed into one integer, which a Feistel network permutes within exactly as many
bits: the packed integer can always be had back. Its top bits name the shard, the next ones the quotient, and all the others are kept
as remainder, so a filter is lossless: a bit vector of run lengths (the quotients), full remainders, and counters of one byte
with an overflow list. Entries are sorted by the permuted value, so filters of a shard merge as sorted runs.

*Passes.* Texts become chunks of word codes with a dictionary each; shards of words add the counts up, and give those frequent enough an id that is
unique in the language: the shard, then a running number. Then, for n = 2 to 5, each chunk builds a filter for each shard over its n-grams, the shards merge all chunks' filters, and send every chunk those
of its n-grams that are frequent. An n-gram is counted only where its two (n-1)-grams are frequent, which loses
nothing, as no phrase is more frequent than its parts. A chunk holds about ``CHUNK`` words of one language and a shard about ``SHARD`` counters, whatever the
input; a very frequent n-gram is one counter in each chunk.

*Scores.* Frequent n-grams are rows (ids, count); the parts of each cut are found by joins. Products are decimals of 38 digits.

Results for odd input: a NULL text is empty; a NULL language is ``und``; repeated rows, and rows with repeated or NULL ids, count each; texts without
words add nothing; an empty table gives no rows; of languages with fewer phrases all are returned; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_arrow, mix, table, text_bytes, written

LEAST = 100                     # occurrences of a candidate
LONGEST = 5
TOP = 2000
CHUNK = 1 << 21                 # words in a chunk
SHARD = 1 << 20                 # n-gram occurrences for each shard
BREAK = b"."                    # cannot be a word

_U = np.uint64
_PIECE = re.compile(rb"[.,;:!?\n-\r]+")
_ROUNDS = [_U(0x9E3779B97F4A7C15 * k & (1 << 64) - 1) for k in range(1, 9)]


def tokens(text: bytes | None) -> list[bytes]:
    """Words, with ``BREAK`` between pieces. bytes.lower knows A-Z only; what bytes.split takes for blanks besides
    blank and tab ends pieces and is gone by then."""
    return _PIECE.sub(b" . ", text.lower()).split() if text else []


# ---- packing and permutation ---------------------------------------------------------------------------------------

def limb_words(n: int, bits: int) -> list[int]:
    """How many of ``n`` words of ``bits`` bits go into each 64-bit limb."""
    per = 64 // bits
    return [min(per, n - k) for k in range(0, n, per)]


def pack(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of the rows of ``ids`` (one n-gram a row)."""
    out, at = [], 0
    for k in limb_words(ids.shape[1], bits):
        limb = np.zeros(len(ids), _U)
        for j in range(at, at + k):
            limb = (limb << _U(bits)) | ids[:, j].astype(_U)
        out.append(limb)
        at += k
    return out


def unpack(limbs: list[np.ndarray], n: int, bits: int) -> np.ndarray:
    out, at = np.zeros((len(limbs[0]), n), np.int64), 0
    for limb, k in zip(limbs, limb_words(n, bits)):
        for j in range(k):
            out[:, at + j] = (limb >> _U(bits * (k - 1 - j)) & _U((1 << bits) - 1)).astype(np.int64)
        at += k
    return out


def _mask(width: int) -> np.uint64:
    return _U((1 << width) - 1)


def permute(limbs: list[np.ndarray], widths: list[int], back: bool = False) -> list[np.ndarray]:
    """Feistel network over the limbs, a single one being cut in two; ``back`` undoes it."""
    if len(widths) == 1:
        low = widths[0] // 2
        parts, sizes = [limbs[0] >> _U(low), limbs[0] & _mask(low)], [widths[0] - low, low]
    else:
        parts, sizes = list(limbs), widths
    m = len(parts)
    steps = [(r, j) for r in range(4) for j in range(m)]
    for r, j in reversed(steps) if back else steps:
        parts[j] = parts[j] ^ (mix(parts[(j + 1) % m] + _ROUNDS[r + 4 * (j % 2)]) & _mask(sizes[j]))
    return [(parts[0] << _U(low)) | parts[1]] if len(widths) == 1 else parts


def ordered(limbs: list[np.ndarray]) -> np.ndarray:
    return np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])


def summed(limbs: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys and the sums of their counts (1 each without ``counts``)."""
    if not len(limbs[0]):
        return limbs, np.zeros(0, np.int64)
    if len(limbs) == 1 and counts is None:
        limbs = [np.sort(limbs[0])]
    else:
        order = ordered(limbs)
        limbs = [x[order] for x in limbs]
        counts = None if counts is None else counts[order]
    new = np.concatenate([[True], limbs[0][1:] != limbs[0][:-1]])
    for x in limbs[1:]:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    total = np.diff(np.append(first, len(new))) if counts is None else np.add.reduceat(counts, first)
    return [x[first] for x in limbs], total


# ---- the filter ----------------------------------------------------------------------------------------------------

class Layout:
    """How n-grams of one length and vocabulary are laid out in filters of ``2**shard_bits`` shards."""

    def __init__(self, n: int, bits: int, shard_bits: int):
        self.n, self.bits = n, bits
        self.widths = [k * bits for k in limb_words(n, bits)]
        self.shard_bits = min(shard_bits, self.widths[0] - 1)

    def shards(self, limbs: list[np.ndarray]) -> np.ndarray:
        return (limbs[0] >> _U(self.widths[0] - self.shard_bits)).astype(np.int64)

    def encode(self, limbs: list[np.ndarray], counts: np.ndarray) -> bytes:
        """The filter of one shard's sorted keys: about one entry for each quotient."""
        m, free = len(counts), self.widths[0] - self.shard_bits
        q = min(m.bit_length(), free)
        rest = free - q
        quotient = (limbs[0] >> _U(rest) & _mask(q)).astype(np.int64)
        runs = np.zeros(m + (1 << q), np.uint8)
        runs[quotient + np.arange(m)] = 1
        remainders = [_bytes(limbs[0] & _mask(rest), rest)] + [_bytes(x, w) for x, w in zip(limbs[1:], self.widths[1:])]
        large = counts >= 255
        return b"".join([struct.pack("<qqqI", m, int(large.sum()), int(self.shards(limbs)[0]) if m else 0, q), np.packbits(runs).tobytes(),
                         *remainders, np.where(large, 255, counts).astype(np.uint8).tobytes(),
                         counts[large].astype("<i8").tobytes()])

    def decode(self, blob: bytes) -> tuple[list[np.ndarray], np.ndarray]:
        m, large, shard, q = struct.unpack_from("<qqqI", blob)
        at, free = 28, self.widths[0] - self.shard_bits
        rest, size = free - q, -(-(m + (1 << q)) // 8)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, size, at)))
        at += size
        limbs = []
        for w in [rest, *self.widths[1:]]:
            step = -(-w // 8)
            limbs.append(_unbytes(np.frombuffer(blob, np.uint8, m * step, at), step))
            at += m * step
        limbs[0] = _U(shard << free) | ((ones - np.arange(m)).astype(_U) << _U(rest)) | limbs[0]
        counts = np.frombuffer(blob, np.uint8, m, at).astype(np.int64)
        counts[counts == 255] = np.frombuffer(blob, "<i8", large, at + m)
        return limbs, counts

    def split(self, limbs: list[np.ndarray], counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """A filter for each shard that sorted keys fall into."""
        of = self.shards(limbs)
        edges = np.append(np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])), len(of)) if len(of) else []
        for x, y in zip(edges[:-1], edges[1:]):
            yield int(of[x]), self.encode([v[x:y] for v in limbs], counts[x:y])

    def merge(self, blobs: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        parts = [self.decode(b) for b in blobs]
        return summed([np.concatenate([p[0][j] for p in parts]) for j in range(len(self.widths))],
                      np.concatenate([p[1] for p in parts]))

    def keys(self, ids: np.ndarray) -> list[np.ndarray]:
        return permute(pack(ids, self.bits), self.widths)

    def words(self, limbs: list[np.ndarray]) -> np.ndarray:
        return unpack(permute(limbs, self.widths, back=True), self.n, self.bits)


def _bytes(x: np.ndarray, width: int) -> bytes:
    step = -(-width // 8)
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :step].tobytes()


def _unbytes(raw: np.ndarray, step: int) -> np.ndarray:
    m = len(raw) // step if step else 0
    if not step:
        return _U(0)
    out = np.zeros((m, 8), np.uint8)
    out[:, :step] = raw.reshape(m, step)
    return out.view("<u8").ravel()


def within(some: list[np.ndarray], among: list[np.ndarray]) -> np.ndarray:
    """Which of the keys ``some`` are among the sorted distinct keys ``among``."""
    if not len(among[0]) or not len(some[0]):
        return np.zeros(len(some[0]), bool)
    if len(some) == 1:
        at = np.minimum(np.searchsorted(among[0], some[0]), len(among[0]) - 1)
        return among[0][at] == some[0]
    kind = np.dtype([(f"l{j}", ">u8") for j in range(len(some))])
    rows = [np.ascontiguousarray(np.stack(x, 1).astype(">u8")).view(f"V{kind.itemsize}").ravel() for x in (some, among)]
    both, of = np.unique(np.concatenate(rows), return_inverse=True)
    held = np.zeros(len(both), bool)
    held[of[len(rows[0]):]] = True
    return held[of[:len(rows[0])]]


# ---- chunks --------------------------------------------------------------------------------------------------------

class _Codes(dict):
    """Codes in order of appearance; 0 is the break."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def chunks(docs: DataFrame) -> DataFrame:
    """(chunk, lang, words, counts, codes) of ``docs``(lang, text): word codes of some documents of a language, with their dictionary.

    A task's open chunks are sent when they hold ``CHUNK`` words together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        open_chunks: dict[str, tuple[_Codes, list[np.ndarray]]] = {}
        size = made = 0

        def sent() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for lang, (codes, parts) in open_chunks.items():
                flat = np.concatenate(parts)
                counts = np.bincount(flat, minlength=len(codes))
                yield pa.record_batch([pa.array([task + made]), pa.array([lang]), pa.array([[w for w in codes][1:]], pa.list_(pa.binary())),
                                       pa.array([counts[1:]], pa.list_(pa.int64())), pa.array([flat.tobytes()], pa.binary())],
                                      names=["chunk", "lang", "words", "counts", "codes"])
                made += 1
            open_chunks.clear()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                words = tokens(text)
                if not words:
                    continue
                codes, parts = open_chunks.setdefault(lang, (_Codes({BREAK: 0}), []))
                words.append(BREAK)
                parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= CHUNK:
                    yield from sent()
                    size = 0
        yield from sent()
    return docs.mapInArrow(run, "chunk bigint, lang string, words array<binary>, counts array<bigint>, codes binary")


WORDS = "chunk bigint, lang string, bits int, shard bigint, words array<binary>, codes binary, numbers binary"


def _words_table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * 7
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=["chunk", "lang", "bits", "shard", "words", "codes", "numbers"])


def word_shards(parts: DataFrame) -> DataFrame:
    """Each chunk's dictionary, dealt to its language's shards by a hash: words, their codes in the chunk, their counts."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for chunk, lang, bits, words, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "lang", "bits", "words", "counts"))):
            of = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) >> (32 - bits)
            order = np.argsort(of, kind="stable")
            counts = np.array(counts, np.int64)
            for own in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                rows.append((chunk, lang, bits, int(of[own[0]]), [words[i] for i in own.tolist()], (own + 1).astype("<i4").tobytes(), counts[own].tobytes()))
        return _words_table(rows).combine_chunks().to_batches()[0] if rows else None
    return map_arrow(parts, run, WORDS)


def frequent_words(shards: DataFrame, least: int) -> DataFrame:
    """Of each shard the words with ``least`` occurrences or more: all with their counts (chunk -1), and for each chunk the codes and the running
    numbers of those that it holds."""
    def run(t: pa.Table) -> pa.Table:
        total: dict[bytes, int] = defaultdict(int)
        held = list(zip(*(t.column(c).to_pylist() for c in ("chunk", "words", "codes", "numbers"))))
        lang, bits, shard = (t.column(c)[0].as_py() for c in ("lang", "bits", "shard"))
        for _, words, _, counts in held:
            for w, c in zip(words, np.frombuffer(counts, np.int64).tolist()):
                total[w] += c
        number = {w: k for k, w in enumerate((w for w, c in total.items() if c >= least), 1)}
        if not number:
            return _words_table([])
        rows = [(-1, lang, bits, shard, list(number), None, np.array([total[w] for w in number], np.int64).tobytes())]
        for chunk, words, codes, _ in held:
            own = np.fromiter((number.get(w, 0) for w in words), np.int64, len(words))
            has = own > 0
            if has.any():
                rows.append((chunk, lang, bits, shard, None, np.frombuffer(codes, "<i4")[has].tobytes(), own[has].tobytes()))
        return _words_table(rows)
    return shards.groupBy("lang", "shard").applyInArrow(run, WORDS)


def spelling(frequent: DataFrame, low_bits: int) -> DataFrame:
    """(lang, id, word, c) of all frequent words."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, ids, words, counts = [], [], [], []
        for lang, shard, own, c in zip(*(batch.column(x).to_pylist() for x in ("lang", "shard", "words", "numbers"))):
            langs += [lang] * len(own)
            words += own
            ids.append((shard << low_bits) + np.arange(1, len(own) + 1))
            counts.append(np.frombuffer(c, np.int64))
        return pa.record_batch([pa.array(langs, pa.string()), pa.array(np.concatenate(ids)), pa.array(words, pa.binary()),
                                pa.array(np.concatenate(counts))], names=["lang", "id", "word", "c"])
    return map_arrow(frequent.filter("chunk = -1").select("lang", "shard", "words", "numbers"), run, "lang string, id bigint, word binary, c bigint")


def windows(ids: np.ndarray, n: int) -> np.ndarray:
    """Where n words follow each other without a break."""
    ok = ids > 0
    m = max(0, len(ids) - n + 1)
    out = np.ones(m, bool)
    for k in range(n):
        out &= ok[k:k + m]
    return np.flatnonzero(out)


def grams(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.stack([ids[at + k] for k in range(n)], 1) if len(at) else np.zeros((0, n), ids.dtype)


def kept(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The words of the n-grams at ``at``, each gap being one break."""
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n, -1)
    inside = np.cumsum(cover[:-1]) > 0
    out = np.where(inside, ids, 0)
    return out[inside | np.concatenate([[False], inside[:-1]])]


COUNTED = "chunk bigint, lang string, bits int, shard bigint, body binary"      # shard -1: the chunk's words


def _counted(chunk: int, lang: str, bits: int, ids: np.ndarray, at: np.ndarray, layout: Layout) -> pa.Table:
    limbs, counts = summed(layout.keys(grams(ids, at, layout.n)))
    rows = [(-1, kept(ids, at, layout.n).astype("<u4").tobytes())] if len(at) else []
    rows += list(layout.split(limbs, counts))
    k = len(rows)
    return pa.table([pa.array([chunk] * k, pa.int64()), pa.array([lang] * k, pa.string()), pa.array([bits] * k, pa.int32()),
                     pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                    names=["chunk", "lang", "bits", "shard", "body"])


def first_filters(parts: DataFrame, known: DataFrame, id_bits: int, low_bits: int) -> DataFrame:
    """Filters of the 2-grams of frequent words: ``parts``(chunk, lang, bits, codes) with ``known``(chunk, shard, codes, numbers)."""
    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        bodies = a.column("codes").to_pylist()
        if not bodies or not b.num_rows:
            return _nothing(COUNTED)
        codes = np.frombuffer(bodies[0], np.int32)
        ids = np.zeros(int(codes.max()) + 1, np.int64)
        for shard, own, numbers in zip(*(b.column(c).to_pylist() for c in ("shard", "codes", "numbers"))):
            ids[np.frombuffer(own, "<i4")] = (shard << low_bits) + np.frombuffer(numbers, np.int64)
        seq, bits = ids[codes], a.column("bits")[0].as_py()
        return _counted(a.column("chunk")[0].as_py(), a.column("lang")[0].as_py(), bits, seq, windows(seq, 2), Layout(2, id_bits, bits))
    return parts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, COUNTED)


def _nothing(schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.table([pa.array([], kinds[k]) for _, k in fields], names=[c for c, _ in fields])


def merged(filters: DataFrame, n: int, id_bits: int, least: int) -> DataFrame:
    """Of each shard the n-grams with ``least`` occurrences or more: one filter with chunk -1, and for each chunk those that it holds."""
    def run(t: pa.Table) -> pa.Table:
        lang, bits, shard = (t.column(c)[0].as_py() for c in ("lang", "bits", "shard"))
        layout = Layout(n, id_bits, bits)
        blobs, owners = t.column("body").to_pylist(), t.column("chunk").to_pylist()
        limbs, counts = layout.merge(blobs)
        often = counts >= least
        limbs, counts = [x[often] for x in limbs], counts[often]
        rows = []
        if len(counts):
            rows.append((-1, layout.encode(limbs, counts)))
            for owner, blob in zip(owners, blobs):
                own, own_counts = layout.decode(blob)
                has = within(own, limbs)
                if has.any():
                    rows.append((owner, layout.encode([x[has] for x in own], own_counts[has])))
        k = len(rows)
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([lang] * k, pa.string()), pa.array([bits] * k, pa.int32()),
                         pa.array([shard] * k, pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                        names=["chunk", "lang", "bits", "shard", "body"])
    return filters.groupBy("lang", "shard").applyInArrow(run, COUNTED)


def next_filters(seqs: DataFrame, frequent: DataFrame, n: int, id_bits: int) -> DataFrame:
    """Filters of the (n+1)-grams whose two n-grams are frequent."""
    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        bodies, blobs = a.column("body").to_pylist(), b.column("body").to_pylist()
        if not bodies or not blobs:
            return _nothing(COUNTED)
        bits = a.column("bits")[0].as_py()
        ids = np.frombuffer(bodies[0], "<u4").astype(np.int64)
        layout = Layout(n, id_bits, bits)
        at = windows(ids, n)
        good = np.zeros(len(ids) + 1, bool)
        good[at[within(layout.keys(grams(ids, at, n)), layout.merge(blobs)[0])]] = True
        both = np.flatnonzero(good[:-1] & good[1:])
        return _counted(a.column("chunk")[0].as_py(), a.column("lang")[0].as_py(), bits, ids, both, Layout(n + 1, id_bits, bits))
    return seqs.groupBy("chunk").cogroup(frequent.groupBy("chunk")).applyInArrow(run, COUNTED)


def listed(frequent: DataFrame, n: int, id_bits: int) -> DataFrame:
    """(lang, g: the words' ids, 4 bytes each, a: count) of the shards' filters."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, keys, counts = [], [], []
        for lang, bits, blob in zip(*(batch.column(c).to_pylist() for c in ("lang", "bits", "body"))):
            layout = Layout(n, id_bits, bits)
            limbs, a = layout.decode(blob)
            raw = layout.words(limbs).astype(">u4").tobytes()
            keys += [raw[i:i + 4 * n] for i in range(0, len(raw), 4 * n)]
            counts.append(a)
            langs += [lang] * len(a)
        return pa.record_batch([pa.array(langs, pa.string()), pa.array(keys, pa.binary()), pa.array(np.concatenate(counts))],
                               names=["lang", "g", "a"])
    return map_arrow(frequent.filter("chunk = -1").select("lang", "bits", "body"), run, "lang string, g binary, a bigint")


# ---- the operator --------------------------------------------------------------------------------------------------

def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(lang, g, a) of all phrases of 1 to ``longest`` words with ``least`` occurrences; (lang, id, word) of their words;
    (lang, n) of all words. None if no word is frequent."""
    base = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    made = written(chunks(base), "chunks")
    totals = written(made.select("lang", F.aggregate("counts", F.lit(0).cast("bigint"), lambda x, y: x + y).alias("n"))
                     .groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    bits = totals.select("lang", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / SHARD))).cast("int").alias("bits"))
    dealt = written(word_shards(made.join(bits, "lang").select("chunk", "lang", "bits", "words", "counts")), "word-shards")
    known = written(frequent_words(dealt, least), "frequent-words")
    most, top_bits = known.filter("chunk = -1").agg(F.max(F.size("words")), F.max("bits")).first()
    if most is None:
        return None
    low_bits = int(most).bit_length()
    id_bits = low_bits + top_bits
    if id_bits > 32:
        raise ValueError(f"word ids of {id_bits} bits: phrases are written with 4 bytes a word")
    vocabulary = written(spelling(known, low_bits), "vocabulary")
    found = [vocabulary.select("lang", F.unhex(F.lpad(F.hex("id"), 8, "0")).alias("g"), F.col("c").alias("a"))]
    filters = written(first_filters(made.join(bits, "lang").select("chunk", "lang", "bits", "codes"), known.filter("chunk >= 0")
                                    .select(F.col("chunk").alias("chunk"), "shard", "codes", "numbers"), id_bits, low_bits), "filters")
    for n in range(2, longest + 1):
        frequent = written(merged(filters.filter("shard >= 0"), n, id_bits, least), "frequent")
        found.append(listed(frequent, n, id_bits))
        if n < longest:
            filters = written(next_filters(filters.filter("shard = -1").select("chunk", "lang", "bits", "body"),
                                           frequent.filter("chunk >= 0").select(F.col("chunk").alias("chunk"), "body"), n, id_bits), "filters")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return written(out, "phrases"), vocabulary, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the ``top`` phrases by score."""
    got = phrase_counts(docs, least, longest, lang_col, text_col)
    if got is None:
        return docs.sparkSession.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    counts, vocabulary, totals = got
    size = F.expr("cast(octet_length(g) div 4 as int)")
    phrases = counts.withColumn("m", size).filter("m > 1")
    # a phrase goes if one that is a word longer occurs as often; longer ones still then do, too, or not at all
    around = phrases.filter("m > 2").select("lang", F.explode(F.array(F.expr("substring(g, 1, 4 * m - 4)"), F.expr("substring(g, 5, 4 * m - 4)"))).alias("g"), "a") \
        .groupBy("lang", "g").agg(F.max("a").alias("longer"))
    stay = phrases.join(around, ["lang", "g"], "left").filter("longer is null or 100 * longer < 100 * a").select("lang", "g", "a", "m")
    cuts = stay.select("lang", "g", "a", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")) \
        .select("lang", "g", "a", "k", F.expr("substring(g, 1, 4 * k)").alias("gl"), F.expr("substring(g, 4 * k + 1)").alias("gr"))
    wide = "decimal(38,0)"
    scored = (cuts.join(counts.select("lang", F.col("g").alias("gl"), F.col("a").alias("l")), ["lang", "gl"])
              .join(counts.select("lang", F.col("g").alias("gr"), F.col("a").alias("r")), ["lang", "gr"])
              .join(totals, "lang")
              .withColumn("score", F.expr(f"cast(1000 as {wide}) * a * n div (cast(l as {wide}) * r)"))
              .groupBy("lang", "g", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
              .select("lang", "g", "a", "n", "low.score", "low.l", "low.r"))
    scored = written(scored, "scored")
    # only phrases from the score bands that the first ``top`` can lie in are spelt and ranked
    band = F.floor(F.log2(F.col("score") + 1.0) * 64).cast("int")
    bands = scored.groupBy("lang", band.alias("band")).count()
    above = Window.partitionBy("lang").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    wanted = (bands.withColumn("before", F.coalesce(F.sum("count").over(above), F.lit(0))).filter(F.col("before") < top)
              .groupBy("lang").agg(F.min("band").alias("least_band")))
    first = scored.join(wanted, "lang").filter(band >= F.col("least_band")).drop("least_band")
    spelt = (first.select("lang", "g", F.posexplode(F.expr("transform(sequence(1, cast(octet_length(g) div 4 as int)), i -> substring(g, 4 * i - 3, 4))")).alias("pos", "w"))
             .withColumn("id", F.conv(F.hex("w"), 16, 10).cast("bigint")).join(vocabulary.select("lang", "id", "word"), ["lang", "id"])
             .groupBy("lang", "g").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("word").cast("string").alias("word")))).alias("ws"))
             .select("lang", "g", F.array_join(F.transform("ws", lambda x: x["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (first.join(spelt, ["lang", "g"]).withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of each language of the documents."""
    return collocations(table(spark, sf_dir, "documents"))


#: DuckDB: all phrases of a piece, cuts by joins.
ORACLE = f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
g AS MATERIALIZED (SELECT lang, array_to_string(g, ' ') AS g, len(g) AS m, count(*) AS a FROM (
      SELECT lang, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS g
      FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS m) WHERE len(w) >= m)
      GROUP BY lang, g HAVING count(*) >= {LEAST}),
c AS (SELECT lang, g, m, a, string_split(g, ' ') AS s FROM g WHERE m > 1),
l AS (SELECT lang, unnest([array_to_string(s[1:m - 1], ' '), array_to_string(s[2:m], ' ')]) AS g, a FROM c WHERE m > 2),
k AS (SELECT c.lang, c.g, c.m, c.a, c.s FROM c LEFT JOIN (SELECT lang, g, max(a) AS b FROM l GROUP BY lang, g) x ON c.lang = x.lang AND c.g = x.g
      WHERE b IS NULL OR 100 * b < 100 * a),
u AS (SELECT k.*, unnest(range(1, m)) AS cut FROM k),
z AS (SELECT u.lang, u.g, u.a, u.cut, x.a AS l, y.a AS r, n.n, (CAST(1000 AS HUGEINT) * u.a * n.n) // (CAST(x.a AS HUGEINT) * y.a) AS score
      FROM u JOIN g x ON x.lang = u.lang AND x.g = array_to_string(u.s[1:u.cut], ' ')
      JOIN g y ON y.lang = u.lang AND y.g = array_to_string(u.s[u.cut + 1:u.m], ' ') JOIN n ON n.lang = u.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS nth FROM z),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM b WHERE nth = 1)
SELECT lang, rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM r WHERE rank <= {TOP}
"""
