"""Byte-level BPE encoding and decoding in time linear in the text.

Each match of the split pattern is encoded by itself. Its bytes become Latin-1 characters, so one
Aho-Corasick pass over them (pyahocorasick) gives, for every position, the tokens that
start there. The encoder takes the longest, and steps back to the next shorter one, or to the
token before, whenever two neighbours are not *compatible*: two adjacent tokens are, if merging
their bytes in rank order leaves the border between them alone. That test is memoised per pair.
A sequence whose neighbours are all compatible is the very one that the merges produce.

Results for odd input: NULL text counts as empty (no ids, empty decoded text); rows with equal or
NULL ids are encoded row by row; other columns are not read.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from .common import map_arrow, table

PIECES_KEPT = 1_200_000        # memoised pieces and pairs per worker; then the memo starts anew
PAIRS_KEPT = 1_000_000
SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}


def merge_by_rank(ranks: dict[bytes, int], piece: bytes, below: int | None = None) -> list[bytes]:
    """The merges as defined: again and again join the adjacent pair of lowest rank."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min((r, i) for i in range(len(parts) - 1)
                   if (r := ranks.get(parts[i] + parts[i + 1], 1 << 60)) is not None)
        if best[0] == 1 << 60 or (below is not None and best[0] >= below):
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def token_splits(ranks: dict[bytes, int]) -> dict[int, tuple[int, int]]:
    """For each token of two bytes or more, the two tokens that its last merge joins. Tokens
    that no merges reach are left out: only a whole piece can be such a token."""
    out = {}
    for tok, rank in ranks.items():
        if len(tok) > 1:
            parts = merge_by_rank(ranks, tok, below=rank)
            if len(parts) == 2:
                out[rank] = (ranks[parts[0]], ranks[parts[1]])
    return out


# the split pattern's classes for texts without characters beyond U+00FF
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"


class Encoder:
    def __init__(self, ranks: dict[bytes, int], splits: dict[int, tuple[int, int]], pattern: str):
        self.ranks, self.splits = ranks, splits
        self.joined = {pair: tok for tok, pair in splits.items()}
        n = max(ranks.values(), default=-1) + 1
        self.size = np.zeros(n, np.int64)
        by_rank = [b""] * n
        self.trie = ahocorasick.Automaton()
        for tok, rank in ranks.items():
            by_rank[rank] = tok
            self.size[rank] = len(tok)
            if rank in splits:
                self.trie.add_word(tok.decode("latin-1"), rank)
        self.trie.make_automaton()
        # the next shorter token that starts a token, -1 if none
        self.shorter = [-1] * n
        for tok, rank in ranks.items():
            for cut in range(len(tok) - 1, 0, -1):
                known = ranks.get(tok[:cut])
                if known is not None and (cut == 1 or known in splits):
                    self.shorter[rank] = known
                    break
        self.sizes = self.size.tolist()
        self.single = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.flat = np.frombuffer(b"".join(by_rank), np.uint8)
        self.begin = np.cumsum(self.size) - self.size
        self.find_any = regex.compile(pattern).findall
        # one-byte characters only: the same pattern with its classes spelt out, for the faster re
        self.find_latin = self.find_any
        if pattern == public_tokenizers.PATTERN:
            short = (pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACE}{_LETTER}{_NUMBER}]")
                     .replace(r"\p{L}", f"[{_LETTER}]").replace(r"\p{N}", f"[{_NUMBER}]")
                     .replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]"))
            self.find_latin = re.compile(short).findall
        self.pieces: dict[str, bytes] = {}
        self.fits: dict[int, int] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Would the merges leave the border between these two tokens alone? Undo the later of
        the two tokens' own last merges step by step; a merge across the border that comes before
        the merge just undone would have happened first."""
        limit, a, b = 1 << 60, left, right
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < limit:
                return False
            part_a, part_b = self.splits.get(a), self.splits.get(b)
            if part_a is None and part_b is None:
                return True
            if part_b is None or (part_a is not None and a > b):
                limit, a = a, part_a[1]
            else:                       # equal ranks merge from the left: the right one is later
                limit, b = b + 1, part_b[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        sizes, shorter, fits = self.sizes, self.shorter, self.fits
        longest = [self.single[b] for b in piece]
        for end, tok in self.trie.iter(piece.decode("latin-1")):
            longest[end + 1 - sizes[tok]] = tok             # later ends are longer tokens
        if len(fits) >= PAIRS_KEPT:
            fits.clear()
        dead = bytearray(n + 1)                             # no compatible way on from here
        out: list[int] = []
        pos, last, tok = 0, -1, longest[0]
        while True:
            if last >= 0 and tok >= 0:                      # the longest that fits the one before
                pair = last << 32 | tok
                tok = fits.get(pair)
                if tok is None:
                    tok = fits[pair] = self.first_fit(last, pair & 0xFFFFFFFF)
            if tok < 0:                                     # step back: a shorter token before
                dead[pos] = 1
                tok = out.pop()
                pos -= sizes[tok]
                last = out[-1] if out else -1
                tok = shorter[tok]
                continue
            end = pos + sizes[tok]
            if dead[end]:
                tok = shorter[tok]
                continue
            out.append(tok)
            if end == n:
                return out
            pos, last, tok = end, tok, longest[end]

    def first_fit(self, left: int, tok: int) -> int:
        """The longest of ``tok`` and its prefixes that may follow ``left``; -1 if none."""
        while tok >= 0 and not self.compatible(left, tok):
            tok = self.shorter[tok]
        return tok

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        try:
            text.encode("latin-1")
            found = self.find_latin(text)
        except UnicodeEncodeError:
            found = self.find_any(text)
        pieces = self.pieces
        out = list(map(pieces.get, found))
        if None in out:
            if len(pieces) >= PIECES_KEPT:
                pieces.clear()
            for i, ids in enumerate(out):
                if ids is None:
                    p = found[i]
                    ids = pieces.get(p)
                    if ids is None:
                        ids = array("I", self.encode_piece(p.encode("utf-8", "surrogatepass"))).tobytes()
                        if len(p) < 64:
                            pieces[p] = ids
                    out[i] = ids
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        toks = np.frombuffer(ids, "<u4")
        size = self.size[toks]
        shift = self.begin[toks] - (np.cumsum(size) - size)
        return self.flat[np.repeat(shift, size) + np.arange(size.sum())].tobytes()


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[dict[bytes, int], dict[int, tuple[int, int]]]:
    ranks = read_ranks(path)
    return ranks, token_splits(ranks)


_ENCODERS: dict[tuple[str, str], Encoder] = {}      # one per Python worker and vocabulary


def encode(docs: DataFrame, vocabulary: str, pattern: str = public_tokenizers.PATTERN,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids: little-endian uint32, decoded: bytes) of every row.

    The vocabulary file is read on the driver and broadcast; its size is that of a rank file
    (50,256 tokens here) and does not depend on the data.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(_vocabulary(vocabulary))
    key = (vocabulary, pattern)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = _ENCODERS.get(key)
        if enc is None:
            enc = _ENCODERS[key] = Encoder(*shared.value, pattern)
        ids = [enc.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
        return pa.record_batch([
            batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array(ids, pa.binary()), pa.array([enc.decode(x) for x in ids], pa.binary()),
        ], names=["doc_id", "n_tokens", "ids", "decoded"])

    return map_arrow(docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")), run, SCHEMA)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every whole document."""
    out = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
