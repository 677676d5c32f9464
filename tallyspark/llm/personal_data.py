"""Personal data by a skip-chain conditional random field.

*Base spans* come from fixed patterns with checks (octets, Luhn, digit counts). They are evidence of the field, never its result: a
token inside one is clamped to its kind.

*Graph.* Nodes are the tokens that hold a digit or an ``@``, and mentions of an e-mail's local part; all other words are observed as
ordinary. Neighbouring tokens share a chain potential. Tokens of a document that are equal or similar (letter case, other marks between the
same digits, the same last seven digits, an address and its local part) share a skip potential, each with the next of its kind,
however far. So the evidence of one mention reaches all others.

*Potentials.* Node weights are a logistic regression on shapes, numbers and the word before; pair potentials are the logarithms of how much more
often two labels meet than by chance (piecewise training). Both are learnt from the base spans of a bounded sample of documents.

*Inference.* Loopy sum-product messages over all documents of a batch at once. Where a label's marginal reaches ``SURE`` outside base spans, the tokens
become further spans of that kind. Work is linear in the text; each token has at most one skip edge forwards for each of its keys.

Results for odd input: a NULL text is empty and has no spans; each row gives a row, repeated and NULL ids included; an empty table gives
none; without any token to learn from only base spans are found; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table

# fixed values: kinds in the order that breaks ties
KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)         # 0: ordinary
SAMPLE_DOCS = 4000              # about as many documents are learnt from
SAMPLE_ROWS = 20_000            # distinct labelled feature rows
SLOTS = 1 << 12
STEPS = 80
ROUNDS = 8
SURE = 0.9
AGREE = 0.98                    # of linked tokens, before any are seen
CLAMP = 40.0

# possessive where a class cannot give back anything useful: linear on any text
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NODE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_EDGE = "()[]{}<>\"'.,;:!?"
_RUN = re.compile(r"[a-zA-Z]+|[0-9]+|[^a-zA-Z0-9]")
_WORD_BEFORE = re.compile(r"(\S+)\s*$")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]     # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octets(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def emails(text: str) -> list[tuple[int, int]]:
    """From each @ outwards, so that a long word is read once."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(m[0].count, "0123456789")) <= 15]
    return sorted(out)


# ---- the graph of a document ---------------------------------------------------------------------------------------

@dataclass
class Graph:
    spans: list[tuple[int, int]]            # of the nodes
    labels: list[int]                       # of the base span that a node lies in, else 0
    features: list[list[int]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _EDGE:
        start += 1
    while end > start and text[end - 1] in _EDGE:
        end -= 1
    return start, end


def _slot(name: str) -> int:
    h = 2166136261                                           # FNV-1a: the same in every process
    for b in name.encode("utf-8", "surrogatepass"):
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) % SLOTS


def shape(token: str) -> str:
    """Runs of letters and digits with their rough lengths, other characters as they are."""
    parts = []
    for m in _RUN.finditer(token[:64]):
        c, n = m[0][0], len(m[0])
        parts.append(f"d{min(n, 6)}" if c in "0123456789" else "a" if c.isascii() and c.isalpha() else c if c.isascii() else "u")
    return "".join(parts)[:32]


def _locals(text: str, base: list[Span]) -> set[str]:
    """Local parts that are more than a common word."""
    names = {text[s:e].split("@", 1)[0] for s, kind, e in base if kind == 0}
    return {x for x in (n.strip("._%+-") for n in names) if len(x) >= 5 and any(c in "._%+-0123456789" for c in x)}


def keys_of(token: str) -> list[str]:
    """What similar tokens have in common."""
    low = token.lower()
    if "@" in low:
        return [low] + ([local] if len(local := low.split("@", 1)[0].strip("._%+-")) >= 5 else [])
    digits = _NOT_DIGIT.sub("", low)
    if len(digits) < 4:
        return [low] if len(low) >= 5 else []
    return list(dict.fromkeys([low, f"d{digits}"] + ([f"s{digits[-7:]}"] if len(digits) >= 7 else [])))


def graph_of(text: str, base: list[Span]) -> Graph | None:
    found = [_trimmed(text, m.start(), m.end()) for m in _NODE.finditer(text)]
    if names := _locals(text, base):
        bare = re.compile(r"(?<![\w@.%+-])(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?![\w@%+-])", re.I)
        found += [m.span() for m in bare.finditer(text)]
    found = sorted({x for x in found if x[0] < x[1]})
    spans: list[tuple[int, int]] = []
    for x in found:                                          # a name inside a token is that token
        if not spans or x[0] >= spans[-1][1]:
            spans.append(x)
    if not spans:
        return None
    labels, b = [], 0
    for s, e in spans:
        while b < len(base) and base[b][2] <= s:
            b += 1
        labels.append(next((base[k][1] + 1 for k in range(b, min(b + 4, len(base))) if base[k][0] < e and base[k][2] > s), 0))
    chain = [(i, i + 1) for i in range(len(spans) - 1) if len(gap := text[spans[i][1]:spans[i + 1][0]]) <= 4 and not any(map(str.isalnum, gap))]
    last: dict[str, int] = {}
    skip = set()
    for i, (s, e) in enumerate(spans):
        for key in keys_of(text[s:e]):
            if key in last:
                skip.add((last[key], i))
            last[key] = i
    return Graph(spans, labels, _features(text, spans, chain), chain, sorted(skip.difference(chain)))


def _features(text: str, spans: list[tuple[int, int]], chain: list[tuple[int, int]]) -> list[list[int]]:
    follows = {b for _, b in chain}
    out, i = [], 0
    while i < len(spans):                                    # a run of neighbouring tokens is looked at together
        j = i + 1
        while j < len(spans) and j in follows:
            j += 1
        digits = _NOT_DIGIT.sub("", "".join(text[s:e] for s, e in spans[i:j]))
        if not digits and "@" not in text[spans[i][0]:spans[i][1]]:
            out += [[_slot("bias")]] * (j - i)               # a name: what it is, its links tell
            i = j
            continue
        signed = spans[i][0] > 0 and "+" in text[max(0, spans[i][0] - 2):spans[i][0] + 1]
        run = f"run {min(len(digits), 20)} {signed} {12 <= len(digits) <= 19 and luhn(digits)}"
        m = _WORD_BEFORE.search(text, max(0, spans[i][0] - 40), spans[i][0])
        before = m[1].strip(_EDGE).lower() if m else ""
        for k in range(i, j):
            token = text[spans[k][0]:spans[k][1]]
            own = _NOT_DIGIT.sub("", token)
            out.append(sorted({_slot(f) for f in (
                "bias", "shape " + shape(token), run, f"place {k > i} {min(len(own), 20)}", "before " + before,
                f"ip {_octets(token)}", f"at {'@' in token} {bool(_DOMAIN.fullmatch(token.rpartition('@')[2]))}",
                f"own {min(len(own), 20)} {12 <= len(own) <= 19 and luhn(own)} {token.startswith('+') or signed}")}))
        i = j
    return out


# ---- learning ------------------------------------------------------------------------------------------------------

@dataclass
class Model:
    weights: np.ndarray                     # slot x label
    chain: np.ndarray                       # label x label
    skip: np.ndarray


def fit_nodes(rows: list[list[int]], labels: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Multinomial logistic regression with a quadratic penalty, by accelerated gradient steps."""
    w = np.zeros((SLOTS, LABELS))
    if not len(rows):
        return w
    slot = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    goal = np.eye(LABELS)[labels]
    share = times / times.sum()
    ahead, step = w.copy(), 2.0 / max(len(r) for r in rows)
    for k in range(STEPS):
        z = np.stack([np.bincount(row, ahead[slot, y], len(rows)) for y in range(LABELS)], 1)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        miss = (p - goal) * share[:, None]
        grad = np.stack([np.bincount(slot, miss[row, y], SLOTS) for y in range(LABELS)], 1) + 1e-5 * ahead
        new = ahead - 2 * step * grad
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


def association(counts: np.ndarray, share: np.ndarray, prior: float, agree: float) -> np.ndarray:
    """log P(y, y') / P(y) P(y') of linked labels, whose own frequencies are ``share``. ``prior`` pairs are put in beforehand, of which the part
    ``agree`` has equal labels and the others meet by chance."""
    chance = np.outer(share, share)
    p = (counts + counts.T) / 2 + prior * ((1 - agree) * chance + agree * np.diag(share))
    return np.log(p / p.sum() / chance)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """From the base spans of the documents whose hash is under a bound that lets about ``SAMPLE_DOCS`` through."""
    base = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("text")).filter("length(text) > 0")
    share = min(1.0, SAMPLE_DOCS / max(1, base.count()))
    some = base.filter(F.pmod(F.xxhash64("i", "text"), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["text"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []                                            # kind 0: a node; 1, 2: a chain or skip pair
        for text in batch.column(0).to_pylist():
            g = graph_of(text, base_spans(text))
            if g:
                rows += [(0, y, f) for y, f in zip(g.labels, g.features)]
                rows += [(kind, g.labels[a] * LABELS + g.labels[b], []) for kind, pairs in ((1, g.chain), (2, g.skip)) for a, b in pairs]
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["kind", "y", "f"])
    seen = map_arrow(some.select("text"), run, "kind int, y int, f array<int>").groupBy("kind", "y", "f").count()
    got = seen.orderBy(F.desc("kind"), F.xxhash64("y", "f")).limit(SAMPLE_ROWS).collect()
    pairs = np.zeros((3, LABELS, LABELS))
    for r in got:
        if r["kind"]:
            pairs[r["kind"], r["y"] // LABELS, r["y"] % LABELS] += r["count"]
    nodes = [r for r in got if r["kind"] == 0]
    weights = fit_nodes([r["f"] for r in nodes], np.array([r["y"] for r in nodes], int), np.array([r["count"] for r in nodes], float))
    share = np.bincount([r["y"] for r in nodes], [r["count"] for r in nodes], LABELS) + 1.0
    share /= share.sum()
    return Model(weights, association(pairs[1], share, 10.0, 0.0), association(pairs[2], share, 50.0, AGREE))


# ---- inference -----------------------------------------------------------------------------------------------------

def marginals(node: np.ndarray, edges: np.ndarray, tables: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Sum-product with all messages at once: ``node`` (n x labels) and ``tables`` (edges x labels x labels) are logarithms. Exact on trees of
    a diameter up to ``rounds``."""
    tail, head = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.concatenate([tables, tables.transpose(0, 2, 1)])
    m, turn = len(edges), np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.zeros((2 * m, node.shape[1]))
    for _ in range(rounds if m else 0):
        belief = node.copy()
        np.add.at(belief, head, messages)
        out = (belief[tail] - messages[turn])[:, :, None] + both
        top = out.max(1, keepdims=True)
        new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
        messages = new - new.max(1, keepdims=True)
    belief = node.copy()
    np.add.at(belief, head, messages)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def further(graphs: list[tuple[str, Graph]], model: Model) -> list[list[Span]]:
    """The spans that the field adds to each text's base spans."""
    size = [len(g.spans) for _, g in graphs]
    at = np.cumsum([0] + size)
    feats = [f for _, g in graphs for f in g.features]
    row = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    slot = np.concatenate(feats)
    node = np.stack([np.bincount(row, model.weights[slot, y], len(feats)) for y in range(LABELS)], 1)
    labels = np.concatenate([g.labels for _, g in graphs])
    node[labels > 0] = -CLAMP
    node[labels > 0, labels[labels > 0]] = 0
    edges, tables = [np.zeros((0, 2), int)], [np.zeros((0, LABELS, LABELS))]
    for k, (_, g) in enumerate(graphs):
        for pairs, t in ((g.chain, model.chain), (g.skip, model.skip)):
            if pairs:
                edges.append(np.array(pairs) + at[k])
                tables.append(np.broadcast_to(t, (len(pairs), LABELS, LABELS)))
    p = marginals(node, np.concatenate(edges), np.concatenate(tables))
    best = np.where((p.max(1) >= SURE) & (labels == 0), p.argmax(1), 0)
    out = []
    for k, (text, g) in enumerate(graphs):
        spans: list[Span] = []
        near = set(g.chain)
        for i, y in enumerate(best[at[k]:at[k + 1]].tolist()):
            if y and spans and (i - 1, i) in near and spans[-1][1] == y - 1 and spans[-1][2] == g.spans[i - 1][1]:
                spans[-1] = (spans[-1][0], y - 1, g.spans[i][1])
            elif y:
                spans.append((g.spans[i][0], y - 1, g.spans[i][1]))
        out.append(spans)
    return out


SPANS = "array<struct<start:int,kind:int,end:int>>"


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): base spans and all spans of each row, by start, then kind; positions are code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)             # SLOTS x LABELS numbers
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base = [base_spans(t) if t else [] for t in batch.column(1).to_pylist()]
        spans, open_graphs = [list(b) for b in base], []
        for k, text in enumerate(batch.column(1).to_pylist()):
            if text and (g := graph_of(text, base[k])) and not all(g.labels):
                open_graphs.append((k, text, g))
        if open_graphs:
            for (k, _, _), more in zip(open_graphs, further([x[1:] for x in open_graphs], shared.value)):
                spans[k] = sorted(spans[k] + more)
        rows = [pa.array([[{"start": s, "kind": y, "end": e} for s, y, e in one] for one in x], kind) for x in (base, spans)]
        return pa.record_batch([batch.column(0), *rows], names=["doc_id", "base", "spans"])
    return map_arrow(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run,
                     f"doc_id bigint, base {SPANS}, spans {SPANS}")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole document."""
    docs = table(spark, sf_dir, "documents")
    found = find(docs, train(docs))
    names = F.array(*map(F.lit, KINDS))

    def text(spans: str) -> F.Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))

    def count(k: int) -> F.Column:               # a second parameter of the lambda, even one with a default, would be the position
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
