"""Personal data, phrases and ranked search on small tables with odd rows, against plain recomputations."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyspark.llm import collocations, lexical_search, personal_data

from .test_operators import ODD, docs_of, empty


def clashing(df):
    """Extra columns with names that the operators use themselves."""
    from pyspark.sql import functions as F
    for c in ("id", "n", "rank", "g", "chunk", "spans", "term"):
        df = df.withColumn(c, F.lit("x"))
    return df


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- op11

def plain_base(text):
    digits = lambda t: re.sub("[^0-9]", "", t)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


PII = ["mail a.b@c.de, x@y, p@q@r.st and a@b.c@d.e", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.4 1..2.3.4.5", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
       "+1 (268) 555-9530 +49 30 1234567890123456 ++4912345678901 +1(((", "é +33 1 23 45 67 89 漢 u@h.x", "0" * 30 + " 12 " * 9, "a" * 50 + "@" * 9 + "b.c"]


def test_base_spans_equal_finditer():
    rng = random.Random(2)
    texts = PII + ["".join(rng.choice("a1.@+- ()4é\n") for _ in range(80)) for _ in range(400)]
    for t in texts:
        assert personal_data.base_spans(t) == plain_base(t), t


def test_base_spans_are_linear_in_the_text():
    for t in ("1" * 400_000, "a" * 400_000, "+" * 200_000, "1.2." * 100_000, "a@" * 200_000, "+1((((" * 60_000):
        g = personal_data.graph_of(t, personal_data.base_spans(t))
        assert g is None or len(g.spans) >= 1


def brute_marginals(node, edges, tables):
    n, k = node.shape
    total = np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        p = math.exp(sum(node[i, y[i]] for i in range(n)) + sum(t[y[a], y[b]] for (a, b), t in zip(edges, tables)))
        for i in range(n):
            total[i, y[i]] += p
    return total / total.sum(1, keepdims=True)


def test_messages_are_exact_on_trees_and_agree_on_loops():
    rng = np.random.default_rng(4)
    for edges, exact in (([(0, 1), (1, 2), (1, 3), (3, 4)], True), ([(0, 1), (1, 2), (2, 3), (0, 3)], False)):
        node = rng.normal(size=(5, 3))
        tables = rng.normal(size=(len(edges), 3, 3)) * (1.0 if exact else 0.5)
        got, want = personal_data.marginals(node, np.array(edges), tables, 12), brute_marginals(node, edges, tables)
        assert np.allclose(got, want, atol=1e-9 if exact else 0.08)


def trained(spark):
    rng = random.Random(6)
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    forms = [lambda: f"w{rng.choice('abc')}.{num(2)}@mail{num(1)}.example.com", lambda: f"{rng.randrange(256)}.{rng.randrange(256)}.7.{rng.randrange(256)}",
             lambda: f"+1 ({num(3)}) 555-{num(4)}", lambda: "4111111111111111", lambda: num(4), lambda: num(16)]
    rows = [(k, " ".join(["some words"] + [f() + " and more" for f in rng.choices(forms, k=6)])) for k in range(300)]
    return personal_data.train(docs_of(spark, rows))


def test_personal_data_spreads_labels_over_a_document(spark):
    model = trained(spark)
    text = "Write to maria.lopez@mail.example.com now. Card 4111 1111 1111 1111 or 4111111111111111; later maria.lopez paid by 4111.1111.1111.1111."
    rows = ODD + [(10, text), (11, "maria.lopez paid by 4111.1111.1111.1111."), (12, "in 2024 some 500 of 12345")] + [(20 + k, t) for k, t in enumerate(PII)]
    got = personal_data.find(clashing(docs_of(spark, rows)), model).collect()
    assert sorted((str(r["doc_id"]), [tuple(s) for s in r["base"]]) for r in got) == sorted((str(i), plain_base(t or "")) for i, t in rows)
    for r in got:
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]} and list(r["spans"]) == sorted(r["spans"])
    found = {r["doc_id"]: [text[s["start"]:s["end"]] for s in r["spans"] if s not in r["base"]] for r in got}
    assert found[10] == ["maria.lopez", "4111.1111.1111.1111"] and not found[12] and "maria.lopez" not in str(found[11])
    assert personal_data.find(empty(spark), personal_data.train(empty(spark))).count() == 0


def test_personal_data_query_equals_its_contract(spark, tmp_path):
    rows = ODD + [(100 + k, t) for k, t in enumerate(PII)] + [(200, " a@b.co ".join(PII)), (200, "1.2.3.4 5.6.7.8 9.8.7.6 x@y.zz")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = personal_data.op11_personal_data(spark, str(tmp_path))
    want = []
    for i, t in rows:
        spans = plain_base(t or "")
        listed = ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        want.append((i, *(sum(k == kind for _, kind, _ in spans) for k in range(4)), hashlib.sha256(listed.encode()).hexdigest()))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert sorted(str(tuple(r)[:6]) for r in got.collect()) == sorted(map(str, want))


# ---- op12

def plain_phrases(rows, least, longest, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in cand.items():
            if any(len(h) > len(g) and b >= a and any(h[i:i + len(g)] == g for i in range(len(h))) for h, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("chunk", [60, 1 << 21])
def test_phrases_equal_brute_force(spark, chunk, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "SHARD", 64)
    rng = random.Random(9)
    words = ["A", "b", "ab", "é", "b\x01", "x\xa0y", "漢", "'s"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "; "]) for _ in range(rng.choice([3, 40])))
    rows = [(rng.choice(["en", "en", None, "und", "fr"]), text()) for _ in range(50)]
    rows += [("en", "one two three four five six " * 3)] * 5 + [("en", None), ("xx", ""), ("de", "a a a a a a a a a"), (None, "only")]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("doc_id", F.lit(None).cast("bigint"))
    for least, top in ((3, 1000), (4, 5)):
        got = sorted(map(tuple, collocations.collocations(clashing(df), least, 5, top).collect()))
        assert got == plain_phrases(rows, least, 5, top)
    assert collocations.collocations(df.limit(0), 3, 5, 5).count() == 0
    assert collocations.collocations(df, 10 ** 6).count() == 0


@pytest.mark.parametrize("bits", [3, 13, 21, 25, 32, 38])
def test_filters_are_lossless(bits):
    rng = np.random.default_rng(bits)
    for n in range(2, 6):
        ids = rng.integers(1, 1 << bits, (500, n))
        ids[250:] = ids[:250]
        lay = collocations.Layout(n, bits, 3)
        keys, counts = collocations.summed(lay.keys(ids))
        want = Counter(map(tuple, ids.tolist()))
        got = {}
        for shard, blob in lay.split(keys, counts * 200):
            again, c = lay.decode(blob)
            twice, sums = lay.merge([blob, blob, lay.encode(again, c)])
            assert (lay.shards(again) == shard).all() and (sums == 3 * c).all() and all((x == y).all() for x, y in zip(twice, again))
            got |= dict(zip(map(tuple, lay.words(again).tolist()), (c // 200).tolist()))
        assert got == dict(want)


# ---- op13

def plain_ranking(docs, items, top):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    rows = [(i, Counter(find(t))) for i, t in docs]
    rows = [r for r in rows if r[1]]
    n, total = len(rows), sum(c.total() for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    asked = defaultdict(Counter)
    for i, t in items:
        if i is not None:
            asked[i].update(find(t))
    out = []
    for item, q in asked.items():
        scores = []
        for i, c in rows:
            m = 75 + 25 * c.total() * n // total
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in q.items() if t in c)
            if s and i is not None:
                scores.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("known", [1 << 20, 3])
def test_ranking_equals_brute_force(spark, known, monkeypatch):
    for name, value in (("VOCABULARY", known), ("BLOCK", 64), ("BATCH_ITEMS", 5), ("FAN", 3), ("SLICE", 2)):
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(11)
    words = [f"w{k}" for k in range(30)] + ["É", "é", "X-y", "漢字"]
    text = lambda n: " ".join(rng.choice(words[:rng.choice([5, 34])]) for _ in range(n))
    docs = ODD + [(100 + k, text(rng.choice([1, 5, 60]))) for k in range(260)] + [(500 + k, "W1 w2 w3 same copy") for k in range(70)]
    items = [(k, text(rng.choice([1, 4, 20]))) for k in range(17)] + [(3, "w1 w1"), (None, "w2"), (90, None), (91, "?!"), (92, "unseen"), (93, "same copy w1")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = lexical_search.ranked(clashing(docs_of(spark, docs)), clashing(bench), 7)
    assert sorted(map(tuple, got.collect())) == plain_ranking(docs, items, 7)
    if known > 3:
        assert lexical_search.ranked(empty(spark), bench).count() == 0
        assert lexical_search.ranked(docs_of(spark, docs), bench.limit(0)).count() == 0


def test_pruned_nodes_hold_nothing_better():
    """Every document's score stays below the bounds of the nodes above it."""
    rng = np.random.default_rng(1)
    docs, ids = np.repeat(np.arange(100), 6), rng.integers(1, 40, 600)
    pairs = np.unique(np.stack([ids, docs], 1), axis=0)
    block = lexical_search.Block(np.arange(100), pairs[:, 0], pairs[:, 1], rng.integers(1, 1000, len(pairs)))
    asked, weights = np.unique(rng.integers(1, 50, 12)), None
    weights = rng.integers(1, 9, len(asked))
    score = block.levels[0].bounds(asked, weights, np.ones(100, bool))
    for level, size in enumerate(block.sizes):
        bound = block.levels[level].bounds(asked, weights, np.ones(size, bool))
        for d in range(100):
            assert bound[d // lexical_search.FAN ** level] >= score[d]
