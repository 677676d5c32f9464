"""Each corpus operator on small hand-made tables with odd rows, against a plain recomputation."""

import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallyspark.llm import (byte_bpe, decontaminate, gbdt, jaccard_join, langid, language_model,
                            pivot_search, quality, secrets, toxicity, url_filter)
from tallyspark.llm.components import components

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double"
ODD = [(1, None), (2, ""), (3, "   \n\t"), (None, "no id here"), (4, "twice the same"), (4, "twice the same"),
       (5, "é 漢字 😀 a b"), (6, "word " * 30_000)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.0) for i, t in rows], DOC)


def empty(spark):
    return spark.createDataFrame([], DOC)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_byte_bpe_equals_tiktoken(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    rows = ODD + [(100 + k, "".join(rng.choice("abc thé'rs \n\t0１९½漢😀\x85\x1c=#") for _ in range(60))) for k in range(60)]
    rows += [(900, "<|endoftext|> a" * 3), (901, "a" * 5000), (902, "=" * 777)]
    got = byte_bpe.encode(docs_of(spark, rows), path).collect()
    want = sorted((str(i), ref.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
    assert sorted(bytes(r["decoded"]) for r in got) == sorted((t or "").encode() for _, t in rows)
    assert byte_bpe.encode(empty(spark), path).count() == 0


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(12)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(1, text(20)), (2, "Short ITEM"), (3, text(13)), (3, text(13)), (4, None), (5, "..."), (None, "w1 w2")]
    rows = ODD + [(10 + k, " ".join([text(9), rng.choice(items)[1] or "", text(rng.choice([0, 300]))])) for k in range(40)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in
           decontaminate.contamination(docs_of(spark, rows), bench).collect()}
    want = set()
    for i, t in rows:
        w, hit, ids = plain_words(t), set(), set()
        for item, it in items:
            iw = plain_words(it)
            n = min(13, len(iw))
            wins = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)} if iw and item is not None else set()
            for k in range(len(w) - n + 1 if wins else 0):
                if tuple(w[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    ids.add(str(item))
        want.add((i, len(w), len(hit), tuple(sorted(ids))))
    assert got == want
    assert decontaminate.contamination(docs_of(spark, ODD), bench.limit(0)).count() == len(ODD)
    assert decontaminate.contamination(empty(spark), bench).count() == 0


def test_jaccard_join_equals_brute_force(spark):
    rng = random.Random(7)
    boiler = [f"b{k}" for k in range(60)]
    rows = list(ODD)
    for g in range(14):
        base = [f"x{g}_{k}" for k in range(rng.choice([1, 4, 6, 9, 12, 20, 45, 150, 400]))]
        for c in range(6):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 12)):
                w[rng.randrange(len(w))] = f"y{rng.randrange(10**6)}"
            rows.append((100 + 10 * g + c, " ".join(w)))
    rows += [(500 + k, " ".join(boiler + [f"z{k}_{j}" for j in range(8 + k)])) for k in range(30)]
    rows += [(700 + k, " ".join(boiler)) for k in range(9)] + [(800, "A b C d E f"), (801, "a B c D e F")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs_of(spark, rows)).collect()}
    sets = [(i, jaccard_join.shingles(jaccard_join.words_of((t or "").encode()))) for i, t in rows]
    label = {i: i for i, _ in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for i, a in sets:
            for j, b in sets:
                if i is not None and j is not None and i != j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                    low = min(label[i], label[j])
                    changed |= label[i] != low or label[j] != low
                    label[i] = label[j] = low
    assert got == {(i, len(s), label.get(i)) for i, s in sets}


@pytest.mark.parametrize("n", [4, 5, 7, 8, 12, 15])
def test_small_sets_find_every_partner(n):
    """A small set's segments, up to one missing shingle, are credits enough or all are compared."""
    band = jaccard_join.band_of(n)
    assert 2 * jaccard_join.segments_in(band) > n // 4
    h = np.sort(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
    sizes, keys, of, rest = jaccard_join.with_rests(h, band)
    assert sizes.sum() == n and len(rest) == n
    for k in range(n):                                     # a one-deletion key is the key of the smaller set
        _, other, _, _ = jaccard_join.with_rests(np.delete(h, k), band)
        assert other[of[k]] == rest[k]


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 90: 90, 95: 90, 100: 90}


def test_secret_spans_equal_finditer(spark):
    rows = ODD + [(10, 'x password="abcdefgh1" Token: short token: abcdefgh9 AKIAABCDEFGHIJKL12'),
                  (11, "é😀 api_key=AAAAbbbb token=token=abcdefgh deadbeef" + "0a" * 20 + " AKIAshort"),
                  (12, "secret=" + "ab" * 20 + "\nPASSWD : 'Zz/+_.=-9'")]
    found, added = secrets.scan(docs_of(spark, rows))
    want = set()
    for i, t in rows:
        t, spans = t or "", []
        for rank, r in enumerate(secrets.RULES):
            for m in re.finditer(r.pattern, t):
                if not r.value or len(re.search(r.value, m[0])[1]) >= r.least:
                    spans.append((m.start(), rank, m.end(), r.kind))
        want.add((i, tuple(sorted(spans))))
    assert {(r["doc_id"], tuple(map(tuple, r["spans"]))) for r in found.collect()} == want
    # the ledger: nothing unseen, nothing scanned; a new rule version is
    again, more = secrets.scan(docs_of(spark, rows + [(13, "token: abcdefgh")]), added)
    assert more.count() == 1 and again.filter("doc_id = 13").first()["spans"][0]["kind"] == "assign"
    masked = {r["doc_id"]: r for r in secrets.mask(docs_of(spark, rows)).collect()}
    assert masked[10]["text"].startswith("x [SECRET]") and masked[10]["n_chars"] == len(masked[10]["text"])
    assert masked[5]["text"] == ODD[6][1] and secrets.scan(empty(spark))[0].count() == 0


def test_secret_value_is_the_part_after_the_sign(spark):
    texts = ["token=abc", "api_key=1", "token=abcdefgh", "http://x.org/?token=abc&secret=0", "password=x", "PASSWD: 'a=b=c=d='",
             "token=token=abc", "secret = 1234567", "api-key=abcdefgh", 'Api_Key":"====AAAA"', "token=abc token=abcdefgh1"]
    rule = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = {k: [(m.start(), m.end()) for m in rule.finditer(t) if len(m[2]) >= 8] for k, t in enumerate(texts)}
    assert not want[0] and not want[1] and want[2]
    docs = docs_of(spark, list(enumerate(texts)))
    spans = lambda found: {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found.collect()}
    assert spans(secrets.scan(docs)[0]) == want
    # the query's SQL, too
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    got = {r[0]: (r[1], r[5]) for r in con.sql(secrets.ORACLE).fetchall()}
    assert got == {k: (len(v), ",".join(f"assign:{s}:{e}" for s, e in v)) for k, v in want.items()}
    # what an earlier version of the rule put in the ledger does not count
    old = docs.selectExpr("sha2(text, 256) AS blob", "array('assign@1') AS scanned",
                          f"cast(array(struct(0, 0, length(text), 'assign')) AS array<{secrets.SPAN}>) AS spans")
    assert spans(secrets.scan(docs, old)[0]) == want
    masked = {r["doc_id"]: r["text"] for r in secrets.mask(docs).collect()}
    assert masked[0] == "token=abc" and masked[2] == "[SECRET]" and masked[10] == "token=abc [SECRET]"


def test_url_filter(spark):
    urls = [None, "", "no scheme org/", "http://ORG/", "https://a.example.org/es/x", "http://example.org/en/123?x#y",
            "http://example.org", "http://notorg/", "http://x.com/de/", "http://x.com/FR/", "http://b.net/casino/?a=1"]
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")).collect()}
    assert got[0] == got[1] == ("", "", None, "allow") and got[2][0] == ""
    assert got[3] == ("org", "/", "org/", "allow") and got[4][2:] == ("example.org/es/", "block")
    assert got[5] == ("example.org", "/en/123", "example.org/en/1", "block")
    assert got[6] == ("example.org", "", None, "allow") and got[7][2] is None
    assert got[8][2:] == ("com/de/", "block") and got[9][2] is None and got[10][2:] == (None, "block")


def test_pivot_search_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.standard_normal(16).round(2).tolist()) for k in range(300)]
    rows += [(7, rows[9][1]), (400, None), (401, [float("nan")] * 16), (402, [None] + [1.0] * 15), (None, [1.0] * 16), (450, [1.0, 2.0])]
    got = pivot_search.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"),
                             pivot_search.F.col("vec_id") % 50 == 0).collect()
    ok = [(i, np.floor(256 * np.array([*v, *[0.0] * (16 - len(v))]))) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in ok:
        if q % 50 == 0:
            best = sorted((-int(v @ x), i) for i, x in ok if i != q)[:5]
            assert [(-r["score"], r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == best
    assert pivot_search.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), pivot_search.F.lit(True)).count() == 0


def test_gbdt_learns_and_traverses():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((800, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    f = gbdt.fit(x[:500], y[:500])
    assert ((f.score(x[500:]) > 0.5) == y[500:]).mean() > 0.9
    assert np.allclose(gbdt.fit(x[:5], np.ones(5)).score(x[:2]), 0.999)


def test_language_model_gradient_and_normalisation():
    v = language_model.Vocabulary([b"a", b"b", b"c", b""], [5, 4, 3, 2], 20, 7)
    net = v.network()
    streams = np.random.default_rng(0).integers(-1, 4, (6, 3))
    prev, now = np.where(streams[:-1] < 0, 4, streams[:-1]), streams[1:].ravel()
    h0 = np.zeros((3, language_model.HIDDEN), np.float32)

    def loss():
        s, _ = net.steps(prev, h0)
        return float(net.log_probs(s.reshape(-1, language_model.HIDDEN), v.cls[now], v.member[now], v.sizes)[0].sum())
    grads = {k: np.zeros_like(p) for k, p in net.p.items()}
    states, kept = net.steps(prev, h0)
    _, back = net.log_probs(states.reshape(-1, language_model.HIDDEN), v.cls[now], v.member[now], v.sizes, grads)
    net.backward(prev, kept, back.reshape(states.shape), grads)
    for name, at in (("u", (2, 5)), ("x", (1, 3)), ("c", (3, 2)), ("u", (1, 2 * language_model.HIDDEN + 8))):
        net.p[name][at] += 1e-2
        up = loss()
        net.p[name][at] -= 2e-2
        down = loss()
        net.p[name][at] += 1e-2
        assert abs((up - down) / 2e-2 - grads[name][at]) < 0.02 + 0.05 * abs(grads[name][at])
    s = states.reshape(-1, language_model.HIDDEN)[:1]
    total = sum(np.exp(net.log_probs(s, v.cls[[k]], v.member[[k]], v.sizes)[0][0]) for k in (0, 1, 2, 3, -1))
    assert abs(total - 1) < 1e-4


def test_language_model_short_list_is_not_cut():
    short = [b"%d" % k for k in range(language_model.SHORT)]
    v = language_model.Vocabulary(short, [language_model.SHORT - k for k in range(len(short))], 10**6, 10**5)
    assert len(short) >= 1024 and language_model.CLASSES >= 32 and np.count_nonzero(v.sizes) >= 32
    assert v.network().p["u"].shape[0] >= 16 and (v.places(short) >= 0).all()


def test_language_model_learns_the_same_from_any_layout(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(40)))) for k in range(120)] + ODD[:6]
    toks = [w for _, t in rows for w in language_model.tokens_of((t or "").encode())]
    short = sorted(set(toks))
    v = language_model.Vocabulary(short, [toks.count(w) for w in short], len(toks), len(short))
    nets = [language_model.trained(d, v, 150).flat() for d in
            (docs_of(spark, rows).repartition(1), docs_of(spark, rows[::-1]).repartition(7, "text"))]
    assert np.array_equal(*nets) and not np.array_equal(nets[0], v.network().flat())
    base = language_model.F.lit(True)
    one, many = ({(r["doc_id"], r["n_tokens"], round(r["score"], 3)) for r in language_model.log_likelihood(docs_of(spark, rows).repartition(n), base).collect()}
                 for n in (1, 9))
    assert one == many


@pytest.mark.parametrize("n", [1, 3, 700, 5000, 600_000])
def test_language_model_streams_predict_every_token_once(n):
    flat = np.append(-7, np.arange(n))                     # a document's mark, then tokens that all differ
    streams = language_model.streams_of(flat, -7)
    prev, now = streams[:-1].T.ravel(), streams[1:].T.ravel()
    assert sorted(now[now != -7].tolist()) == list(range(n))
    assert all(p == t - 1 or t == 0 and p == -7 for p, t in zip(prev, now) if t != -7)
    assert streams.shape[1] <= language_model.STREAMS and len(streams) > min(n, language_model.UPDATES * language_model.WINDOW)


def test_language_model_counts(spark):
    rows = ODD + [(k, f"Alpha beta gamma{k}") for k in range(20, 60)]
    got = language_model.log_likelihood(docs_of(spark, rows), language_model.F.col("doc_id") < 40).collect()
    train = [language_model.tokens_of((t or "").encode()) for i, t in rows if i is not None and i < 40]
    flat = [w for d in train for w in d]
    for r in got:
        assert r["train_tokens"] == len(flat)
        if r["doc_id"] == 45:
            want = sum(np.log10((flat.count(w) + 1) / (len(flat) + len(set(flat)) + 1)) for w in (b"alpha", b"beta", b"gamma45", b""))
            assert (r["n_tokens"], r["n_known"]) == (4, 3) and abs(r["base_score"] - want) < 1e-9
    assert len(got) == len(rows) and all(r["score"] < 0 for r in got)
    assert language_model.log_likelihood(empty(spark), language_model.F.lit(True)).count() == 0


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_classifiers_on_held_out_labels(spark, name):
    d = "/root/testdata/sf0.01"
    run = {"quality": quality.op7_quality, "toxic": toxicity.op2_toxicity}[name]
    got = run(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    y, p = got[name].to_numpy(), got["predicted"].to_numpy()
    assert p[y == 1].mean() > (0.95 if name == "quality" else 0.5) and p[y == 0].mean() < 0.25


def test_classifiers_on_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(4, 1, 0), (4, None, 1), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    for labels in (none, one):
        for out in (quality.scored(docs_of(spark, ODD), labels), toxicity.scored(docs_of(spark, ODD), labels)):
            assert all(0 <= r["score"] <= 1 for r in out.collect()) and out.count() == len(ODD)
    assert quality.scored(empty(spark), none).count() == toxicity.scored(empty(spark), none).count() == 0


def test_toxicity_kernel():
    k = toxicity.kernel(["^idiot$", "^i.d-iot$", "^thanour$"], ["^idiot$"])[:, 0]
    assert abs(k[0] - 1) < 1e-5 and k[0] > k[1] > 0.3 > k[2]
    assert "idiot" in toxicity.units("you I D I O T!")or "idiot!" in toxicity.units("you I D I O T!") or "idiot" in toxicity.units("an i d i o t here")


def test_toxicity_kernel_reads_its_sums_in_blocks(monkeypatch):
    """Equal to the sum over all pairs of subsequences; strings come to the kernel in blocks, so that its sums stay in the cache."""
    from itertools import combinations
    lam, sizes, plain = toxicity.LAMBDA, [], toxicity.common_weight

    def weight(a, b):
        subs = [[("".join(s[i] for i in c), c[2] - c[0] + 1) for c in combinations(range(len(s)), 3)] for s in (a, b)]
        return sum(lam ** (m + n) for u, m in subs[0] for v, n in subs[1] if u == v)
    words, marks = ["^idiot$", "^i.d-iot$", "^a$", "^dodo$"], ["^idiot$", "^todo$"]
    want = [[weight(w, m) / (weight(w, w) * weight(m, m)) ** 0.5 for m in marks] for w in words]
    assert np.allclose(toxicity.kernel(words, marks), want, atol=1e-5)
    monkeypatch.setattr(toxicity, "common_weight", lambda x, y: sizes.append(len(x) * y.shape[1]) or plain(x, y))
    assert np.allclose(toxicity.kernel(words * 200, marks), want * 200, atol=1e-5)
    assert max(sizes) <= 512


def test_toxicity_filter_lets_bent_forms_through():
    m = toxicity.Model(["^idiot$", "^trash$"], ["^there$"])
    bent = ["t..r..a..s..h", "i..d..i..o..t", "you-idiot-go-away-now", "youaresuchanidiotsogoawaynow", "you_trash_you", "idot", "idiiot"]
    assert all(m.near(toxicity.pieces(u)).any() for u in bent) and not m.near(toxicity.pieces("wonderful")).any()
    m.w[:2] = 1.0
    seen = (set(), {})
    first, again = (toxicity.text_margins(m, seen, [*bent, "a wonderful day", None]) for _ in range(2))
    assert np.array_equal(first, again) and (first[:-2] > -2).all() and (first[-2:] == -2).all()
    assert len(toxicity.pieces("x" * 5000)) < 10 and toxicity.pieces("idiot") == ["^idiot$"]


def test_language_identification(spark):
    got = {r["doc_id"]: r for r in langid.identify(docs_of(spark, ODD)).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[4]["lang_pred"] == "en"
    assert langid.identify(empty(spark)).count() == 0
    d = "/root/testdata/sf0.01"
    held = langid.op4_langid(spark, d).filter("held_out").join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count()
