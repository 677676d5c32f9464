"""Repeated ids with several texts, clashing column names, hot and empty tables, many languages, large scores."""

import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import common, decontaminate, gbdt, jaccard_join, langid, pivot_search, quality, secrets, svm
from tallyspark.llm.common import BATCH_BYTES, by_hash, map_arrow

from .test_operators import DOC, ODD, docs_of, empty

# names that the operators might use for columns of their own
CLASH = ["spans", "blob", "own_blob", "merged", "bad_id", "BAD_KEY", "tkey", "c", "n", "id", "score", "stats", "first", "twice_row", "__id", "__k", "__m", "__b", "a.b"]


def clashing(spark, rows):
    made = [(i, t, len(t or ""), *(f"{name}{k}" for name in CLASH)) for k, (i, t) in enumerate(rows)]
    names = ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame(made, f"doc_id bigint, text string, n_chars bigint, {names}")


def sets_of(rows):
    return [(i, jaccard_join.shingles(jaccard_join.words_of((t or "").encode()))) for i, t in rows]


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def several_texts():
    rng = random.Random(11)
    texts = []
    for g in range(10):
        base = [f"x{g}_{k}" for k in range(40)]
        for _ in range(5):
            w = list(base)
            w[rng.randrange(40)] = f"y{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    rows = ODD + [(rng.randrange(100, 135), t) for t in texts + texts[::3]]
    # one id holds much, under it a copy of another's text and texts of its own
    rows += [(700, texts[0])] * 6 + [(700, f"only here and nowhere else in text number {k}") for k in "abcd"] + [(50, texts[0].upper())]
    return rows


def test_jaccard_join_of_repeated_ids(spark):
    rows = several_texts()
    got = sorted(map(str, map(tuple, jaccard_join.near_duplicates(docs_of(spark, rows)).collect())))
    sets = sets_of(rows)
    label = {i: i for i, _ in sets if i is not None}
    pairs = [(i, j) for i, a in sets for j, b in sets if i is not None and j is not None and i != j and linked(a, b)]
    for _ in label:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    assert got == sorted(str((i, len(s), label.get(i))) for i, s in sets)
    assert label[700] == label[50] == 50


def test_keep_one_judges_each_row_by_its_text(spark):
    rows = several_texts()
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one(clashing(spark, rows)).collect()]
    sets = sets_of(rows)
    group = list(range(len(rows)))
    while True:
        before = list(group)
        for i, (x, a) in enumerate(sets):
            for j, (y, b) in enumerate(sets):
                if x is not None and y is not None and linked(a, b):
                    group[i] = group[j] = min(group[i], group[j])
        if group == before:
            break
    want = [(rows[k][0], rows[k][1]) for k in range(len(rows)) if rows[k][0] is None or not sets[k][1]]
    for g in set(group):
        members = [k for k in range(len(rows)) if group[k] == g and rows[k][0] is not None and sets[k][1]]
        if members:
            low = min(rows[k][0] for k in members)
            of = {rows[k] for k in members if rows[k][0] == low}
            one = [r for r in kept if r in of]
            assert len(one) == 1 and not [r for r in kept if r in {rows[k] for k in members} - of]
            want += one
    assert sorted(map(str, kept)) == sorted(map(str, want))
    assert sum(i == 700 for i, _ in kept) == 4
    assert jaccard_join.keep_one(empty(spark)).count() == 0


def test_stages_keep_every_column(spark):
    rows = ODD + [(10, "password=abcdefgh and more"), (11, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (12, "x")]
    docs = clashing(spark, rows)
    items = spark.createDataFrame([(1, rows[-2][1])], "item_id bigint, text string")
    labels = spark.createDataFrame([(10, 1), (11, 0)], "doc_id bigint, quality int")
    full = {(r["doc_id"], r["text"], *r[3:]) for r in docs.collect()}
    for stage, gone in ((lambda d: quality.keep_good(d, labels), None), (jaccard_join.keep_one, {(4, "twice the same")}),
                        (lambda d: decontaminate.drop_contaminated(d, items), {rows[-2]}), (secrets.mask, set())):
        out = stage(docs)
        assert out.columns == docs.columns
        got = [(r["doc_id"], r["text"], *r[3:]) for r in out.collect()]
        if stage is secrets.mask:
            assert {g[2:] for g in got} == {f[2:] for f in full} and len(got) == len(rows)
            assert [g[1] for g in got if g[0] == 10] == ["[SECRET] and more"]
        else:
            assert set(got) <= full and len(got) == len(set(got))
            if gone is not None:
                assert len(rows) - len(got) == 1 and {f[:2] for f in full - set(got)} == gone
        assert stage(empty(spark)).count() == 0


def test_sample_by_hash_does_not_depend_on_partitions(spark):
    df = spark.range(40_000).selectExpr("id", "xxhash64(id) AS h")
    want = sorted((r["h"], r["id"]) for r in df.collect())[:700]
    for n in (1, 17):
        assert [(r["h"], r["id"]) for r in by_hash(df.repartition(n), "h", 700, "id").collect()] == want
    assert by_hash(df.limit(5), "h", 700).count() == 5 and by_hash(df.limit(0), "h", 700).count() == 0


def test_scores_past_the_doubles_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(x) for x in rng.integers(-2**21, 2**21, 6)]) for k in range(120)]
    rows += [(200, [2.0**20, 1 / 256, 0.0, 0.0, 0.0, 0.0]), (201, [2.0**20, 2 / 256, 0.0, 0.0, 0.0, 0.0]), (250, [2.0**20, 1 / 256, 0.0, 0.0, 0.0, 0.0])]
    got = pivot_search.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), pivot_search.F.col("vec_id") % 50 == 0).collect()
    whole = {i: [int(256 * x) for x in v] for i, v in rows}
    for q in (0, 50, 100, 200, 250):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == best
        assert max(-s for s, _ in best) > 2**53


def test_every_language_is_learnt(spark):
    rng = random.Random(2)
    langs = [f"q{k:03d}" for k in range(220)]
    stock = {n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(6)] for n in langs}
    rows = [(k * len(langs) + j, " ".join(rng.choice(stock[n]) for _ in range(30)), n) for k in range(5) for j, n in enumerate(langs)]
    docs = spark.createDataFrame([(i, t, n, "s", 0, 0.0) for i, t, n in rows], DOC)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    learnt = {n for i, _, n in rows if crc32(str(i).encode()) % 3 != 1}
    assert len(learnt) > 200 and set(got.values()) == learnt
    assert all(got[i] == n for i, _, n in rows if crc32(str(i).encode()) % 3 != 1)
    assert sum(got[i] == n for i, _, n in rows) > 0.95 * len(rows)


def test_language_of_no_and_of_one_training_language(spark):
    none = spark.createDataFrame([(k, "some words", None, "s", 0, 0.0) for k in range(9)], DOC)
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(none).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([(k, "some words" if k else "...", "en", "s", 0, 0.0) for k in range(9)], DOC)
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(one).collect()} == {("en", 1.0), ("und", 0.0)}
    # equal texts under two languages: the same prediction for all, whatever it is
    tie = spark.createDataFrame([(k, "same words here", "en" if k % 2 else "de", "s", 0, 0.0) for k in range(20)], DOC)
    assert len({r["lang_pred"] for r in langid.identify(tie).collect()}) == 1


def test_unlisted_languages_join_the_family_that_is_most_alike():
    rng = np.random.default_rng(0)
    base = rng.standard_normal((3, 40)) * 3
    x = np.concatenate([base[0] + rng.standard_normal((20, 40)), base[0] + rng.standard_normal((20, 40)), base[1] + rng.standard_normal((20, 40)),
                        base[2] + rng.standard_normal((20, 40))])
    lang = np.repeat(["en", "xx", "fr", "zz"], 20)
    assert langid.families(["en", "fr", "xx", "zz"], x, lang) == {"en": "germanic", "fr": "romance", "xx": "germanic", "zz": "zz"}


def test_machines_fitted_together_equal_single_ones():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 12)).astype(np.float32)
    y = np.sign(x @ rng.standard_normal((12, 3)) + 0.1)
    w, b = svm.fit_each(x, y, np.ones_like(y))
    for k in range(3):
        one, c = svm.fit(x, y[:, k])
        assert np.allclose(w[:, k], one, atol=1e-3) and abs(b[k] - c) < 1e-3


def test_pair_votes_recomputed():
    rng = np.random.default_rng(3)
    langs = ["de", "en", "nl", "fr", "it"]
    x = np.concatenate([rng.standard_normal((30, 50)) + 2 * rng.standard_normal(50) for _ in langs]).astype(np.float32)
    m = langid.Model(x, np.repeat(langs, 30))
    for row, name in zip(x, m.predict(x)[0]):
        f = max(range(len(m.families)), key=lambda k: row @ m.of_family[k][0] + m.of_family[k][1])
        votes = {n: [0, 0.0] for n in m.members[m.families[f]]}
        for a, b, w, c in m.pairs[m.families[f]]:
            s = float(row @ w + c)
            votes[a if s > 0 else b][0] += 1
            votes[a][1] += np.tanh(s)
            votes[b][1] -= np.tanh(s)
        assert name == max(votes, key=lambda n: votes[n])


def test_forest_equals_a_walk_of_each_tree():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 4)).round(1)
    f = gbdt.fit(x, (x[:, 0] * x[:, 1] > 0.2).astype(float))
    for row, got in zip(x[:80], f.score(x[:80])):
        total = f.bias
        for node in f.roots:
            while f.feature[node] >= 0:
                node = f.left[node] if row[f.feature[node]] <= f.threshold[node] else f.right[node]
            total += f.value[node]
        assert abs(got - 1 / (1 + np.exp(-total))) < 1e-9


@pytest.mark.parametrize("operator", [decontaminate, jaccard_join])
def test_whole_texts_go_to_python_in_small_batches(spark, operator, monkeypatch):
    """What an operator writes on the way is made from batches of bounded bytes; the session's own bound is kept for the rest."""
    bound, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, written = spark.conf.get(bound), operator.written

    def sizes(batch):
        return pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    def watched(df, name):
        if not seen:
            seen.extend(r["n"] for r in map_arrow(docs.select("text"), sizes, "n bigint").collect())
        return written(df, name)
    monkeypatch.setattr(operator, "written", watched)
    docs = spark.range(0, 90, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat(concat(id, ' '), 60000)").alias("text"))
    if operator is decontaminate:
        operator.contamination(docs, spark.createDataFrame([(1, "a b c")], "item_id bigint, text string"))
    else:
        operator.linked_sets(docs)
    assert sum(seen) > 2 * BATCH_BYTES and max(seen) < BATCH_BYTES + 300_000
    assert spark.conf.get(bound) == before


def shuffle_files(spark):
    jvm = spark._jvm
    disk = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()) if f.getName().startswith("shuffle_")}


def test_jaccard_join_leaves_no_shuffle_files(spark):
    """Each query's shuffle files go when it ends, not when the driver's JVM collects its garbage."""
    words = [f"w{k}" for k in range(40)]
    docs = docs_of(spark, [(i, " ".join(words[:30 + i % 5] + [f"x{i}"])) for i in range(20)])
    cleanup, before = common._CLEANUP, shuffle_files(spark)
    was = spark.conf.get(cleanup)
    jaccard_join.linked_sets(docs)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(cleanup) == was


def test_rounds_end_when_few_open_sets_link():
    """Sets that share a passage are open in each round; the few links of a round are measured against them, too."""
    assert jaccard_join.goes_on(found=5104, asked=5365, sets=5910)
    assert jaccard_join.goes_on(found=2, asked=3, sets=10)
    assert not jaccard_join.goes_on(found=75, asked=117, sets=5910)
    assert not jaccard_join.goes_on(found=100, asked=5000, sets=1000)


def test_largest_reads_each_set_once(spark):
    sets = spark.createDataFrame([(1, 10), (2, 70), (3, 90)], "id long, n long")
    rows = spark.createDataFrame([(i, k) for i in (1, 2) for k in range(50)], "id long, key long")
    assert jaccard_join.largest(rows, sets) == 70
    assert jaccard_join.largest(rows.filter("id > 5"), sets) is None


def test_bitmap_comes_to_the_driver_in_columns(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "toPandas", None)
    hashes = np.array([5, 1 << 60, -7, 1 << 40], np.int64)
    df = spark.createDataFrame([(int(h),) for h in hashes], "h long")
    words = common.hash_bitmap(df, "h", 16)
    assert common.in_bitmap(words, hashes.view(np.uint64)).all()
    assert sum(int(w).bit_count() for w in words) == len(set((hashes.view(np.uint64) >> np.uint64(48)).tolist()))
    assert not common.hash_bitmap(df.limit(0), "h", 16).any()
